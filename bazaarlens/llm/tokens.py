"""Problem 8: byte-level BPE encoding of whole corpora with a public tokenizer.

The merge loop is a rank queue: every merge rank owns a bucket of linked-list positions, a
hierarchical bitmap over the ranks finds the lowest rank that still has positions (find-first-set
on each level), and entries whose pair no longer stands at their position are skipped when met.
A pre-token of n bytes costs O(n) bucket operations, so one word of a million letters is no worse
per byte than a short one. Ids of short chunks are kept in a bounded table per Python worker.

Defined results: a null text and an empty text both give an empty list of ids; lone surrogates
cannot occur in Spark strings; strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the split pattern that belongs to the byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Chunks kept per worker and the longest chunk that is kept: a bound of some 50 MB.
CACHE_ENTRIES, CACHE_CHARS = 200_000, 48
WORD = 64


def tokenizer_dir(path: str | None = None) -> str:
    """Folder of the public vocabularies: the argument, or BAZAARLENS_TOKENIZERS, or the installed package."""
    if path or os.environ.get("BAZAARLENS_TOKENIZERS"):
        return path or os.environ["BAZAARLENS_TOKENIZERS"]
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"


class RankBitmap:
    """A set of ranks below ``size`` as bitmaps over bitmaps; the lowest member is found by one find-first-set per level."""

    def __init__(self, size: int) -> None:
        self.levels: list[list[int]] = []
        while True:
            size = (size + WORD - 1) // WORD
            self.levels.append([0] * size)
            if size <= 1:
                break

    def add(self, rank: int) -> None:
        for level in self.levels:
            word, bit = rank >> 6, 1 << (rank & 63)
            if level[word] & bit:
                return
            level[word] |= bit
            rank = word

    def discard(self, rank: int) -> None:
        for level in self.levels:
            word = rank >> 6
            level[word] &= ~(1 << (rank & 63))
            if level[word]:
                return
            rank = word

    def lowest(self) -> int:
        """The lowest rank, or -1 if there is none."""
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return -1
            at = (at << 6) | ((word & -word).bit_length() - 1)
        return at


class BytePairEncoder:
    """Encoder over a rank file (token bytes in base64 and rank on each line)."""

    def __init__(self, rank_file: str) -> None:
        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
        self.queue = RankBitmap(max(self.ranks.values()) + 1)
        self.split = regex.compile(SPLIT)
        self.edge_space = regex.compile(r"^\s|\s$")
        self.chunks: dict[str, array | None] = {}
        self.pretokens: dict[str, array] = {}

    def merge(self, data: bytes) -> array:
        """Ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return array("i", (whole,))
        n = len(data)
        part: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        buckets: dict[int, list[int]] = {}
        queue = self.queue
        for i in range(n - 1):
            rank = ranks.get(data[i : i + 2])
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    queue.add(rank)
        while (rank := queue.lowest()) >= 0:
            queue.discard(rank)
            for at in sorted(buckets.pop(rank)):
                left = part[at]
                right_at = after[at]
                if left is None or right_at >= n:
                    continue
                pair = left + part[right_at]
                if ranks.get(pair) != rank:
                    continue  # stale: one side has merged with another since
                part[at], part[right_at] = pair, None
                following = after[at] = after[right_at]
                if following < n:
                    before[following] = at
                    new = ranks.get(pair + part[following])
                    if new is not None:
                        if new in buckets:
                            buckets[new].append(at)
                        else:
                            buckets[new] = [at]
                            queue.add(new)
                previous = before[at]
                if previous >= 0:
                    new = ranks.get(part[previous] + pair)
                    if new is not None:
                        if new in buckets:
                            buckets[new].append(previous)
                        else:
                            buckets[new] = [previous]
                            queue.add(new)
        return array("i", (ranks[p] for p in part if p is not None))

    def _split_encode(self, text: str) -> array:
        out = array("i")
        kept = self.pretokens
        for token in self.split.findall(text):
            ids = kept.get(token)
            if ids is None:
                ids = self.merge(token.encode())
                if len(token) <= CACHE_CHARS:
                    if len(kept) >= CACHE_ENTRIES:
                        kept.clear()
                    kept[token] = ids
            out.extend(ids)
        return out

    def chunk(self, text: str) -> array | None:
        """Ids of a stretch without white space at its ends (but for one leading space), or None if it has some."""
        body = text[1:] if text[:1] == " " else text
        if not body or self.edge_space.search(body):
            return None
        return self._split_encode(text)

    def encode_into(self, text: str, out: array) -> None:
        """Append the ids of ``text``.

        A single space before a visible character always opens a pre-token, so a text without other
        white space at chunk ends is the concatenation of its chunks; any other text is split whole.
        """
        if not text:
            return
        kept = self.chunks
        start = len(out)
        lead = ""
        for piece in text.split(" "):
            key = lead + piece
            lead = " "
            try:
                ids = kept[key]
            except KeyError:
                ids = self.chunk(key)
                if len(key) <= CACHE_CHARS:
                    if len(kept) >= CACHE_ENTRIES:
                        kept.clear()
                    kept[key] = ids
            if ids is None:
                del out[start:]
                out.extend(self._split_encode(text))
                return
            out.extend(ids)

    def encode(self, text: str | None) -> list[int]:
        out = array("i")
        self.encode_into(text or "", out)
        return out.tolist()


_ENCODERS: dict[str, BytePairEncoder] = {}


def encoder(name: str = "byte_bpe_50k", folder: str | None = None) -> BytePairEncoder:
    """The worker's encoder for a vocabulary file."""
    path = os.path.join(tokenizer_dir(folder), f"{name}.tiktoken")
    if path not in _ENCODERS:
        _ENCODERS[path] = BytePairEncoder(path)
    return _ENCODERS[path]


def encode_column(df: DataFrame, id_col: str, text_col: str, name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """``id_col`` and ``ids``: the token ids of each row's text. Row-local: no shuffle, whole texts."""
    schema = T.StructType([df.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, folder)
        for batch in batches:
            flat, offsets = array("i"), array("i", (0,))
            for text in batch.column(1).to_pylist():
                if text:
                    enc.encode_into(text, flat)
                offsets.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(memoryview(offsets), pa.int32()), pa.array(memoryview(flat), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], [id_col, "ids"])

    return df.select(id_col, text_col).mapInArrow(run, schema)


def decode_column(encoded: DataFrame, id_col: str, name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """``id_col`` and ``text`` of the rows of :func:`encode_column`; no ids give the empty text."""
    schema = T.StructType([encoded.schema[id_col], T.StructField("text", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = {rank: data for data, rank in encoder(name, folder).ranks.items()}
        for batch in batches:
            texts = [b"".join(map(pieces.__getitem__, ids)).decode() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return encoded.select(id_col, "ids").mapInArrow(run, schema)


def count_column(df: DataFrame, id_col: str, text_col: str, name: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """``id_col`` and ``n_tokens`` of each row's text; null and empty texts have 0."""
    schema = T.StructType([df.schema[id_col], T.StructField("n_tokens", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, folder)
        for batch in batches:
            counts = array("q")
            for text in batch.column(1).to_pylist():
                flat = array("i")
                if text:
                    enc.encode_into(text, flat)
                counts.append(len(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(memoryview(counts), pa.int64())], [id_col, "n_tokens"])

    return df.select(id_col, text_col).mapInArrow(run, schema)


def token_statistics(encoded: DataFrame) -> DataFrame:
    """One row of corpus totals over the result of :func:`encode_column`."""
    n = F.size("ids")
    return encoded.agg(
        F.count("*").alias("documents"),
        F.sum(n).cast("long").alias("tokens"),
        F.max(n).cast("long").alias("longest"),
        F.sum((n == 0).cast("long")).alias("without_tokens"),
    )
