"""Problem 10: reading level by smoothed unigram language models, one per level.

The models come from labelled texts: word counts per level, additive smoothing, level priors. They
are fitted on at most ``max_labelled`` labelled documents (a hash sample beyond that), of which every
word counts; every document is then scored whole, row by row, with the model sent to the executors,
whose size the labelled documents bound.

Defined results: a null text, a text without words and a text of which the models know fewer than
``least_words`` words get a null level and null confidence; repeated or disagreeing labels of one document count
by their median (the lower of two); labels outside 1..levels and null labels are ignored; with no
usable label at all every level is null.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlens.session import small_side

_WORD = re.compile(r"[^\W\d_]+")
_MARKUP = re.compile(r"<[^<>]{1,80}>")
_UNSEEN = dict.fromkeys(map(ord, "​‌‍⁠﻿­"))
#: Latin letters that stand for Cyrillic ones of the same look inside Cyrillic words.
_LOOKALIKE = str.maketrans("aceopxykmtbh", "асеорхукмтвн")
_CYRILLIC = re.compile("[а-яё]")
_UNSEEN_ONE = re.compile("[" + "".join(map(chr, _UNSEEN)) + "]")
#: A word of both scripts; only such a word can hold look-alike letters.
_MIXED = re.compile(r"[а-яё][^\W\d_]*?[a-z]|[a-z][^\W\d_]*?[а-яё]")


def words(text: str | None) -> list[str]:
    """Lower-case words of a text, without markup, invisible characters and look-alike letters."""
    if not text:
        return []
    plain = text.isascii()
    if not plain:
        if _UNSEEN_ONE.search(text):
            text = text.translate(_UNSEEN)
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
    if "<" in text:
        text = _MARKUP.sub(" ", text)
    text = text.lower().replace("ё", "е")
    found = _WORD.findall(text)
    if plain or not _MIXED.search(text):
        return found
    return [w.translate(_LOOKALIKE) if not w.isascii() and _CYRILLIC.search(w) else w for w in found]


@dataclass(frozen=True)
class LevelModel:
    """Log-probabilities: ``table`` has a row per word and a column per level."""

    index: dict[str, int]
    table: np.ndarray
    prior: np.ndarray

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log-posterior up to a constant of each text and level, and the number of known words of each text."""
        get = self.index.get
        flat: list[int] = []
        known = np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            at = [k for k in map(get, words(text)) if k is not None]
            known[i] = len(at)
            flat.extend(at)
        total = np.tile(self.prior, (len(texts), 1))
        if flat:
            sums = np.concatenate([np.zeros((1, len(self.prior))), np.cumsum(self.table[np.asarray(flat)], axis=0)])
            ends = np.cumsum(known)
            total += sums[ends] - sums[ends - known]
        return total, known


def document_labels(labels: DataFrame, id_col: str, level_col: str, levels: int) -> DataFrame:
    """One row for each judged document with the lower median of its usable labels."""
    usable = labels.where(F.col(level_col).between(1, levels) & F.col(id_col).isNotNull())
    return usable.groupBy(id_col).agg(F.percentile_approx(level_col, 0.5, 10000).cast("int").alias("_level"))


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", level_col: str = "reading_level", levels: int = 5, smoothing: float = 0.1, max_labelled: int = 200_000) -> LevelModel | None:
    """Fit the level models, or None if there is no labelled text with words."""
    judged = document_labels(labels, id_col, level_col, levels)
    n = judged.count()
    if n > max_labelled:
        judged = judged.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < int(1e6 * max_labelled / n))
    texts = documents.select(id_col, text_col).join(small_side(judged), id_col).select("_level", text_col)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter = Counter()
            for level, text in zip(batch["_level"], batch[text_col], strict=True):
                found = words(text)
                seen.update((w, level) for w in found)
                if found:
                    seen[("", level)] += 1  # documents of the level
            yield pd.DataFrame([(w, int(lv), c) for (w, lv), c in seen.items()], columns=["word", "level", "n"])

    counted = texts.mapInPandas(count, "word string, level int, n long").groupBy("word").pivot("level", list(range(1, levels + 1))).agg(F.sum("n")).na.fill(0)
    names = [str(k) for k in range(1, levels + 1)]
    rows = sorted(counted.collect(), key=lambda r: r["word"])  # words of at most max_labelled texts
    if not rows or rows[0]["word"] != "":
        return None
    docs = np.array([rows[0][k] for k in names], dtype=float)
    counts = np.array([[r[k] for k in names] for r in rows[1:]], dtype=float).reshape(-1, levels)
    with np.errstate(divide="ignore"):
        prior = np.log(docs / docs.sum())
    table = np.log((counts + smoothing) / (counts.sum(axis=0) + smoothing * (len(counts) + 1)))
    return LevelModel({r["word"]: i for i, r in enumerate(rows[1:])}, table, prior)


def assign(documents: DataFrame, model: LevelModel | None, id_col: str = "doc_id", text_col: str = "text", least_words: int = 3) -> DataFrame:
    """Columns id, level (1 easiest), confidence (posterior of that level), expected_level, n_words known."""
    schema = T.StructType([documents.schema[id_col], T.StructField("level", T.IntegerType()), T.StructField("confidence", T.DoubleType()), T.StructField("expected_level", T.DoubleType()), T.StructField("n_words", T.LongType())])
    if model is None:
        return documents.select(id_col, F.lit(None).cast("int").alias("level"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("double").alias("expected_level"), F.lit(0).cast("long").alias("n_words"))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            parts = []
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at : at + 1000]
                score, known = m.score(part[text_col].tolist())
                with np.errstate(invalid="ignore"):
                    p = np.exp(score - score.max(axis=1, keepdims=True))
                    p /= p.sum(axis=1, keepdims=True)
                none = known < least_words
                parts.append(pd.DataFrame({
                    id_col: part[id_col],
                    "level": pd.array(np.where(none, 0, score.argmax(axis=1) + 1), dtype="Int32"),
                    "confidence": p.max(axis=1),
                    "expected_level": p @ np.arange(1, p.shape[1] + 1),
                    "n_words": known,
                }))
                parts[-1].loc[none, ["level", "confidence", "expected_level"]] = None
            if parts:
                yield pd.concat(parts)

    return documents.select(id_col, text_col).mapInPandas(run, schema)


def held_out_accuracy(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", level_col: str = "reading_level", levels: int = 5, folds: int = 5) -> DataFrame:
    """Confusion counts (level, assigned, n) of one hash fold held out from training."""
    fold = F.pmod(F.xxhash64(id_col), F.lit(folds)) == 0
    model = fit(documents, labels.where(~fold), id_col, text_col, level_col, levels)
    judged = document_labels(labels.where(fold), id_col, level_col, levels)
    held = documents.join(small_side(judged), id_col)
    scored = assign(held, model, id_col, text_col).withColumnRenamed("level", "assigned")
    return scored.join(judged, id_col).groupBy(F.col("_level").alias("level"), "assigned").agg(F.count("*").alias("n"))
