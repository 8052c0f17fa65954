"""Problem 7: offers of the same product grouped by a trained encoder, an inverted-file index and vetoes.

1. Every offer is read into canonical attributes and a name (see ``offers``). Offers that agree on
   both letter by letter are one representative from here on, so the search never sees copies.
2. A subword encoder maps a name to a unit vector: hashed character n-grams, each with a trained
   vector, summed. It is trained contrastively (a name against its misspelt, respaced or partly
   renamed form, other names of the batch as negatives) on at most ``sample`` names.
3. The vectors are put into an inverted file of cells (k-means on the sample; every representative
   is indexed). Each representative probes the nearest cells; their number is tuned on held queries
   until ``recall`` of the neighbours that an exact search over all representatives finds are found
   from both sides. If half of the cells do not suffice, all are probed, which is the exact search
   and by then the cheaper one.
4. Variants are vetoed: candidates must agree in every attribute of their kind (model, storage,
   colour, power, length, ...), which is part of the join key, so vetoed pairs are never made.
   What is left is checked exactly: words of both names that agree but for a slip or a blank
   must hold ``threshold`` of the names' weight, rare words weighing more. Words are counted over all
   representatives; words of less than one in ``RARE`` of them weigh alike.
5. Pairs that find each other, each through its own probes, are edges; connected representatives are
   one product. There is no cap on partners. A cell of a variant that holds very many
   representatives is split over several tasks, and so are nodes with very many edges.

Defined results: null texts are empty; an offer in which no word of a name is found groups only
with offers of exactly the same attributes and no name; an attribute that is named nowhere is
equal only to itself; repeated rows are one product; an empty table gives no groups.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm import offers
from bazaarlens.llm.gazetteer import distance, letters
from bazaarlens.session import cut_lineage, small_side

SLOTS, WIDTH = 1 << 14, 48
#: Words of fewer than one in this many names weigh alike.
RARE = 10_000
#: Representatives of one key in a task of a join, and edges of a node beyond which its label is broadcast.
BLOCK, HUB = 5_000, 10_000


@lru_cache(200_000)
def name_grams(name: str) -> tuple[int, ...]:
    """Hashed pairs, triples and pairs with a gap of the letters of each word."""
    found = [w[i : i + n] for w in name.split(" ") for n in (2, 3) for i in range(len(w) - n + 1)]
    found += [f"{w[i]}_{w[i + 2]}" for w in name.split(" ") for i in range(len(w) - 2)]
    return tuple(crc32(g.encode()) % SLOTS for g in found) or (0,)


@dataclass(frozen=True)
class Encoder:
    """Trained n-gram vectors, the weights of common words, and the weight of all others."""

    vectors: np.ndarray
    common: dict[str, float]
    rare: float

    def encode(self, names: list[str]) -> np.ndarray:
        grams = [name_grams(n) for n in names]
        if not grams:
            return np.zeros((0, WIDTH), dtype=np.float32)
        ends = np.cumsum([len(g) for g in grams])
        sums = np.add.reduceat(self.vectors[np.concatenate([np.asarray(g) for g in grams])], np.concatenate([[0], ends[:-1]]), axis=0)
        return sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)

    def likeness(self, a: str, b: str) -> float:
        """Share of two names' weight in words that agree; long words may differ by a slip, or two if another word agrees, and one word may stand as two."""
        x, y = a.split(), b.split()
        weigh = lambda w: self.common.get(w, self.rare)
        if x and y:
            heavy, total = max(x, key=weigh), sum(map(weigh, x))
            if weigh(heavy) > total - weigh(heavy) and heavy not in y and not _has_partner(heavy, x, y):
                return 1 - weigh(heavy) / total  # at most, as the heaviest word agrees with none
        same = [w for w in x if w in y]
        agreed = total_x = total_y = sum(map(weigh, same))
        left_x, left_y = [w for w in x if w not in same], [w for w in y if w not in same]
        total_x, total_y = total_x + _weight_of(left_x, left_y, weigh), total_y + _weight_of(left_y, left_x, weigh)
        slips = 2 if same else 1
        for w in list(left_x):
            near = next((v for v in left_y if within(w, v, slips)), None)
            if near:
                left_x.remove(w)
                left_y.remove(near)
                agreed += min(weigh(w), weigh(near))
        for whole, parts in ((left_x, left_y), (left_y, left_x)):
            for w in list(whole):
                halves = next(((u, v) for u in parts for v in parts if u != v and within(w, u + v, slips)), None)
                if halves:
                    whole.remove(w)
                    for u in halves:
                        parts.remove(u)
                    agreed += weigh(w)
        whole = max(total_x, total_y)
        return agreed / whole if whole else 1.0


def _weight_of(words: list[str], others: list[str], weigh) -> float:  # noqa: ANN001
    """Weight of words; two that may be one word of the other name weigh as much as that one."""
    if len(words) >= 2:
        for w in others:
            for u in words:
                for v in words:
                    if u != v and len(u) + len(v) >= 6 and abs(len(u) + len(v) - len(w)) <= 1 and within(w, u + v, 1):
                        return weigh(w) + sum(weigh(z) for z in words if z not in (u, v))
    return sum(map(weigh, words))


def _has_partner(word: str, x: list[str], y: list[str]) -> bool:
    """Whether ``word`` of ``x`` can agree with a word of ``y``, as one, as two, or as one half of one."""
    if any(within(word, v, 2) for v in y):
        return True
    if len(y) > 2 and any(within(word, u + v, 2) for u in y for v in y if u != v):
        return True
    return len(x) > 2 and any(within(v, word + u, 2) or within(v, u + word, 2) for u in x if u != word for v in y)


def within(a: str, b: str, slips: int) -> bool:
    """Whether two words of six letters or more differ by at most ``slips`` slips; a slip changes two of the letters that occur at most."""
    return min(len(a), len(b)) >= 6 and abs(len(a) - len(b)) <= slips and (letters(a) ^ letters(b)).bit_count() <= 2 * slips and distance(a, b, slips) <= slips


def _misspell(name: str, rng: np.random.Generator) -> str:
    """One random slip of a typist, one dropped word, or a word written as two."""
    words = name.split(" ")
    if len(words) > 1 and rng.random() < 0.2:
        words.pop(int(rng.integers(len(words))))
        return " ".join(words)
    if rng.random() < 0.1:
        at = max(range(len(words)), key=lambda k: len(words[k]))
        half = len(words[at]) // 2
        return " ".join([*words[:at], words[at][:half], words[at][half:], *words[at + 1 :]]).replace("  ", " ")
    i = int(rng.integers(max(1, len(name) - 1)))
    kind = rng.integers(4)
    if kind == 0:
        return name[:i] + name[i + 1 :]
    if kind == 1:
        return name[:i] + name[i : i + 2][::-1] + name[i + 2 :]
    if kind == 2:
        return name[:i] + name[i : i + 1] + name[i:]
    return name[:i] + "aeiounrst"[int(rng.integers(9))] + name[i + 1 :]


def train(names: list[str], common: dict[str, float], rare: float, steps: int = 160, batch: int = 256, temperature: float = 0.1, rate: float = 0.05, seed: int = 7) -> Encoder:
    """Contrastive training: each name against its misspelt form, the batch's other names as negatives."""
    rng = np.random.default_rng(seed)
    seen = Counter(g for n in names for g in set(name_grams(n)))
    weights = np.full(SLOTS, math.log(1 + max(1, len(names))))
    for g, n in seen.items():
        weights[g] = math.log(1 + len(names) / n)
    vectors = rng.normal(size=(SLOTS, WIDTH)) * weights[:, None] / math.sqrt(WIDTH)
    energy = np.full(SLOTS, 1e-2)

    def bag(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        grams = [name_grams(t) for t in texts]
        lengths = np.array([len(g) for g in grams])
        flat = np.concatenate([np.asarray(g) for g in grams])
        sums = np.add.reduceat(vectors[flat], np.concatenate([[0], np.cumsum(lengths)[:-1]]), axis=0)
        norm = np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        return flat, lengths, sums / norm, norm

    for _ in range(steps if len(names) >= 2 else 0):
        picked = [names[int(i)] for i in rng.choice(len(names), size=min(batch, len(names)), replace=False)]
        left, right = bag(picked), bag([_misspell(n, rng) or n for n in picked])
        logits = left[2] @ right[2].T / temperature
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(p)), np.arange(len(p))] -= 1
        for (flat, lengths, unit, norm), grad in ((left, p @ right[2]), (right, p.T @ left[2])):
            grad = grad / (temperature * len(p))
            grad = np.repeat((grad - unit * (grad * unit).sum(axis=1, keepdims=True)) / norm, lengths, axis=0)
            order = np.argsort(flat, kind="stable")
            touched, starts = np.unique(flat[order], return_index=True)
            total = np.add.reduceat(grad[order], starts, axis=0)
            energy[touched] += (total**2).mean(axis=1)
            vectors[touched] -= rate * total / np.sqrt(energy[touched])[:, None] * weights[touched, None]
    return Encoder(vectors.astype(np.float32), common, rare)


def cells_of(vectors: np.ndarray, cells: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means centres."""
    rng = np.random.default_rng(seed)
    centres = vectors[rng.choice(len(vectors), size=min(cells, len(vectors)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.argmax(vectors @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centres)
    return centres


def read_offers(rows: DataFrame, id_col: str) -> DataFrame:
    """Columns offer, variant (the attributes in one text), name."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            read = [offers.read(*(x if isinstance(x, str) else None for x in r)) for r in zip(batch["title"], batch["description"], batch["params"], strict=True)]
            yield pd.DataFrame({"offer": batch["offer"], "variant": ["|".join(a or "" for a in o.attributes) for o in read], "name": [" ".join(o.name) for o in read]})

    return rows.select(F.col(id_col).alias("offer"), "title", "description", "params").mapInPandas(run, f"offer {kind}, variant string, name string")


@dataclass(frozen=True)
class Index:
    """What the executors need to search: the encoder, the cells' centres and the number of cells to probe."""

    encoder: Encoder
    centres: np.ndarray
    probes: int
    threshold: float


def _ranked_cells(reps: DataFrame, index: Index, most: int) -> DataFrame:
    """``reps`` with the nearest cells of each name, nearest first."""
    shared = reps.sparkSession.sparkContext.broadcast((index.encoder, index.centres))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, centres = shared.value
        for batch in batches:
            near = encoder.encode(batch["name"].tolist()) @ centres.T
            k = min(most, near.shape[1])
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            order = np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, axis=1), axis=1), axis=1)
            yield batch.assign(cells=list(order.astype(np.int32)))

    return reps.mapInPandas(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in reps.schema.fields)}, cells array<int>")


def _same_name(pairs: DataFrame, index: Index) -> DataFrame:
    """``pairs`` (a, b, name_a, name_b) whose names pass the exact check."""
    shared = pairs.sparkSession.sparkContext.broadcast((index.encoder, index.threshold))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, threshold = shared.value
        for batch in batches:
            keep = [encoder.likeness(a, b) >= threshold for a, b in zip(batch["name_a"], batch["name_b"], strict=True)]
            yield batch[keep]

    return pairs.mapInPandas(run, pairs.schema)


def word_weights(reps: DataFrame) -> tuple[dict[str, float], float]:
    """Weights of the words that stand in at least one of ``RARE`` names (so of at most ``RARE`` times a name's words of them), counted over all names, and of all rarer ones."""
    n = reps.count()
    words = reps.select(F.explode(F.array_distinct(F.split("name", " "))).alias("w")).where("w != ''").groupBy("w").agg(F.count("*").alias("c"))
    common = {r["w"]: math.log(1 + n / r["c"]) for r in words.where(F.col("c") * RARE > n).collect()}
    return common, math.log(1 + min(RARE, max(1, n)))


def build_index(reps: DataFrame, sample: int = 20_000, threshold: float = 0.55, recall: float = 0.9995, held: int = 2_000) -> Index:
    """Train on a bounded sample and choose the least number of probes that reaches ``recall`` on held queries; all cells if half of them do not."""
    n = reps.count()
    share = min(1.0, sample / max(1, n))
    drawn = reps.select("name").where(F.pmod(F.xxhash64("name"), F.lit(1_000_000)) < int(share * 1e6) + 1).orderBy(F.xxhash64("name")).limit(sample)
    names = [r[0] for r in drawn.collect()] or [""]
    encoder = train(names, *word_weights(reps))
    centres = cells_of(encoder.encode(names), max(4, round(math.sqrt(max(1, n)))))
    index = Index(encoder, centres, len(centres), threshold)
    # exact neighbours of the held queries: all representatives of the same variant, checked one by one
    queries = cut_lineage(reps.where(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) <= int(1e6 * min(1.0, 1.5 * held / max(1, n)))).orderBy(F.xxhash64("rep")).limit(held).select("rep", "name", "variant"))
    need = _probes_needed(_same_name(_exact_pairs(queries, reps), index), index)
    counts = {r[0]: r[1] for r in need.groupBy("probe").agg(F.count("*")).collect()}  # a row for each cell at most
    total, found = sum(counts.values()), 0
    for probes in range(1, len(centres) // 2 + 1):
        found += counts.get(probes, 0)
        if total and found >= recall * total:
            return Index(encoder, centres, probes, threshold)
    return index


def _probes_needed(pairs: DataFrame, index: Index) -> DataFrame:
    """Column probe: the number of cells that both of a pair must probe to find each other."""
    shared = pairs.sparkSession.sparkContext.broadcast((index.encoder, index.centres))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, centres = shared.value
        for batch in batches:
            a, b = (encoder.encode(batch[f"name_{x}"].tolist()) @ centres.T for x in "ab")
            each = np.arange(len(batch))
            ranks = [(near >= near[each, other.argmax(axis=1)][:, None]).sum(axis=1) for near, other in ((a, b), (b, a))] if len(batch) else [each, each]
            yield pd.DataFrame({"probe": np.maximum(*ranks).astype(np.int32)})

    return pairs.select("name_a", "name_b").mapInPandas(run, "probe int")


def _exact_pairs(queries: DataFrame, reps: DataFrame) -> DataFrame:
    """a, b, name_a, name_b: each query with every other representative of its variant; variants of many representatives are split over several tasks."""
    left = queries.select(F.col("rep").alias("a"), F.col("name").alias("name_a"), "variant")
    right = reps.select(F.col("rep").alias("b"), F.col("name").alias("name_b"), "variant")
    return _salted(left, right, ["variant"], "b").where(F.col("a") != F.col("b")).select("a", "b", "name_a", "name_b")


def _salted(left: DataFrame, right: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """``left`` joined with ``right`` on ``keys``; of keys that more than ``BLOCK`` rows of ``right`` hold, blocks of ``right`` go to different tasks, and ``left`` to all of them."""
    crowded = cut_lineage(right.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > BLOCK).select(*keys, F.ceil(F.col("_n") / BLOCK).cast("long").alias("_salts")))
    if crowded.isEmpty():
        return left.join(right, keys)
    crowded = small_side(crowded)
    one = F.lit(1).cast("long")
    right = right.join(crowded, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce("_salts", one))).drop("_salts")
    left = left.join(crowded, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", one) - 1))).drop("_salts")
    return left.join(right, [*keys, "_salt"])


def edges(reps: DataFrame, index: Index) -> DataFrame:
    """Columns a, b (a < b): representatives of one product that find each other through the index; an index that probes every cell is a join by variant."""
    if index.probes >= len(index.centres):
        pairs = _exact_pairs(reps, reps).where(F.col("a") < F.col("b"))
        return _same_name(pairs, index).select("a", "b")
    ranked = cut_lineage(_ranked_cells(reps, index, index.probes))
    homes = ranked.select(F.col("rep").alias("b"), F.col("name").alias("name_b"), "variant", F.col("cells")[0].alias("cell"), F.col("cells").alias("cells_b"))
    probing = ranked.select(F.col("rep").alias("a"), F.col("name").alias("name_a"), "variant", F.col("cells")[0].alias("home"), F.explode("cells").alias("cell"))
    # b found from a, and a from b: its home is among the cells that b probes
    pairs = _salted(probing, homes, ["variant", "cell"], "b").where((F.col("a") < F.col("b")) & F.array_contains("cells_b", F.col("home")))
    return _same_name(pairs.select("a", "b", "name_a", "name_b"), index).select("a", "b")


def components(nodes: DataFrame, links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Columns rep, product: the least representative that each one is connected to, by minimum labels and pointer jumping.

    Labels of nodes with more than ``HUB`` edges are sent to all tasks, so no task gets all edges of one.
    """
    both = cut_lineage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    degrees = both.groupBy("b").agg(F.count("*").alias("_n"), F.min("a").alias("_least"))
    hubs = cut_lineage(degrees.where(F.col("_n") > HUB).select("b"))
    has_hubs = not hubs.isEmpty()
    if has_hubs:
        both = cut_lineage(both.join(small_side(hubs.withColumn("_hub", F.lit(True))), "b", "left").withColumn("_hub", F.coalesce("_hub", F.lit(False))))
    labels = cut_lineage(degrees.select(F.col("b").alias("rep"), F.least("b", "_least").alias("label")))
    for _ in range(max_rounds):
        named = labels.select(F.col("rep").alias("b"), "label")
        if has_hubs:
            told = both.where(~F.col("_hub")).join(named, "b").select("a", "label").unionByName(both.where("_hub").join(small_side(named.join(small_side(hubs), "b")), "b").select("a", "label"))
        else:
            told = both.join(named, "b").select("a", "label")
        heard = told.groupBy("a").agg(F.min("label").alias("heard"))
        near = labels.join(heard.withColumnRenamed("a", "rep"), "rep").select("rep", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jumped = near.join(labels.select(F.col("rep").alias("label"), F.col("label").alias("further")), "label", "left")
        after = cut_lineage(jumped.select("rep", "old", F.least("label", F.coalesce("further", "label")).alias("label")))
        changed = not after.where(F.col("label") != F.col("old")).isEmpty()
        labels = after.select("rep", "label")
        if not changed:
            return nodes.select("rep").join(labels, "rep", "left").select("rep", F.coalesce("label", "rep").alias("product"))
    raise ArithmeticError(f"components did not stand still within {max_rounds} rounds")


def group_offers(rows: DataFrame, id_col: str, **settings: float) -> DataFrame:
    """Columns offer, product (the least offer of the group) for every offer."""
    read = cut_lineage(read_offers(rows, id_col))
    reps = cut_lineage(read.groupBy("variant", "name").agg(F.min("offer").alias("rep")))
    index = build_index(reps, **settings)
    products = components(reps, edges(reps, index))
    members = read.join(reps, ["variant", "name"]).join(products, "rep")
    return members.select("offer", "product")


def pairs_of_groups(members: DataFrame, block: int = 2_000) -> DataFrame:
    """Columns offer_a, offer_b (offer_a < offer_b) of all pairs within a product; large groups are spread over salts."""
    members = cut_lineage(members.distinct())
    largest = members.groupBy("product").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    salts = 1 + int(largest) // block
    left = members.select("product", F.col("offer").alias("offer_a"), F.pmod(F.xxhash64("offer"), F.lit(salts)).alias("salt"))
    right = members.select("product", F.col("offer").alias("offer_b"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    return left.join(right, ["product", "salt"]).where(F.col("offer_a") < F.col("offer_b")).select("offer_a", "offer_b")


def recall_report(rows: DataFrame, id_col: str, **settings: float) -> DataFrame:
    """One row: links of the queries (representatives divisible by 50) by exact search and through the index, and the probes used."""
    read = cut_lineage(read_offers(rows, id_col))
    reps = cut_lineage(read.groupBy("variant", "name").agg(F.min("offer").alias("rep")))
    index = build_index(reps, **settings)
    queries = reps.where(F.pmod("rep", F.lit(50)) == 0)
    exact = _same_name(_exact_pairs(queries, reps), index).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    found = edges(reps, index).withColumn("found", F.lit(1))
    return exact.join(found, ["a", "b"], "left").agg(F.count("*").alias("exact_links"), F.count("found").alias("found_links"), F.lit(index.probes).alias("probes"))
