"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Examples lie in an inverted index with the largest weight per term and block of
consecutive examples. A query adds these up to a bound for every block, scores
blocks from the highest bound down, and stops when no other block can hold a
nearer example. The votes of the nearest examples, weighted by distance, are
mapped to calibrated scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdin.llm.frames import pinned, text_bytes

#: Labelled rows used per class at most, terms kept at most, and what a term must show to be kept.
EXAMPLES = 4096
TERMS = 2048
LEAST_Z = 6.0
LEAST_SHARE = 0.005
NEIGHBOURS = 15
BLOCK = 64
TOXIC_AT = 0.7
_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def sketch_of(data: bytes) -> int:
    """Smallest hash of the text's three-word shingles: near copies mostly share it, other texts do not."""
    words = data.lower().translate(_LETTERS).split()
    return min((xxhash.xxh64_intdigest(b" ".join(words[k : k + 3])) for k in range(max(1, len(words) - 2))), default=0) >> 1


def terms_of(data: bytes) -> Counter[bytes]:
    """Counts of the lower-case runs of letters (all non-ASCII characters count as letters)."""
    return Counter(data.lower().translate(_LETTERS).split())


@dataclass
class Model:
    """Index of the examples, and the map from votes to scores."""

    terms: dict[bytes, int]
    idf: np.ndarray
    vectors: list[list[tuple[int, float]]]
    names: np.ndarray
    toxic: np.ndarray
    weight: np.ndarray
    base: float
    neighbours: int = NEIGHBOURS
    steps: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    known: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        blocks = max(1, -(-len(self.names) // BLOCK))
        self.highest = np.zeros((len(self.terms), blocks))
        lists: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for name, vector in enumerate(self.vectors):
            for term, value in vector:
                lists[term].append((name, value))
                self.highest[term, name // BLOCK] = max(self.highest[term, name // BLOCK], value)
        self.posted = [np.array([n for n, _ in one], dtype=np.int64) for one in lists]
        self.values = [np.array([v for _, v in one]) for one in lists]
        self.cuts = [np.searchsorted(one, np.arange(blocks + 1) * BLOCK) for one in self.posted]

    def vector(self, counts: Counter[bytes]) -> tuple[tuple[int, int], ...]:
        terms = self.terms
        if len(counts) > len(terms):
            return tuple((k, counts[term]) for term, k in terms.items() if term in counts)
        return tuple(sorted((terms[term], n) for term, n in counts.items() if term in terms))

    def weighted(self, vector: tuple[tuple[int, int], ...]) -> tuple[np.ndarray, np.ndarray]:
        """Terms and their TF-IDF weights, of length one together."""
        term = np.array([t for t, _ in vector], dtype=np.int64)
        value = (1 + np.log([n for _, n in vector])) * self.idf[term]
        return term, value / np.sqrt((value**2).sum())

    def nearest(self, vector: tuple[tuple[int, int], ...], leave: int = -1) -> list[tuple[float, int]]:
        """Cosine and number of the nearest examples with any term in common; equal ones in order of number."""
        term, value = self.weighted(vector)
        bound = value @ self.highest[term]
        best: list[tuple[float, int]] = []
        for block in np.argsort(-bound, kind="stable").tolist():
            if bound[block] <= 0 or len(best) == self.neighbours and bound[block] + 1e-9 < best[-1][0]:
                break
            near = np.zeros(BLOCK)
            for t, v in zip(term.tolist(), value.tolist(), strict=True):
                a, b = self.cuts[t][block], self.cuts[t][block + 1]
                near[self.posted[t][a:b] - block * BLOCK] += v * self.values[t][a:b]
            least = best[-1][0] if len(best) == self.neighbours else 0.0
            place = np.flatnonzero((near > 0) & (near >= least - 1e-12))
            best += [(round(float(near[p]), 12), block * BLOCK + p) for p in place.tolist() if block * BLOCK + p != leave]
            best = sorted(best, key=lambda one: (-one[0], one[1]))[: self.neighbours]
        return best

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Share of the toxic examples, by nearness and class size; the base rate fills missing neighbours."""
        if not near:
            return self.base
        number = np.array([n for _, n in near])
        pull = self.weight[number] / (1.05 - np.array([s for s, _ in near]))
        spare = (self.neighbours - len(near)) * 0.05
        return float(((pull * self.toxic[number]).sum() + spare * self.base) / (pull.sum() + spare))

    def score(self, counts: Counter[bytes]) -> tuple[float, list[int]]:
        """Calibrated score and the ids of the nearest examples."""
        vector = self.vector(counts)
        if vector not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            near = self.nearest(vector) if vector else []
            score = float(np.interp(self.vote(near), *self.steps)) if vector else self.base
            self.known[vector] = min(1.0, max(0.0, score)), [int(self.names[n]) for _, n in near]
        return self.known[vector]

    def calibrate(self, counts: list[tuple[tuple[int, int], ...]]) -> None:
        """Monotone steps from votes to toxic shares, each example judged by the others."""
        votes = np.array([self.vote(self.nearest(vector, leave=k)) for k, vector in enumerate(counts)])
        if len(votes):
            self.steps = monotone(votes, self.toxic, self.weight)


def monotone(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: votes in rising order and the rising toxic shares they stand for."""
    pools: list[list[float]] = []
    for k in np.argsort(votes, kind="stable").tolist():
        pools.append([votes[k], votes[k], weight[k] * toxic[k], weight[k]])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, high, hits, size = pools.pop()
            pools[-1] = [pools[-1][0], high, pools[-1][2] + hits, pools[-1][3] + size]
    x = np.array([v for low, high, _, _ in pools for v in (low, high)])
    y = np.array([hits / size for _, _, hits, size in pools for _ in (0, 1)])
    return x, y


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(labels: DataFrame, most: int = EXAMPLES) -> tuple[DataFrame, dict[int, float]]:
    """Labelled rows to learn from, at most ``most`` of each class, and rows per sampled row of each class.

    One row per document (toxic if any of its rows is). The choice is by a hash of the id.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    numbers = {row[0]: row[1] for row in known.groupBy("toxic").agg(F.count("*")).collect()}  # two rows at most
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [known.where(F.col("toxic") == kind).orderBy(*order).limit(most) for kind in (0, 1)]
    return parts[0].unionByName(parts[1]), {kind: n / min(n, most) for kind, n in numbers.items()}


def fit(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES, terms: int = TERMS, neighbours: int = NEIGHBOURS) -> Model:
    """Index and calibration from a bounded sample of labelled rows.

    At most ``most`` examples of each class are used, and the ``terms`` terms
    whose presence in toxic examples stands out most (``LEAST_Z`` standard
    errors, ``LEAST_SHARE`` of the toxic examples at least; near copies count
    once): vectors over these terms tell insults from the rest of a text. What reaches the driver is
    bounded by these two numbers.
    """
    chosen, worth = sample(labels, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(2))
            counts, sketches = [terms_of(data) for data in texts], pa.array([sketch_of(data) for data in texts], pa.int64())
            words = pa.array([list(c) for c in counts], pa.list_(pa.binary()))
            tfs = pa.array([list(c.values()) for c in counts], pa.list_(pa.int32()))
            columns = [batch.column(0), batch.column(1), sketches, words, tfs]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "toxic", "sketch", "terms", "tf"])

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    joined = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")  # at most 2 * most rows
    examples = pinned(joined.mapInArrow(run, "doc_id long, toxic int, sketch long, terms array<binary>, tf array<int>"))
    sizes = examples.groupBy("toxic").agg(F.count_distinct("sketch").alias("n")).collect()
    n = {row[0]: row[1] for row in sizes}
    total, toxic = sum(n.values()), n.get(1, 0)
    share = toxic / max(1, total)
    z = (F.col("hits") - share * F.col("n")) / F.sqrt(share * (1 - share) * F.col("n"))
    kept = (
        examples.select("toxic", "sketch", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count_distinct("sketch").alias("n"), F.count_distinct(F.when(F.col("toxic") == 1, F.col("sketch"))).alias("hits"))
        .where(F.col("hits") >= max(4.0, LEAST_SHARE * toxic))
        .withColumn("z", z)
        .where(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "term")
        .limit(terms)
        .collect()
    )
    numbers = {bytes(row["term"]): k for k, row in enumerate(kept)}
    idf = np.array([np.log((1 + total) / (1 + row["n"])) + 1 for row in kept])
    listed = F.array(*[F.lit(term) for term in numbers]) if numbers else F.array().cast("array<binary>")
    pairs = F.filter(F.arrays_zip("terms", "tf"), lambda x: F.array_contains(listed, x["terms"]))
    rows = examples.select("doc_id", "toxic", pairs.alias("pairs")).orderBy("doc_id", "toxic").collect()
    worth = [worth.get(0, 1.0), worth.get(1, 1.0)]
    bare = [row["toxic"] for row in rows if not row["pairs"]]
    masses = [worth[kind] * bare.count(kind) for kind in (0, 1)]
    base = (masses[1] + 0.5 * min(1.0, share)) / (sum(masses) + 0.5) if total else 0.5
    full = [row for row in rows if row["pairs"]]
    counts = [tuple(sorted((numbers[bytes(p[0])], p[1]) for p in row["pairs"])) for row in full]
    kinds = np.array([row["toxic"] for row in full], dtype=np.int64)
    model = Model(
        numbers, idf, [], np.array([row["doc_id"] for row in full], dtype=np.int64), kinds, np.array(worth)[kinds], base, neighbours
    )
    vectors = [list(zip(*(part.tolist() for part in model.weighted(vector)), strict=True)) for vector in counts]
    model.vectors = vectors
    model.__post_init__()
    model.calibrate(counts)
    return model


def scored(docs: DataFrame, labels: DataFrame, toxic_at: float = TOXIC_AT, **settings) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score``, ``predicted``, ``nearest`` (ids of the evidence).

    A score depends on the text alone. Texts without a known term, empty and
    null ones included, get the toxic share of such examples. Without labelled
    examples every score is 0.5. Null ids are not held out; labels that are null
    or not 0 or 1 teach nothing. Repeated rows come back as they are; other
    columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, **settings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.value.score(terms_of(data)) for data in text_bytes(batch.column(1))]
            score = pa.array([s for s, _ in found], pa.float64())
            near = pa.array([ids for _, ids in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), score, near], names=["doc_id", "score", "nearest"])

    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, nearest array<long>")
    return out.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxic_at).cast("int").alias("predicted"), "nearest"
    )
