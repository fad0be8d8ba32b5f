"""Benchmark decontamination by the q-gram lemma and banded alignment.

An item of m characters that occurs in a text with at most k edits shares at
least ``m - q + 1 - k q`` of its q-grams with the place, all on diagonals that
span at most k + 1. Bands of 2 (k + 1) diagonals, each overlapping the next by
half, therefore hold that many shared q-grams for every such occurrence. Bands
that reach the number are verified by alignment inside the band. Items shorter than
a q-gram share none; they are searched exactly, all at once, and count where no letter or
digit adjoins them.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdin.llm.frames import keep_rows

Q = 8
ERRORS = 0.1
LEAST_CHARS = 1
BLOCK_CHARS = 4_000_000
PORTION_CHARS = 500_000
SLICE_HITS = 4_000_000
NO_CHAR = 0x110000  # stands between texts and matches nothing
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
SCHEMA = "doc_id long, item_ids array<long>, edits array<int>, starts array<long>, ends array<long>"


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join((text or "").lower().split())


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """64-bit polynomial hashes of all q-grams; ``q`` is a power of two."""
    with np.errstate(over="ignore"):
        value, power, width = codes.astype(np.uint64) + np.uint64(1), _BASE, 1
        while width < q:
            value = value[:-width] * power + value[width:]
            power, width = power * power, width * 2
    return value


def budget(length: int, q: int = Q, errors: float = ERRORS) -> tuple[int, int]:
    """Edits allowed for an item, and the q-grams that its occurrence must share.

    ``errors`` of the length, less where the lemma would promise no shared q-gram.
    """
    edits = int(errors * length)
    edits = max(0, min(edits, (length - q) // q))
    return edits, length - q + 1 - edits * q


def banded(item: np.ndarray, text: np.ndarray, low: int, high: int, edits: int, places: bool = False) -> tuple[int, int, int] | None:
    """Best alignment of the whole item on diagonals ``low`` to ``high``: edits, start and end in the text.

    Null above ``edits``. Row i of the table holds the edits for the item's
    first i characters ending on each diagonal. Places before and after the text
    match nothing. The start is known only with ``places``, which carries along
    where each alignment began.
    """
    width, n = high - low + 1, len(text)
    lane = np.arange(width)
    window = np.full(width + len(item), -1, dtype=np.int64)
    first, last = max(0, low), min(n, low + len(window))
    if first < last:
        window[first - low : last - low] = text[first:last]
    cost, below, begin = np.zeros(width, dtype=np.int64), np.full(width, 1 << 20), lane + low
    for i, char in enumerate(item.tolist()):
        match = cost + (window[i : i + width] != char)
        below[:-1] = cost[1:]  # the item's character has no partner
        best = np.minimum(match, below + 1)
        run = best - lane  # characters of the text without partner, from the left
        cost = np.minimum.accumulate(run) + lane
        if places:
            origin = np.where(match <= below + 1, begin, np.append(begin[1:], 0))
            begin = origin[np.maximum.accumulate(np.where(best == cost, lane, 0))]
        if not i & 7 and cost.min() > edits:
            return None
    end = int(np.argmin(cost))
    if cost[end] > edits:
        return None
    if not places:
        return banded(item, text, low, high, edits, places=True)
    return int(cost[end]), max(0, int(begin[end])), min(n, len(item) + low + end)


class Index:
    """The q-grams of a block of items, with a bit table in front of the sorted hashes."""

    def __init__(self, items: list[tuple[int, str]], q: int, errors: float) -> None:
        short = [one for one in items if len(one[1]) < q]
        items = [one for one in items if len(one[1]) >= q]
        self.q, self.ids = q, [name for name, _ in items + short]
        self.short = ahocorasick.Automaton() if short else None
        for k, (_, text) in enumerate(short, len(items)):
            self.short.add_word(text, [*self.short.get(text, []), k])
        self.shorts = [text for _, text in short]
        if short:
            self.short.make_automaton()
        self.codes = [codes_of(text) for _, text in items]
        self.reach = 2 * max(map(len, self.codes), default=0)
        self.cells = (1 << 20) - 1
        limits = [budget(len(codes), q, errors) for codes in self.codes]
        self.edits = np.array([one[0] for one in limits], dtype=np.int64)
        self.needed = np.array([one[1] for one in limits], dtype=np.int64)
        grams = [gram_hashes(codes, q) for codes in self.codes]
        owner = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([np.zeros(0, dtype=np.int64), *[np.arange(len(g)) for g in grams]])
        hashes = np.concatenate([np.zeros(0, dtype=np.uint64), *grams])
        order = np.argsort(hashes, kind="stable")
        self.hashes, first = np.unique(hashes[order], return_index=True)
        self.first = np.append(first, len(order))
        self.owner, self.place = owner[order], place[order]
        bits = max(16, len(self.hashes).bit_length() + 5)
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, dtype=bool)
        self.table[self.slot(self.hashes)] = True

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return hashes * _SPREAD >> self.shift

    def candidates(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and bands that share enough q-grams with a run of characters.

        Hits, a q-gram of the run with each of its places in the items, are laid out a slice at a time:
        counted first, then kept where the counts allow a band.
        """
        nothing = np.zeros(0, dtype=np.int64)
        if len(codes) < self.q or not len(self.hashes):
            return nothing, nothing
        hashes = gram_hashes(codes, self.q)
        at = np.flatnonzero(self.table[self.slot(hashes)])
        rank = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        equal = self.hashes[rank] == hashes[at]
        at, rank = at[equal], rank[equal]
        number = self.first[rank + 1] - self.first[rank]
        cuts = np.searchsorted(np.cumsum(number), np.arange(SLICE_HITS, int(number.sum()) + SLICE_HITS, SLICE_HITS), side="right")
        edges = sorted({0, len(at), *cuts.tolist()})
        slices = [slice(low, high) for low, high in zip(edges, edges[1:], strict=False)]

        def hits(part: slice) -> tuple[np.ndarray, ...]:
            many = number[part]
            entry = np.repeat(self.first[rank[part]] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            item, diagonal = self.owner[entry], np.repeat(at[part], many) - self.place[entry]
            # coarse stretches: every band lies within one of them; cells that share a counter only count too much
            return item, diagonal, entry, (item * 1_000_003 + (diagonal + self.reach) // self.reach * 2) & self.cells

        counted = np.zeros(self.cells + 1, dtype=np.int64)
        laid = [hits(part) for part in slices] if len(slices) == 1 else map(hits, slices)
        for *_, cell in laid:
            counted += np.bincount(cell, minlength=self.cells + 1)
        kept = []
        for item, diagonal, entry, cell in laid if len(slices) == 1 else map(hits, slices):
            both = counted[cell] + np.maximum(counted[cell + 2 & self.cells], counted[cell - 2 & self.cells])
            keep = both >= self.needed[item]
            kept.append((item[keep], diagonal[keep], entry[keep]))
        item, diagonal, entry = (np.concatenate([nothing, *column]) for column in zip(*kept, strict=True)) if kept else (nothing, nothing, nothing)
        if not len(item):
            return nothing, nothing
        # bands start at every multiple of edits + 1; each hit lies in two
        band = diagonal // (self.edits[item] + 1)
        offset = 1 - int(band.min())
        span = int(band.max()) + offset + 1
        key = np.concatenate((item * span + band + offset, item * span + band + offset - 1))
        found, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        enough = count >= self.needed[found // span]
        # of a q-gram of the item, one partner in the band counts
        chosen = enough[inverse]
        pairs = np.unique(inverse[chosen] * len(self.place) + np.concatenate((entry, entry))[chosen])
        count = np.bincount(pairs // len(self.place), minlength=len(found))
        found = found[count >= self.needed[found // span]]
        return found // span, found % span - offset

    def verify(self, item: int, band: int, codes: np.ndarray) -> tuple[int, int, int] | None:
        """Edits, start and end in the band: an exact occurrence is seen at once, others are aligned."""
        edits, wanted = int(self.edits[item]), self.codes[item]
        low = band * (edits + 1)
        near = codes[max(0, low) : low + 2 * edits + 2 + len(wanted)]
        if len(near) >= len(wanted):
            whole = np.flatnonzero((np.lib.stride_tricks.sliding_window_view(near, len(wanted)) == wanted).all(axis=1))
            if len(whole):
                start = max(0, low) + int(whole[0])
                return 0, start, start + len(wanted)
        return banded(wanted, codes, low - edits, low + 3 * edits + 1, edits)

    def exact(self, texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """Text, item, start and end of every occurrence of an item shorter than a q-gram."""
        for k, text in enumerate(texts if self.short else []):
            for last, items in self.short.iter(text):
                for item in items:
                    start = last + 1 - len(self.short_text(item))
                    before, after = text[start - 1 : start] if start else "", text[last + 1 : last + 2]
                    if not before.isalnum() and not after.isalnum():
                        yield k, item, start, last + 1

    def short_text(self, item: int) -> str:
        return self.shorts[item - len(self.codes)]

    def search(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """Per normalised text: item, edits, start and end of the best occurrence of every item found."""
        runs = [codes_of(text) for text in texts]
        starts = np.cumsum([0, *[len(run) + 1 for run in runs]])
        codes = np.full(starts[-1], NO_CHAR, dtype=np.uint32)
        for start, run in zip(starts.tolist(), runs, strict=False):
            codes[start : start + len(run)] = run
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for item, band in zip(*map(np.ndarray.tolist, self.candidates(codes)), strict=True):
            best = self.verify(item, band, codes)
            if best:
                key = int(np.searchsorted(starts, best[2] - 1, side="right")) - 1, item
                found[key] = min(best, found.get(key, best))
        for text, item, start, end in self.exact(texts):
            found.setdefault((text, item), (0, int(starts[text]) + start, int(starts[text]) + end))
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        for (text, item), (edits, start, end) in sorted(found.items()):
            first = int(starts[text])
            out[text].append((self.ids[item], edits, max(0, start - first), end - first))
        return out


def _blocks(benchmark: DataFrame, q: int, least: int, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct().toLocalIterator():
        text = normal(row[1])
        if row[0] is None or len(text) < max(least, 1):
            continue
        held.append((row[0], text))
        size += len(text)
        if size >= block_chars:
            yield sorted(held)
            held, size = [], 0
    if held:
        yield sorted(held)


def occurrences(docs: DataFrame, benchmark: DataFrame, q: int = Q, errors: float = ERRORS, least: int = LEAST_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents that contain benchmark items: parallel lists of items, edits, starts and ends.

    Every item is compared with every whole text. The benchmark is a stated
    query set: it is shipped in blocks of at most ``block_chars`` characters,
    one pass over the documents each, so memory does not grow with it. Places
    are in the normalised text (lower case, single spaces). Empty and null items,
    null item ids and items shorter than ``least`` characters are left out; items whose
    budget the lemma cannot serve get a smaller one (``budget``), items shorter than ``q`` none.
    """
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    out = None
    for items in _blocks(benchmark, q, least, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        found = narrow.mapInArrow(_searcher(shared, q, errors), SCHEMA)
        out = found if out is None else out.unionByName(found)
    if out is None:
        schema = T._parse_datatype_string(SCHEMA)
        return docs.sparkSession.createDataFrame([], schema)
    return out


def _portions(texts: list[str]) -> Iterator[list[str]]:
    """The normalised texts in portions of bounded size."""
    held, size = [], 0
    for text in texts:
        held.append(normal(text))
        size += len(held[-1])
        if size >= PORTION_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _searcher(shared, q: int, errors: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value, q, errors)
        for batch in batches:
            rows = []
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for key, found in zip(keys, (found for portion in _portions(texts) for found in index.search(portion)), strict=True):
                if found:
                    rows.append((key, *map(list, zip(*found, strict=True))))
            if rows:
                types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[part.split()[0] for part in SCHEMA.split(", ")])

    return run


def report(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """One row per document: ``doc_id``, ``contaminated``, ``n_items``, ``item_ids``, ``least_edits``.

    Null and empty texts are clean. Repeated rows and null ids come back as they
    are: rows with equal ids share the items found in any of them.
    """
    found = occurrences(docs, benchmark, **settings)
    found = found.groupBy("doc_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        F.min(F.array_min("edits")).alias("least_edits"),
    )
    named = docs.select(F.col("doc_id").cast("long"))
    return (
        named.alias("d")
        .join(found.alias("f"), F.expr("d.doc_id <=> f.doc_id"), "left")
        .select(
            "d.doc_id",
            F.col("item_ids").isNotNull().alias("contaminated"),
            F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
            F.col("least_edits").cast("long").alias("least_edits"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, q: int = Q, errors: float = ERRORS, least: int = LEAST_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows that contain a benchmark item; all columns stay."""
    for items in _blocks(benchmark, q, least, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        docs = keep_rows(docs, _cleaner(shared, q, errors), binary=False)
    return docs


def _cleaner(shared, q: int, errors: float):
    built: list[Index] = []

    def chosen(texts: list[str]) -> list[bool]:
        if not built:
            built.append(Index(shared.value, q, errors))
        return [not found for portion in _portions(texts) for found in built[0].search(portion)]

    return chosen
