"""SimHash near-duplicates found through Golay-code keys.

The binary Golay code of length 23 is perfect: every 23-bit word lies within
three bits of exactly one of 4096 codewords. All codewords within four bits of
a word are its keys: one, or six when the nearest is three bits away. Two words
at most two bits apart share a key, because the word between them decodes to a
codeword within four bits of both.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations
from math import ceil, log2
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdin.llm.components import components
from verdin.llm.frames import free_names, pinned, text_bytes
from verdin.session import stored

#: Generator polynomial of the code, and the bits of the fingerprint in each of three segments.
GENERATOR = 0xAE3
SEGMENTS = (22, 21, 21)
SEED = 42


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of each byte of a word, and per remainder the error patterns of up to four bits and their number."""
    remainder, powers = 1, []
    for _ in range(23):
        powers.append(remainder)
        remainder <<= 1
        if remainder & 0x800:
            remainder ^= GENERATOR
    by_byte = np.zeros((3, 256), dtype=np.int32)
    for part in range(3):
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1 and 8 * part + bit < 23:
                    by_byte[part, value] ^= powers[8 * part + bit]
    errors = np.zeros((2048, 6), dtype=np.int32)
    number = np.zeros(2048, dtype=np.int32)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            rest = 0
            for bit in bits:
                rest ^= powers[bit]
            errors[rest, number[rest]] = sum(1 << bit for bit in bits)
            number[rest] += 1
    return by_byte, errors, number


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and 12-bit indices of all codewords within four bits of 23-bit words."""
    by_byte, errors, number = golay_tables()
    words = words.astype(np.int32)
    rest = by_byte[0, words & 255] ^ by_byte[1, words >> 8 & 255] ^ by_byte[2, words >> 16 & 127]
    row, place = np.nonzero(np.arange(6) < number[rest][:, None])
    return row, (words[row] ^ errors[rest[row], place]) >> 11


def segments_of(values: np.ndarray) -> list[np.ndarray]:
    """The three segments of 64-bit fingerprints."""
    parts, shift = [], 0
    for width in SEGMENTS:
        parts.append((values >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64))
        shift += width
    return parts


def join_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys: fingerprints at most two bits apart share one.

    Two wrong bits leave one of three segments whole, and the segment after it
    within two bits: its exact value and each Golay index of its neighbour form
    the key.
    """
    parts = segments_of(values)
    rows, keys = [], []
    for family in range(3):
        row, index = golay_keys(parts[(family + 1) % 3])
        rows.append(row)
        keys.append(family << 34 | parts[family][row] << 12 | index)
    return np.concatenate(rows), np.concatenate(keys)


def _features(data: bytes, size: int) -> list[bytes]:
    """Space-joined word shingles with repeats; a shorter text gives its whole sequence, an empty one nothing."""
    words = data.lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    line = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    return [line[start : end - 1] for start, end in zip([0, *ends], ends[size - 1 :], strict=False)]


def _majority(digests: bytes, counts: list[int]) -> np.ndarray:
    """Fingerprints of documents from their features' digests (8 bytes, most significant first)."""
    out = np.zeros(len(counts), dtype=np.uint64)
    number = np.array(counts)
    full = np.flatnonzero(number)
    if len(full):
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8), axis=1)
        starts = np.concatenate(([0], np.cumsum(number[full])[:-1]))
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        packed = np.packbits(ones * 2 > number[full][:, None], axis=1)
        out[full] = packed.view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """64-bit SimHash of every whole text: ``doc_id``, ``fingerprint`` (long with the same bits).

    Null and blank texts give zero. Very long texts are hashed in full, rows in
    portions of bounded size. Rows are kept as they come, repeated or with a
    null id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_digest
        for batch in batches:
            values, digests, counts, held = [], [], [], 0
            for data in text_bytes(batch.column(1)):
                features = _features(data, shingle)
                digests.extend([digest(f, SEED) for f in features])
                counts.append(len(features))
                held += len(features)
                if held > 200_000:
                    values.append(_majority(b"".join(digests), counts))
                    digests, counts, held = [], [], 0
            values.append(_majority(b"".join(digests), counts))
            column = pa.array(np.concatenate(values).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint long")


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        rows, keys = join_keys(values.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values[rows])], names=["key", "f"])


def links(values: DataFrame, column: str = "fingerprint", most: int = 32) -> DataFrame:
    """Links that join all distinct fingerprints within two bits of each other: ``a``, ``b``.

    Buckets of up to ``most`` fingerprints are joined with themselves and
    verified. Members of larger buckets are compared without pairs: each is
    spread to the 65 values within one bit of it, and those that meet (at most
    65) are linked to the smallest. Two fingerprints within two bits always
    meet, and those that meet are within two bits, so the components are the
    same as those of all pairs.
    """
    keyed = values.select(column).distinct().mapInArrow(_keyed, "key long, f long")
    sized = keyed.join(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")
    sized = pinned(sized)
    small = sized.where(F.col("n") <= most).select("key", "f")
    pairs = (
        small.alias("l")
        .join(small.alias("r"), F.expr("l.key = r.key and l.f < r.f and bit_count(l.f ^ r.f) <= 2"))
        .select(F.col("l.f").alias("a"), F.col("r.f").alias("b"))
        .distinct()
    )
    crowded = sized.where(F.col("n") > most).select("f").distinct()
    near = crowded.select("f", F.explode(F.array(F.col("f"), *[F.col("f").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])).alias("x"))
    met = near.groupBy("x").agg(F.collect_set("f").alias("fs")).where("size(fs) > 1")
    stars = met.select(F.array_min("fs").alias("a"), F.explode("fs").alias("b")).where("a <> b").distinct()
    return pairs.unionByName(stars)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A component
    is what links of at most two bits reach; its id is the smallest ``doc_id`` in
    it, null ids aside (null if all are). Documents without words have the
    fingerprint zero and link like any other. Repeated rows come back repeated.
    """
    marked = pinned(fingerprints(docs, shingle))
    distinct = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    found = components(links(distinct))
    rooted = distinct.join(found, distinct.fingerprint == found.node, "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    heads = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return (
        marked.join(rooted.join(heads, "root").select("fingerprint", "component_id"), "fingerprint")
        .select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
    )


# Near copies: SimHash links first, then an exact join on the rarest shingles of each text; shingles decide.

BLOCK_BYTES = 8 << 20
CELLS_PER_BYTE = 3
#: Turns of comparisons with one text a shingle before all texts are compared; they only save work.
TURNS = 2
#: Rows of a shingle that meet in one task, and rows compared at once.
PORTION_ROWS = 2048
BLOCK_ROWS = 256
#: Cells by which overlaps are bounded from above, and earlier keys that a row carries along.
CELLS = 256
BEFORE = 8
_SKETCH = "doc_id long, digest long"
_CELLS = "bucket int, block int, cells binary, counts binary"
_RANKS = "bucket int, block int, ranks binary"
_KEYED = "key long, digest long, n long, place long, before binary"


def _apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bits in which fingerprints differ (of a signed number numpy would count those of its absolute value)."""
    return np.bitwise_count((left ^ right).view(np.uint64))


def _word_digest(data: bytes) -> int:
    """Signed digest of the word sequence, case aside."""
    value = xxhash.xxh3_64_intdigest(b" ".join(data.lower().split()))
    return value - (1 << 64) if value >> 63 else value


def shingle_hashes(data: bytes, size: int) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct word shingles."""
    digest = xxhash.xxh64_digest
    return np.unique(np.frombuffer(b"".join([digest(one) for one in _features(data, size)]), dtype="<u8"))


def prefix_length(n: int, least: float) -> int:
    """Of two sets with a Jaccard similarity of ``least``, both have a common element among so many first ones in any order."""
    return n - ceil(least * n - 1e-9) + 1 if n else 0


def may_reach(n: np.ndarray, place: np.ndarray, m: np.ndarray, at: np.ndarray, least: float) -> np.ndarray:
    """Whether sets of ``n`` and ``m`` can be similar if their first common element stands at ``place`` and ``at``."""
    need = np.ceil(least / (1 + least) * (n + m) - 1e-9)
    return (np.minimum(n, m) >= least * np.maximum(n, m) - 1e-9) & (np.minimum(n - place, m - at) >= need)


def _distinct_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and text of each word sequence, once per task."""
    seen: set[int] = set()
    for batch in batches:
        digests, texts = [], []
        for data in text_bytes(batch.column(0)):
            value = _word_digest(data)
            if value not in seen:
                seen.add(value)
                digests.append(value)
                texts.append(data)
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.int64()), pa.array(texts, pa.binary())], names=["digest", "data"])


def _sets(table: pa.Table, size: int) -> dict[int, np.ndarray]:
    """Shingle hashes of each word sequence of a block."""
    texts = dict(zip(table.column("digest").to_pylist(), table.column("data").to_pylist(), strict=True))
    return {digest: shingle_hashes(data, size) for digest, data in texts.items()}


def _cells(sets: dict[int, np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells (leading bits of hashes) of a block in rising order, and the hashes in each."""
    return np.unique(np.concatenate([*sets.values(), np.zeros(0, dtype=np.uint64)]) >> np.uint64(64 - bits), return_counts=True)


def _block_cells(size: int, bits: int, parts: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        press = zstandard.ZstdCompressor(level=1)
        cells, counts = _cells(_sets(table, size), bits)
        bucket, first = np.unique(cells >> np.uint64(bits - parts), return_index=True)
        rows: dict[str, list] = {"bucket": [], "block": [], "cells": [], "counts": []}
        for k, a, b in zip(bucket.tolist(), first.tolist(), [*first[1:].tolist(), len(cells)], strict=True):
            steps = np.diff(cells[a:b], prepend=np.uint64(0))
            rows["bucket"].append(k)
            rows["block"].append(key[0].as_py())
            rows["cells"].append(press.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes()))
            rows["counts"].append(press.compress(np.minimum(counts[a:b], 255).astype(np.uint8).tobytes()))
        return pa.table([pa.array(rows["bucket"], pa.int32()), pa.array(rows["block"], pa.int32()), pa.array(rows["cells"], pa.binary()), pa.array(rows["counts"], pa.binary())], names=list(rows))

    return run


def _bucket_ranks(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Sums of the counts of cells over all blocks, sent back to each block on a scale of one byte."""
    press, open_ = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    lists = [
        np.cumsum(np.ascontiguousarray(np.frombuffer(open_.decompress(one), dtype=np.uint8).reshape(8, -1).T).view(np.uint64).ravel())
        for one in table.column("cells").to_pylist()
    ]
    counts = np.concatenate([np.frombuffer(open_.decompress(one), dtype=np.uint8) for one in table.column("counts").to_pylist()])
    cells, place = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(cells))
    scale = np.where(total <= 64, total, np.minimum(255, 64 + np.floor(12 * np.log2(np.maximum(total, 64) / 64)))).astype(np.uint8)
    ends = np.cumsum([len(one) for one in lists])
    ranks = [press.compress(scale[place[end - len(one) : end]].tobytes()) for one, end in zip(lists, ends.tolist(), strict=True)]
    bucket = pa.array([key[0].as_py()] * len(ranks), pa.int32())
    return pa.table([bucket, table.column("block"), pa.array(ranks, pa.binary())], names=["bucket", "block", "ranks"])


def _prefixes(size: int, bits: int, least: float):
    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        open_ = zstandard.ZstdDecompressor()
        sets = _sets(left, size)
        cells, _ = _cells(sets, bits)
        parts = sorted(zip(right.column("bucket").to_pylist(), right.column("ranks").to_pylist(), strict=True))
        ranks = np.frombuffer(b"".join(open_.decompress(one) for _, one in parts), dtype=np.uint8)
        columns: list[list[np.ndarray]] = [[np.zeros(0, dtype=np.int64)] for _ in range(4)]
        earlier: list[np.ndarray] = [np.zeros((0, BEFORE), dtype=np.uint64)]
        for digest, hashes in sets.items():
            rank = ranks[np.searchsorted(cells, hashes >> np.uint64(64 - bits))]
            first = np.argsort(rank, kind="stable")[: prefix_length(len(hashes), least)]
            place = np.flatnonzero(rank[first] > 1)  # a shingle that is alone in its cell meets no other
            keys = hashes[first[place]]
            for column, values in zip(columns, (keys.view(np.int64), np.full(len(place), digest), np.full(len(place), len(hashes)), place), strict=True):
                column.append(values)
            padded = np.concatenate([np.zeros(BEFORE, dtype=np.uint64), keys])
            earlier.append(np.lib.stride_tricks.sliding_window_view(padded, BEFORE)[: len(keys)])
        before = np.concatenate(earlier)
        ends = pa.py_buffer(np.arange(len(before) + 1, dtype=np.int32) * (8 * BEFORE))
        packed = pa.Array.from_buffers(pa.binary(), len(before), [None, ends, pa.py_buffer(before.tobytes())])
        return pa.table([*[pa.array(np.concatenate(column).astype(np.int64)) for column in columns], packed], names=["key", "digest", "n", "place", "before"])

    return run


def rare_shingles(docs: DataFrame, shingle: int, least: float) -> DataFrame:
    """The first shingles of each word sequence in a common order, rare ones first: ``key``, ``digest``, ``n``, ``place``, ``before``.

    ``before`` holds the ``BEFORE`` keys of the sequence just before this one.

    Two sets with a similarity of ``least`` have one of their first shingles in
    common, whatever the order, as long as it is the same for all. The order is
    that of the number of texts by cell (leading bits of the hash), then of the
    hash: shared cells make a shingle seem less rare but lose none.
    Shingles that no other text has are counted but left out.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("binary")))).first()[0] or 0
    blocks = max(8, ceil(size / BLOCK_BYTES))
    bits = max(20, ceil(log2(CELLS_PER_BYTE * size + 1)))
    parts = max(3, ceil(log2(blocks)))
    texts = docs.select("text").mapInArrow(_distinct_texts, "digest long, data binary")
    by_block = texts.withColumn("block", F.pmod(F.xxhash64("digest"), F.lit(blocks)).cast("int")).repartition(blocks, "block").groupBy("block")
    cells = by_block.applyInArrow(_block_cells(shingle, bits, parts), _CELLS)
    ranks = cells.groupBy("bucket").applyInArrow(_bucket_ranks, _RANKS)
    return by_block.cogroup(ranks.groupBy("block")).applyInArrow(_prefixes(shingle, bits, least), _KEYED)


def _reach(least: float, pivot: str) -> Column:
    """``may_reach`` of a row and the pivot in the struct column ``pivot``."""
    n, place, m, at = F.col("n"), F.col("place"), F.col(f"{pivot}.n"), F.col(f"{pivot}.place")
    need = F.ceil(F.lit(least / (1 + least)) * (n + m) - 1e-9)
    return (F.least(n, m) >= F.lit(least) * F.greatest(n, m) - 1e-9) & (F.least(n - place, m - at) >= need)


def with_pivots(rows: DataFrame, pivots: DataFrame, least: float) -> DataFrame:
    """Pairs of each row with its shingle's pivot, where they are in different groups: ``a``, ``b``, at most one pair a row.

    A shingle with very many texts is a skewed join key, which adaptive execution splits.
    """
    met = rows.join(pivots, "key").where((F.col("root") != F.col("pivot_root")) & _reach(least, "pivot"))
    return met.select(F.least("digest", "pivot.digest").alias("a"), F.greatest("digest", "pivot.digest").alias("b")).distinct()


def simhash_pairs(marked: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of texts whose SimHash fingerprints link: ``a``, ``b``, the smaller digest first.

    Texts of one fingerprint are paired with the smallest of them, and linked fingerprints (two bits at most,
    as ``links`` finds them) by their smallest texts, so a large group of copies gives no pairs among its members.
    """
    rows = fingerprints(marked.select(F.col("content").alias("doc_id"), "text"))
    marks = rows.groupBy("doc_id").agg(F.min("fingerprint").alias("fingerprint"))
    placed = stored(nodes.join(marks, F.col("content") == F.col("doc_id")).select("digest", "fingerprint"))
    firsts = stored(placed.groupBy("fingerprint").agg(F.min("digest").alias("first")))
    equal = placed.join(firsts, "fingerprint").select(F.col("first").alias("x"), F.col("digest").alias("y"))
    left = firsts.select(F.col("fingerprint").alias("a"), F.col("first").alias("x"))
    right = firsts.select(F.col("fingerprint").alias("b"), F.col("first").alias("y"))
    near = links(firsts).join(left, "a").join(right, "b").select("x", "y")
    return equal.unionByName(near).where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def group_pivots(rows: DataFrame) -> DataFrame:
    """One row of the largest group of each shingle."""
    groups = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("digest", "n", "place")).alias("first"))
    pivots = groups.groupBy("key").agg(F.max(F.struct("size", "root", "first")).alias("best"))
    return pivots.select("key", F.col("best.root").alias("pivot_root"), F.col("best.first").alias("pivot"))


def contested(keyed: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of shingles whose texts are in different groups, with ``root`` and ``members``, the shingle's number of rows; without ``before``."""
    rooted = keyed.join(nodes.select("digest", "root"), "digest").select("key", "digest", "n", "place", "root")
    bounds = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("members"))
    return rooted.join(bounds.where("low <> high").select("key", "members"), "key")


class Bucket(NamedTuple):
    """Rows of one shingle, or of two portions of a large one, sorted by root."""

    left: np.ndarray
    digest: np.ndarray
    n: np.ndarray
    place: np.ndarray
    root: np.ndarray
    cells: np.ndarray
    before: np.ndarray


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, Bucket]]:
    """Whole buckets, rows sorted by their keys ``key``, ``i``, ``j``; and whether both portions are the same."""
    held: list[pa.RecordBatch] = []

    def cut(rows: pa.Table) -> tuple[bool, Bucket]:
        numbers = [rows.column(k).to_numpy() for k in range(3, 8)]
        cells = np.frombuffer(b"".join(rows.column(8).to_pylist()), dtype=np.uint8).reshape(-1, CELLS)
        before = np.frombuffer(b"".join(rows.column(9).to_pylist()), dtype=np.uint64).reshape(-1, BEFORE)
        return rows.column(1)[0].as_py() == rows.column(2)[0].as_py(), Bucket(*numbers, cells, before)

    last = None
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
        bounds = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for low, high in zip(bounds, bounds[1:], strict=False):
            key = tuple(keys[:, low]) if high > low else last
            if held and key != last:
                yield cut(pa.Table.from_batches(held))
                held = []
            if high > low:
                held.append(batch.slice(low, high - low))
            last = key
    if held:
        yield cut(pa.Table.from_batches(held))


def bounds(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlaps of sets from their counts by cell; infinite where one cell is full in both."""
    out = np.empty(len(left))
    for k in range(0, len(left), 4096):
        low = np.minimum(left[k : k + 4096], right[k : k + 4096])
        out[k : k + 4096] = np.where((low == 255).any(axis=1), np.inf, low.sum(axis=1, dtype=np.int64))
    return out


def met_before(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether rows have one of the keys in common that come just before; such a pair met there already."""
    out = np.empty(len(left), dtype=bool)
    for k in range(0, len(left), 4096):
        x, y = left[k : k + 4096, :, None], right[k : k + 4096, None, :]
        out[k : k + 4096] = ((x == y) & (x != 0)).any(axis=(1, 2))
    return out


def _close(least: float):
    """Pairs of a bucket in different groups that neither their places nor their counts by cell rule out.

    Two texts with many keys in common meet in many buckets; the first of these reports them, and others
    only where none of the keys just before is common too.
    """

    def of_blocks(same: bool, bucket: Bucket, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        good = (bucket.root[a][:, None] != bucket.root[b][None, :]) & (a[:, None] < b[None, :])
        if not same:
            good &= bucket.left[a][:, None] != bucket.left[b][None, :]
        x, y = np.nonzero(good)
        x, y = a[x], b[y]
        fine = may_reach(bucket.n[x], bucket.place[x], bucket.n[y], bucket.place[y], least)
        x, y = x[fine], y[fine]
        fresh = ~met_before(bucket.before[x], bucket.before[y])
        x, y = x[fresh], y[fresh]
        need = np.ceil(least / (1 + least) * (bucket.n[x] + bucket.n[y]) - 1e-9)
        near = bounds(bucket.cells[x], bucket.cells[y]) >= need
        return bucket.digest[x[near]], bucket.digest[y[near]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for same, bucket in _buckets(batches):
            rows = np.arange(len(bucket.root))
            blocks = [rows[k : k + BLOCK_ROWS] for k in range(0, len(rows), BLOCK_ROWS)]
            for k, a in enumerate(blocks):
                for b in blocks[k:]:
                    x, y = of_blocks(same, bucket, a, b)
                    if len(x):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    return run


def close_pairs(rows: DataFrame, sketches: DataFrame, least: float, portion: int = PORTION_ROWS) -> DataFrame:
    """``_close`` pairs of all rows of each shingle: ``a``, ``b``.

    A shingle of more than ``portion`` rows is cut by a hash into portions, and every two portions
    meet in a bucket of their own, so no task holds more than two of them.
    """
    parts = F.ceil(F.col("members") / portion).cast("int")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("digest"), parts).cast("int")).withColumn("parts", parts)
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.struct(F.least(x, "part").alias("i"), F.greatest(x, "part").alias("j")))
    dealt = rows.withColumn("pair", F.explode(pairs)).select("key", "pair.*", "digest", "n", "place", "root", "part", "before")
    full = dealt.join(sketches, "digest").select("key", "i", "j", (F.col("part") == F.col("i")).alias("left"), "digest", "n", "place", "root", "cells", "before")
    walked = full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "root", "digest").mapInArrow(_close(least), "a long, b long")
    return walked.distinct()


def texts_of(marked: DataFrame, nodes: DataFrame, digests: DataFrame) -> DataFrame:
    """One text of each of the given distinct ``digest``: ``digest``, ``text``."""
    ends = digests.join(nodes, "digest").select("digest", "content")
    return marked.select("content", "text").join(ends, "content").groupBy("digest").agg(F.first("text").alias("text"))


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """``digest`` and the sorted hashes of a text's distinct word shingles, for a table of ``digest`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(data, size).tobytes() for data in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["digest", "shingles"])

    return docs.mapInArrow(run, "digest long, shingles binary")


def shingle_counts(docs: DataFrame, size: int) -> DataFrame:
    """``digest`` and ``cells``: how many of a text's distinct shingles fall into each of ``CELLS`` cells, one byte each, 255 for more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [shingle_hashes(data, size) % np.uint64(CELLS) for data in text_bytes(batch.column(1))]
            cells = [np.minimum(np.bincount(one.astype(np.int64), minlength=CELLS), 255).astype(np.uint8).tobytes() for one in hashes]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.binary())], names=["digest", "cells"])

    return docs.mapInArrow(run, "digest long, cells binary")


def _similar(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(common >= least * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def verified(pairs: DataFrame, marked: DataFrame, nodes: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs whose whole texts have the similarity: ``a``, ``b``."""
    pairs = stored(pairs)
    ends = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
    sets = stored(shingle_sets(texts_of(marked, nodes, ends), shingle))
    joined = (
        pairs.join(sets.select(F.col("digest").alias("a"), F.col("shingles").alias("x")), "a")
        .join(sets.select(F.col("digest").alias("b"), F.col("shingles").alias("y")), "b")
        .select("a", "b", "x", "y")
    )
    return stored(joined.mapInArrow(_similar(least), "a long, b long"))


def similar_groups(docs: DataFrame, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """Groups of near copies: ``doc_id``, ``content`` (hash of the text), ``root``, one row per row of ``docs``.

    Texts with the same words, case aside, are copies. Others are linked if
    their sets of ``shingle``-word shingles have a Jaccard similarity of
    ``least``. SimHash proposes the first pairs (``simhash_pairs``). It misses some, so the rest follows exactly:
    every similar pair meets at one of its rarest shingles (``rare_shingles``). First
    each text of a shingle is compared with one text of the shingle's largest group, in a few turns while that
    links anything. Then all texts that meet and are still in different groups are
    compared inside the task that holds them, by counts that bound the overlap from above; only pairs that
    pass become rows. Every pair is verified on the whole texts. Texts without words are copies of each other.
    """
    content = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = rows.select(F.col("doc_id"), "text", content.alias("content"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = pa.array([_word_digest(data) for data in text_bytes(batch.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), digests, batch.column(2)], names=["doc_id", "digest", "content"])

    sketched = stored(marked.mapInArrow(sketch, f"{_SKETCH}, content long"))
    nodes = stored(sketched.groupBy("digest").agg(F.min("content").alias("content")))
    linked = verified(simhash_pairs(marked, nodes), marked, nodes, shingle, least)
    keyed = stored(rare_shingles(rows, shingle, least))
    rows = stored(contested(keyed, nearly_rooted(nodes, linked)))
    for _ in range(TURNS):
        found = verified(with_pivots(rows, group_pivots(rows), least), marked, nodes, shingle, least)
        if found.isEmpty():
            break
        linked = linked.unionByName(found)
        rows = stored(contested(rows.drop("root", "members"), nearly_rooted(nodes, linked)))
    sketches = stored(shingle_counts(texts_of(marked, nodes, rows.select("digest").distinct()), shingle))
    rows = rows.join(keyed.select("key", "digest", "before"), ["key", "digest"])
    found = verified(close_pairs(rows, sketches, least), marked, nodes, shingle, least)
    grouped = rooted(nodes, linked.unionByName(found))
    return sketched.join(grouped.select("digest", "root"), "digest").select("doc_id", "content", "root")


def nearly_rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with a ``root`` that each reaches: the smallest neighbour of its smallest neighbour.

    Texts with one root are in one group; a group may still have several roots, which costs
    comparisons but loses none. Links from pivots are stars, so few do.
    """
    both = links.select("a", "b").union(links.select("b", "a"))
    lowest = both.groupBy("a").agg(F.min("b").alias("low"))
    once = stored(nodes.join(lowest, nodes.digest == lowest.a, "left").select("digest", F.least("digest", F.coalesce("low", "digest")).alias("root")))
    jump = once.select(F.col("digest").alias("root"), F.col("root").alias("next"))
    return once.join(jump, "root").select("digest", F.col("next").alias("root"))


def rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with the smallest digest of their group as ``root``."""
    found = components(links)
    return stored(nodes.join(found, nodes.digest == found.node, "left").select("digest", "content", F.coalesce("root", "digest").alias("root")))


def without_near_copies(docs: DataFrame, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of near copies: the smallest ``doc_id``, null ids last; all columns stay.

    Rows that repeat the same id and text count as one document and come once.
    """
    doc_id, content_name = free_names(docs, "_doc_id", "_content")
    groups = stored(similar_groups(docs, shingle, least))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("content"))
    heads = groups.groupBy("root").agg(F.min(order).alias("head"), F.count("*").alias("n"))
    heads = heads.select(F.col("head.doc_id").alias(doc_id), F.col("head.content").alias(content_name))
    content = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id)) & (content == F.col(content_name))
    rows = docs.join(heads, same, "left_semi")
    twice = groups.groupBy("doc_id", "content").agg(F.count("*").alias("n")).where("n > 1")
    twice = stored(twice.select(F.col("doc_id").alias(doc_id), F.col("content").alias(content_name)))
    if twice.isEmpty():
        return rows
    again = rows.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return rows.join(twice, same, "left_anti").unionByName(again)
