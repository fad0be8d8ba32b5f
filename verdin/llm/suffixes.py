"""Removal of passages that an earlier document holds too, by longest previous factors.

Every string of ``LENGTH`` bytes is assigned to its anchor: the smallest hash of
the 16-byte strings inside it. Equal strings have equal anchors wherever they
stand, so strings with the same anchor meet in one bucket and no other bucket
needs to be looked at. The steps, each one shuffle:

1. blocks of documents send the hashes of their anchors to buckets;
2. buckets send back the hashes that two documents or more have;
3. blocks send the stretches of text around those anchors, equal ones of a block
   once, with the smallest document that has them;
4. buckets sort the suffixes of their stretches and send back, for every string,
   the smallest document of its suffix interval - its earliest match;
5. blocks remove the strings whose earliest match is an earlier document.

A passage that very many documents share comes once per block and context, so
no bucket grows with its number of copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 50
ANCHOR = 16
SPLIT = 64  # strings of one stretch at most
BLOCK_BYTES = 12 << 20
BUCKET_BYTES = 3 << 20
CHUNK_BYTES = 1 << 20
LAST = np.iinfo(np.int64).max  # stands for a null id
_MIX = np.uint64(0x9E3779B97F4A7C15)
_END = np.uint64(0xBF58476D1CE4E5B9)


def words_at(data: np.ndarray, big: bool = False) -> np.ndarray:
    """The eight bytes from each position on as one number; beyond the end stand zeros."""
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    view = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1))
    return np.ascontiguousarray(view).view(">u8" if big else "<u8").ravel()


def anchor_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Per start of a string of ``length`` bytes: the smallest hash of 16 bytes inside it, an even number."""
    words = words_at(data)
    n = len(data) - ANCHOR + 1
    with np.errstate(over="ignore"):
        value = words[:n] * _MIX
        value ^= value >> np.uint64(29)
        value = (value ^ words[8 : n + 8]) * _MIX
        value ^= value >> np.uint64(32)
        value *= _END
        value ^= value >> np.uint64(29)
    value &= ~np.uint64(1)
    width, have = length - ANCHOR + 1, 1
    while 2 * have <= width:
        value = np.minimum(value[:-have], value[have:])
        have *= 2
    rest = width - have
    return np.minimum(value[:-rest], value[rest:]) if rest else value


class Stretches:
    """Runs of strings with one anchor in a portion of documents."""

    def __init__(self, texts: list[bytes], length: int) -> None:
        self.data = b"".join(texts)
        sizes = np.array([len(text) for text in texts], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        if len(self.data) < length:
            self.anchor, self.start, self.count, self.text = (np.zeros(0, dtype=kind) for kind in (np.uint64, np.int64, np.int64, np.int64))
            return
        hashes = anchor_hashes(np.frombuffer(self.data, dtype=np.uint8), length)
        owner = np.repeat(np.arange(len(texts)), sizes)[: len(hashes)]
        valid = np.arange(len(hashes)) + length <= self.first[owner + 1]
        change = np.ones(len(hashes), dtype=bool)
        change[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]) | (valid[1:] != valid[:-1])
        start = np.flatnonzero(change)
        count = np.diff(np.append(start, len(hashes)))
        keep = valid[start]
        start, count = start[keep], count[keep]
        parts = -(-count // SPLIT)
        if len(parts) and parts.max() > 1:  # long runs of repeated bytes
            inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            count = np.minimum(np.repeat(count, parts) - inside * SPLIT, SPLIT)
            start = np.repeat(start, parts) + inside * SPLIT
        self.anchor, self.start, self.count, self.text = hashes[start], start, count, owner[start]

    def among(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the runs whose anchor is one of the sorted hashes."""
        if not len(hashes) or not len(self.anchor):
            return np.zeros(0, dtype=np.int64)
        place = np.minimum(np.searchsorted(hashes, self.anchor), len(hashes) - 1)
        return np.flatnonzero(hashes[place] == self.anchor)


def _documents(table: pa.Table) -> tuple[list[int], list[bytes]]:
    """Ids and texts of a block in a fixed order."""
    ids = [LAST if one is None else one for one in table.column("doc_id").to_pylist()]
    pairs = sorted(zip(ids, table.column("data").to_pylist(), strict=True))
    return [one for one, _ in pairs], [data for _, data in pairs]


def _portions(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK_BYTES:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _numbers(column: list[bytes], kind: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(one, dtype=kind) for one in column]) if column else np.zeros(0, dtype=kind)


def _by_bucket(anchor: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by bucket, and bucket, first and last place of each."""
    bucket = (anchor >> np.uint64(3)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    return order, list(zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True))


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.table({name: pa.array(list(column), kinds[kind]) for (name, kind), column in zip(fields, columns, strict=True)})


ANCHORS = "bucket int, block int, hashes binary"
SHARED = "block int, hashes binary"
SENT = "bucket int, block int, anchors binary, digests binary, lowest binary, highest binary, counts binary, body binary"
EARLIEST = "block int, anchors binary, digests binary, offsets binary, counts binary, lowest binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _anchors(length: int, buckets: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, texts = _documents(table)
        ids = np.array(ids, dtype=np.int64)
        hashes, owners = [], []
        for a, b in _portions(texts):
            runs = Stretches(texts[a:b], length)
            hashes.append(runs.anchor)
            owners.append(ids[a + runs.text])
        hashes, owners = np.concatenate(hashes), np.concatenate(owners)
        order = np.lexsort((owners, hashes))
        hashes, owners = hashes[order], owners[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = hashes[1:] != hashes[:-1]
        first = np.flatnonzero(new)
        lowest = owners[first]
        highest = owners[np.append(first[1:], len(hashes)) - 1] if len(first) else lowest
        hashes = hashes[first] | (lowest != highest).astype(np.uint64)  # odd: two documents of the block have it
        order, parts = _by_bucket(hashes, buckets)
        return _table(ANCHORS, [(k, key[0].as_py(), hashes[order[a:b]].tobytes()) for k, a, b in parts])

    return run


def _shared(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    lists = [np.frombuffer(one, dtype=np.uint64) for one in table.column("hashes").to_pylist()]
    blocks = table.column("block").to_pylist()
    marked = np.sort(np.concatenate(lists))
    even = marked & ~np.uint64(1)
    twice = np.unique(np.concatenate((even[1:][even[1:] == even[:-1]], even[marked != even])))
    rows = []
    for block, hashes in zip(blocks, lists, strict=True):
        hashes = hashes & ~np.uint64(1)
        place = np.minimum(np.searchsorted(twice, hashes), max(0, len(twice) - 1))
        own = hashes[twice[place] == hashes] if len(twice) else hashes[:0]
        if len(own):
            rows.append((block, own.tobytes()))
    return _table(SHARED, rows)


def _sent(length: int, buckets: int):
    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        shared = np.sort(_numbers(right.column("hashes").to_pylist(), "u8"))
        if not len(shared) or not left.num_rows:
            return _table(SENT, [])
        press = zstandard.ZstdCompressor(level=3)
        ids, texts = _documents(left)
        known: dict[bytes, int] = {}
        anchors, lowest, highest = [], [], []
        for a, b in _portions(texts):
            runs = Stretches(texts[a:b], length)
            chosen = runs.among(shared)
            starts = runs.start[chosen]
            ends = starts + runs.count[chosen] + length - 1
            columns = runs.anchor[chosen].tolist(), starts.tolist(), ends.tolist(), (a + runs.text[chosen]).tolist()
            for anchor, start, end, text in zip(*columns, strict=True):
                stretch, name = runs.data[start:end], ids[text]
                at = known.setdefault(stretch, len(anchors))
                if at == len(anchors):
                    anchors.append(anchor)
                    lowest.append(name)
                    highest.append(name)
                else:  # ids rise within a block
                    highest[at] = name
        bodies = list(known)
        digests = np.array([xxhash.xxh64_intdigest(one) for one in bodies], dtype=np.uint64)
        counts = np.array([len(one) - length + 1 for one in bodies], dtype=np.uint8)
        anchors, lowest, highest = np.array(anchors, dtype=np.uint64), np.array(lowest, dtype=np.int64), np.array(highest, dtype=np.int64)
        order, parts = _by_bucket(anchors, buckets)
        rows = []
        for k, a, b in parts:
            own = order[a:b]
            arrays = [column[own].tobytes() for column in (anchors, digests)]
            pressed = [column[own].tobytes() for column in (lowest, highest, counts)] + [b"".join([bodies[i] for i in own.tolist()])]
            rows.append((k, key[0].as_py(), *arrays, *[press.compress(one) for one in pressed]))
        return _table(SENT, rows)

    return run


def suffix_intervals(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes from ``starts`` in the order of their first ``length`` bytes, and where intervals of equal ones begin.

    Prefix doubling: ranks by 8 bytes give ranks by 16, these by 32, and two of
    them that overlap give those by ``length`` (at least 32, at most 64).
    """

    def rank(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        ranked = key[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = ranked[1:] != ranked[:-1]
        out = np.empty(len(key), dtype=np.uint64)
        out[order] = np.cumsum(new)
        return out

    def pair(ranks: np.ndarray, left: np.ndarray | slice, right: np.ndarray) -> np.ndarray:
        return ranks[left] << np.uint64(32) | right

    def moved(ranks: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate((ranks[by:], np.zeros(min(by, len(ranks)), dtype=np.uint64)))[: len(ranks)]

    ranks = rank(words_at(data, big=True).astype(np.uint64))
    for width in (8, 16):
        ranks = rank(pair(ranks, slice(None), moved(ranks, width)))
    key = pair(ranks, starts, ranks[starts + length - 32])
    order = np.argsort(key, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = key[order][1:] != key[order][:-1]
    return order, np.flatnonzero(new)


def _earliest(length: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = {name: table.column(name).to_pylist() for name in table.column_names}
        open_ = zstandard.ZstdDecompressor()
        for name in ("lowest", "highest", "counts", "body"):
            part[name] = [open_.decompress(one) for one in part[name]]
        sizes = [len(one) for one in part["counts"]]
        block = np.repeat(np.array(part["block"], dtype=np.int64), sizes)
        anchors, digests = _numbers(part["anchors"], "u8"), _numbers(part["digests"], "u8")
        lowest, highest = _numbers(part["lowest"], "i8"), _numbers(part["highest"], "i8")
        counts = _numbers(part["counts"], "u1").astype(np.int64)
        data = np.frombuffer(b"".join(part["body"]), dtype=np.uint8)
        begin = np.cumsum(counts + length - 1) - (counts + length - 1)
        # equal stretches of several blocks are sorted once
        same = np.lexsort((digests, anchors))
        new = np.ones(len(same), dtype=bool)
        new[1:] = (digests[same][1:] != digests[same][:-1]) | (anchors[same][1:] != anchors[same][:-1])
        group = np.empty(len(same), dtype=np.int64)
        group[same] = np.cumsum(new) - 1
        leader = same[new]
        least = np.minimum.reduceat(lowest[same], np.flatnonzero(new))
        sizes = counts[leader] + length - 1
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        text = data[np.repeat(begin[leader], sizes) + inside]
        number = counts[leader]
        offset = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        starts = np.repeat(np.cumsum(sizes) - sizes, number) + offset
        owner = np.repeat(np.arange(len(leader)), number)
        order, first = suffix_intervals(text, starts, length)
        smallest = np.minimum.reduceat(least[owner][order], first)
        earliest = np.empty(len(order), dtype=np.int64)
        earliest[order] = np.repeat(smallest, np.diff(np.append(first, len(order))))
        # runs of strings with one earliest document, for the stretches that lose something
        turn = np.ones(len(owner), dtype=bool)
        turn[1:] = (owner[1:] != owner[:-1]) | (earliest[1:] != earliest[:-1])
        at = np.flatnonzero(turn)
        run_owner, run_earliest, run_offset = owner[at], earliest[at], offset[at]
        run_count = np.diff(np.append(at, len(owner)))
        run_first = np.searchsorted(run_owner, np.arange(len(leader) + 1))
        floor = np.minimum.reduceat(run_earliest, run_first[:-1])
        losing = np.flatnonzero(floor[group] < highest)
        losing = losing[np.argsort(block[losing], kind="stable")]
        runs = run_first[group[losing] + 1] - run_first[group[losing]]
        entry = np.repeat(run_first[group[losing]] - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())
        back = np.repeat(losing, runs)
        useful = run_earliest[entry] < highest[back]
        entry, back = entry[useful], back[useful]
        found, cut = np.unique(block[back], return_index=True)
        rows = []
        for name, a, b in zip(found.tolist(), cut.tolist(), [*cut[1:].tolist(), len(back)], strict=True):
            e, s = entry[a:b], back[a:b]
            columns = anchors[s], digests[s], run_offset[e].astype(np.uint8), run_count[e].astype(np.uint8), run_earliest[e]
            rows.append((name, *[column.tobytes() for column in columns]))
        return _table(EARLIEST, rows)

    return run


def _removed(length: int):
    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        ids, texts = _documents(left) if left.num_rows else ([], [])
        part = {name: right.column(name).to_pylist() for name in right.column_names}
        anchors, digests = _numbers(part["anchors"], "u8"), _numbers(part["digests"], "u8")
        columns = _numbers(part["offsets"], "u1").tolist(), _numbers(part["counts"], "u1").tolist(), _numbers(part["lowest"], "i8").tolist()
        matches: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for name, *match in zip(zip(anchors.tolist(), digests.tolist(), strict=True), *columns, strict=True):
            matches.setdefault(name, []).append(tuple(match))
        wanted, rows = np.unique(anchors), []
        for a, b in _portions(texts):
            runs = Stretches(texts[a:b], length)
            edges = np.zeros(len(runs.data) + 1, dtype=np.int32)
            chosen = runs.among(wanted)
            starts, counts, owners = runs.start[chosen].tolist(), runs.count[chosen].tolist(), (a + runs.text[chosen]).tolist()
            opened, closed = [], []
            for anchor, start, count, text in zip(runs.anchor[chosen].tolist(), starts, counts, owners, strict=True):
                digest = xxhash.xxh64_intdigest(runs.data[start : start + count + length - 1])
                for offset, number, earliest in matches.get((anchor, digest), ()):
                    if earliest < ids[text]:
                        opened.append(start + offset)
                        closed.append(start + offset + number + length - 1)
            np.add.at(edges, opened, 1)
            np.add.at(edges, closed, -1)
            gone = np.cumsum(edges[:-1]) > 0
            data = np.frombuffer(runs.data, dtype=np.uint8)
            for k in range(b - a):
                x, y = int(runs.first[k]), int(runs.first[k + 1])
                lost = gone[x:y]
                number = int(np.count_nonzero(lost))
                spans = int(np.count_nonzero(lost[1:] & ~lost[:-1]) + lost[:1].sum()) if number else 0
                kept = data[x:y][~lost].tobytes() if number else runs.data[x:y]
                name = ids[a + k]
                rows.append((None if name == LAST else name, y - x, number, spans, hashlib.sha256(kept).hexdigest()))
        return _table(RESULT, rows)

    return run


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    A byte is removed if a string of ``length`` bytes (32 to 64) that covers it
    also starts in a document with a smaller ``doc_id``, judged on the input.
    Null texts are empty, texts below ``length`` bytes lose nothing. Null ids
    come after all others and are not earlier than each other, nor are rows with
    the same id. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"))
    size = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    blocks, buckets = max(8, ceil(size / BLOCK_BYTES)), max(8, ceil(size / BUCKET_BYTES))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "data"), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    by_block = rows.groupBy("block")
    anchors = by_block.applyInArrow(_anchors(length, buckets), ANCHORS)
    shared = anchors.groupBy("bucket").applyInArrow(_shared, SHARED)
    sent = by_block.cogroup(shared.groupBy("block")).applyInArrow(_sent(length, buckets), SENT)
    earliest = sent.groupBy("bucket").applyInArrow(_earliest(length), EARLIEST)
    return by_block.cogroup(earliest.groupBy("block")).applyInArrow(_removed(length), RESULT)
