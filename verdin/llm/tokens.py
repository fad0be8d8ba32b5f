"""Token ids in segments of compressed byte or bit planes, written and read back by Spark.

A segment is one self-contained binary value (a "file"), little-endian:

- head, 24 bytes: ``b"PLN1"``, plane kind (1 byte: 8 byte planes, 1 bit planes),
  3 zero bytes, ids per block (uint32), number of ids (uint64), number of blocks (uint32);
- the planes of each block, each compressed with zstandard. A block holds a fixed
  number of ids (the last one fewer); its unsigned 32-bit ids are transposed, so
  that byte (or bit) k of all ids lies together;
- the chunk index: for every block its offset (uint64) and the compressed length
  of each plane (uint32 each).

Segments lie in the rows of a Parquet table (shard, segment, ids, documents,
payload), beside the documents' ids and lengths. Spark's commit protocol makes the
write safe against lost executors, and any store that Spark reaches will do. Shards
and segments ascend with ``doc_id``.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdin.session import scratch_path

HEAD = struct.Struct("<4sB3xIQI")
BLOCK_IDS = 1 << 16
SEGMENT_IDS = 1 << 20
KNOWN_WORDS = 250_000
PORTION_BYTES = 4 << 20
_MARKS = bytes(k for k in range(0x21, 0x7F) if not chr(k).isalnum() and k != ord("'"))  # ASCII marks but the apostrophe
SCHEMA = "shard int, segment int, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


class Encoder:
    """A tokenizer with a memory of encoded words.

    The tokenizers library does all encoding. A text is cut at ASCII white
    space, which no pre-token of a white-space-dropping tokenizer crosses, so
    the ids of a text are those of its words in a row. Words of letters with
    closing marks are encoded as two parts, in lower case, where the tokenizer
    treats both alike (``probe``), and many new parts are encoded in one text
    where the vocabulary marks the end of a word.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values(), default=0) + 1, dtype=bool)
        self.ends[[number for name, number in names.items() if name.endswith("</w>")]] = True
        self.lowers, self.splits = self.probe()
        self.words: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {b"": b""}
        self.parts: dict[bytes, bytes] = {b"": b""}

    def single(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(words, add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4").tobytes() for one in found]

    def probe(self) -> tuple[bool, bool]:
        """Whether case is dropped, and whether closing marks are tokens of their own."""
        upper, lower, both, mark = self.single(["ÉAb", "éab", "éab.%", ".%"])
        return upper == lower, both == lower + mark

    def split(self, word: bytes) -> tuple[bytes, bytes]:
        """The part of letters and the closing marks; other words stay whole."""
        if not self.splits:
            return word, b""
        stem = word.rstrip(_MARKS)
        if stem.isalpha():  # bytes: ASCII letters only
            return stem.lower() if self.lowers else stem, word[len(stem) :]
        if stem.isascii():
            return word, b""
        text = stem.decode()
        lower = text.lower() if self.lowers else text
        plain = text.isalpha() and lower.isalpha() and is_normalized("NFC", text) and is_normalized("NFC", lower)
        if not plain or "Σ" in text or "İ" in text:  # their lower case depends on the place or takes two characters
            return word, b""
        return lower.encode(), word[len(stem) :]

    def learn(self, parts: list[bytes]) -> None:
        """Encode new parts: words of letters many at a time, others alone."""
        texts = [part.decode() for part in parts]
        plain = [k for k, text in enumerate(texts) if text.isalpha()] if self.splits and self.ends.any() else []
        alone = set(range(len(parts))).difference(plain)
        portions = [plain[k : k + 200] for k in range(0, len(plain), 200)]
        found = self.single([" ".join(texts[k] for k in portion) for portion in portions])
        for portion, data in zip(portions, found, strict=True):
            cuts = (np.flatnonzero(self.ends[np.frombuffer(data, dtype="<u4")]) + 1) * 4
            if len(cuts) != len(portion):
                alone.update(portion)
                continue
            for k, start, end in zip(portion, [0, *cuts.tolist()], cuts.tolist(), strict=False):
                self.parts[parts[k]] = data[start:end]
        rest = sorted(alone)
        for k, data in zip(rest, self.single([texts[k] for k in rest]), strict=True):
            self.parts[parts[k]] = data

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text of a string column, null as empty."""
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(texts):
            held = sizes[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, held + PORTION_BYTES, side="right")))
            yield from self._encoded(texts.slice(first, last - first))
            first = last

    def _encoded(self, texts: pa.Array) -> Iterator[bytes]:
        """Cut and numbered by Arrow: each distinct word of the portion is looked up once, its ids are laid out by numpy."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        numbered = split.flatten().dictionary_encode()
        found = self.known(numbered.dictionary.cast(pa.binary()).to_pylist())
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        ids, starts = np.frombuffer(b"".join(found), dtype="<u4"), np.cumsum(sizes) - sizes
        at = numbered.indices.to_numpy()
        size = sizes[at]
        ends = np.append(0, np.cumsum(size))
        out = ids[np.repeat(starts[at] - ends[:-1], size) + np.arange(ends[-1])]
        edges = ends[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        for low, high in zip(edges, edges[1:], strict=False):
            yield out[low:high].tobytes()

    def known(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words. Of a full memory the half that was used last stays."""
        if len(self.words) > KNOWN_WORDS:
            self.older, self.words = self.words, {b"": b""}
        if len(self.parts) > 2 * KNOWN_WORDS:
            self.parts = {b"": b""}
        found = [self.words.get(word) for word in words]
        missing = [k for k, data in enumerate(found) if data is None]
        new = []
        for k in missing:
            data = self.older.get(words[k])
            if data is None:
                new.append((k, *self.split(words[k])))
            else:
                found[k] = self.words[words[k]] = data
        parts = self.parts
        self.learn(list({part for _, *pair in new for part in pair if part not in parts}))
        for k, stem, marks in new:
            found[k] = self.words[words[k]] = parts[stem] + parts[marks]
        return found


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pack(ids: np.ndarray, kind: str = "byte", block: int = BLOCK_IDS) -> bytes:
    """One segment of unsigned 32-bit ids."""
    press = zstandard.ZstdCompressor(level=1)
    bits = 8 if kind == "byte" else 1
    blocks = -(-len(ids) // block)
    body, index, place = [HEAD.pack(b"PLN1", bits, block, len(ids), blocks)], [], HEAD.size
    for start in range(0, len(ids), block):
        planes = np.ascontiguousarray(ids[start : start + block], dtype="<u4").view(np.uint8).reshape(-1, 4).T
        if bits == 1:
            planes = np.vstack([np.packbits(plane[None, :] >> np.arange(8, dtype=np.uint8)[:, None] & 1, axis=1) for plane in planes])
        pressed = [press.compress(np.ascontiguousarray(plane).tobytes()) for plane in planes]
        index.append(struct.pack(f"<Q{len(pressed)}I", place, *map(len, pressed)))
        body += pressed
        place += sum(map(len, pressed))
    return b"".join(body + index)


def unpack(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of a segment, or of its blocks ``first`` to before ``last`` found through the chunk index."""
    magic, bits, block, number, blocks = HEAD.unpack_from(payload)
    if magic != b"PLN1":
        raise ValueError("not a segment of token ids")
    planes = 32 // bits
    entry = struct.Struct(f"<Q{planes}I")
    index = len(payload) - blocks * entry.size
    open_ = zstandard.ZstdDecompressor()
    out = [np.zeros(0, dtype=np.uint32)]
    for k in range(first, blocks if last is None else min(last, blocks)):
        place, *sizes = entry.unpack_from(payload, index + k * entry.size)
        count, rows = min(block, number - k * block), []
        for size in sizes:
            rows.append(np.frombuffer(open_.decompress(payload[place : place + size]), dtype=np.uint8))
            place += size
        if bits == 1:
            lit = np.vstack([np.unpackbits(row)[:count] for row in rows]).reshape(4, 8, count)
            rows = [np.bitwise_or.reduce(byte << np.arange(8, dtype=np.uint8)[:, None], axis=0) for byte in lit]
        out.append(np.ascontiguousarray(np.vstack(rows).T).view("<u4").ravel())
    return np.concatenate(out)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, kind: str = "byte") -> None:
    """Encode every whole text and write the segments to ``path`` in ascending ``doc_id`` order.

    Null texts count as empty; ``end_id`` is added to each document. Rows with
    equal ids keep the order of their texts, null ids come last. A document
    longer than a segment gets a longer segment of its own. Other columns are
    ignored; an empty table gives an empty set of segments.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(tokenizer), b"" if end_id is None else struct.pack("<I", end_id)
        shard, segment = TaskContext.get().partitionId(), 0
        names, lengths, held, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal names, lengths, held, size, segment
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            columns = [[shard], [segment], [size], [names], [lengths], [pack(ids, kind)]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            names, lengths, held, size, segment = [], [], [], 0, segment + 1
            return pa.RecordBatch.from_arrays(arrays, names=[part.split()[0] for part in SCHEMA.split(", ")])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for key, data in zip(keys, coder.encode(batch.column(1)), strict=True):
                data += end
                names.append(key)
                lengths.append(len(data) // 4)
                held.append(data)
                size += len(data) // 4
                if size >= SEGMENT_IDS:
                    yield flush()
        if names:
            yield flush()

    key = F.col("doc_id").cast("long")
    ordered = docs.select(key.alias("doc_id"), "text").repartitionByRange(F.col("doc_id").asc_nulls_last())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")
    ordered.mapInArrow(run, SCHEMA).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read from its segment: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    stored = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"]).tobytes()
                ends = np.cumsum([0, *row["lengths"]])
                sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(ends, ends[1:], strict=False)]
                n = len(sums)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                        pa.array(ends[:-1], pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(sums, pa.int64()),
                    ],
                    names=["shard", "segment", "doc_id", "offset", "n_tokens", "ids_crc32"],
                )

    rows = stored.mapInArrow(run, "shard int, segment int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    sizes = stored.select("shard", "segment", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("segment_start")).join(shards, "shard")
    return rows.join(starts, ["shard", "segment"]).select(
        "doc_id", (F.col("shard_start") + F.col("segment_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_output(docs: DataFrame, tokenizer: str, end_id: int | None = 1, kind: str = "byte") -> DataFrame:
    """Write the segments to a new path of the shared folder and report each document as read back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id, kind)
    return read_tokens(docs.sparkSession, path)
