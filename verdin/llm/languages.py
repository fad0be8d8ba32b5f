"""Language of web pages from text, declared markup language, address suffix and host.

The posterior of a language is the product of the text's likelihood, the
probability of the declared language under it, and a host prior that is
smoothed towards the prior of the host's suffix, and that one towards the prior of all pages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdin.llm.frames import pinned, text_bytes
from verdin.llm.urls import host_of

BUCKETS = 1 << 16
SAMPLE = 500
TEXT_WEIGHT = 0.3
HOST_WEIGHT = 8.0
SUFFIX_WEIGHT = 50.0
DECLARED_WEIGHT = 5.0
_HIDDEN = regex.compile(rb"(?is)<!--.*?-->|<(script|style|template)\b.*?</\1\s*>|<[^>]*>")
_MARKUP = (
    r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})",
    r"(?is)<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?([a-zA-Z]{2,3})",
)
_GRAM = np.uint32(0x9E3779B1)


def grams_of(data: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of a text, lower case, anything but letters as one blank."""
    words = b" ".join(data.lower().translate(_LETTERS).split())
    if not words:
        return np.zeros(0, dtype=np.int64)
    codes = np.frombuffer(b" " + words + b" ", dtype=np.uint8).astype(np.uint32)
    packed = codes[:-2] << np.uint32(16) | codes[1:-1] << np.uint32(8) | codes[2:]
    with np.errstate(over="ignore"):
        return (packed * _GRAM >> np.uint32(16)).astype(np.int64)


_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def visible(html: bytes) -> bytes:
    """Text of a page without tags, comments, scripts and styles; entities become blanks."""
    return regex.sub(rb"&#?\w{1,10};", b" ", _HIDDEN.sub(b" ", html))


def declared(html: Column) -> Column:
    """Language that the markup declares, lower case, empty if none."""
    found = [F.nullif(F.regexp_extract(html, pattern, 1), F.lit("")) for pattern in _MARKUP]
    return F.lower(F.coalesce(*found, F.lit("")))


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and log-likelihoods of trigram buckets per language.

    ``docs`` has ``doc_id``, ``text`` and ``lang``. At most ``sample`` documents per
    language are read, chosen by a hash of the id; one row of ``BUCKETS`` numbers
    per language reaches the driver. Null languages teach nothing.
    """
    ids = docs.where("lang is not null").select(F.col("doc_id"), F.col("lang"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = ids.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= sample).select("doc_id", "lang")
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("lang", "text")  # sample rows per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                total[lang] = total.get(lang, 0) + np.bincount(grams_of(data), minlength=BUCKETS)
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            columns = [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    counted = joined.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("all")).orderBy("lang").collect()
    names = [row["lang"] for row in rows]
    table = np.full((len(names), BUCKETS), 0.5)
    for k, row in enumerate(rows):
        for bucket, n in row["all"]:
            table[k, bucket] += n
    return names, np.log(table / table.sum(axis=1, keepdims=True)) if names else table


def identified(pages: DataFrame, docs: DataFrame, sample: int = SAMPLE, text_weight: float = TEXT_WEIGHT) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``suffix``, ``declared``, ``text_lang``, ``lang``, ``confidence``.

    Counts come from the text posteriors of all pages: per declared language, per
    suffix and per host (a page's own vote is taken out of its host). Null or
    empty pages rest on address and prior; without ``://`` host and suffix are
    empty, which counts as a host of its own. Equal posteriors go to the language
    first in code point order. Without any labelled document ``lang`` is
    null. Repeated pages count as often as they come; other columns are ignored.
    """
    names, table = fit(docs, sample)
    if not names:
        return pages.select(F.col("page_id").cast("long"), *[F.lit(None).cast("string").alias(c) for c in ("host", "suffix", "declared", "text_lang", "lang")], F.lit(None).cast("double").alias("confidence"))
    shared = pages.sparkSession.sparkContext.broadcast(table.astype(np.float32))
    size = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = []
            for data in text_bytes(batch.column(3)):
                grams = grams_of(visible(data))
                said = text_weight * shared.value[:, grams].sum(axis=1, dtype=np.float64)
                logs.append((said - np.logaddexp.reduce(said)).round(6).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(logs, pa.list_(pa.float64()))], names=["page_id", "host", "declared", "logs"])

    host = host_of(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long"), host.alias("host"), declared(F.col("html")).alias("declared"), "html")
    rows = rows.mapInArrow(run, "page_id long, host string, declared string, logs array<double>")
    rows = rows.withColumn("suffix", F.substring_index(F.regexp_replace("host", r":\d*$", ""), ".", -1))
    rows = pinned(rows.select("page_id", "host", "suffix", "declared", *[F.col("logs")[k].alias(f"l{k}") for k in range(size)]))
    votes = [F.exp(F.col(f"l{k}")) for k in range(size)]

    def totals(of: DataFrame, key: str, name: str, columns: list[Column]) -> DataFrame:
        return of.groupBy(key).agg(*[F.sum(column).alias(f"{name}{k}") for k, column in enumerate(columns)])

    hosts = rows.groupBy("host", "suffix").agg(*[F.sum(v).alias(f"h{k}") for k, v in enumerate(votes)])
    hosts = pinned(hosts)
    suffixes = totals(hosts, "suffix", "s", [F.col(f"h{k}") for k in range(size)])
    everything = suffixes.agg(*[F.sum(f"s{k}").alias(f"g{k}") for k in range(size)]).first()  # one row
    world = [((everything[k] or 0.0) + 1.0) for k in range(size)]
    world = [w / sum(world) for w in world]
    markup = totals(rows, "declared", "d", votes)
    sums = [max(1e-9, everything[k] or 0.0) for k in range(size)]
    seen = markup.agg(*[F.sum(f"d{k}").alias(f"d{k}") for k in range(size)], F.count("*").alias("kinds")).first()  # one row
    kinds = max(1, seen["kinds"] or 1)
    markup = markup.select(
        "declared", *[F.log((F.col(f"d{k}") + DECLARED_WEIGHT / kinds) / (sums[k] + DECLARED_WEIGHT)).alias(f"m{k}") for k in range(size)]
    )
    above = sum((F.col(f"s{k}") for k in range(size)), F.lit(0.0))
    suffixes = suffixes.select("suffix", *[((F.col(f"s{k}") + SUFFIX_WEIGHT * world[k]) / (above + SUFFIX_WEIGHT)).alias(f"p{k}") for k in range(size)])
    hosts = hosts.join(suffixes, "suffix").drop("suffix")
    full = rows.join(hosts, "host").join(markup, "declared")
    number = sum((F.col(f"h{k}") for k in range(size)), F.lit(0.0)) - 1
    posterior = [
        F.col(f"l{k}") + F.col(f"m{k}") + F.log((F.greatest(F.col(f"h{k}") - votes[k], F.lit(0.0)) + HOST_WEIGHT * F.col(f"p{k}")) / (number + HOST_WEIGHT))
        for k in range(size)
    ]
    full = full.withColumns({f"q{k}": F.round(p, 6) for k, p in enumerate(posterior)})
    best = F.greatest(*[F.col(f"q{k}") for k in range(size)]) if size > 1 else F.col("q0")
    said = F.greatest(*[F.col(f"l{k}") for k in range(size)]) if size > 1 else F.col("l0")
    weight = sum((F.exp(F.col(f"q{k}") - best) for k in range(size)), F.lit(0.0))

    def first(prefix: str, top: Column) -> Column:
        return F.coalesce(*[F.when(F.col(f"{prefix}{k}") == top, F.lit(name)) for k, name in enumerate(names)])

    return full.select(
        "page_id", "host", "suffix", "declared", first("l", said).alias("text_lang"), first("q", best).alias("lang"), F.round(1 / weight, 6).alias("confidence")
    )
