"""Lines that several documents share, kept in the first document only, against levelled sorted runs of line hashes.

Documents come in batches of ascending ids. A run is a table of line hashes with the
first document of each, hashed into buckets and sorted inside them. A new batch
is reduced to its distinct hashes (combined on the map side, so a line in a third of all
documents is one row per task), anti-joined with every run by merging, bucket by
bucket, and what is left becomes the next run. Before a batch, a level that holds
``FAN`` runs is compacted into one run of the next level, so a batch meets a number of
runs that grows with the logarithm of the number of batches.

A line stays exactly where its run row (hash, document) says so. All other lines of the
batch are found by an anti-join on hash and document together, which spreads a hot line
over its documents. Only column expressions are used; no row leaves the JVM.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdin.llm.frames import lower_ascii
from verdin.session import scratch_path, shuffle_width

SPACE = " \t\n\v\f\r"
#: Keys of fewer code points stay everywhere.
LEAST_CHARS = 10
BATCHES = 4
FAN = 2
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(lower_ascii(bare))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def hashed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per line with a long enough key: document, digest of its text, line number, and 128 bits of the key's hash."""
    lines = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("version"), F.posexplode(text_lines(F.col("text"))))
    keyed = lines.withColumn("key", line_key(F.col("col"))).where(F.length("key") >= least_chars)
    return keyed.select("doc", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


class Runs:
    """Levels of sorted runs, each a bucketed table (h1, h2, doc) below the shared folder.

    ``add`` takes batches of ascending documents; ``close`` takes the tables out of the catalogue.
    """

    def __init__(self, spark: SparkSession, fan: int = FAN) -> None:
        self.spark, self.fan = spark, fan
        self.buckets = shuffle_width(spark)
        self.levels: list[list[str]] = []
        self.tables: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.tables.append(name)
        writer = rows.write.format("parquet").option("path", scratch_path(self.spark, "lines"))
        writer.bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name)
        return name

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in the lines of a batch and return those to be dropped, all columns as they are."""
        self._compact()
        new = lines.groupBy(*HASH).agg(F.min("doc").alias("doc"))  # a null id comes after all others
        for level in self.levels:
            for run in level:
                new = new.join(self.spark.table(run).hint("merge"), HASH, "left_anti")
        name = self._write(new)
        self.levels = self.levels or [[]]
        self.levels[0].append(name)
        kept = self.spark.table(name)
        same = [lines[column].eqNullSafe(kept[column]) if column == "doc" else lines[column] == kept[column] for column in [*HASH, "doc"]]
        return lines.join(kept, same[0] & same[1] & same[2], "left_anti")

    def _compact(self) -> None:
        for level, held in enumerate(self.levels):
            if len(held) >= self.fan:
                rows = reduce(DataFrame.unionAll, [self.spark.table(name) for name in held])
                self.levels[level] = []
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(rows.repartition(self.buckets, *HASH)))

    def close(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables, self.levels = [], []


def batch_number(docs: DataFrame, batches: int) -> Column:
    """Batches of about equal numbers of documents by ascending ``doc_id``; a null id belongs to the last one.

    Equal ids share a batch. The bounds are approximate and decide nothing but the order of work.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc"))
    bounds = ids.approxQuantile("doc", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else []
    number = F.lit(0)
    for bound in sorted(set(bounds)):
        number = number + (F.col("doc") > bound).cast("int")
    return F.coalesce(number, F.lit(len(set(bounds))))


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """``doc``, ``version`` and ``pos`` of every line to be dropped, written batch by batch."""
    spark = docs.sparkSession
    base = scratch_path(spark, "line-batches")
    lines = hashed_lines(docs, least_chars)
    lines.withColumn("batch", batch_number(docs, batches)).write.partitionBy("batch").parquet(f"{base}/lines")
    schema = "doc long, version long, pos int, h1 long, h2 long, batch int"
    found = spark.read.schema(schema).parquet(f"{base}/lines")
    runs = Runs(spark, fan)
    out = None
    try:
        for batch in range(batches):
            part = found.where(F.col("batch") == batch).drop("batch")
            runs.add(part).select("doc", "version", "pos").write.parquet(f"{base}/dropped/batch={batch}")
        out = spark.read.schema("doc long, version long, pos int").parquet(*[f"{base}/dropped/batch={batch}" for batch in range(batches)])
    finally:
        runs.close()
    return out


def deduplicated(docs: DataFrame, least_chars: int = LEAST_CHARS, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_lines`` before dropping, ``n_dropped``, and the ``kept`` text.

    A line whose key has ``least_chars`` code points and stands in two documents or more is
    dropped everywhere but in the smallest ``doc_id``; repeats inside that
    document stay. Null and empty texts are one empty line. Rows with one id are
    one document; null ids are one document after all others. Other columns are ignored; an empty
    table gives an empty result.
    """
    gone = dropped_lines(docs, least_chars, batches, fan).groupBy("doc", "version").agg(F.collect_list("pos").alias("gone"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row_version"))
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("row_version") == F.col("version"))
    joined = rows.join(gone.hint("shuffle_hash"), same, "left")
    split = joined.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_lines(F.col("text")).alias("lines"), "gone")
    n_lines = F.size("lines")
    places = F.array_except(F.sequence(F.lit(0), n_lines - 1), "gone")
    left = F.array_join(F.transform(places, lambda place: F.get("lines", place)), "\n")
    return split.select(
        "doc_id",
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0)).otherwise(n_lines - F.size(places)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("kept"),
    )


def digests(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = """WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM s),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key),
    m AS (SELECT k.*, coalesce(doc_id <> first, false) AS gone FROM k LEFT JOIN f USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id"""
