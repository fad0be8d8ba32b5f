"""Routing of newly created objects: who sent it, may it be processed, was it seen before."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from verdin.functions.parsers import job_name, key_extension, mail_in_key, unquote

RECORDS = "Records ARRAY<STRUCT<s3: STRUCT<bucket: STRUCT<name: STRING>, object: STRUCT<key: STRING>>>>"


def read_notifications(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of notification documents (JSON lines) as they arrive in a folder."""
    reader = spark.readStream.schema(RECORDS)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).json(folder)


def object_records(notifications: DataFrame) -> DataFrame:
    """One row per created object: bucket and decoded key."""
    rows = notifications.select(F.explode("Records").alias("record"))
    return rows.select(
        F.col("record.s3.bucket.name").alias("bucket"), unquote(F.col("record.s3.object.key")).alias("key")
    )


def approved_mails(table: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Distinct tidy mails of the first candidate column that the table has."""
    names = {c.strip().lower(): c for c in table.columns}
    column = next((names[c.strip().lower()] for c in candidates if c.strip().lower() in names), None)
    if column is None:
        raise ValueError(f"no mail column among {list(candidates)}")
    tidy = F.lower(F.trim(F.col(column).cast("string")))
    return table.select(tidy.alias("approved")).where("approved <> ''").distinct()


def route(records: DataFrame, approved: DataFrame, allowed: Sequence[str], key: str = "key") -> DataFrame:
    """Add the sender's mail and the reason for skipping (null when the object is to be processed).

    The same function serves batches and streams; Spark picks the join strategy
    from the size of the approved list.
    """
    mailed = records.withColumn("mail", mail_in_key(F.col(key)))
    joined = mailed.join(approved, F.col("mail") == F.col("approved"), "left")
    return joined.withColumn("reason", skip_reason(F.col(key), F.col("mail"), F.col("approved"), allowed)).drop("approved")


def skip_reason(key: Column, mail: Column, approved: Column, allowed: Sequence[str]) -> Column:
    known = key_extension(key).isin(*[a.lower().lstrip(".") for a in allowed])
    # fixed values: reason names
    return (
        F.when(~known, F.lit("ext_not_allowed"))
        .when(mail.isNull(), F.lit("no_email_in_key"))
        .when(approved.isNull(), F.lit("correo_no_aprobado"))
    )


def mark_repeats(routed: DataFrame, done: DataFrame | None, key: str = "key", row: str = "row_id") -> DataFrame:
    """``status``: started for the first request of a key, already_exists for every other one.

    ``row`` numbers the requests. The first one is found by a minimum that is
    combined on the map side, so a key requested very often is not gathered.
    """
    first = routed.groupBy(F.col(key).alias("_key")).agg(F.min(row).alias("_first"))
    if done is not None:
        first = first.join(done.select(F.col(key).alias("_key")).distinct(), "_key", "left_anti")
    joined = routed.join(first, F.col(key) == F.col("_key"), "left")
    started = F.coalesce(F.col("_first") == F.col(row), F.lit(False))
    status = F.when(started, F.lit("started")).otherwise(F.lit("already_exists"))
    return joined.withColumn("status", status).drop("_key", "_first")


class StartOnce(StatefulProcessor):
    """Keeps one value per key, in the state store: that the key was started.

    The first request of a key is ``started``, every other one ``already_exists``.
    With ``keep_ms`` a key is forgotten that long after its start.
    """

    def __init__(self, keep_ms: int | None = None) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.started = handle.getValueState("started", "done boolean", self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        known = self.started.exists()
        if not known:
            self.started.update((True,))
        for row in rows:
            yield Row(bucket=row.bucket, key=row.key, mail=row.mail, status="already_exists" if known else "started")
            known = True

    def handleInitialState(self, key: tuple, initialState: Row, timerValues: object) -> None:  # noqa: N802, N803
        self.started.update((True,))

    def close(self) -> None:
        pass


STARTS = "bucket STRING, key STRING, mail STRING, status STRING"
ROUTED = f"{STARTS}, reason STRING"


#: Rows that one array makes at most when requests are laid out again.
LAID_OUT = 4096


def with_statuses(batch: DataFrame) -> DataFrame:
    """The requests of a batch as rows with their ``status``, where ``first`` marks the extra row of a key's first request.

    Requests have no identity besides their columns, so they are counted and laid out again: one of them is
    ``started`` where the key is new, the others are ``already_exists``; those with a reason have no status.
    A key requested very often is counted on the map side.
    """
    counted = batch.groupBy("bucket", "key", "mail", "reason").agg(F.count_if("first").alias("started"), F.count_if(~F.col("first")).alias("n"))
    wanted = F.array(
        F.struct(F.lit("started").alias("status"), F.col("started").alias("n")),
        F.struct(F.lit("already_exists").alias("status"), (F.col("n") - F.col("started")).alias("n")),
    )
    left_out = F.array(F.struct(F.lit(None).cast("string").alias("status"), F.col("n").alias("n")))
    parts = F.explode(F.when(F.col("reason").isNull(), wanted).otherwise(left_out)).alias("part")
    columns = ["bucket", "key", "mail", "reason"]
    sized = counted.select(*columns, parts).select(*columns, "part.*").where("n > 0")
    cut = sized.withColumn("cut", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / LAID_OUT))))
    rows = F.least(F.lit(LAID_OUT), F.col("n") - F.col("cut") * LAID_OUT).cast("int")
    return cut.select(*columns, F.explode(F.array_repeat("status", rows)).alias("status"))


def run_routing(
    notifications: DataFrame,
    approved_path: str,
    mail_columns: Sequence[str],
    allowed: Sequence[str],
    output: str,
    checkpoint: str,
    stamp: str,
    keep_ms: int | None = None,
) -> StreamingQuery:
    """Route a stream until the present input is used up; ``processed`` and ``skipped`` read the result.

    A run reads the approved list as it is at its start. Started keys live in the
    state store of the checkpoint, one value per key, so a batch touches the state
    of its own keys only: Spark's streaming deduplication, or ``StartOnce`` where keys are forgotten
    after ``keep_ms``. A batch is written once, over its own folder below the id of its
    query; repeated after a failure it starts from the state before it and
    overwrites itself. A query starts nothing again that others started below ``output`` before its run.
    """
    session = notifications.sparkSession
    approved = approved_mails(session.read.parquet(approved_path), mail_columns)
    routed = route(object_records(notifications), approved, allowed).select("bucket", "key", "mail", "reason")
    wanted = routed.where("reason IS NULL").drop("reason")
    new = not _exists(session, f"{checkpoint}/metadata", "text")
    own = [] if new else [_query_id(session, checkpoint)]
    if keep_ms:
        earlier = started_keys(session, output) if new else None
        marked = wanted.groupBy("key").transformWithState(
            StartOnce(keep_ms),
            outputStructType=STARTS,
            outputMode="Append",
            timeMode="ProcessingTime",
            initialState=None if earlier is None else earlier.groupBy("key"),
        )
        named = marked.unionByName(routed.where("reason IS NOT NULL"), allowMissingColumns=True)
    else:
        earlier = started_keys(session, output, *own)
        if earlier is not None and not earlier.isEmpty():
            wanted = wanted.join(earlier, "key", "left_anti").select(*wanted.columns)
        first = wanted.dropDuplicates(["key"]).withColumns({"reason": F.lit(None).cast("string"), "first": F.lit(True)})
        named = routed.withColumn("first", F.lit(False)).unionByName(first)

    def one_batch(batch: DataFrame, number: int) -> None:
        if not own:
            own.append(_query_id(session, checkpoint))
        rows = batch if keep_ms else with_statuses(batch)
        going = F.col("reason").isNull()
        rows = rows.withColumns({"job": F.when(going, job_name(F.col("key"), stamp)), "outcome": F.when(going, F.lit("processed")).otherwise(F.lit("skipped"))})
        # one write: the plan holds the state operator and must not run twice
        rows.write.mode("overwrite").partitionBy("outcome").parquet(f"{output}/routed/run={own[0]}/batch={number}")

    writer = named.writeStream.outputMode("append").foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    # a time to live asks for further batches for ever; a run ends with its input
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = session.conf.get(setting)
    session.conf.set(setting, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        session.conf.set(setting, before)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def _exists(spark: SparkSession, path: str, kind: str) -> bool:
    try:
        return bool(spark.read.format(kind).load(path).columns)
    except AnalysisException:
        return False


def outcomes(spark: SparkSession, output: str) -> DataFrame:
    """All routed objects of all runs: the routed columns, ``job``, ``run``, ``batch`` and ``outcome``."""
    return spark.read.schema(f"{ROUTED}, job STRING, run STRING, batch INT, outcome STRING").parquet(f"{output}/routed")


def processed(spark: SparkSession, output: str) -> DataFrame:
    return outcomes(spark, output).where("outcome = 'processed'").drop("outcome", "reason")


def skipped(spark: SparkSession, output: str) -> DataFrame:
    return outcomes(spark, output).where("outcome = 'skipped'").drop("outcome", "status", "job")


def started_keys(spark: SparkSession, output: str, *besides: str) -> DataFrame | None:
    """Keys that any run started, but for the runs ``besides``; none when nothing was written yet."""
    if not _exists(spark, f"{output}/routed", "parquet"):
        return None
    rows = processed(spark, output).where("status = 'started'")
    return rows.where(~F.col("run").isin(*besides)).select("key").distinct()
