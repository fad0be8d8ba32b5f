"""Relational queries: scans, filters, recodes, joins, aggregates, sets, sorts, periods.

Orders stand in for enrolments and receipts: the id is the customer, the period
is the half-year of the order date, status F is paid.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdin.functions import dates
from verdin.operators import columns, features, joins, kpi, periods, ranking, students
from verdin.plans.registry import query
from verdin.plans.scoring import rounded
from verdin.session import read_table, scratch_path
from verdin.sources import readers, staged

HALVES = tuple(f"{year}{half}" for year in range(1995, 2002) for half in "AB")
PERIOD_SQL = "CAST(year(o_orderdate) AS VARCHAR) || CASE WHEN month(o_orderdate) <= 6 THEN 'A' ELSE 'B' END"
AS_OF = dt.date(2001, 12, 31)


def enrolments(spark: SparkSession, folder: str) -> DataFrame:
    half = F.when(F.month("o_orderdate") <= 6, F.lit("A")).otherwise(F.lit("B"))
    return read_table(spark, folder, "orders").withColumn(
        "period", F.concat(F.year("o_orderdate").cast("string"), half)
    )


ENROLMENTS = f"enrol AS (SELECT *, {PERIOD_SQL} AS period FROM orders)"
ORDINALS = "ords AS (SELECT unnest([{0}]) AS code, unnest(range(1, {1})) AS ord)".format(
    ", ".join(f"'{h}'" for h in HALVES), len(HALVES) + 1
)


# ---------------------------------------------------------------- scans and sinks
@query(
    "s1_extract_query",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_returnflag = 'R' AND l_shipdate < TIMESTAMP '1998-01-01'""",
)
def extract_query(spark, folder):
    text = "SELECT l_orderkey, l_linenumber, l_quantity FROM source WHERE l_returnflag = 'R' AND l_shipdate < TIMESTAMP_NTZ '1998-01-01'"
    return readers.extract(spark, f"{folder}/lineitem.parquet", text)


@query("s2_delimited_round_trip", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def delimited_round_trip(spark, folder):
    path = scratch_path(spark, "orders-csv")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    staged.write_delimited(orders, path, compress=True)
    return readers.read_delimited(spark, path, "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE")


@query(
    "s3_text_columns",
    """SELECT CAST(c_custkey AS VARCHAR) AS call_id, c_name AS recording, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS note
       FROM customer""",
)
def text_columns(spark, folder):
    path = scratch_path(spark, "calls-csv")
    note = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).otherwise(F.lit(""))
    calls = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias(" Call_ID "), F.col("c_name").alias("Recording"), note.alias("NOTE")
    )
    calls.write.option("header", True).option("sep", ";").csv(path)
    return readers.read_text_columns(spark, path)


@query("s10_replace_table", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def replace_table(spark, folder):
    path = scratch_path(spark, "orders-table")
    table = f"orders_copy_{path.rsplit('-', 1)[1]}"
    staged.replace_table(read_table(spark, folder, "orders"), table, path)
    return spark.table(table).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- projections and filters
@query(
    "p1_list_and_equality",
    f"""WITH {ENROLMENTS} SELECT o_orderkey, period FROM enrol
        WHERE period IN ('1996A', '1996B', '1999A') AND o_orderstatus = 'F'""",
)
def list_and_equality(spark, folder):
    wanted = F.col("period").isin("1996A", "1996B", "1999A") & (F.col("o_orderstatus") == "F")
    return enrolments(spark, folder).where(wanted).select("o_orderkey", "period")


def within(moment: str, start: dt.datetime | None, end: dt.datetime | None):
    """Half-open range; a missing bound is open."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col(moment) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        condition = condition & (F.col(moment) < F.lit(end).cast("timestamp_ntz"))
    return condition


@query(
    "p2_half_open_range",
    "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'",
)
def half_open_range(spark, folder):
    week = within("ts", dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15))
    return read_table(spark, folder, "events").where(week).select("event_id", "user_id")


@query(
    "p2_open_ended_range",
    "SELECT event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY event_type",
)
def open_ended_range(spark, folder):
    before = within("ts", None, dt.datetime(2024, 1, 15))
    return read_table(spark, folder, "events").where(before).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("p3_contains_not_blank", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RED%' AND trim(p_name) <> ''")
def contains_not_blank(spark, folder):
    part = read_table(spark, folder, "part")
    return part.where(F.col("p_name").ilike("%red%") & (F.trim("p_name") != "")).select("p_partkey", "p_name")


@query("p4_prefix_filter", "SELECT page_id, url FROM pages WHERE NOT starts_with(lower(url), 'https')")
def prefix_filter(spark, folder):
    return read_table(spark, folder, "pages").where(~F.lower("url").startswith("https")).select("page_id", "url")


@query(
    "p5_searched_case",
    f"""WITH {ENROLMENTS}, last AS (SELECT o_custkey, max(period) AS paid FROM enrol WHERE o_orderstatus = 'F' GROUP BY o_custkey)
    SELECT o_orderkey,
      CASE WHEN paid IS NULL OR paid = period THEN 'NO HA PAGADO' ELSE 'YA PAGO' END AS payment_state,
      coalesce(paid, 'NO HA PAGADO') AS paid_period
    FROM enrol LEFT JOIN last USING (o_custkey)""",
)
def searched_case(spark, folder):
    rows = enrolments(spark, folder)
    last = periods.last_paid_period(rows.where("o_orderstatus = 'F'"), "o_custkey", "period")
    states = periods.payment_state(F.col("period"), F.col("last_paid"))
    return rows.join(last, "o_custkey", "left").withColumns(states).select("o_orderkey", "payment_state", "paid_period")


@query(
    "p6_tidy_names",
    'SELECT c_custkey AS client, c_name AS "full name", c_mktsegment AS segment FROM customer',
)
def tidy_names(spark, folder):
    customer = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias(" Client "), F.col("c_name").alias("Full Name"), F.col("c_mktsegment").alias("SEGMENT")
    )
    return columns.tidy_header(customer)


@query("p8_drop_repeated", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def drop_repeated(spark, folder):
    orders = read_table(spark, folder, "orders")
    twice = orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.upper("o_orderpriority").alias("o_orderstatus"))
    return columns.drop_repeated(twice, keep="first")


@query("p8_drop_repeated_keep_last", "SELECT o_orderkey, o_totalprice, o_orderpriority AS o_orderstatus FROM orders")
def drop_repeated_keep_last(spark, folder):
    orders = read_table(spark, folder, "orders")
    twice = orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderpriority").alias("o_orderstatus"))
    return columns.drop_repeated(twice, keep="last")


@query("p9_drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def drop_columns(spark, folder):
    return read_table(spark, folder, "orders").drop("o_totalprice", "o_orderdate", "o_orderpriority", "absent")


@query(
    "p11_fixed_schema",
    """SELECT conv_id AS archivo, role AS asesor, CAST('' AS VARCHAR) AS cedula, CAST(NULL AS DOUBLE) AS puntaje,
              CAST(250 AS INT) AS size FROM conversations""",
)
def fixed_schema(spark, folder):
    rows = read_table(spark, folder, "conversations").select(F.col("conv_id").alias("archivo"), F.col("role").alias("asesor"))
    wanted = {"archivo": "bigint", "asesor": "string", "cedula": "string", "puntaje": "double", "size": "int"}
    return columns.fixed_schema(rows, wanted, {"cedula": "", "size": 250})


@query(
    "p13_numbered_columns",
    """SELECT page_id, url AS "address#1", CAST(NULL AS VARCHAR) AS "address#2", html AS "address#3" FROM pages""",
)
def numbered_columns(spark, folder):
    pages = read_table(spark, folder, "pages")
    sheet = pages.select("page_id", F.col("url").alias("address#1"), F.col("html").alias("address#3"))
    return columns.numbered_columns(sheet, "address", 3)


@query(
    "p13_single_column_fallback",
    """SELECT page_id, url AS "address#1", CAST(NULL AS VARCHAR) AS "address#2" FROM pages""",
)
def single_column_fallback(spark, folder):
    sheet = read_table(spark, folder, "pages").select("page_id", F.col("url").alias("address"))
    return columns.numbered_columns(sheet, "address", 2).drop("address")


@query(
    "p14_recode",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'PAGO' ELSE 'NO' END AS paid,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'HIGH' ELSE o_orderpriority END AS priority
       FROM orders""",
)
def recode(spark, folder):
    priority = columns.recode(F.col("o_orderpriority"), {"1-URGENT": "HIGH", "2-HIGH": "HIGH"})
    paid = columns.recode(F.col("o_orderstatus"), {"F": "PAGO"}, F.lit("NO"))
    return read_table(spark, folder, "orders").select("o_orderkey", paid.alias("paid"), priority.alias("priority"))


@query(
    "p15_canonical_names",
    """SELECT p_partkey, CASE upper(p_name) WHEN 'RED WIDGET' THEN 'RED GADGET' WHEN 'RED GADGET' THEN 'CRIMSON GADGET'
       WHEN 'SMALL RING' THEN 'RING' ELSE upper(p_name) END AS name FROM part""",
)
def canonical_names(spark, folder):
    mapping = {"RED WIDGET": "RED GADGET", "RED GADGET": "CRIMSON GADGET", "SMALL RING": "RING"}
    part = read_table(spark, folder, "part").select("p_partkey", F.upper("p_name").alias("name"))
    return part.replace(mapping, subset=["name"])


@query(
    "p16_nulls_to_zero",
    """SELECT o_orderkey, coalesce(CASE WHEN o_totalprice > 200000 THEN o_totalprice END, 0) AS big,
       CAST(coalesce(CASE WHEN o_orderstatus = 'F' THEN 1 END, 0) AS INT) AS paid FROM orders""",
)
def nulls_to_zero(spark, folder):
    sparse = read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice")).alias("big"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).alias("paid"),
    )
    return columns.zero_nulls(sparse, ["big", "paid"])


@query(
    "p17_overwrite_by_nullness",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'ACTIVO' ELSE o_orderstatus END AS state,
       CASE WHEN o_totalprice > 300000 THEN 'SI' ELSE 'NO' END AS schedule FROM orders""",
)
def overwrite_by_nullness(spark, folder):
    grade = F.when(F.col("o_totalprice") > 300000, F.col("o_totalprice"))
    rows = read_table(spark, folder, "orders").withColumn("grade", grade)
    known = F.col("grade").isNotNull()
    return rows.select(
        "o_orderkey",
        F.when(known, F.lit("ACTIVO")).otherwise(F.col("o_orderstatus")).alias("state"),
        F.when(known, F.lit("SI")).otherwise(F.lit("NO")).alias("schedule"),
    )


@query(
    "x2_row_function",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN 'A'
       WHEN o_orderpriority = '1-URGENT' THEN 'B' ELSE 'C' END AS class FROM orders""",
)
def row_function(spark, folder):
    chosen = (
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000), F.lit("A"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit("B"))
        .otherwise(F.lit("C"))
    )
    return read_table(spark, folder, "orders").select("o_orderkey", chosen.alias("class"))


# ---------------------------------------------------------------- joins
@query(
    "j1_latest_per_key",
    """WITH last AS (SELECT o_custkey, max(o_orderdate) AS d FROM orders WHERE o_orderdate < TIMESTAMP '2000-07-01' GROUP BY o_custkey)
    SELECT o.o_orderkey, o.o_custkey, o.o_orderdate FROM orders o JOIN last ON o.o_custkey = last.o_custkey AND o.o_orderdate = last.d""",
)
def latest_per_key(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cutoff = F.lit(dt.datetime(2000, 7, 1)).cast("timestamp_ntz")
    return joins.latest_per_key(orders, "o_custkey", "o_orderdate", cutoff)


@query(
    "j2_composite_key",
    """SELECT a.l_orderkey, a.l_linenumber, a.l_quantity, b.total FROM lineitem a
       JOIN (SELECT l_orderkey, l_linenumber, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY ALL) b
       ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber""",
)
def composite_key(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    totals = lines.groupBy("l_orderkey", "l_linenumber").agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))
    return lines.select("l_orderkey", "l_linenumber", "l_quantity").join(totals, ["l_orderkey", "l_linenumber"])


@query(
    "j3_left_join_chain",
    """SELECT c.c_custkey, c.c_name, n.n_name, o.o_orderkey, t.tickets FROM customer c
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F') o ON c.c_custkey = o.o_custkey
       LEFT JOIN (SELECT l_orderkey, count(*) AS tickets FROM lineitem GROUP BY 1) t ON o.o_orderkey = t.l_orderkey""",
)
def left_join_chain(spark, folder):
    base = read_table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    orders = read_table(spark, folder, "orders").where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey")
    tickets = read_table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("tickets"))
    steps = [
        (nation, {"c_nationkey": "n_nationkey"}),
        (orders, {"c_custkey": "o_custkey"}),
        (tickets, {"o_orderkey": "l_orderkey"}),
    ]
    return joins.chain_left(base, steps).drop("c_nationkey")


@query(
    "j4_left_join_aggregates",
    f"""WITH {ENROLMENTS}, paid AS (SELECT * FROM enrol WHERE o_orderstatus = 'F'),
    t1 AS (SELECT o_custkey, max(period) AS last_paid FROM paid GROUP BY 1),
    t2 AS (SELECT o_custkey, period, max(o_orderpriority) AS novelty FROM paid GROUP BY 1, 2)
    SELECT e.o_orderkey, t1.last_paid, t2.novelty FROM enrol e LEFT JOIN t1 ON e.o_custkey = t1.o_custkey
    LEFT JOIN t2 ON e.o_custkey = t2.o_custkey AND e.period = t2.period""",
)
def left_join_aggregates(spark, folder):
    rows = enrolments(spark, folder)
    paid = rows.where("o_orderstatus = 'F'")
    last = periods.last_paid_period(paid, "o_custkey", "period")
    novelty = paid.groupBy("o_custkey", "period").agg(F.max("o_orderpriority").alias("novelty"))
    joined = rows.join(last, "o_custkey", "left").join(novelty, ["o_custkey", "period"], "left")
    return joined.select("o_orderkey", "last_paid", "novelty")


@query(
    "j5_cast_key",
    """SELECT o.o_orderkey, s.c_name FROM orders o
       JOIN (SELECT CAST(c_custkey AS VARCHAR) AS key, c_name FROM customer) s ON CAST(o.o_custkey AS VARCHAR) = s.key""",
)
def cast_key(spark, folder):
    people = read_table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("key"), "c_name")
    orders = read_table(spark, folder, "orders").withColumn("key", F.col("o_custkey").cast("string"))
    return orders.join(people, "key").select("o_orderkey", "c_name")


@query(
    "j6_three_way_join",
    """SELECT o.o_orderkey, l.l_linenumber, s.s_name, o.o_orderdate FROM orders o
       JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
       WHERE o.o_orderstatus <> 'P' AND o.o_orderdate >= TIMESTAMP '1999-09-23'
       ORDER BY o.o_orderdate DESC, o.o_orderkey, l.l_linenumber""",
)
def three_way_join(spark, folder):
    orders = read_table(spark, folder, "orders")
    since = F.lit(dt.datetime(1999, 9, 23)).cast(orders.schema["o_orderdate"].dataType)  # compared as it is, so that the scan filters
    recent = F.col("o_orderdate") >= since
    orders = orders.where((F.col("o_orderstatus") != "P") & recent)
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    suppliers = read_table(spark, folder, "supplier").select("s_suppkey", "s_name")
    joined = orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        joined.join(suppliers, F.col("s_suppkey") == F.col("l_suppkey"))
        .select("o_orderkey", "l_linenumber", "s_name", "o_orderdate")
        .orderBy(F.desc("o_orderdate"), "o_orderkey", "l_linenumber")
    )


@query(
    "j7_key_set_pushdown",
    f"""WITH {ENROLMENTS}, keys AS (SELECT DISTINCT o_custkey, period FROM enrol WHERE o_totalprice > 400000)
    SELECT e.o_orderkey, e.o_custkey, e.period FROM enrol e SEMI JOIN keys k ON e.o_custkey = k.o_custkey AND e.period = k.period""",
)
def key_set_pushdown(spark, folder):
    rows = enrolments(spark, folder).select("o_orderkey", "o_custkey", "period", "o_totalprice")
    keys = rows.where(F.col("o_totalprice") > 400000)
    return joins.found(rows.select("o_orderkey", "o_custkey", "period"), keys, ["o_custkey", "period"])


MAIL_SQL = "lower(replace(c_name, '#', '.')) || '@example.com'"


@query(
    "j8_lookup_last_wins",
    """WITH staff AS (SELECT c_mktsegment AS seg, max_by(c_name, c_custkey) AS who FROM customer WHERE c_acctbal > 0 GROUP BY 1)
    SELECT c.c_custkey, coalesce(s.who, '') AS who FROM customer c LEFT JOIN staff s ON c.c_mktsegment = s.seg AND c.c_acctbal > 0""",
)
def lookup_last_wins(spark, folder):
    customer = read_table(spark, folder, "customer")
    staff = customer.where("c_acctbal > 0").select(F.col("c_mktsegment").alias("seg"), "c_name", F.col("c_custkey").alias("line"))
    asked = customer.select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment"))
    return joins.lookup(asked, staff, "segment", "seg", "c_name", "line", "who").select("c_custkey", "who")


@query(
    "j9_fill_from_metadata",
    f"""WITH meta AS (SELECT CAST(c_custkey AS VARCHAR) AS id, CAST('2024-02-02' AS VARCHAR) AS day, c_name AS phone
                      FROM customer WHERE c_acctbal > 2000)
    SELECT o.o_orderkey, coalesce(m.day, '2024-01-01') AS day,
           CASE WHEN o.o_orderstatus = 'F' THEN m.phone ELSE o.o_orderstatus END AS phone
    FROM orders o LEFT JOIN meta m ON CAST(o.o_custkey AS VARCHAR) = m.id""",
)
def fill_from_metadata(spark, folder):
    meta = read_table(spark, folder, "customer").where("c_acctbal > 2000").select(
        F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" ")).alias("id"),
        F.lit("2024-02-02").alias("day"),
        F.col("c_name").alias("phone"),
    )
    own = F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.col("o_orderstatus"))
    base = read_table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("id"), F.lit("2024-01-01").alias("day"), own.alias("phone")
    )
    return joins.fill_from(base, meta, "id", prefer=["day"], fill_empty=["phone"]).drop("id")


@query(
    "j14_role_override",
    """WITH roles AS (SELECT lower(s_name) AS mail, max_by('ROLE_' || s_nationkey, s_suppkey) AS role
                      FROM supplier WHERE s_acctbal > 3000 GROUP BY 1)
    SELECT s_suppkey,
      CASE WHEN s_nationkey IN (3, 5) THEN 'team ' || s_nationkey || '@example.com' ELSE lower(s_name) END AS mail,
      CASE WHEN s_nationkey IN (3, 5) THEN 'TEAM ROLE' ELSE coalesce(r.role, 'SIN_CARGO_DEFINIDO') END AS role
    FROM supplier LEFT JOIN roles r ON r.mail = lower(s_name)""",
)
def role_override(spark, folder):
    return _with_roles(spark, folder).select("s_suppkey", "mail", "role")


def _with_roles(spark, folder):
    supplier = read_table(spark, folder, "supplier")
    special = F.col("s_nationkey").isin(3, 5)
    owner = F.when(special, F.concat(F.lit(" Team "), F.col("s_nationkey"))).otherwise(F.col("s_name"))
    roles = supplier.where("s_acctbal > 3000").select(
        F.col("s_name").alias("mail"), F.concat(F.lit("ROLE_"), F.col("s_nationkey")).alias("role"), F.col("s_suppkey").alias("line")
    )
    return joins.role_of(
        supplier.withColumn("owner", owner), "owner", roles, ["team 3", "team 5"], "TEAM ROLE", "@example.com", "SIN_CARGO_DEFINIDO"
    )


@query(
    "a29_count_per_role",
    """WITH roles AS (SELECT lower(s_name) AS mail, 'ROLE_' || s_nationkey AS role FROM supplier WHERE s_acctbal > 3000)
    SELECT CASE WHEN s_nationkey IN (3, 5) THEN 'TEAM ROLE' ELSE coalesce(r.role, 'SIN_CARGO_DEFINIDO') END AS role, count(*) AS n
    FROM supplier LEFT JOIN roles r ON r.mail = lower(s_name) GROUP BY 1""",
)
def count_per_role(spark, folder):
    return _with_roles(spark, folder).groupBy("role").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j18_rows_by_week",
    "SELECT c_custkey, CAST(w AS INT) AS week FROM customer, range(1, 17) t(w)",
)
def rows_by_week(spark, folder):
    return features.weekly_rows(read_table(spark, folder, "customer").select("c_custkey"), 16)


@query(
    "j19_exists_flag",
    """SELECT c_custkey, CAST(EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000) AS INT) AS attended
       FROM customer c""",
)
def exists_flag(spark, folder):
    big = read_table(spark, folder, "orders").where("o_totalprice > 450000")
    return joins.exists_flag(read_table(spark, folder, "customer").select("c_custkey"), big, "c_custkey", "o_custkey", "attended")


# ---------------------------------------------------------------- aggregates
@query("a1_count_per_key", "SELECT l_suppkey, l_returnflag, count(*) AS tickets FROM lineitem GROUP BY ALL")
def count_per_key(spark, folder):
    return read_table(spark, folder, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("tickets"))


@query(
    "a2_last_period_text",
    f"WITH {ENROLMENTS} SELECT o_custkey, max(period) AS last_paid FROM enrol WHERE o_orderstatus = 'F' GROUP BY 1",
)
def last_period_text(spark, folder):
    return periods.last_paid_period(enrolments(spark, folder).where("o_orderstatus = 'F'"), "o_custkey", "period")


@query(
    "a2_last_period_ordinal",
    f"""WITH {ENROLMENTS}, {ORDINALS} SELECT o_custkey, max_by(period, ord) AS last_paid
        FROM enrol JOIN ords ON code = period WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def last_period_ordinal(spark, folder):
    paid = enrolments(spark, folder).where("o_orderstatus = 'F'")
    return periods.last_paid_period(paid, "o_custkey", "period", "ordinal", HALVES)


@query(
    "a3_distinct_groups",
    f"WITH {ENROLMENTS} SELECT DISTINCT o_custkey, period, max(o_orderpriority) AS novelty FROM enrol GROUP BY o_custkey, period",
)
def distinct_groups(spark, folder):
    return enrolments(spark, folder).groupBy("o_custkey", "period").agg(F.max("o_orderpriority").alias("novelty"))


@query(
    "a4_value_counts",
    """SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY 1""",
)
def value_counts(spark, folder):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return rounded(features.value_counts(read_table(spark, folder, "events").select(kind.alias("kind")), "kind"))


@query("a5_distinct_keys", f"WITH {ENROLMENTS} SELECT DISTINCT o_custkey, period FROM enrol")
def distinct_keys(spark, folder):
    return enrolments(spark, folder).select("o_custkey", "period").dropDuplicates()


@query(
    "a5_keep_first",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def keep_first(spark, folder):
    orders = read_table(spark, folder, "orders")
    first = ranking.first_per_key(orders, ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")])
    return first.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "a6_cardinality",
    """SELECT count(DISTINCT l_orderkey) AS l_orderkey, count(DISTINCT l_partkey) AS l_partkey,
       count(DISTINCT l_suppkey) AS l_suppkey, count(DISTINCT l_returnflag) AS l_returnflag FROM lineitem""",
)
def cardinality(spark, folder):
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"]
    return features.cardinality(read_table(spark, folder, "lineitem"), names)


@query(
    "a27_projection",
    """WITH t AS (SELECT o_orderstatus = 'F' AS done, o_totalprice / (o_totalprice + 100000.0) AS p FROM orders)
    SELECT count(*) AS n, count(*) FILTER (done) AS done, round(sum(p) FILTER (NOT done), 4) AS expected_more,
           round(count(*) FILTER (done) + sum(p) FILTER (NOT done), 4) AS projected FROM t""",
)
def projection(spark, folder):
    p = F.col("o_totalprice") / (F.col("o_totalprice") + 100000.0)
    rows = read_table(spark, folder, "orders").withColumn("p", p)
    return rounded(kpi.projection(rows, F.col("o_orderstatus") == "F"), 4)


@query(
    "a30_rare_to_other",
    """WITH f AS (SELECT p_name, count(*) AS n FROM part GROUP BY 1)
    SELECT p_partkey, CASE WHEN n < 32 THEN 'OTRO' ELSE p_name END AS p_name FROM part JOIN f USING (p_name)""",
)
def rare_to_other(spark, folder):
    part = read_table(spark, folder, "part").select("p_partkey", "p_name")
    return features.group_rare(part, "p_name", 32, "OTRO")


# ---------------------------------------------------------------- sorts, limits, sets
@query(
    "o3_multi_key_sort",
    f"WITH {ENROLMENTS} SELECT period, o_custkey, o_orderkey FROM enrol ORDER BY period, o_custkey, o_orderkey",
)
def multi_key_sort(spark, folder):
    return enrolments(spark, folder).select("period", "o_custkey", "o_orderkey").orderBy("period", "o_custkey", "o_orderkey")


@query("o4_largest_first", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id")
def largest_first(spark, folder):
    return read_table(spark, folder, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id")


@query("o5_top_n", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice LIMIT 500")
def top_n(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    order = [F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_quantity"), F.asc("l_extendedprice")]
    return ranking.top_rows(lines, order, 500).select("l_orderkey", "l_linenumber", "l_quantity")


@query("o5_zero_means_all", "SELECT s_suppkey, s_name FROM supplier")
def zero_means_all(spark, folder):
    return ranking.top_rows(read_table(spark, folder, "supplier"), [F.asc("s_suppkey")], 0).select("s_suppkey", "s_name")


@query(
    "u1_union_blocks",
    """SELECT 'open' AS block, o_orderkey FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT 'paid' AS block, o_orderkey FROM orders WHERE o_orderstatus = 'F'""",
)
def union_blocks(spark, folder):
    orders = read_table(spark, folder, "orders")
    opened = orders.where("o_orderstatus = 'O'").select(F.lit("open").alias("block"), "o_orderkey")
    paid = orders.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("paid").alias("block"))
    return opened.unionByName(paid)


@query("u2_key_difference", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def key_difference(spark, folder):
    labels = read_table(spark, folder, "labels").select("doc_id")
    return joins.not_found(read_table(spark, folder, "documents").select("doc_id"), labels, ["doc_id"]).orderBy("doc_id")


@query("u4_key_intersection", "SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 480000")
def key_intersection(spark, folder):
    big = read_table(spark, folder, "orders").where("o_totalprice > 480000").select(F.col("o_custkey").alias("c_custkey"))
    return read_table(spark, folder, "customer").select("c_custkey").intersect(big)


# ---------------------------------------------------------------- periods and dates
@query(
    "d5_age",
    "SELECT o_orderkey, CAST(date_sub('year', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INT) AS age FROM orders",
)
def age(spark, folder):
    rows = read_table(spark, folder, "orders")
    return rows.select("o_orderkey", dates.age_in_years(F.col("o_orderdate"), F.lit(AS_OF)).alias("age"))


@query(
    "d6_days_since",
    "SELECT o_orderkey, CAST(DATE '2001-12-31' - CAST(o_orderdate AS DATE) AS INT) AS days FROM orders",
)
def days_since(spark, folder):
    days = dates.days_since(F.col("o_orderdate").cast("date"), F.lit(AS_OF))
    return read_table(spark, folder, "orders").select("o_orderkey", days.alias("days"))


@query(
    "e1_period_order",
    f"""WITH {ENROLMENTS}, {ORDINALS} SELECT o_orderkey, period, CAST(ord AS INT) AS period_order
        FROM enrol JOIN ords ON code = period WHERE period <> '1995A'""",
)
def period_order(spark, folder):
    rows = enrolments(spark, folder).withColumn("period", F.concat(F.lit(" "), F.lower("period")))
    return periods.with_period_order(rows, "period", periods=("1995B-only", *HALVES[1:])).select(
        "o_orderkey", "period", "period_order"
    )


LABEL_SQL = f"""{ENROLMENTS}, {ORDINALS},
    last AS (SELECT o_custkey, max(period) AS paid FROM enrol WHERE o_orderstatus = 'F' GROUP BY o_custkey),
    lab AS (SELECT e.*, paid, a.ord AS ord,
      CASE WHEN NOT (paid IS NULL OR paid = period) AND b.ord > a.ord THEN 1 ELSE 0 END AS y
      FROM enrol e LEFT JOIN last USING (o_custkey) JOIN ords a ON a.code = e.period LEFT JOIN ords b ON b.code = paid)"""


def labelled_enrolments(spark: SparkSession, folder: str) -> DataFrame:
    rows = enrolments(spark, folder)
    last = periods.last_paid_period(rows.where("o_orderstatus = 'F'"), "o_custkey", "period")
    joined = rows.join(last, "o_custkey", "left").withColumns(
        periods.payment_state(F.col("period"), F.col("last_paid"))
    )
    label = periods.paid_later(F.col("payment_state"), F.col("period"), F.col("paid_period"), HALVES)
    return periods.with_period_order(joined, "period", periods=HALVES).withColumn("y", label)


@query("e2_paid_later_label", f"WITH {LABEL_SQL} SELECT o_orderkey, CAST(y AS INT) AS y FROM lab")
def paid_later_label(spark, folder):
    return labelled_enrolments(spark, folder).select("o_orderkey", "y")


@query(
    "r3_map_lookup",
    f"WITH {ENROLMENTS}, {ORDINALS} SELECT o_orderkey, CAST(coalesce(ord, -1) AS INT) AS place FROM enrol LEFT JOIN ords ON code = period AND ord <= 10",
)
def map_lookup(spark, folder):
    place = F.coalesce(periods.period_order(F.col("period"), HALVES[:10]), F.lit(-1))
    return enrolments(spark, folder).select("o_orderkey", place.alias("place"))


@query(
    "w6_last_period_split",
    f"""WITH {ENROLMENTS}, {ORDINALS}, o AS (SELECT o_orderkey, ord FROM enrol JOIN ords ON code = period)
    SELECT o_orderkey, CASE WHEN ord = (SELECT max(ord) FROM o) THEN 'validation' ELSE 'train' END AS part FROM o""",
)
def last_period_split(spark, folder):
    rows = periods.with_period_order(enrolments(spark, folder), "period", periods=HALVES)
    train, validation = ranking.split_last_period(rows, "period_order")
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(
        validation.select("o_orderkey", F.lit("validation").alias("part"))
    )


@query(
    "w7_time_folds",
    f"""WITH {ENROLMENTS}, r AS (SELECT o_orderkey, row_number() OVER (ORDER BY period, o_custkey, o_orderkey) - 1 AS i, count(*) OVER () AS n FROM enrol)
    SELECT o_orderkey, CAST(CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END AS INT) AS fold FROM r""",
)
def time_folds(spark, folder):
    rows = enrolments(spark, folder).select("period", "o_custkey", "o_orderkey")
    order = [F.asc("period"), F.asc("o_custkey"), F.asc("o_orderkey")]
    return ranking.time_folds(rows, order, 5).select("o_orderkey", "fold")


@query(
    "enrolment_base",
    f"""WITH {ENROLMENTS}, rc AS (SELECT o_custkey, period, o_orderpriority AS novelty, o_orderstatus AS place FROM enrol WHERE o_orderstatus <> 'O'),
    t1 AS (SELECT o_custkey, max(period) AS paid FROM rc WHERE period >= '1997A' GROUP BY 1),
    t2 AS (SELECT o_custkey, period, place, max(novelty) AS novelty FROM rc WHERE period < '2000A' GROUP BY 1, 2, 3)
    SELECT e.o_orderkey, e.o_custkey, e.period, t2.place, t2.novelty,
      CASE WHEN paid IS NULL OR paid = e.period THEN 'NO HA PAGADO' ELSE 'YA PAGO' END AS payment_state,
      coalesce(paid, 'NO HA PAGADO') AS paid_period
    FROM enrol e LEFT JOIN t1 ON e.o_custkey = t1.o_custkey LEFT JOIN t2 ON e.o_custkey = t2.o_custkey AND e.period = t2.period""",
)
def enrolment_base(spark, folder):
    rows = enrolments(spark, folder)
    receipts = rows.where("o_orderstatus <> 'O'").select(
        "o_custkey", "period", F.col("o_orderpriority").alias("novelty"), F.col("o_orderstatus").alias("place")
    )
    return periods.enrolment_base(
        rows.select("o_orderkey", "o_custkey", "period"),
        receipts,
        "o_custkey",
        "period",
        [h for h in HALVES if h >= "1997A"],
        [h for h in HALVES if h < "2000A"],
        ["place"],
        "novelty",
    )


# ---------------------------------------------------------------- the student base
@query(
    "student_base",
    """WITH last AS (SELECT o_custkey, max(o_orderdate) AS d FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01' GROUP BY 1),
    ap AS (SELECT l_orderkey, count(*) AS enrolled, count(*) FILTER (l_returnflag = 'A') AS approved FROM lineitem GROUP BY 1),
    gr AS (SELECT l_orderkey, l_partkey AS subject, l_quantity AS grade FROM lineitem WHERE l_discount > 0.07),
    tk AS (SELECT user_id, count(*) AS tickets FROM events GROUP BY 1),
    b AS (SELECT o.*, ap.enrolled, ap.approved, c.c_mktsegment, c.c_name, n.n_name, gr.subject, gr.grade, tk.tickets
      FROM orders o JOIN last ON last.o_custkey = o.o_custkey AND last.d = o.o_orderdate JOIN ap ON ap.l_orderkey = o.o_orderkey
      LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
      LEFT JOIN gr ON gr.l_orderkey = o.o_orderkey LEFT JOIN tk ON tk.user_id = o.o_custkey)
    SELECT o_orderkey, o_custkey, subject, grade, enrolled, approved, CAST(date_sub('year', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INT) AS age,
      CASE WHEN c_mktsegment = 'BUILDING' THEN 'NO TRABAJA' ELSE 'TRABAJA' END AS works, CAST(o_orderstatus = 'F' AS INT) AS status,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Presencial' WHEN '2-HIGH' THEN 'Virtual' ELSE o_orderpriority END AS modality,
      CASE WHEN o_orderstatus = 'F' THEN 'PAGO' ELSE 'NO' END AS payment_state, CAST(DATE '2001-12-31' - CAST(o_orderdate AS DATE) AS INT) AS days_since_access,
      CASE WHEN grade IS NOT NULL THEN 'ACTIVO' ELSE o_orderpriority END AS lms_state, CASE WHEN grade IS NOT NULL THEN 'SI' ELSE 'NO' END AS schedule,
      CASE WHEN o_totalprice > 250000 THEN 'SI' ELSE 'NO' END AS mail, CASE WHEN n_name = 'NATION_1' THEN 'FIRST NATION' ELSE n_name END AS region,
      coalesce(tickets, 0) AS tickets, 'NUEVO' AS student_state FROM b""",
)
def student_base(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    approvals = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("enrolled"), F.count_if(F.col("l_returnflag") == "A").alias("approved")
    )
    people = read_table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nations = read_table(spark, folder, "nation").select("n_nationkey", F.initcap("n_name").alias("region"))
    grades = lines.where("l_discount > 0.07").select("l_orderkey", F.col("l_partkey").alias("subject"), F.col("l_quantity").alias("grade"))
    tickets = read_table(spark, folder, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("tickets"))
    base = students.student_base(
        read_table(spark, folder, "orders"), "o_custkey", "o_orderdate", F.lit("2001-01-01").cast("timestamp_ntz"), approvals, ["o_orderkey"],
        [
            (people, {"o_custkey": "c_custkey"}), (nations, {"c_nationkey": "n_nationkey"}),
            (grades, {"o_orderkey": "l_orderkey"}), (tickets, {"o_custkey": "user_id"}),
        ],
    )
    named = base.select(
        "o_orderkey", "o_custkey", "subject", "grade", "enrolled", "approved", "region", "tickets",
        F.col("o_orderdate").alias("birth_date"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise(F.lit(" ")).alias("company"),
        F.when(F.col("o_orderstatus") == "F", F.lit("gone")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.lit("Nuevo - Homologado").alias("student_state"),
        columns.recode(F.col("o_orderpriority"), {"1-URGENT": "Presencial Fin De Semana", "2-HIGH": "No Presencial"}).alias("modality"),
        F.when(F.col("o_orderstatus") == "F", F.lit("PAGO")).alias("payment_state"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_access"),
        F.col("o_orderpriority").alias("lms_state"), F.lit("").alias("schedule"),
        F.when(F.col("o_totalprice") > 250000, F.lit("SI")).alias("mail"),
    )
    cleaned = students.clean_students(named, AS_OF, "gone", {"region": {"NATION_1": "FIRST NATION"}}, ["tickets"])
    return cleaned.drop("birth_date", "company", "last_access")
