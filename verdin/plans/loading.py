"""Loader queries: contracts on line items written as text, staged load, reports, JSON answers.

Every 97th order has a broken quantity and every 50th an empty line number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdin.functions import documents
from verdin.operators import contract, kpi
from verdin.operators.contract import Field
from verdin.plans.registry import query
from verdin.plans.scoring import SCORED, rounded, scored
from verdin.session import read_table, scratch_path
from verdin.sources import published, staged

FIELDS = (
    Field("L_OrderKey", "bigint", nullable=False),
    Field("L_LineNumber", "int", nullable=False),
    Field("L_Quantity", "decimal", nullable=False),
    Field("L_ShipDate", "datetime2"),
    Field("L_ReturnFlag", "bit"),
    Field("L_LineStatus", "varchar", max_length=2),
)


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as they would arrive in a text sheet."""
    key = F.col("l_orderkey")
    flag = F.when(F.col("l_returnflag") == "A", F.lit(" SÍ ")).when(F.col("l_returnflag") == "R", F.lit("No")).otherwise(F.lit("?"))
    return read_table(spark, folder, "lineitem").select(
        F.col("l_linestatus").alias("comment"),
        F.concat(F.lit(" "), key.cast("string")).alias("l_orderkey "),
        F.when(key % 50 == 0, F.lit("")).when(key % 7 == 0, F.lit("1.5")).otherwise(F.concat(F.col("l_linenumber").cast("string"), F.lit("e0"))).alias("L_LINENUMBER"),
        F.when(key % 97 == 0, F.lit("many")).otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.when(key % 11 == 0, F.lit("soon")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("l_shipdate"),
        flag.alias("l_returnflag"),
        F.concat(F.col("l_linestatus"), F.lit("-long")).alias("l_linestatus"),
    )


@query(
    "p7_match_columns",
    """SELECT ' ' || l_orderkey AS "L_OrderKey", CASE WHEN l_orderkey % 97 = 0 THEN 'many' ELSE format('{:.1f}', l_quantity) END AS "L_Quantity" FROM lineitem""",
)
def match_columns(spark, folder):
    return contract.match_columns(raw_lines(spark, folder), [FIELDS[0], FIELDS[2]])


CONVERTED_SQL = """conv AS (SELECT CAST(l_orderkey AS BIGINT) AS "L_OrderKey", CASE WHEN l_orderkey % 50 <> 0 AND l_orderkey % 7 <> 0 THEN CAST(l_linenumber AS BIGINT) END AS "L_LineNumber",
    CASE WHEN l_orderkey % 97 <> 0 THEN l_quantity END AS "L_Quantity", CASE WHEN l_orderkey % 11 <> 0 THEN l_shipdate END AS "L_ShipDate",
    CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 0 END AS INT) AS "L_ReturnFlag", l_linestatus || '-' AS "L_LineStatus" FROM lineitem)"""


@query("p20_convert", f"WITH {CONVERTED_SQL} SELECT * FROM conv")
def convert(spark, folder):
    return contract.convert_all(raw_lines(spark, folder), FIELDS)


@query(
    "p21_conversion_report",
    """SELECT 'L_OrderKey' AS "column", 'bigint' AS type, CAST(0 AS BIGINT) AS lost
       UNION ALL SELECT 'L_LineNumber', 'int', count(*) FILTER (l_orderkey % 50 <> 0 AND l_orderkey % 7 = 0) FROM lineitem
       UNION ALL SELECT 'L_Quantity', 'decimal', count(*) FILTER (l_orderkey % 97 = 0) FROM lineitem""",
)
def conversion_report(spark, folder):
    return contract.conversion_report(raw_lines(spark, folder), FIELDS)


@query(
    "p22_bit_words",
    """SELECT event_id, CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'signup' THEN 0 END AS INT) AS bit FROM events""",
)
def bit_words(spark, folder):
    word = (
        F.when(F.col("event_type") == "view", F.lit(" Sí"))
        .when(F.col("event_type") == "click", F.lit("FALSE "))
        .when(F.col("event_type") == "error", F.lit("1"))
        .when(F.col("event_type") == "signup", F.lit("n"))
        .otherwise(F.lit("maybe"))
    )
    return read_table(spark, folder, "events").select("event_id", contract.to_bit(word).alias("bit"))


@query(
    "s9_staged_load",
    f"""WITH {CONVERTED_SQL} SELECT "L_OrderKey" AS l_orderkey, "L_Quantity" AS l_quantity, CAST(NULL AS VARCHAR) AS note FROM conv
        UNION ALL SELECT "L_OrderKey", "L_Quantity", NULL FROM conv WHERE "L_LineNumber" = 1""",
)
def staged_load(spark, folder):
    converted = contract.convert_all(raw_lines(spark, folder), FIELDS)
    rows = converted.select(F.col("L_OrderKey").alias("l_orderkey"), F.col("L_Quantity").alias("l_quantity"))
    path = scratch_path(spark, "load")
    table = f"lines_{path.rsplit('-', 1)[1]}"
    empty = rows.withColumn("note", F.lit(None).cast("string")).where(F.lit(False))
    empty.write.format("parquet").option("path", path).saveAsTable(table)
    staged.staged_load(rows, table, f"{path}-staging", truncate=True)
    again = converted.where(F.col("L_LineNumber") == 1).select(*[F.col(f"L_{n}").alias(f"l_{n.lower()}") for n in ("OrderKey", "Quantity")])
    staged.staged_load(again, table, f"{path}-staging-2")
    return spark.table(table)


@query(
    "s9_published_load",
    f"""WITH {CONVERTED_SQL} SELECT "L_OrderKey" AS l_orderkey, "L_Quantity" AS l_quantity, CAST(NULL AS VARCHAR) AS note FROM conv
        UNION ALL SELECT "L_OrderKey", "L_Quantity", NULL FROM conv WHERE "L_LineNumber" = 1""",
)
def published_load(spark, folder):
    """The staged load as versions that readers see whole: a first load, then one appended."""
    converted = contract.convert_all(raw_lines(spark, folder), FIELDS)
    rows = converted.select(F.col("L_OrderKey").alias("l_orderkey"), F.col("L_Quantity").alias("l_quantity"))
    path = scratch_path(spark, "published-load")
    published.publish(rows.withColumn("note", F.lit(None).cast("string")), path, checks={"key": F.col("l_orderkey").isNotNull()})
    first = converted.where(F.col("L_LineNumber") == 1).select(F.col("L_OrderKey").alias("l_orderkey"), F.col("L_Quantity").alias("l_quantity"))
    published.publish(first, path, append=True)
    return published.read_published(spark, path)


@query("s10_published_replace", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus")
def published_replace(spark, folder):
    path = scratch_path(spark, "published-orders")
    orders = read_table(spark, folder, "orders")
    published.publish(orders, path)
    published.publish(orders.where("o_orderstatus <> 'P'"), path)
    return published.read_published(spark, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s12_json_report",
    f"""WITH {SCORED} SELECT round(avg((p - y) * (p - y)), 6) AS brier, CAST(sum(y) AS BIGINT) AS positives, count(*) AS n FROM scored""",
)
def json_report(spark, folder):
    path = scratch_path(spark, "report")
    staged.write_report(rounded(kpi.base_metrics(scored(spark, folder)).select("brier", "positives", "n")), path)
    return staged.read_report(spark, path, "brier DOUBLE, positives BIGINT, n BIGINT")


# ---------------------------------------------------------------- JSON documents
@query(
    "n1_find_object",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(props->>'$.k' AS BIGINT) END AS k FROM events""",
)
def find_object(spark, folder):
    said = F.when(F.col("event_type") == "error", F.lit("no answer")).otherwise(
        F.concat(F.lit("Sure, here:\n```json\n"), F.col("props"), F.lit("\n``` bye"))
    )
    found = documents.parse_object(said)
    return read_table(spark, folder, "events").select("event_id", F.try_variant_get(found, "$.k", "bigint").alias("k"))


@query(
    "n3_answer_defaults",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 0.0 ELSE CAST(props->>'$.k' AS DOUBLE) / 100 END AS outcome_score, 0.5::DOUBLE AS confidence,
       CAST(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS INT) AS effective, 'neutro' AS sentiment,
       CASE WHEN event_type = 'view' THEN 'cierre' ELSE 'ninguno' END AS outcome_kind, event_type = 'view' AS confirmed,
       CASE WHEN event_type = 'view' THEN repeat('x', 220) ELSE '' END AS evidence, CASE WHEN event_type = 'view' THEN 'a; b; c; d; e' ELSE '' END AS reasons, '' AS improvements,
       event_type = 'view' AS closing_present, CASE WHEN event_type = 'view' THEN repeat('y', 180) ELSE '' END AS closing_evidence, false AS greeting_present FROM events""",
)
def answer_defaults(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    score = F.when(F.col("event_type") == "click", F.lit('"high"')).otherwise((k / 100).cast("string"))
    more = F.when(
        F.col("event_type") == "view",
        F.lit(', "efectiva": "1", "resultado": {"tipo": "cierre", "confirmado": true, "evidencia": "' + "x" * 300 + '"}, "razones": ["a","b","c","d","e","f"], "proceso": {"etapas": {"cierre": {"presente": true, "evidencia": "' + "y" * 200 + '"}, "saludo": 3}}'),
    ).otherwise(F.lit(""))
    said = F.concat(F.lit('Answer {"score_resultado": '), score, more, F.lit("}"))
    parsed = read_table(spark, folder, "events").select("event_id", documents.parse_object(said).alias("said"))
    return parsed.select("event_id", documents.call_answer(F.col("said")).alias("answer")).select("event_id", "answer.*").select(
        "*", F.col("stages.cierre.present").alias("closing_present"), F.col("stages.cierre.evidence").alias("closing_evidence"),
        F.col("stages.saludo.present").alias("greeting_present"),
    ).drop("stages")


@query("n5_field_access", """SELECT event_id, CAST(props->>'$.k' AS INT) AS k FROM events""")
def field_access(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    return read_table(spark, folder, "events").select("event_id", k.alias("k"))


@query(
    "n2_summary_shape",
    """SELECT event_id, 'v' || event_id AS video, CASE WHEN event_type = 'error' THEN '' ELSE 'General ' || (props->>'$.k') END AS resumen_general,
       CASE event_type WHEN 'error' THEN '' WHEN 'view' THEN 'one' ELSE 'one|two' END AS puntos_clave,
       CASE event_type WHEN 'error' THEN '' ELSE 'term=meaning|alone=' END AS glosario,
       CASE event_type WHEN 'error' THEN '' ELSE 'why?=' END AS preguntas FROM events""",
)
def summary_shape(spark, folder):
    k = F.get_json_object("props", "$.k")
    points = F.when(F.col("event_type") == "view", F.lit('"one"')).otherwise(F.lit('["one", "two"]'))
    body = F.concat(
        F.lit('{"resumen_general": "General '), k, F.lit('", "puntos_clave": '), points,
        F.lit(', "glosario": [{"termino": "term", "definicion": "meaning"}, " alone ", ""], "preguntas_repaso": "why?"}'),
    )
    said = F.when(F.col("event_type") != "error", body)
    name = F.concat(F.lit("v"), F.col("event_id").cast("string"))
    parsed = read_table(spark, folder, "events").select("event_id", name.alias("name"), documents.parse_object(said).alias("said"))
    rows = parsed.select("event_id", documents.summary(F.col("said"), F.col("name")).alias("s"))
    return rows.select(
        "event_id",
        "s.video",
        "s.resumen_general",
        F.array_join("s.puntos_clave", "|").alias("puntos_clave"),
        F.array_join(F.transform("s.glosario", lambda g: F.concat(g["termino"], F.lit("="), g["definicion"])), "|").alias("glosario"),
        F.array_join(
            F.transform("s.preguntas_repaso", lambda g: F.concat(g["pregunta"], F.lit("="), g["respuesta_corta"])), "|"
        ).alias("preguntas"),
    )


@query(
    "n4_failed_rules",
    """WITH e AS (SELECT event_id, event_type, CAST(props->>'$.k' AS INT) AS k, unnest(['net', 'web']) AS network FROM events)
    SELECT event_id, network, CASE WHEN network = 'web' THEN 'topic_comma,reason_short,advice_placeholder,advice_blocks,advice_short,estimate_keys'
      WHEN k < 50 THEN 'reason_short' ELSE '' END AS failed FROM e""",
)
def failed_rules(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    good_advice = " | ".join(["hook " + "a" * 40] * 4)
    reason = F.when(k < 50, F.lit("short")).otherwise(F.lit("r" * 70))
    item = F.struct(
        F.lit("one idea").alias("tema_principal"), reason.alias("justificacion"), F.lit(good_advice).alias("recomendaciones_graficas"),
        F.create_map(*[F.lit(x) for key in documents.ESTIMATE_KEYS for x in (key, "1")]).alias("interacciones_estimadas"),
    )
    weak = F.struct(
        F.lit("a, b").alias("tema_principal"), F.lit("no").alias("justificacion"), F.lit("Yes").alias("recomendaciones_graficas"),
        F.create_map(F.lit("min"), F.lit("1")).alias("interacciones_estimadas"),
    )
    block = F.struct(F.create_map(F.lit("net"), F.array(item), F.lit("web"), F.array(weak)).alias("por_red"))
    written = F.to_json(F.struct(F.array(block).alias("predicciones")))
    parsed = F.from_json(F.concat(written), documents.PREDICTION)
    rows = read_table(spark, folder, "events").select("event_id", F.explode(parsed["predicciones"]).alias("block"))
    by_network = rows.select("event_id", F.explode("block.por_red").alias("network", "items"))
    items = by_network.select("event_id", "network", F.explode("items").alias("item"))
    return items.select("event_id", "network", F.array_join(documents.failed_rules(F.col("item")), ",").alias("failed"))


@query(
    "n4_incomplete_items",
    """SELECT doc_id, array_to_string(list_filter([CASE WHEN lang = 'de' THEN 'audiencia' END, CASE WHEN trim(source) = 'src1' THEN 'cta' END,
         CASE WHEN doc_id % 3 <> 2 THEN 'palabras_clave_seo' END], lambda x: x IS NOT NULL), ',') AS missing FROM documents""",
)
def incomplete_items(spark, folder):
    rows = read_table(spark, folder, "documents").select("doc_id", "lang", "source")
    given = {
        "tema_principal": F.lit("a"), "audiencia": F.when(F.col("lang") != "de", F.col("lang")), "justificacion": F.lit("b"), "formato": F.lit("c"),
        "cta": F.when(F.col("source") == "src1", F.lit("  ")).otherwise(F.col("source")), "recomendaciones_graficas": F.lit("d"),
    }
    words = F.when(F.col("doc_id") % 3 == 0, F.array(*[F.lit("w")] * 4)).when(F.col("doc_id") % 3 == 1, F.array(*[F.lit("w")] * 4, F.lit(" ")))
    said = F.to_json(F.struct(*[value.alias(name) for name, value in given.items()], words.otherwise(F.array(*[F.lit("w")] * 5)).alias("palabras_clave_seo")))
    parsed = F.from_json(said, documents.COMPLETE)
    return rows.select("doc_id", F.array_join(documents.incomplete(parsed), ",").alias("missing"))
