"""JSON found in noisy text, answers with defaults, and summaries in one fixed shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def find_object(text: Column) -> Column:
    """From the first ``{`` to the last ``}``; null when there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def parse_object(text: Column) -> Column:
    """VARIANT of the object in a text, null when it is no valid JSON."""
    return F.try_parse_json(find_object(text))


def field(document: Column, path: str, kind: str, default: object) -> Column:
    """One field in the wanted type, with a default when absent or not convertible."""
    return F.coalesce(F.try_variant_get(document, path, kind), F.lit(default).cast(kind))


# fixed values: the stages of a call
STAGES = ("saludo", "indagacion", "programas", "argumentacion", "objecion", "cierre")


def stage_evidence(document: Column) -> Column:
    """Per stage whether the reviewer saw it, and the words that show it (180 characters)."""
    stages = []
    for stage in STAGES:
        path = f"$.proceso.etapas.{stage}"
        seen, words = field(document, f"{path}.presente", "boolean", False), field(document, f"{path}.evidencia", "string", "")
        stages.append(F.struct(seen.alias("present"), F.left(words, F.lit(180)).alias("evidence")).alias(stage))
    return F.struct(*stages)


def call_answer(document: Column) -> Column:
    """Answer of a call reviewer with all fields present and in their types."""
    return F.struct(
        field(document, "$.score_resultado", "double", 0.0).alias("outcome_score"),
        field(document, "$.confianza", "double", 0.5).alias("confidence"),
        field(document, "$.efectiva", "int", 0).alias("effective"),
        field(document, "$.sentimiento_cliente", "string", "neutro").alias("sentiment"),
        field(document, "$.resultado.tipo", "string", "ninguno").alias("outcome_kind"),
        field(document, "$.resultado.confirmado", "boolean", False).alias("confirmed"),
        F.left(field(document, "$.resultado.evidencia", "string", ""), F.lit(220)).alias("evidence"),
        F.array_join(F.slice(items(document, "$.razones"), 1, 5), "; ").alias("reasons"),
        F.array_join(F.slice(items(document, "$.mejoras"), 1, 5), "; ").alias("improvements"),
        stage_evidence(document).alias("stages"),
    )


def _variants(document: Column, path: str) -> Column:
    """A list as it is, a single value as a list of one, nothing as an empty list."""
    value = F.try_variant_get(document, path, "variant")
    many = F.try_variant_get(document, path, "array<variant>")
    single = F.when(value.isNotNull() & (F.schema_of_variant(value) != "VOID"), F.array(value))
    return F.coalesce(many, single, F.array().cast("array<variant>"))


def _text(value: Column) -> Column:
    return F.coalesce(F.try_variant_get(value, "$", "string"), F.lit(""))


def items(document: Column, path: str) -> Column:
    return F.transform(_variants(document, path), _text)


def _pairs(document: Column, path: str, first: str, second: str) -> Column:
    """Objects with two fields; a plain text becomes the first field."""

    def pair(value: Column) -> Column:
        is_object = F.schema_of_variant(value).startswith("OBJECT")
        named = F.coalesce(F.try_variant_get(value, f"$.{first}", "string"), F.lit(""))
        other = F.coalesce(F.try_variant_get(value, f"$.{second}", "string"), F.lit(""))
        return F.struct(
            F.when(is_object, named).otherwise(F.trim(_text(value))).alias(first),
            F.when(is_object, other).otherwise(F.lit("")).alias(second),
            is_object.alias("_object"),
        )

    kept = F.filter(F.transform(_variants(document, path), pair), lambda p: p["_object"] | (p[first] != ""))
    return F.transform(kept, lambda p: F.struct(p[first].alias(first), p[second].alias(second)))


def summary(document: Column, name: Column) -> Column:
    """Summary with every key present, lists as lists, glossary and questions as structs."""
    # fixed values: the field names of a summary
    texts = ("resumen_general", "resumen_estudio")
    lists = ("puntos_clave", "temas_principales", "conceptos_importantes", "tareas_o_recomendaciones")
    return F.struct(
        name.alias("video"),
        *[field(document, f"$.{t}", "string", "").alias(t) for t in texts],
        *[items(document, f"$.{entry}").alias(entry) for entry in lists],
        _pairs(document, "$.glosario", "termino", "definicion").alias("glosario"),
        _pairs(document, "$.preguntas_repaso", "pregunta", "respuesta_corta").alias("preguntas_repaso"),
    )


PREDICTION = (
    "predicciones ARRAY<STRUCT<por_red: MAP<STRING, ARRAY<STRUCT<tema_principal: STRING, justificacion: STRING,"
    " recomendaciones_graficas: STRING, interacciones_estimadas: MAP<STRING, STRING>>>>>>"
)
# fixed values: the keys of an estimate, and the texts that a complete prediction has
ESTIMATE_KEYS = ("min", "probable", "max", "supuesto", "unidad")


FILLED_TEXTS = ("tema_principal", "audiencia", "justificacion", "formato", "cta", "recomendaciones_graficas")
COMPLETE = ", ".join(f"{name} STRING" for name in FILLED_TEXTS) + ", palabras_clave_seo ARRAY<STRING>"
KEYWORDS = 5


def incomplete(item: Column) -> Column:
    """Names of the fields of a ``COMPLETE`` item that are empty; the keywords must be exactly five, none blank."""
    empty = [F.when(F.trim(F.coalesce(item[name], F.lit(""))) == "", F.lit(name)) for name in FILLED_TEXTS]
    words = F.coalesce(item["palabras_clave_seo"], F.array().cast("array<string>"))
    blank = F.exists(words, lambda word: F.trim(F.coalesce(word, F.lit(""))) == "")
    return F.array_compact(F.array(*empty, F.when((F.size(words) != KEYWORDS) | blank, F.lit("palabras_clave_seo"))))


def failed_rules(item: Column) -> Column:
    """Names of the rules a predicted post breaks."""
    topic = F.trim(F.coalesce(item["tema_principal"], F.lit("")))
    reason = F.trim(F.coalesce(item["justificacion"], F.lit("")))
    advice = F.trim(F.coalesce(item["recomendaciones_graficas"], F.lit("")))
    estimate = item["interacciones_estimadas"]
    has_keys = F.size(F.array_intersect(F.map_keys(estimate), F.array(*[F.lit(k) for k in ESTIMATE_KEYS])))
    rules = {
        "topic_comma": topic.contains(","),
        "reason_short": F.length(reason) < 70,
        "advice_placeholder": F.lower(advice).startswith("yes") | advice.startswith("#"),
        "advice_blocks": ~advice.contains(" | "),
        "advice_short": F.length(advice) < 160,
        "estimate_keys": F.coalesce(has_keys, F.lit(0)) < len(ESTIMATE_KEYS),
    }
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
