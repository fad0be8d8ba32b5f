"""Tidying the answers of a comment or post classifier."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the allowed sentiments by tone, and their polarity
POSITIVE = ("gratitud_alegria", "confianza_seguridad", "sorpresa")
NEGATIVE = ("tristeza", "miedo_preocupacion", "desagrado", "enojo_frustracion")
NEUTRAL = "consulta_sugerencia"
POLARITY = {
    "gratitud_alegria": 1.0,
    "confianza_seguridad": 1.0,
    "sorpresa": 0.5,
    "consulta_sugerencia": 0.0,
    "pregunta_neutral": 0.0,
    "tristeza": -0.5,
    "miedo_preocupacion": -1.0,
    "desagrado": -1.0,
    "enojo_frustracion": -1.0,
}
# fixed values: signs of fear and of strong rejection
FEAR_SIGNS = r"😟|😰|😨|😱|😥|😓|😔|\b(miedo|temo|temer|preocupad\w*|ansied\w*|p[aá]nico|asustad\w*)\b"
REJECTION_SIGNS = r"\b(p[eé]simo|estafa|robo|asco|in[uú]tiles|ladrones|engañ)\b"
# fixed values: answers and names that mean "no product"
NO_PRODUCT = ("ninguno", "n/a", "no aplica", "no", "informacion")
NO_RANK = ("ninguno", "error", "n/a", "comunidad", "informacion", "foto", "post", "nan", "none")


def check_fear(text: Column, sentiment: Column) -> Column:
    """Fear is only kept when the text shows it; else it is anger or a question."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    replaced = F.when(lower.rlike("(?U)" + REJECTION_SIGNS), F.lit("enojo_frustracion")).otherwise(F.lit(NEUTRAL))
    shown = lower.rlike("(?U)" + FEAR_SIGNS)
    return F.when((sentiment != "miedo_preocupacion") | shown, sentiment).otherwise(replaced)


def sentiment(text: Column, answer: Column) -> Column:
    checked = check_fear(text, F.lower(F.coalesce(answer, F.lit(""))))
    return F.when(checked.isin(*POSITIVE, *NEGATIVE, NEUTRAL), checked).otherwise(F.lit(NEUTRAL))


def topic(text: Column, answer: Column) -> Column:
    """The answered topic; "otro" is replaced by a topic read from the text."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    # fixed values: word stems and topics
    read = (
        F.when(lower.contains("inscrip") | lower.contains("matr"), F.lit("admisiones_matricula"))
        .when(lower.contains("pag") | lower.contains("cost"), F.lit("pagos_finanzas"))
        .when(lower.contains("clase") | lower.contains("curso"), F.lit("educacion_academico"))
        .otherwise(F.lit("comunidad"))
    )
    given = F.lower(F.coalesce(answer, F.lit("")))
    return F.when(given == "otro", read).otherwise(given)


def comment_kind(answer: Column, tidy_sentiment: Column) -> Column:
    """The answered kind, else the one that belongs to the sentiment."""
    own = (
        F.when(tidy_sentiment.isin(*POSITIVE), F.lit("felicitacion_positivo"))
        .when(tidy_sentiment.isin(*NEGATIVE), F.lit("queja_reclamo_negativo"))
        .when(tidy_sentiment == NEUTRAL, F.lit("pregunta_neutral"))
        .otherwise(F.lit("otro"))
    )
    return F.coalesce(F.nullif(answer, F.lit("")), own)


def product(answer: Column) -> Column:
    tidy = F.lower(F.trim(F.coalesce(answer, F.lit("ninguno"))))
    bare = F.regexp_replace(tidy, r'^[."]+|[."]+$', "")
    return F.when(bare.isin(*NO_PRODUCT), F.lit("ninguno")).otherwise(bare)


def tidy_comment(text: Column, answer: Column) -> Column:
    """Struct of tidied answers from a struct of raw ones."""
    tidy = sentiment(text, answer["sentiment"])
    return F.struct(
        tidy.alias("sentiment"),
        comment_kind(answer["kind"], tidy).alias("kind"),
        topic(text, answer["topic"]).alias("topic"),
        F.coalesce(answer["class"], F.lit("otro")).alias("class"),
        F.coalesce(answer["reason"], F.lit("")).alias("reason"),
    )


def sentiment_polarity(tidy: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in POLARITY.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(tidy)), F.lit(0.0))


def tone(tidy: Column) -> Column:
    own = F.lower(tidy)
    return (
        F.when(own.isin(*POSITIVE), F.lit("positiva")).when(own.isin(*NEGATIVE), F.lit("negativa")).otherwise(F.lit("neutral"))
    )
