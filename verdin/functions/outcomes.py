"""Outcome rules of sales calls: result score, routing to a second opinion, final label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdin.functions.text import contains_any, tail

# fixed values: phrases of hesitation, of a closed sale and of an agreed follow-up
HESITATION = (
    "lo voy a pensar", "lo pensare", "lo pensaré", "tengo que pensarlo", "tengo que pensarlo mas",
    "no estoy seguro", "no estoy segura", "despues", "después", "mas adelante", "más adelante",
    "no hoy", "luego", "te aviso", "dejame revisar", "déjame revisar", "dejame consultarlo",
    "no puedo ahora", "en otro momento", "por ahora no",
)
CLOSED = (
    "ya pague", "ya pagué", "pago hoy", "voy a pagar hoy", "lo pago hoy", "ya hice el pago",
    "ya me inscribi", "ya me inscribí", "ya me matricule", "ya me matriculé",
    "quede inscrito", "quedé inscrito", "quedo inscrita", "quedó inscrita",
    "matricula realizada", "matrícula realizada",
)
FOLLOW_UP = (
    "te llamo mañana", "te llamo manana", "te marco mañana", "te marco manana",
    "te contacto mañana", "te contacto manana", "te vuelvo a llamar",
    "agendamos llamada", "agendemos", "queda agendada", "quedo agendada", "quedó agendada",
    "confirmo la cita", "te confirmo cita", "quedamos en", "nos hablamos", "nos hablamos mañana",
    "te envío la información", "te envio la informacion", "te envío el link", "te envio el link",
    "seguimiento", "seguimos", "continuamos",
)
CLOSING_HINTS = ("pago", "matricula", "inscripcion", "portal", "link")


@dataclass(frozen=True)
class OutcomePhrases:
    hesitation: Sequence[str] = HESITATION
    closed: Sequence[str] = CLOSED
    follow_up: Sequence[str] = FOLLOW_UP
    closing_hints: Sequence[str] = CLOSING_HINTS


def outcome_flags(words: Column, phrases: OutcomePhrases = OutcomePhrases()) -> dict[str, Column]:
    """What the last 30 % of a normalised text mentions."""
    end = tail(words)
    return {
        "hesitates": contains_any(end, phrases.hesitation),
        "closed": contains_any(end, phrases.closed),
        "follow_up": contains_any(end, phrases.follow_up),
        "closing_hint": contains_any(end, phrases.closing_hints),
    }


def outcome_score(flags: Mapping[str, Column]) -> dict[str, Column]:
    """Score and the rule it came from."""
    hesitates, closed, follow_up = flags["hesitates"], flags["closed"], flags["follow_up"]
    # fixed values: scores and rule names
    rules = [
        (hesitates & follow_up, 0.65, "regla_seguimiento_a_pesar_de_indecision"),
        (closed & ~hesitates, 0.85, "regla_cierre_real"),
        (follow_up & ~hesitates, 0.70, "regla_seguimiento"),
        (hesitates, 0.15, "regla_anti_cierre"),
        (F.lit(True), 0.30, "regla_sin_evidencia_resultado"),
    ]
    return {
        "outcome_score": F.coalesce(*[F.when(test, F.lit(score)) for test, score, _ in rules]),
        "outcome_rule": F.coalesce(*[F.when(test, F.lit(name)) for test, _, name in rules]),
    }


def review_reason(
    score: Column,
    closing_count: Column,
    flags: Mapping[str, Column],
    borderline: tuple[float, float] | None = (0.45, 0.90),
) -> Column:
    """Why a call needs a second opinion, null when it does not.

    Without a borderline range every call is reviewed.
    """
    closing = (closing_count > 0) | flags["closing_hint"]
    hesitates, agreed = flags["hesitates"], closing | flags["follow_up"]
    # fixed values: reason names
    reason = (
        F.when(hesitates & agreed, F.lit("contradiccion_indecision_vs_cierre_seguimiento"))
        .when(hesitates, F.lit("anti_cierre_en_final"))
        .when(agreed & (score >= 0.75), F.lit("validar_resultado_cierre_o_seguimiento"))
    )
    if borderline is None:
        return reason.otherwise(F.lit("modo_llm_todos"))
    return reason.when((score >= borderline[0]) & (score <= borderline[1]), F.lit("borderline_score"))


def final_label(process: Column, outcome: Column) -> Column:
    # fixed values: thresholds and label texts
    return (
        F.when((process >= 0.75) & (outcome >= 0.70), F.lit("efectiva"))
        .when(process >= 0.75, F.lit("buena_no_cerrada"))
        .otherwise(F.lit("no_efectiva"))
    )


def needs_person(confidence: Column, least: float = 0.65) -> Column:
    """1 when the confidence of a second opinion is low or unreadable."""
    value = confidence.try_cast("double")
    return F.when(value >= least, 0).otherwise(1)
