"""Complete evaluations of chats and calls, each row in one pass plus one lookup join."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdin.functions import documents, outcomes, parsers, text, transcripts
from verdin.functions.dates import clock_time, format_date, time7
from verdin.functions.numbers import add
from verdin.functions.phrases import EFFECTIVE_FROM, EVEN_RUBRIC, TRAINER_RUBRIC, Dictionary, Rubric
from verdin.functions.phrases import category_counts, flag_share, rubric_score
from verdin.operators import classify, joins, ordered
from verdin.operators.columns import fixed_schema


def message_line(role: str, content: str) -> Column:
    """A message as a transcript line that starts with its speaker."""
    return F.concat(F.lit("#"), F.col(role), F.lit(" : "), F.col(content))


def message_turns(messages: DataFrame, conversation: str, turn: str, role: str, content: str) -> DataFrame:
    """Turns of whole conversations: ``conversation``, ``place`` (0-based), ``speaker``, ``content``.

    Every message starts with a speaker, so turns are split inside the message
    and numbered over the conversation, however long it is.
    """
    split = messages.select(conversation, turn, F.posexplode(transcripts.turns(message_line(role, content))).alias("_pos", "_turn"))
    split = split.select(conversation, turn, "_pos", F.col("_turn.speaker").alias("speaker"), F.col("_turn.content").alias("content"))
    numbered = ordered.row_number(split, [F.col(turn), F.col("_pos")], "_place", [conversation])
    return numbered.select(conversation, (F.col("_place") - 1).cast("int").alias("place"), "speaker", "content")


def score_columns(counts: dict[str, Column], rubric: Rubric, effective: float = EFFECTIVE_FROM) -> dict[str, Column]:
    score = rubric_score(counts, rubric)
    return {"score": F.round(score, 3), "effective": F.when(score >= effective, F.lit("1")).otherwise(F.lit("0"))}


def sentiment_columns(line: Column, lexicon: tuple[Sequence[str], Sequence[str]]) -> dict[str, Column]:
    value = text.polarity(line, *lexicon)
    return {"polarity": value, "sentiment": text.polarity_label(value)}


CHAT_COLUMNS = {
    "mail": "string", "staff_id": "string", "adviser": "string", "day": "string",
    "saludo": "int", "indagacion": "int", "programas": "int", "argumentacion": "int", "objecion": "int", "cierre": "int",
    "score": "double", "effective": "string", "polarity": "double", "sentiment": "string", "confidence": "double",
    "words": "int", "sentences": "int", "source": "string", "phone": "string", "kind": "string", "clock": "string",
}


def with_chat_measures(df: DataFrame, transcript: Column, dictionary: Dictionary, lexicon: tuple[Sequence[str], Sequence[str]]) -> DataFrame:
    """``df`` with the counts of a transcript, or of one message of it: they add up over the messages of a chat.

    Automatic speakers are left out and phrases are counted by alternation.
    """
    clean = df.withColumn("_turns", transcripts.turns(transcripts.unescape(transcript)))
    clean = clean.withColumn("_clean", transcripts.without_automatic(F.col("_turns")))
    ready = clean.withColumns({"_words": text.normalise_words(F.col("_clean")), "_line": text.normalise_line(F.col("_clean"))})
    good, bad = lexicon
    measures = category_counts(F.col("_words"), dictionary) | {
        "_good": add([text.occurrences(F.col("_line"), w) for w in good]),
        "_bad": add([text.occurrences(F.col("_line"), w) for w in bad]),
        "words": text.word_count(F.col("_clean")),
        "sentences": F.size(text.sentences(F.col("_clean"))),
    }
    return ready.withColumns(measures)


def message_measures(
    messages: DataFrame,
    conversation: str,
    role: str,
    content: str,
    dictionary: Dictionary,
    lexicon: tuple[Sequence[str], Sequence[str]] = (text.POSITIVE_WORDS, text.NEGATIVE_WORDS),
) -> DataFrame:
    """One row per conversation with its measures, summed over its messages on the map side.

    A phrase is counted inside a message; the speaker's name stands between two messages anyway.
    """
    measured = with_chat_measures(messages, message_line(role, content), dictionary, lexicon)
    names = [*dictionary, "_good", "_bad", "words", "sentences"]
    return measured.groupBy(conversation).agg(*[F.sum(name).cast("int").alias(name) for name in names])


def score_chats(
    measured: DataFrame,
    staff: DataFrame,
    dictionary: Dictionary,
    as_of: dt.date,
    rubric: Rubric = EVEN_RUBRIC,
    kind: str = "chats",
    confidence: Column | None = None,
) -> DataFrame:
    """Measured chats (with mail, adviser, phone, source, created, clock where known) to scored rows.

    The staff id is looked up by mail: ``staff`` has mail, staff_id and line (the
    largest wins). ``confidence`` is that of a trained tone model; without one it
    follows from the polarity.
    """
    value = text.polarity_of(F.col("_good"), F.col("_bad"))
    scored = measured.withColumns(score_columns({c: F.col(c) for c in dictionary}, rubric))
    scored = scored.withColumns({"polarity": value, "sentiment": text.polarity_label(value)})
    given = text.capped_confidence(F.col("polarity")) if confidence is None else confidence
    filled = scored.withColumns(
        {
            "confidence": F.round(given, 2),
            "polarity": F.round("polarity", 3),
            "mail": F.lower(F.trim(F.coalesce("mail", F.lit("")))),
            "day": format_date(F.col("created"), as_of),
            "clock": time7(clock_time(F.col("clock"))),
            "kind": F.lit(kind),
        }
    )
    tidy_staff = staff.select(F.lower(F.trim("mail")).alias("_mail"), F.trim("staff_id").alias("staff_id"), "line")
    looked_up = joins.lookup(filled, tidy_staff, "mail", "_mail", "staff_id", "line")
    return fixed_schema(looked_up, CHAT_COLUMNS, {"adviser": "", "phone": "", "source": ""})


def evaluate_chats(
    chats: DataFrame,
    staff: DataFrame,
    dictionary: Dictionary,
    as_of: dt.date,
    rubric: Rubric = EVEN_RUBRIC,
    lexicon: tuple[Sequence[str], Sequence[str]] = (text.POSITIVE_WORDS, text.NEGATIVE_WORDS),
    kind: str = "chats",
) -> DataFrame:
    """Chats with a whole transcript each (transcript, mail, adviser, phone, source, created, clock) to scored rows."""
    measured = with_chat_measures(chats, F.col("transcript"), dictionary, lexicon)
    return score_chats(measured, staff, dictionary, as_of, rubric, kind)


def evaluate_trainer_calls(
    files: DataFrame,
    meta: DataFrame,
    dictionary: Dictionary,
    as_of: dt.date,
    rubric: Rubric = TRAINER_RUBRIC,
    lexicon: tuple[Sequence[str], Sequence[str]] = (text.POSITIVE_WORDS, text.NEGATIVE_WORDS),
    kind: str = "entrenador",
) -> DataFrame:
    """Call texts (file_name, text, size) to scored rows, phrases counted one by one.

    ``meta`` has call_id, day, number and recording; its day wins, the others fill.
    """
    ready = files.withColumns({"_line": text.normalise_line(F.col("text")), "call_id": parsers.call_id(F.col("file_name"))})
    counted = ready.withColumns(category_counts(F.col("_line"), dictionary, "per_phrase"))
    scored = counted.withColumns(
        score_columns({c: F.col(c) for c in dictionary}, rubric) | sentiment_columns(F.col("_line"), lexicon)
    )
    filled = scored.withColumns(
        {
            "confidence": F.round(text.polarity_confidence(F.col("polarity")), 2),
            "polarity": F.round("polarity", 3),
            "words": text.word_count(F.col("text")),
            "sentences": F.size(text.sentences(F.col("text"))),
            "phone_text": parsers.phone_in_text(F.col("text")),
            "day": F.lit(as_of.isoformat()),
            "number": F.lit(""),
            "recording": F.lit(""),
            "kind": F.lit(kind),
        }
    )
    joined = joins.fill_from(filled, meta, "call_id", prefer=["day"], fill_empty=["number", "recording"])
    names = [*dictionary, "score", "effective", "polarity", "sentiment", "confidence", "words", "sentences"]
    return joined.select(
        "file_name", "call_id", "day", *names, "number",
        parsers.last_ten_digits(F.col("number")).alias("number10"), "recording", "size", "phone_text", "kind",
    )


def evaluate_sales_calls(
    files: DataFrame,
    staff: DataFrame,
    dictionary: Dictionary,
    rubric: Rubric = EVEN_RUBRIC,
    phrases: outcomes.OutcomePhrases = outcomes.OutcomePhrases(),
    borderline: tuple[float, float] | None = (0.45, 0.90),
    kind: str = "ventas",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Call texts (file_name, text, size) to process score, outcome by rules, review reason and final label.

    ``extra`` columns of the files are carried along.
    """
    ready = files.withColumn("_words", text.normalise_words(F.col("text")))
    counted = ready.withColumns(category_counts(F.col("_words"), dictionary))
    flagged = counted.withColumns({f"_{k}": v for k, v in outcomes.outcome_flags(F.col("_words"), phrases).items()})
    flags = {k: F.col(f"_{k}") for k in ("hesitates", "closed", "follow_up", "closing_hint")}
    process = F.round(rubric_score({c: F.col(c) for c in dictionary}, rubric), 3)
    scored = flagged.withColumn("process_score", process).withColumns(outcomes.outcome_score(flags))
    closing = F.col("cierre") if "cierre" in dictionary else F.lit(0)
    filled = scored.withColumns(
        {
            "review_reason": outcomes.review_reason(F.col("process_score"), closing, flags, borderline),
            "label": outcomes.final_label(F.col("process_score"), F.col("outcome_score")),
            "mail": parsers.mail_in_name(F.col("file_name")),
            "adviser": parsers.adviser_name(F.col("file_name")),
            "phone": parsers.leading_phone(F.col("file_name")),
            "words": text.token_count(F.col("_words")),
            "sentences": text.sentence_mark_count(F.col("text")),
            "kind": F.lit(kind),
        }
    )
    tidy_staff = staff.select(F.lower(F.trim("mail")).alias("_mail"), F.trim("staff_id").alias("staff_id"), "line")
    looked_up = joins.lookup(filled, tidy_staff, "mail", "_mail", "staff_id", "line")
    names = ["process_score", "outcome_score", "outcome_rule", "review_reason", "label", "words", "sentences"]
    return looked_up.select("file_name", "mail", "staff_id", "adviser", "phone", *dictionary, *names, "size", "kind", *extra)


def second_opinion(scored: DataFrame, text_column: str, reviewer: classify.Classifier, cache: DataFrame | None = None, retries: int = 1) -> DataFrame:
    """Scored sales calls with the reviewer's answer where the rules ask for one.

    ``scored`` has the columns of ``evaluate_sales_calls`` and the text. The
    reviewer gets a text and gives ``{"said": JSON}``. Each text without an answer in ``cache`` (text_key, said)
    is asked once. The answer's outcome score replaces that of the rules and the label follows it;
    ``needs_person`` is 1 where the reviewer's confidence is low. Rows
    without a review reason keep the rules' outcome.
    """
    asked = classify.text_key(scored.where(F.col("review_reason").isNotNull()), text_column)
    session = scored.sparkSession
    cache = session.createDataFrame([], "text_key STRING, said STRING") if cache is None else cache
    missing = classify.cache_misses(asked, cache, text_column)
    fresh = classify.classify(missing, text_column, reviewer, "said STRING", {"said": "{}"}, retries)
    answered = classify.with_answers(asked, cache, fresh, ["said"])
    answer = documents.call_answer(documents.parse_object(F.col("said")))
    judged = answered.withColumn("answer", answer).withColumns(
        {
            "outcome_score": F.col("answer.outcome_score"),
            "outcome_source": F.lit("llm"),
            "label": outcomes.final_label(F.col("process_score"), F.col("answer.outcome_score")),
            "needs_person": outcomes.needs_person(F.col("answer.confidence").cast("string")),
        }
    )
    kept = scored.where(F.col("review_reason").isNull()).withColumns(
        {"answer": F.lit(None).cast(judged.schema["answer"].dataType), "outcome_source": F.col("outcome_rule"), "needs_person": F.lit(0)}
    )
    return judged.select(kept.columns).unionByName(kept)


def evaluate_flags(
    files: DataFrame,
    meta: DataFrame,
    flags: Sequence[str],
    meta_id: str,
    meta_order: Sequence[Column],
    meta_columns: Sequence[str],
    effective: float = EFFECTIVE_FROM,
) -> DataFrame:
    """Rows with 0/1 flags to a share score, joined to metadata by the audio id in the file name."""
    share = flag_share([F.col(f) for f in flags])
    scored = files.withColumns({"score": share, "effective": F.when(share >= effective, 1).otherwise(0)})
    own = parsers.audio_id(F.col("file_name"))
    other = parsers.audio_id_anywhere(F.col(meta_id).cast("string"))
    return joins.first_match(scored, meta, own, other, meta_order, meta_columns)


def run_summary(scored: DataFrame, effective: str = "effective", number: str | None = None) -> DataFrame:
    """Rows, effective ones and their percentage; also rows with a number when one is named."""
    hits = F.count_if(F.col(effective).cast("string") == "1")
    total = F.count(F.lit(1))
    columns = [
        total.alias("total"),
        hits.alias("effective"),
        F.when(total > 0, hits * 100.0 / F.when(total > 0, total)).otherwise(F.lit(0.0)).alias("percent"),
    ]
    if number:
        columns.append(F.count_if(F.col(number) != "").alias("with_number"))
    return scored.agg(*columns)
