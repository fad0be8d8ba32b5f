"""Phrase dictionaries: counts per category in three modes, and scores against a rubric."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdin.functions.numbers import add
from verdin.functions.text import WORD, phrase_line, phrase_token, phrase_words

Dictionary = Mapping[str, Sequence[str]]
Rubric = Mapping[str, tuple[int, float]]

# fixed values: rubric weights of chats and sales calls, and of trainer calls
EVEN_RUBRIC = {
    "saludo": (1, 1 / 6),
    "indagacion": (1, 1 / 6),
    "programas": (1, 1 / 6),
    "argumentacion": (1, 1 / 6),
    "objecion": (1, 1 / 6),
    "cierre": (1, 1 / 6),
}
TRAINER_RUBRIC = {
    "saludo": (1, 0.10),
    "indagacion": (1, 0.20),
    "programas": (1, 0.20),
    "argumentacion": (1, 0.25),
    "objecion": (1, 0.10),
    "cierre": (1, 0.15),
}
EFFECTIVE_FROM = 0.80


def read_dictionary(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Phrases per category from a delimited file with the columns category and phrase.

    A dictionary is part of the plan: its phrases become patterns.
    """
    rows = spark.read.option("header", True).schema("category STRING, phrase STRING").csv(path).collect()
    result: dict[str, list[str]] = {}
    for row in rows:
        result.setdefault(row["category"], []).append(row["phrase"])
    return result


def _quoted(text: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", text)


def alternation_pattern(phrases: Sequence[str]) -> str | None:
    """One guarded pattern, phrases in text order, so the shorter of two with one start wins."""
    known = sorted({phrase_token(p) for p in phrases if p and p.strip()})
    return r"(?<!\w)(?:" + "|".join(_quoted(p) for p in known) + r")(?!\w)" if known else None


def count_alternation(words: Column, phrases: Sequence[str]) -> Column:
    """Guarded matches of any phrase in normalised words."""
    pattern = alternation_pattern(phrases)
    return F.lit(0) if pattern is None else F.regexp_count(words, F.lit(pattern))


def count_per_phrase(line: Column, phrases: Sequence[str]) -> Column:
    """Guarded matches of each phrase, summed; overlaps and repeated entries count again.

    A plain search comes first, so a pattern only runs where its phrase occurs;
    the guards stand behind the phrase, so they are only tested at its matches.
    """
    terms = []
    for phrase, times in Counter(phrase_line(p) for p in phrases).items():
        pattern = f"{_quoted(phrase)}(?<![{WORD}]{_quoted(phrase)})(?![{WORD}])"
        found = F.regexp_count(line, F.lit(pattern)) * times
        terms.append(F.when(line.contains(phrase), found).otherwise(F.lit(0)))
    return add(terms) if terms else F.lit(0)


def count_substring(words: Column, phrases: Sequence[str]) -> Column:
    """Matches of any phrase without word guards, the first listed phrase wins."""
    known = [phrase_words(p) for p in phrases]
    return F.regexp_count(words, F.lit("|".join(_quoted(p) for p in known))) if known else F.lit(0)


MODES = {"alternation": count_alternation, "per_phrase": count_per_phrase, "substring": count_substring}


def category_counts(text: Column, dictionary: Dictionary, mode: str = "alternation") -> dict[str, Column]:
    """One count per category. The text is normalised for the mode: words, or a line for ``per_phrase``."""
    return {category: MODES[mode](text, phrases) for category, phrases in dictionary.items()}


def with_category_counts(df: DataFrame, text: str, dictionary: Dictionary, mode: str = "alternation") -> DataFrame:
    return df.withColumns(category_counts(F.col(text), dictionary, mode))


def unreachable(dictionary: Dictionary) -> dict[str, list[str]]:
    """Phrases that cannot match normalised words because they keep punctuation."""
    return {c: [p for p in phrases if re.search(r"[^\w\s]", phrase_token(p))] for c, phrases in dictionary.items()}


def rubric_score(counts: Mapping[str, Column], rubric: Rubric) -> Column:
    """Sum of the weights of the categories that reach their minimum, added in rubric order."""
    total = F.lit(0.0)
    for category, (least, weight) in rubric.items():
        reached = counts.get(category, F.lit(0)) >= least
        total = total + F.when(reached, F.lit(weight)).otherwise(F.lit(0.0))
    return total


def flag_share(flags: Sequence[Column]) -> Column:
    """Share of set flags."""
    return add([f.cast("int") for f in flags]) / len(flags)
