"""Transcripts with ``#Name : text`` lines: turns, automatic speakers, re-assembly."""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdin.functions.text import strip, strip_marks

# fixed values: speakers that are no persons
AUTOMATIC_SPEAKERS = (
    "chatbot", "chat bot", "asistente virtual", "sistema", "system", "ivr", "virtual assistant", "channel user",
)
SPEAKER_LINE = r"[^\n:]+:"
SPEAKER = r"^[^\S\n]*#?[^\S\n]*([^\n:]+?)[^\S\n]*:"
LINE_ENDS = r"\r\n|[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


@F.pandas_udf(T.StringType())
def unescape_entities(text: pd.Series) -> pd.Series:
    """All named and numbered HTML entities to characters (no built-in function knows the full set)."""
    return text.map(html.unescape, na_action="ignore")


_CLOSED = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+)|[A-Za-z][A-Za-z0-9]*);")


def _closed(found: re.Match) -> str:
    entity = found.group()
    return html.unescape(entity) if entity[1] == "#" or entity[1:] in html5 else entity


@F.pandas_udf(T.StringType())
def unescape_closed_entities(text: pd.Series) -> pd.Series:
    """The entities that end in a semicolon to characters; what a cut text leaves of one (``&amp``) stays."""
    return text.map(lambda own: _CLOSED.sub(_closed, own), na_action="ignore")


def unescape(text: Column, closed: bool = False) -> Column:
    """HTML entities to characters; with ``closed`` only those that end in a semicolon."""
    return unescape_closed_entities(text) if closed else unescape_entities(text)


def turns(text: Column) -> Column:
    """Array of (speaker, content): lines without a speaker continue the turn before them.

    Lines before the first speaker are ignored. Works inside the row: the text
    is split where a line with a speaker follows.
    """
    lines = F.regexp_replace(F.coalesce(text, F.lit("")), LINE_ENDS, "\n")
    blocks = F.split(lines, r"\n(?=" + SPEAKER_LINE + ")")
    spoken = F.filter(blocks, lambda b: b.rlike("^" + SPEAKER_LINE))

    def parts(block: Column) -> Column:
        speaker = strip(F.regexp_extract(block, SPEAKER, 1))
        content = F.regexp_replace(block, SPEAKER + r"[^\S\n]*", "")
        content = F.regexp_replace(content, r"[^\S\n]+(?=\n|$)", "")
        content = F.regexp_replace(F.regexp_replace(content, r"\s+$", ""), r"^\n", "")
        return F.struct(speaker.alias("speaker"), content.alias("content"))

    return F.transform(spoken, parts)


def is_automatic(speaker: Column, names: Sequence[str] = AUTOMATIC_SPEAKERS) -> Column:
    tidy = F.regexp_replace(F.lower(F.trim(strip_marks(speaker))), r"\s+", " ")
    return tidy.isin(*names)


def without_automatic(turn_list: Column, names: Sequence[str] = AUTOMATIC_SPEAKERS) -> Column:
    """Transcript text of the turns spoken by persons."""
    kept = F.filter(turn_list, lambda t: ~is_automatic(t["speaker"], names))

    def line(turn: Column) -> Column:
        content = strip(turn["content"])
        head = F.concat(F.lit("#"), turn["speaker"], F.lit(" :"))
        return F.when(content != "", F.concat(head, F.lit(" "), content)).otherwise(head)

    joined = strip(F.array_join(F.transform(kept, line), "\n"))
    return F.regexp_replace(joined, r"\n{3,}", "\n\n")
