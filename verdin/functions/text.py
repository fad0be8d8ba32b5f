"""Text normalisers, counts, keywords, trimming and chunking as column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from decimal import Decimal
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdin.functions.numbers import add

# letters, digits and underscore of any script
WORD = r"\p{L}\p{N}_"
# every blank character: as a pattern class (needs the (?U) flag) and as text
BLANK = r"\s\x1c-\x1f"
BLANK_CHARACTERS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_COMMENT_WORD = re.compile("[a-záéíóúñ]{3,}")
NON_ASCII = r"[^\x00-\x7f]"
_CHARACTERS = [chr(code) for code in range(0x80, 0x110000) if not 0xD800 <= code < 0xE000]

# fixed values: words left out of the keywords of a comment
COMMENT_STOP_WORDS = (
    "que", "de", "la", "el", "en", "y", "a", "los", "las", "un", "una", "por", "para", "con", "no", "si",
    "es", "al", "lo", "se", "mi", "tu", "su", "me", "te", "le", "les", "ya", "muy", "más", "mas", "pero",
    "como", "cuando", "donde", "del", "hay", "son", "uno", "este", "esta", "eso", "esa",
)
# fixed values: words left out of the keywords of a post
POST_STOP_WORDS = (
    "para", "pero", "como", "con", "del", "desde", "donde", "durante", "entre", "porque", "cuando", "que", "por",
    "una", "uno", "sobre", "sin", "son", "sus", "tiene", "tienen", "hay", "fue", "han", "más", "muy", "todo",
    "todos", "todas", "ellos", "ellas", "nos", "nuestra", "nuestro", "tu", "tus", "yo", "el", "la", "los", "las",
    "de", "y", "o", "a", "al", "se", "es", "no", "si", "sí",
)
# fixed values: the small polarity lexicon
POSITIVE_WORDS = ("excelente", "bueno", "genial", "me gusta", "agradable", "perfecto", "gracias")
NEGATIVE_WORDS = ("malo", "pesimo", "caro", "no me gusta", "terrible", "problema", "queja")


def _ascii(char: str) -> str:
    return unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")


def _unmarked(char: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn")


@cache
def ascii_table() -> tuple[str, str, dict[str, str]]:
    """Characters with a one-letter ASCII form, those letters, and characters with a longer form."""
    single, longer = {}, {}
    for char in _CHARACTERS:
        form = _ascii(char)
        if len(form) == 1:
            single[char] = form
        elif form:
            longer[char] = form
    return "".join(single), "".join(single.values()), longer


@cache
def mark_table() -> tuple[str, str]:
    """Accented characters and their base letters; combining marks at the end have no partner and are deleted."""
    forms = {}
    for char in _CHARACTERS:
        form = _unmarked(char)
        if len(form) == 1 and form != char:
            forms[char] = form
    marks = "".join(char for char in _CHARACTERS if unicodedata.category(char) == "Mn")
    return "".join(forms) + marks, "".join(forms.values())


def _ranges(characters: str, gap: int = 64) -> str:
    """A pattern of few ranges around the characters; a class of many single ones is slow to test."""
    codes = sorted(map(ord, characters))
    spans = [[codes[0], codes[0]]]
    for code in codes[1:]:
        if code - spans[-1][1] <= gap:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(f"{chr(low)}-{chr(high)}" for low, high in spans) + "]"


def to_ascii(text: Column) -> Column:
    """Compatibility-decomposed text without anything outside ASCII; plain ASCII rows are passed through."""
    plain, letters, longer = ascii_table()
    class_ = _ranges("".join(longer))
    forms = F.create_map(*[F.lit(one) for pair in longer.items() for one in pair])
    # only the characters that the row has are replaced, each once
    met = F.array_distinct(F.regexp_extract_all(text, F.lit(f"({class_})")))
    expanded = F.aggregate(met, text, lambda done, char: F.replace(done, char, F.coalesce(F.try_element_at(forms, char), char)))

    def folded(own: Column) -> Column:
        return F.regexp_replace(F.translate(own, plain, letters), NON_ASCII, "")

    return (
        F.when(~text.rlike(NON_ASCII), text)
        .when(text.rlike(class_), folded(expanded))
        .otherwise(folded(text))
    )


def strip_marks(text: Column) -> Column:
    """Text without accents; letters that have none (ß, œ) stay."""
    accented, base = mark_table()
    return F.when(text.rlike(NON_ASCII), F.translate(text, accented, base)).otherwise(text)


def squeeze(text: Column) -> Column:
    """Blank runs to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, f"(?U)[{BLANK}]+", " "))


def strip(text: Column) -> Column:
    """No blank characters at either end."""
    return F.btrim(text, F.lit(BLANK_CHARACTERS))


def normalise_words(text: Column) -> Column:
    """Lower-case ASCII words separated by single spaces; empty for null."""
    ascii_text = to_ascii(F.lower(F.coalesce(text, F.lit(""))))
    return F.trim(F.regexp_replace(ascii_text, r"\W+", " "))


def normalise_line(text: Column) -> Column:
    """One lower-case line without accents, punctuation kept."""
    return squeeze(strip_marks(F.lower(text)))


def normalise_key(text: Column) -> Column:
    """Upper-case ASCII with single spaces; null stays null."""
    return squeeze(to_ascii(F.upper(text)))


def phrase_token(phrase: str) -> str:
    """A dictionary phrase as lower-case ASCII with single spaces, punctuation kept."""
    return " ".join(_ascii_text(phrase.lower()).split())


def phrase_words(phrase: str) -> str:
    """A dictionary phrase normalised like :func:`normalise_words`."""
    return " ".join("".join(c if c.isalnum() or c in "_ " else " " for c in _ascii_text(phrase.lower())).split())


def phrase_line(phrase: str) -> str:
    """A dictionary phrase normalised like :func:`normalise_line`."""
    return " ".join(_unmarked(phrase.lower()).split())


def _ascii_text(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[{WORD}]+"))


def token_count(normalised: Column) -> Column:
    """Tokens of a text whose blanks were squeezed."""
    return F.when(normalised == "", F.lit(0)).otherwise(F.size(F.split(normalised, " ")))


def sentences(text: Column) -> Column:
    """Non-empty pieces between sentence marks and line ends."""
    pieces = F.transform(F.split(text, r"[.!?¡¿;\n\r]+"), strip)
    return F.filter(pieces, lambda p: p != "")


def sentence_mark_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[.!?]+"))


def post_keywords(text: Column, stop_words: Sequence[str] = POST_STOP_WORDS) -> Column:
    """Words longer than three letters without stop words, in order, repeats kept."""
    clean = F.regexp_replace(F.lower(text), f"(?U)[^{WORD}{BLANK}]", "")
    words = F.split(clean, f"(?U)[{BLANK}]+")
    kept = F.filter(words, lambda w: (F.length(w) > 3) & ~w.isin(*stop_words))
    return F.coalesce(kept, F.array().cast("array<string>"))


def top_words(text: Column, k: int = 5, stop_words: Sequence[str] = COMMENT_STOP_WORDS) -> Column:
    """The ``k`` most frequent words of the row, equal counts by first appearance; null when there is none.

    A vectorised function: counting words with array functions took ten times
    as long on whole documents.
    """
    skipped = frozenset(stop_words)

    def best(value: str | None) -> str | None:
        words = (w for w in _COMMENT_WORD.findall((value or "").lower()) if w not in skipped)
        return ", ".join(w for w, _ in Counter(words).most_common(k)) or None

    @F.pandas_udf(T.StringType())
    def count(values: pd.Series) -> pd.Series:
        return values.map(best)

    return count(text)


def occurrences(text: Column, part: str) -> Column:
    """Non-overlapping occurrences of a plain text."""
    shorter = F.length(F.replace(text, F.lit(part), F.lit("")))
    return ((F.length(text) - shorter) / len(part)).cast("int")


def polarity(
    line: Column, positive: Sequence[str] = POSITIVE_WORDS, negative: Sequence[str] = NEGATIVE_WORDS
) -> Column:
    """(positive - negative) / (positive + negative) occurrences, 0 without any; on a normalised line."""
    return polarity_of(add([occurrences(line, w) for w in positive]), add([occurrences(line, w) for w in negative]))


def polarity_of(good: Column, bad: Column) -> Column:
    """Polarity from the two numbers of occurrences."""
    return F.when(good + bad == 0, F.lit(0.0)).otherwise((good - bad) / (good + bad))


def polarity_label(value: Column, margin: float = 0.1) -> Column:
    # fixed values: the label texts
    return F.when(value >= margin, F.lit("positivo")).when(value <= -margin, F.lit("negativo")).otherwise(F.lit("neutro"))


def polarity_confidence(value: Column) -> Column:
    return F.lit(0.5) + F.abs(value) / 2


def capped_confidence(value: Column) -> Column:
    return F.lit(0.5) + 0.5 * F.least(F.lit(1.0), F.abs(value))


def tail(text: Column, share: float = 0.30) -> Column:
    """The last share of a text; the share counts as written, so that 0.3 of 90 characters are 27."""
    skipped = F.floor(F.length(text) * F.lit(1 - Decimal(str(share)))).cast("int")
    return F.substring(text, skipped + 1, F.length(text))


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    """Whether any normalised phrase occurs in a normalised text."""
    tests = [text.contains(phrase_token(p)) for p in phrases]
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result


def head_and_tail(text: Column, longest: int = 12000, head: float = 0.7) -> Column:
    """Trimmed text, or its beginning and end around a mark when it is too long."""
    trimmed = strip(F.coalesce(text, F.lit("")))
    first = F.left(trimmed, F.lit(int(longest * head)))
    last = F.right(trimmed, F.lit(int(longest * (1 - head))))
    return F.when(F.length(trimmed) <= longest, trimmed).otherwise(F.concat(first, F.lit("\n...\n"), last))


def pieces(text: str | None, longest: int) -> Iterator[str]:
    """Pieces of at most ``longest`` characters, cut after the last full stop beyond 60 % of a piece; blank ones are left out.

    A piece starts where the one before ended, so a text is walked once whatever its length.
    """
    clean, start = (text or "").strip(), 0
    if len(clean) <= longest:
        yield clean
        return
    while start < len(clean):
        end = min(start + longest, len(clean))
        stop = clean.rfind(".", start, end)
        if stop - start > int(longest * 0.6):
            end = stop + 1
        piece = clean[start:end].strip()
        if piece:
            yield piece
        start = end


class _Chunks:
    def eval(self, text: str, longest: int) -> Iterator[tuple[int, str]]:
        yield from enumerate(pieces(text, longest))


def chunk_rows(df: DataFrame, column: str, longest: int) -> DataFrame:
    """``df`` with a row per piece of its ``column``: ``place`` from 0 and ``piece``; a table function over whole texts.

    Null and blank texts are one empty piece.
    """
    cut = F.udtf(_Chunks, returnType="place INT, piece STRING", useArrow=True)
    return df.lateralJoin(cut(F.col(column).outer(), F.lit(longest)))
