"""Names, mails, numbers and keys read out of file names, addresses and free text.

Every parser gives null when there is nothing to find, unless it says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdin.functions.text import normalise_line, squeeze, strip, strip_marks

# fixed values: the mail patterns of object keys and of file names
MAIL_IN_KEY = r"[\w.+-]+@[\w-]+\.[\w.-]+"
MAIL_IN_NAME = r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]*$", 0)


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def extension(path: Column) -> Column:
    """Lower-case extension without the dot, empty when there is none."""
    return F.lower(F.regexp_extract(file_name(path), r".\.([^.]*)$", 1))


def has_extension(path: Column, allowed: Sequence[str]) -> Column:
    return extension(path).isin(*[a.lower().lstrip(".") for a in allowed])


def key_extension(key: Column) -> Column:
    """What follows the last dot of an object key, lower case; empty without a dot."""
    return F.lower(F.regexp_extract(key, r"\.([^.]*)$", 1))


def target_name(text: Column, allowed: Sequence[str]) -> Column:
    """First token of an entry in lower case, without a known extension."""
    token = F.lower(F.element_at(F.split(squeeze(text), " "), 1))
    known = "|".join(a.lower().lstrip(".") for a in allowed)
    return F.regexp_replace(token, rf"\.(?:{known})$", "")


def mail_in_key(key: Column) -> Column:
    """Mail address anywhere in an object key, lower case."""
    return F.lower(_found(key, MAIL_IN_KEY))


def mail_in_name(name: Column) -> Column:
    """Mail address in a file name (its stem), lower case; empty when there is none."""
    return F.lower(F.regexp_extract(stem(name), MAIL_IN_NAME, 1))


def adviser_name(name: Column) -> Column:
    """Person after "by" and before "@" in a file name, else the stem; in title case."""
    own = stem(name)
    raw = F.coalesce(_found(own, r"(?i)by\s+(.+?)@", 1), own)
    spaced = F.regexp_replace(strip(F.translate(raw, "_-", "  ")), r"\s{2,}", " ")
    return F.initcap(spaced)


def leading_phone(name: Column) -> Column:
    """10 to 15 digits at the start of a file name; empty when there are none."""
    return F.regexp_extract(stem(name), r"^(\+?\d{10,15})", 1)


def audio_id(name: Column) -> Column:
    return _found(stem(name), r"(\d+\.\d+)", 1)


def audio_id_anywhere(text: Column) -> Column:
    return _found(text, r"(\d+\.\d+)", 1)


def call_id(name: Column) -> Column:
    return F.lower(strip(stem(name)))


def phone_in_text(text: Column) -> Column:
    """Optional country code and ten digits, else a number of 7 to 12 digits; empty when there is none."""
    national = F.concat(
        F.regexp_extract(text, r"(\+?57)?\s?(\d{10})", 1), F.regexp_extract(text, r"(\+?57)?\s?(\d{10})", 2)
    )
    found = F.when(national != "", national).otherwise(F.regexp_extract(text, r"\+?\d{7,12}", 0))
    return F.when(text.rlike(r"\d{7}"), found).otherwise(F.lit(""))


def last_ten_digits(number: Column) -> Column:
    """Last ten digits of a number; empty for null."""
    return F.right(F.regexp_replace(F.coalesce(number, F.lit("")), r"\D+", ""), F.lit(10))


def document_number(cell: Column, row_text: Column) -> Column:
    """Digits of a cell when there are six or more, else the first 7+ digit word of the row."""
    digits = F.regexp_replace(F.coalesce(cell, F.lit("")), r"\D", "")
    return F.when(F.length(digits) >= 6, digits).otherwise(_found(row_text, r"\b(\d{7,})\b", 1))


def slug(text: Column) -> Column:
    """Letters, digits, dots, dashes and underscores; everything else separates words, joined by underscores."""
    plain = strip_marks(F.coalesce(text, F.lit("")))
    return F.replace(squeeze(F.regexp_replace(plain, r"[^\p{L}\p{N} ._-]", " ")), F.lit(" "), F.lit("_"))


def mail_local(mail: Column) -> Column:
    """What stands before the @; empty when there is none."""
    return F.when(mail.contains("@"), F.trim(F.split_part(mail, F.lit("@"), F.lit(1)))).otherwise(F.lit(""))


def report_root(name: Column, mail: Column, document: Column, prefix: str = "Report", fallback: str = "Report") -> Column:
    """``prefix_name_mail_document``, name cut to 90 and mail to 50 characters, absent parts left out."""
    own = F.coalesce(F.nullif(F.trim(name), F.lit("")), F.lit(fallback))
    local = F.nullif(F.left(slug(mail_local(F.coalesce(mail, F.lit("")))), F.lit(50)), F.lit(""))
    return F.concat_ws("_", F.lit(prefix), F.left(slug(own), F.lit(90)), local, F.nullif(document, F.lit("")))


def candidate_keys(name: Column, mail: Column, document: Column, gender: Column | None = None) -> Column:
    """Keys a person may be indexed under, most specific mail first, without blanks or repeats."""
    own = F.nullif(normalise_line(F.coalesce(name, F.lit(""))), F.lit(""))
    filed = F.nullif(document, F.lit(""))
    keys = [F.nullif(F.lower(F.trim(mail)), F.lit("")), _bar(own, filed), own]
    if gender is not None:
        keys.append(_bar(own, filed, F.nullif(F.lower(F.trim(gender)), F.lit(""))))
    return F.array_distinct(F.array_compact(F.array(*keys)))


def _bar(*parts: Column) -> Column:
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("|"), part)
    return joined


def job_name(key: Column, stamp: str) -> Column:
    """Name of a job for an object: safe characters, at most 200."""
    base = F.regexp_replace(file_name(key), r"[^A-Za-z0-9._-]+", "-")
    return F.left(F.concat(F.lit(f"tr-{stamp}-"), base), F.lit(200))


def origin_host(origin: Column) -> Column:
    """Host of a web address in lower case without ``www.``; anything else trimmed."""
    own = F.trim(origin)
    host = F.replace(F.lower(F.regexp_extract(own, r"(?i)^https?://([^/?#]*)", 1)), F.lit("www."), F.lit(""))
    is_address = F.lower(own).startswith("http://") | F.lower(own).startswith("https://")
    return F.when(~is_address, own).when(host != "", host).otherwise(F.lit("url"))


def unquote(text: Column) -> Column:
    """Percent-decoded text with plus signs as blanks; malformed text stays as it is."""
    return F.coalesce(F.try_url_decode(text), text)
