"""Small helpers the operators share: Arrow batches of whole texts, digests, narrow tables kept in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdin.session import pinned

WORD = r"[^\x20\x09-\x0D]+"


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null read as empty, without decoding."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def keep_rows(df: DataFrame, chosen: Callable[[list[str | bytes]], list[bool]], column: str = "text", binary: bool = True) -> DataFrame:
    """Rows of ``df`` whose texts ``chosen`` keeps, all columns as they are.

    Made as a filter inside the rows' own partitions: no key is needed, repeated rows and null ids are judged one by one.
    """
    place = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            texts = text_bytes(texts) if binary else [text or "" for text in texts.to_pylist()]
            yield batch.filter(pa.array(chosen(texts), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def word_count(text: Column) -> Column:
    """Words of a text, long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where ``df`` has a column of that name (case aside)."""
    taken, found = {column.lower() for column in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def lower_ascii(value: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(value, letters, letters.lower())


__all__ = ["WORD", "free_names", "keep_rows", "lower_ascii", "pinned", "text_bytes", "word_count"]
