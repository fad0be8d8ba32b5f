"""Quality rules on whole texts, with repetition read from a suffix array of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdin.llm.frames import keep_rows, text_bytes

#: Words of a repeat that counts, the share of a text that such repeats may cover, and the longest one allowed.
#: The share is the published limit for duplicate 8-word sequences (MassiveText, Rae et al. 2021: 0.12). Words of such
#: repeats also lie in the base rule's repeated windows, so only a limit well below its one half decides anything.
MIN_REPEAT = 8
MAX_COVERED = 0.12
MAX_LONGEST = 120

_NOT_COUNTED = bytes(range(0x80, 0xC0)) + b" \t\n\v\f\r"
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_maximal long, covered_words long, longest_repeat long"
)


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of a sequence by prefix doubling, and the ranks by the first 1, 2, 4, ... items.

    Each rank array has one more place, for the end of the sequence, which ranks below all.
    """
    n = len(ids)
    _, rank = np.unique(ids, return_inverse=True)
    rank = np.append(rank.astype(np.int64), -1)
    levels, width = [rank], 1
    order = np.argsort(rank[:n], kind="stable")
    while rank[:n].max() < n - 1:
        after = np.full(n, -1, dtype=np.int64)
        after[: max(0, n - width)] = rank[width:n]
        key = rank[:n] * (n + 1) + after + 1
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.full(n + 1, -1, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], ranked[1:] != ranked[:-1])))
        levels.append(rank)
        width *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Items that neighbours in suffix order have in common at their start."""
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(left), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        same = levels[level][left] == levels[level][right]
        step = same.astype(np.int64) << level
        left, right, common = left + step, right + step, common + step
    return common


def repeats(ids: np.ndarray, least: int) -> tuple[int, int, int]:
    """Number of maximal repeated stretches, items they cover together, and the length of the longest.

    The intervals of common prefixes give each position its longest repeat,
    overlapping ones included; a stretch that only continues the one a place
    earlier is not maximal. Stretches under ``least`` items are left out of
    number and cover.
    """
    n = len(ids)
    if n < 2:
        return 0, 0, 0
    order, levels = suffix_order(ids)
    common = common_prefixes(order, levels)
    longest = np.zeros(n, dtype=np.int64)
    longest[order[1:]] = common
    longest[order[:-1]] = np.maximum(longest[order[:-1]], common)
    first = np.concatenate(([True], longest[1:] != longest[:-1] - 1))
    starts = np.flatnonzero(first & (longest >= least))
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + longest[starts], -1)
    return len(starts), int(np.count_nonzero(np.cumsum(edges[:n]))), int(longest.max())


def repeated_window_words(ids: np.ndarray, size: int = 3) -> int:
    """Words inside windows of ``size`` words that occur twice or more, the first included."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    key = ids[:n].astype(np.int64)
    for step in range(1, size):
        if step > 1:  # keep the key short: number the pairs anew
            _, key = np.unique(key, return_inverse=True)
        key = key * (int(ids.max()) + 1) + ids[step : n + step]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
    marked = np.zeros(len(ids), dtype=bool)
    for step in range(size):
        marked[order[twice] + step] = True
    return int(np.count_nonzero(marked))


def measure(data: bytes, least: int = MIN_REPEAT) -> tuple[int, ...]:
    """The measures of one text, in the order of ``SCHEMA``."""
    words = data.split()
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], dtype=np.int64)
    seen: set[bytes] = set()
    copies = 0
    for line in data.split(b"\n"):
        if line.strip():
            copies += line in seen
            seen.add(line)
    return (
        len(words),
        len(data.translate(None, _NOT_COUNTED)),
        len(data) - len(data.translate(None, b"#*$%&|<>")),
        copies,
        repeated_window_words(ids),
        *repeats(ids, least),
    )


def measured(docs: DataFrame, least: int = MIN_REPEAT) -> DataFrame:
    """``docs`` narrowed to ``doc_id`` with the measures of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *[part.split()[0] for part in SCHEMA.split(", ")]]
        for batch in batches:
            rows = np.array([measure(data, least) for data in text_bytes(batch.column(1))], dtype=np.int64).reshape(-1, len(names) - 1)
            columns = [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(rows.shape[1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, {SCHEMA}")


def base_failed() -> Column:
    """Under 50 words, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def passes(max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> Column:
    """The verdict from the suffix array: repeats cover few enough words and none is too long."""
    return (F.col("covered_words") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_longest)


def judged(docs: DataFrame, least: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row per document: measures, ``base_failed`` and ``kept``.

    Null and blank texts have no words and fail. Very long texts are measured
    whole. Repeated rows and null ids come back as they are; other columns are
    ignored.
    """
    failed = base_failed()
    return measured(docs, least).withColumns({"base_failed": failed, "kept": ~failed & passes(max_covered, max_longest)})


def kept(docs: DataFrame, least: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """``docs`` without the rows that ``judged`` rejects; all columns stay."""

    def good(data: bytes) -> bool:
        n, _, _, _, repeated, _, covered, longest = measure(data, least)
        return n >= 50 and 100 * repeated <= 50 * n and covered <= max_covered * n and longest <= max_longest

    return keep_rows(docs, lambda texts: [good(data) for data in texts])
