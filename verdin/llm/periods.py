"""Periodic runs of words: stretches that repeat one passage at least four times.

The dictionary of basic factors names every stretch of 1, 2, 4, ... words, so that
equal stretches have equal names. At length L a stretch and its next occurrence d
words later, ``L < d <= 2 L`` (at length 1 also d = 1), propose the period d where three
occurrences follow one another at that distance. Every run of period d holds such
a stretch: a primitive word of d letters has more than d / 2 distinct cyclic
factors of L >= d / 2 letters, so one of them occurs once in each period. Proposals
of one run are joined, extended word by word, and kept once with their smallest period.

The texts of an Arrow batch are numbered together, a portion of words at a time.
Only stretches that occur twice in their text stay in the dictionary, so ordinary
prose is done after a few lengths. A very long text is one portion of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdin.llm.frames import text_bytes

#: A run repeats its period at least so often and has at least so many words.
TIMES = 4
LEAST = 6
PORTION_WORDS = 400_000
RUN = "struct<start: bigint, length: bigint, period: bigint>"
SCHEMA = f"n_words long, runs array<{RUN}>, collapsed string"


def successors(place: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that have a later occurrence of their name, ascending, and the distance to the next one."""
    order = np.argsort(name, kind="stable")
    same = np.flatnonzero(name[order[1:]] == name[order[:-1]])
    here, there = order[same], order[same + 1]
    back = np.argsort(here, kind="stable")
    here, there = here[back], there[back]
    return place[here], place[there] - place[here]


def repeated(name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where names occur twice or more, and the names there numbered anew."""
    _, number, count = np.unique(name, return_inverse=True, return_counts=True)
    more = count > 1
    at = np.flatnonzero(more[number])
    return at, (np.cumsum(more) - 1)[number[at]]


def proposals(ids: np.ndarray, longest: int) -> Iterator[tuple[int, int, int]]:
    """Stretches ``(start, end, period)`` that keep that period, ascending by period, then start, from the dictionary of basic factors.

    ``ids`` holds one number per word, different for the words of different texts.
    ``longest`` is the greatest period to look for.
    """
    n, length = len(ids), 1
    place, name = repeated(ids)
    while len(place) and length < max(2, longest):
        here, distance = successors(place, name)
        near = (distance <= 2 * length) & ((distance > length) | (length == 1))
        here, distance = here[near], distance[near]
        ahead = np.searchsorted(here, here + distance)
        ahead[ahead == len(here)] = 0
        third = (here[ahead] == here + distance) & (distance[ahead] == distance) if len(here) else np.zeros(0, dtype=bool)
        here, distance = here[third], distance[third]
        order = np.lexsort((here, distance))
        here, distance = here[order], distance[order]
        if len(here):  # neighbours whose stretches touch agree with the words d later without a gap
            cut = np.flatnonzero((distance[1:] != distance[:-1]) | (here[1:] - here[:-1] > length)) + 1
            first, last = np.append(0, cut), np.append(cut, len(here)) - 1
            ends = here[last] + distance[last] + length
            yield from zip(here[first].tolist(), ends.tolist(), distance[first].tolist(), strict=True)
        # names of twice the length: pairs of names, kept where the pair occurs again
        after = np.searchsorted(place, place + length)
        after[after == len(place)] = 0
        both = (place[after] == place + length) & (place + 2 * length <= n)
        pair = name[both] * (int(name.max()) + 1) + name[after[both]]
        place = place[both]
        again, name = repeated(pair)
        place = place[again]
        length *= 2


def extended(ids: np.ndarray, start: int, end: int, period: int) -> tuple[int, int]:
    """The longest stretch around ``start`` to ``end`` that keeps the period."""
    step = max(16, 2 * period)
    while start > 0:
        low = max(0, start - step)
        other = np.flatnonzero(ids[low:start] != ids[low + period : start + period])
        if len(other):
            start = low + int(other[-1]) + 1
            break
        start = low
    while end < len(ids):
        high = min(len(ids), end + step)
        other = np.flatnonzero(ids[end:high] != ids[end - period : high - period])
        if len(other):
            end += int(other[0])
            break
        end = high
    return start, end


def runs(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` by start, then period.

    A multiple of a period may be proposed near the end of its run; it extends to
    the same stretch as the period itself, which came first. Later proposals inside a
    stretch that was extended already are passed over.
    """
    found: dict[tuple[int, int], int] = {}
    known_period = known_end = 0
    for start, end, period in proposals(ids, longest):
        if period == known_period and start < known_end - period:
            continue
        start, end = extended(ids, start, end, period)
        known_period, known_end = period, end
        if end - start >= max(LEAST, TIMES * period):
            known = found.get((start, end))
            found[start, end] = period if known is None else min(known, period)
    return sorted((start, end - start, period) for (start, end), period in found.items())


def measured(texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Per text its number of words, its runs, and the words left when each run is cut to its first period."""
    held: list[list[bytes]] = []
    size = 0
    for text in texts:
        held.append(text.split())
        size += len(held[-1])
        if size >= PORTION_WORDS:
            yield from _portion(held)
            held, size = [], 0
    yield from _portion(held)


def _portion(texts: list[list[bytes]]) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    ids = np.empty(sum(map(len, texts)), dtype=np.int64)
    place = base = 0
    edges = [0]
    for words in texts:
        numbers = {word: k for k, word in enumerate(dict.fromkeys(words))}
        ids[place : place + len(words)] = [numbers[word] for word in words]
        ids[place : place + len(words)] += base
        base += len(numbers)
        place += len(words)
        edges.append(place)
    found = runs(ids, max(map(len, texts), default=0) // TIMES)
    owner = np.searchsorted(edges, [start for start, _, _ in found], side="right") - 1
    own: dict[int, list[tuple[int, int, int]]] = {}
    for (start, length, period), text in zip(found, owner.tolist(), strict=True):
        own.setdefault(text, []).append((start - edges[text], length, period))
    for text, words in enumerate(texts):
        mine = own.get(text, [])
        n = len(words)
        if mine:
            depth = np.zeros(n + 1, dtype=np.int64)
            spans = np.array(mine, dtype=np.int64)
            np.add.at(depth, spans[:, 0] + spans[:, 2], 1)
            np.add.at(depth, spans[:, 0] + spans[:, 1], -1)
            words = [words[k] for k in np.flatnonzero(np.cumsum(depth[:n]) == 0)]
        yield n, mine, b" ".join(words)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``runs`` (by start, then period) and the ``collapsed`` text.

    Words are numbered from 0. A run is a maximal stretch with its smallest
    period, four periods and six words long at least; the collapsed text leaves out
    what follows the first period of a run. Null, empty and blank texts have no
    words, no runs and an empty collapsed text. Repeated rows and null ids come
    back as they are; other columns are ignored. Texts are taken whole.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, found, left = [], [], []
            for n, own, text in measured(text_bytes(batch.column(1))):
                number.append(n)
                found.append([{"start": start, "length": length, "period": period} for start, length, period in own])
                left.append(text)
            arrays = [batch.column(0), pa.array(number, pa.int64()), pa.array(found, kind), pa.array(left, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, {SCHEMA}")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of ``docs``; one document in ten is made periodic from some word on.

    With h the CRC-32 of the decimal id: where h % 10 = 0, each of the n words from a = (h / 10) % n
    on becomes word a + (i - a) % p, p = 1 + (n - a) / (3 + h / 10 % 8). Rows without id or words stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    n, a, p, w = F.col("n"), F.col("a"), F.col("p"), F.col("w")
    chosen = docs.select(F.col("doc_id").cast("long"), "text").withColumn("w", F.when(h % 10 == 0, words))
    chosen = chosen.withColumn("n", F.when(F.size("w") > 0, F.size("w"))).withColumn("a", g % n)
    chosen = chosen.withColumn("p", 1 + F.floor((n - a) / (3 + g % 8)))
    again = F.flatten(F.array_repeat(F.slice(w, a.cast("int") + 1, p.cast("int")), F.ceil((n - a) / p).cast("int")))
    changed = F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), F.slice(again, F.lit(1), (n - a).cast("int"))), " ")
    return chosen.select("doc_id", F.when(n.isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs``: number of runs, the one repeating most often, and digests of all runs and of the collapsed text.

    Most often means the greatest exact length / period; ties go to the smallest start, then period.
    """

    def before(one, two):  # comparison by cross products, exact in long
        left, right = one["length"] * two["period"], two["length"] * one["period"]
        order = F.when(left > right, -1).when(left < right, 1).when(one["start"] < two["start"], -1).when(one["start"] > two["start"], 1)
        return order.when(one["period"] < two["period"], -1).when(one["period"] > two["period"], 1).otherwise(0)

    start = F.get("runs", F.lit(0))
    best = F.aggregate("runs", start, lambda held, one: F.when(before(one, held) < 0, one).otherwise(held))
    line = F.transform("runs", lambda one: F.concat(F.concat_ws(",", one["start"], one["length"], one["period"]), F.lit("\n")))
    parts = {name: F.col(f"best.{name}") for name in ("start", "length", "period")}
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[part.alias(name) for name, part in parts.items()],
        F.floor(1000 * parts["length"] / parts["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
