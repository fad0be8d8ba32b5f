"""Fill-in-the-middle: texts cut at two token bounds and put together in another order.

All bytes of an Arrow batch move at once. The cuts of a document divide its bytes into
prefix, middle and suffix; each part moves by one displacement. A difference
array holds the displacement's change at the first byte of each part, its cumulative
sum gives every byte its place in the output, and one scatter writes the batch. Restoring
reads the marks in the output, finds the displacements again, and gathers with the same
places. Windows of a million bytes carry the sum on, so that a text of any length
needs a bounded number of places at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdin.llm.frames import text_bytes

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = len(PREFIX)
WINDOW = 1 << 20
PORTION_BYTES = 8 << 20
SCHEMA = "n_tokens long, form string, prefix_chars long, middle_chars long, output string"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def windows(size: int) -> Iterator[tuple[int, int]]:
    for low in range(0, size, WINDOW):
        yield low, min(size, low + WINDOW)


def token_starts(data: np.ndarray, begins: np.ndarray, low: int, high: int) -> np.ndarray:
    """Whether bytes ``low`` to before ``high`` start a token: a run of A-Z and a-z, or any other single character.

    ``begins`` holds the first byte of every document, ascending; a document starts a token.
    """
    part = data[low:high]
    letter = _LETTER[part]
    before = np.empty(len(part), dtype=bool)
    before[0] = low > 0 and _LETTER[data[low - 1]]
    before[1:] = letter[:-1]
    inside = begins[np.searchsorted(begins, low) : np.searchsorted(begins, high)]
    before[inside - low] = False
    return ((part & 0xC0) != 0x80) & ~(letter & before)


def counts_before(data: np.ndarray, places: np.ndarray, flags: Callable[[int, int], np.ndarray]) -> np.ndarray:
    """How many flagged bytes lie before each of the ascending ``places``."""
    out = np.zeros(len(places), dtype=np.int64)
    total = 0
    for low, high in windows(len(data)):
        first, last = np.searchsorted(places, [low, high])
        sums = np.concatenate(([0], np.cumsum(flags(low, high))))
        out[first:last] = total + sums[places[first:last] - low]
        total += int(sums[-1])
    out[np.searchsorted(places, len(data)) :] = total
    return out


def places_of(data: np.ndarray, wanted: np.ndarray, flags: Callable[[int, int], np.ndarray]) -> np.ndarray:
    """Where the flagged bytes of the given numbers (from 0, in any order) lie; beyond the last one, the end."""
    out = np.full(len(wanted), len(data), dtype=np.int64)
    order = np.argsort(wanted, kind="stable")
    ranked = wanted[order]
    total = 0
    for low, high in windows(len(data)):
        at = np.flatnonzero(flags(low, high)) + low
        first, last = np.searchsorted(ranked, [total, total + len(at)])
        out[order[first:last]] = at[ranked[first:last] - total]
        total += len(at)
    return out


def moved(data: np.ndarray, starts: np.ndarray, shifts: np.ndarray, out: np.ndarray, back: bool) -> None:
    """Scatter ``data`` into ``out`` by each part's displacement, or gather it back from there.

    ``starts`` are the first bytes of the parts, ascending; the part of a byte is the last one that starts at or before it.
    """
    change = np.diff(shifts, prepend=0)
    carried = 0
    for low, high in windows(len(data)):
        first, last = np.searchsorted(starts, [low, high])
        shift = np.zeros(high - low, dtype=np.int64)
        np.add.at(shift, starts[first:last] - low, change[first:last])  # empty parts share a start
        shift[0] += carried
        np.cumsum(shift, out=shift)
        carried = int(shift[-1])
        shift += np.arange(low, high)
        if back:
            data[low:high] = out[shift]
        else:
            out[shift] = data[low:high]


def marks_inside(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the marks that lie inside one document, and the letter of each."""
    angle = np.flatnonzero(data[:-2] == PREFIX[0]) if len(data) > 2 else np.zeros(0, dtype=np.int64)
    kind = data[angle + 1] if len(angle) else np.zeros(0, dtype=np.uint8)
    fits = np.isin(kind, [PREFIX[1], SUFFIX[1], MIDDLE[1]]) & (data[angle + 2] == PREFIX[2]) if len(angle) else np.zeros(0, dtype=bool)
    angle, kind = angle[fits], kind[fits]
    end = edges[np.searchsorted(edges, angle, side="right")] if len(angle) else angle
    whole = angle + MARK <= end
    return angle[whole], kind[whole]


def laid_out(size: tuple[np.ndarray, np.ndarray, np.ndarray], spm: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First output byte of prefix, middle and suffix, counted from the document's start.

    psm is prefix, suffix, middle; spm is suffix, prefix, middle. A mark stands before each.
    """
    prefix, _, suffix = size
    return MARK + spm * (suffix + MARK), 3 * MARK + prefix + suffix, MARK + ~spm * (prefix + MARK)


def transform(texts: list[bytes], h: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, list[bytes]]:
    """Tokens, form, characters of prefix and middle (0 for plain), and output of every text; ``h`` has four numbers a text."""
    data = np.frombuffer(bytearray(b"".join(texts)), dtype=np.uint8)
    edges = np.cumsum([0, *map(len, texts)])
    begin, end = edges[:-1], edges[1:]
    begins = np.unique(begin[end > begin])

    def starts(low: int, high: int) -> np.ndarray:
        return token_starts(data, begins, low, high)

    def chars(low: int, high: int) -> np.ndarray:
        return (data[low:high] & 0xC0) != 0x80

    token = counts_before(data, edges, starts)
    n = np.diff(token)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    one, two = np.minimum(places_of(data, (token[:-1] + cuts.T).ravel(), starts).reshape(2, -1), end)
    marked = np.zeros(len(texts), dtype=bool)
    marked[np.searchsorted(edges, marks_inside(data, edges)[0], side="right") - 1] = True
    plain = (end == begin) | marked | (h[:, 2] % 100 >= 90)
    spm = h[:, 3] % 100 < 20

    size = one - begin, two - one, end - two
    length = np.where(plain, end - begin, end - begin + 3 * MARK)
    to = np.concatenate(([0], np.cumsum(length)))
    first = to[:-1]
    places = [np.where(plain, part - begin, place) + first for part, place in zip((begin, one, two), laid_out(size, spm), strict=True)]
    out = np.zeros(int(to[-1]), dtype=np.uint8)
    part = np.column_stack((begin, one, two)).ravel()
    moved(data, part, np.column_stack(places).ravel() - part, out, back=False)
    for mark, place in zip((PREFIX, MIDDLE, SUFFIX), places, strict=True):
        at = place[~plain] - MARK
        for k in range(MARK):
            out[at + k] = mark[k]
    where = np.column_stack((begin, one, two)).ravel()
    before = counts_before(data, where, chars).reshape(-1, 3)
    form = np.where(plain, "plain", np.where(spm, "spm", "psm")).tolist()
    whole = out.tobytes()
    outputs = [whole[a:b] for a, b in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)]
    return n, form, (before[:, 1] - before[:, 0]) * ~plain, (before[:, 2] - before[:, 1]) * ~plain, outputs


def restore(outputs: list[bytes], forms: list[str]) -> list[bytes]:
    """The texts that ``transform`` made ``outputs`` from, by the marks in them."""
    out = np.frombuffer(b"".join(outputs), dtype=np.uint8)
    edges = np.cumsum([0, *map(len, outputs)])
    first = edges[:-1]
    plain, spm = np.array(forms) == "plain", np.array(forms) == "spm"
    at, kind = marks_inside(out, edges)
    owner = np.searchsorted(edges, at, side="right") - 1
    place = {}
    for mark in (PREFIX, SUFFIX, MIDDLE):  # one of each in a text that is not plain
        mine = (kind == mark[1]) & ~plain[owner]
        place[mark] = first.copy()
        place[mark][owner[mine]] = at[mine] + MARK
    length = np.diff(edges)
    middle = np.where(plain, 0, edges[1:] - place[MIDDLE])
    prefix = np.where(plain, length, np.where(spm, place[MIDDLE], place[SUFFIX]) - MARK - place[PREFIX])
    suffix = np.where(plain, 0, np.where(spm, place[PREFIX], place[MIDDLE]) - MARK - place[SUFFIX])
    to = np.concatenate(([0], np.cumsum(prefix + middle + suffix)))
    begin = to[:-1]
    part = np.column_stack((begin, begin + prefix, begin + prefix + middle)).ravel()
    source = np.column_stack((place[PREFIX], place[MIDDLE], place[SUFFIX])).ravel()
    data = np.zeros(int(to[-1]), dtype=np.uint8)
    moved(data, part, source - part, out, back=True)
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)]


def portions(texts: list[bytes]) -> Iterator[slice]:
    """Neighbouring rows of some megabytes together; a longer text stands alone."""
    first = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > PORTION_BYTES:
            yield slice(first, k)
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield slice(first, len(texts))


def seeds(doc_id: Column) -> list[Column]:
    """Four numbers from 0 to 2**32 - 1 per document: the first groups of SHA-256 of ``1:`` and the decimal id (null: no digits)."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transformed(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_tokens``, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text.

    Null texts count as empty. Empty texts, texts with a mark of their own and one
    text in ten stay plain, with null sizes; a fifth of the others has the suffix first.
    Cuts depend on the id alone, so repeated rows come out alike. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            h = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(2, 6)]).astype(np.int64)
            for rows in portions(texts):
                n, form, prefix, middle, output = transform(texts[rows], h[rows])
                cut = np.array(form) == "plain"
                columns = [pa.array(n), pa.array(form), pa.array(prefix, mask=cut), pa.array(middle, mask=cut), pa.array(output, pa.binary()).cast(pa.string())]
                ids = batch.column(0).slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "n_tokens", "form", "prefix_chars", "middle_chars", "output"])

    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), "text", *seeds(doc_id)).mapInArrow(run, f"doc_id long, {SCHEMA}")


def restored(rows: DataFrame) -> DataFrame:
    """``rows`` of ``transformed`` with the text rebuilt from ``output`` and ``form`` as ``restored``."""
    places = rows.columns.index("output"), rows.columns.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outputs, forms = text_bytes(batch.column(places[0])), batch.column(places[1]).to_pylist()
            for part in portions(outputs):
                texts = pa.array(restore(outputs[part], forms[part]), pa.binary()).cast(pa.string())
                held = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*held.columns, texts], names=[*held.schema.names, "restored"])

    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, restored string")


def digests(docs: DataFrame) -> DataFrame:
    """Every document transformed and restored, with digests of both texts."""
    digest = {name: F.sha2(F.col(name).cast("binary"), 256).alias(f"{name}_sha256") for name in ("output", "restored")}
    return restored(transformed(docs)).select(
        "doc_id", F.col("n_tokens").alias("n"), "form", "prefix_chars", "middle_chars", digest["output"], digest["restored"]
    )


SQL = """WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS x FROM documents),
    h AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS t, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
      CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
    c AS (SELECT doc_id, text, t, len(t) AS n, h4, text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 AS plain,
      least(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS a, greatest(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS b FROM h),
    p AS (SELECT doc_id, text, n, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
      array_to_string(t[1:a], '') AS pre, array_to_string(t[a + 1:b], '') AS mid, array_to_string(t[b + 1:], '') AS suf FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
      sha256(text) AS restored_sha256 FROM p"""
