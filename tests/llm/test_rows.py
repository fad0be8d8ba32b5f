"""Periodic runs, fill-in-the-middle and line dedup against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdin.llm import infill, lines, periods


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def found_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(words):
    """All maximal stretches of every period, kept where no smaller period holds in them."""
    n, out = len(words), []
    for period in range(1, n // 4 + 1):
        start = 0
        while start < n - period:
            end = start
            while end + period < n and words[end] == words[end + period]:
                end += 1
            if end + period - start >= max(6, 4 * period):
                stretch = words[start : end + period]
                if not any(stretch[k:] == stretch[:-k] for k in range(1, period)):
                    out.append((start, end + period - start, period))
            start = max(end, start) + 1
    return sorted(out)


def brute_collapsed(words, runs):
    gone = {k for start, length, period in runs for k in range(start + period, start + length)}
    return " ".join(word for k, word in enumerate(words) if k not in gone)


def with_repeats(rnd):
    """Words with nested and neighbouring repeats."""
    words = []
    for _ in range(rnd.randrange(1, 6)):
        root = [rnd.choice("abc") for _ in range(rnd.randrange(1, 7))]
        if rnd.random() < 0.3:
            root = root * 5 + ["x"]
        stretch = root * rnd.randrange(1, 8)
        words += stretch[: len(stretch) - rnd.randrange(len(root))]
        words += [rnd.choice("abcd") for _ in range(rnd.randrange(4))]
    return words


def test_runs_equal_brute_force():
    rnd = random.Random(21)
    texts = [with_repeats(rnd) for _ in range(600)] + [[rnd.choice("ab") for _ in range(rnd.randrange(60))] for _ in range(600)]
    texts += [["a"] * n for n in range(12)] + [["a", "b"] * n for n in range(6)] + [list("abc" * 200), []]
    got = list(periods.measured([" ".join(words).encode() for words in texts]))
    for words, (n, runs, left) in zip(texts, got, strict=True):
        want = brute_runs(words)
        assert (n, runs, left.decode()) == (len(words), want, brute_collapsed(words, want))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [word if i < a else words[a + (i - a) % p] for i, word in enumerate(words)]


def test_periodic_runs(spark):
    rnd = random.Random(22)
    texts = [" ".join(rnd.choice(["la", "le", "été", "né e"]) for _ in range(rnd.randrange(0, 90))) for _ in range(150)]
    texts += [None, "", " \n\t", "da\n da\u000bda da\tda  da", "go " * 100_000]
    rows = [(k, text, 5, "x") for k, text in enumerate(texts)] + [(3, texts[3], 5, "x"), (None, "a " * 8, 5, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int, w string").repartition(3)
    got = defaultdict(list)
    for r in periods.digests(periods.periodic_runs(periods.with_planted_runs(df))).collect():
        got[r.doc_id].append(tuple(r)[1:])
    assert sum(map(len, got.values())) == len(rows) and len(got[3]) == 2
    for k, text, *_ in rows:
        words = found_words(text)
        words = planted(k, words) if k is not None else words
        runs = brute_runs(words) if len(words) < 1000 else [(0, len(words), 1)]
        if len(words) >= 1000:
            assert len(set(words)) == 1
        best = min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=(None, None, None))
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        listed = digest("".join(f"{a},{b},{c}\n" for a, b, c in runs))
        want = (len(runs), *best, milli, listed, digest(brute_collapsed(words, runs)))
        assert set(got[k]) == {want}
    assert periods.periodic_runs(df.limit(0)).count() == 0
    plain = periods.periodic_runs(df.where("doc_id = 153")).first()
    assert [tuple(run) for run in plain.runs] == [(0, 6, 1)] and plain.collapsed == "da"


def brute_infill(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    one, two = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(part) for part in (tokens[:one], tokens[one:two], tokens[two:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("window,portion", [(1 << 20, 8 << 20), (7, 40), (64, 1)])
def test_cuts_in_any_window(monkeypatch, window, portion):
    monkeypatch.setattr(infill, "WINDOW", window)
    monkeypatch.setattr(infill, "PORTION_BYTES", portion)
    rnd = random.Random(23)
    pieces = ["word", "Élan", "naïve", " ", "\n", "<", "P>", "<P", ">", "🙂", "x", "1", "<M>", "漢字"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(0, 30))) for _ in range(400)] + ["", "a", "é", "<S>"]
    data = [text.encode() for text in texts]
    h = np.array([[int(hashlib.sha256(f"1:{k}".encode()).hexdigest()[8 * j : 8 * j + 8], 16) for j in range(4)] for k in range(len(texts))])
    for rows in infill.portions(data):
        n, form, prefix, middle, output = infill.transform(data[rows], h[rows])
        for at, k in enumerate(range(rows.start, rows.stop)):
            want = brute_infill(k, texts[k])
            assert (n[at], form[at], output[at].decode()) == (want[0], want[1], want[4])
            assert (prefix[at], middle[at]) == (want[2] or 0, want[3] or 0)
        assert infill.restore(output, form) == data[rows]
    assert sum(rows.stop - rows.start for rows in infill.portions(data)) == len(data)


def test_fill_in_middle(spark):
    rnd = random.Random(24)
    texts = [" ".join(rnd.choice(["one", "zwölf", "3.5", "né", "<b>", "🙂"]) for _ in range(rnd.randrange(0, 40))) for _ in range(200)]
    texts += [None, "", "<P>", "a<S", "\n", "word é " * 60_000]
    rows = [(k, text, "x", 1) for k, text in enumerate(texts)] + [(0, texts[0], "x", 1), (None, "some words here", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, h1 int").repartition(3)
    got = infill.restored(infill.transformed(df)).collect()
    assert len(got) == len(rows)
    want = {(k, *brute_infill(k, text), text or "") for k, text, *_ in rows}
    assert {(r.doc_id, r.n_tokens, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got} == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    short = infill.digests(df.where("doc_id < 200")).collect()
    assert all(r.restored_sha256 == digest(texts[r.doc_id]) and r.output_sha256 == digest(brute_infill(r.doc_id, texts[r.doc_id])[4]) for r in short)
    assert infill.digests(df.limit(0)).count() == 0


def brute_lines(rows, least=10):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))

    first = {}
    for k, text in rows:
        for line in (text or "").split("\n"):
            rank = (k is None, k or 0)
            first[key(line)] = min(first.get(key(line), rank), rank)
    out = []
    for k, text in rows:
        split = (text or "").split("\n")
        left = [line for line in split if len(key(line)) < least or first[key(line)] == (k is None, k or 0)]
        out.append((k, len(split), len(split) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def line_rows():
    rnd = random.Random(25)
    pool = [f"{rnd.choice(['Shared', 'ÉTÉ', 'été', 'short'])} line number {k}" for k in range(25)] + ["tiny", "", "   ", "123456789", "1234567890", "éééééééééé"]
    rows = []
    for k in rnd.sample(range(-300, 900), 240):
        text = "\n".join(
            rnd.choice(["", " ", "\t", " "]) + (rnd.choice(pool) if rnd.random() < 0.7 else f"own line {rnd.random()}") + rnd.choice(["", "  ", "\r"])
            for _ in range(rnd.randrange(0, 9))
        )
        rows.append((k, text.upper() if rnd.random() < 0.2 else text))
    rows += [(901, None), (902, ""), (903, "\n\n"), (904, "the very hot line"), (None, "the very hot line\nonly here at all"), (None, "only here at all")]
    rows += [(k, "the very hot line") for k in range(2000, 2100)] + [rows[0], (rows[0][0], "another version of it\nShared line number 3")]
    return [*rows, (905, "\n".join(["long text line"] * 30_000 + ["Shared line number 1"]))]


@pytest.mark.parametrize("batches,fan", [(4, 2), (1, 2), (7, 2), (5, 3)])
def test_lines_of_earlier_documents_go(spark, batches, fan):
    rows = line_rows()
    df = spark.createDataFrame([(k, text, 1, "h") for k, text in rows], "doc_id long, text string, doc int, h1 string").repartition(4)
    got = [tuple(r) for r in lines.deduplicated(df, batches=batches, fan=fan).select("doc_id", "n_lines", "n_dropped", "kept").collect()]
    assert sorted(got, key=repr) == brute_lines(rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_lines_of_odd_tables(spark):
    df = spark.createDataFrame([(None, "a line of some length"), (None, None)], "doc_id long, text string")
    assert sorted((r.n_lines, r.n_dropped) for r in lines.deduplicated(df).collect()) == [(1, 0), (1, 0)]
    assert lines.deduplicated(df.limit(0)).count() == 0
    assert lines.digests(df.limit(0)).columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


def test_a_hot_line_is_one_row_per_task_and_runs_are_compacted(spark):
    runs = lines.Runs(spark, fan=2)
    try:
        for batch in range(5):
            docs = spark.range(batch * 1000, batch * 1000 + 1000).select(
                F.col("id").alias("doc_id"), F.concat(F.lit("one hot line of all\nown line "), F.col("id").cast("string")).alias("text")
            )
            gone = runs.add(lines.hashed_lines(docs))
            assert gone.count() == 1000 - (batch == 0)
        assert [len(level) for level in runs.levels] == [1, 0, 1]
        assert sum(spark.table(name).count() for level in runs.levels for name in level) == 5001
        plan = gone._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEval" not in plan and "MapInArrow" not in plan
    finally:
        runs.close()
