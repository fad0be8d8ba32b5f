"""Repetition rules, decontamination, toxicity and pseudonyms."""

import datetime
import random
import re
import zlib

import numpy as np
import pytest

from verdin.llm import decontamination, pseudonyms, repetition, toxicity


def words(rnd, n, kinds):
    return [f"w{rnd.randrange(kinds)}" for _ in range(n)]


def brute_repeats(ids, least):
    n, longest = len(ids), [0] * len(ids)
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and ids[i + k] == ids[j + k]:
                k += 1
            longest[i] = max(longest[i], k)
    covered = {p for i in range(n) if longest[i] >= least for p in range(i, i + longest[i])}
    return len(covered), max(longest, default=0)


def test_repeats_equal_brute_force():
    rnd = random.Random(1)
    for _ in range(150):
        ids = np.array([rnd.randrange(3) for _ in range(rnd.randrange(0, 40))], dtype=np.int64)
        assert repetition.repeats(ids, 3)[1:] == brute_repeats(ids.tolist(), 3)


def brute_rules(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(found[k : k + 3]) for k in range(len(found) - 2)]
    marked = {k + s for k, w in enumerate(windows) if windows.count(w) > 1 for s in range(3)}
    seen, copies = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    n = len(found)
    failed = n < 50 or 100 * len(marked) > 50 * n
    return n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), copies, len(marked), failed


def test_quality_rules(spark):
    rnd = random.Random(4)
    texts = [" ".join(words(rnd, n, kinds)) for n, kinds in ((10, 5), (60, 500), (80, 4), (200, 60), (49, 900), (50, 900))]
    line = " ".join(words(rnd, 30, 900))
    texts += [None, "", " \n\t", "\n".join([line] * 3), "\n".join([line, line + " ", "x # $ <a>", "", " "]), "été  naïve " * 40]
    texts.append(" ".join(words(rnd, 130, 10**6) * 2 + words(rnd, 400, 10**6)))
    texts.append(" ".join(words(rnd, 20_000, 10**7)))
    rows = [(k, t, 1, True) for k, t in enumerate(texts)] + [(0, texts[0], 1, True), (None, texts[1], 1, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept boolean")
    got = repetition.judged(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for k, t in enumerate(texts[:-1]):
        r = by[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(t)
        ids = {w: i for i, w in enumerate(dict.fromkeys((t or "").split(" ")))}
        if t and "\n" not in t and len(t) < 4000:
            assert (r.covered_words, r.longest_repeat) == brute_repeats([ids[w] for w in t.split()], 8)
    assert by[len(texts) - 1].kept and not by[len(texts) - 2].kept  # 130 words twice: the longest repeat is above 120
    assert sorted(r.doc_id for r in repetition.kept(df).collect() if r.doc_id is not None) == [k for k in range(len(texts)) if by[k].kept]
    assert repetition.kept(df).columns == df.columns
    assert repetition.judged(df.limit(0)).count() == 0 and repetition.kept(df.limit(0)).count() == 0


def test_covered_share_alone_rejects(spark):
    rnd = random.Random(14)
    passage, other = words(rnd, 100, 10**7), words(rnd, 20, 10**7)
    texts = [passage * 2 + words(rnd, 300, 10**7), other * 2 + words(rnd, 400, 10**7)]
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    by = {r.doc_id: r for r in repetition.judged(df).collect()}
    assert not by[0].base_failed and by[0].longest_repeat <= repetition.MAX_LONGEST and not by[0].kept
    assert by[1].kept
    assert [r.doc_id for r in repetition.kept(df).collect()] == [1]


def distance_inside(item, text):
    before = [0] * (len(text) + 1)
    for i, char in enumerate(item):
        now = [i + 1]
        for j, other in enumerate(text):
            now.append(min(before[j] + (other != char), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def edited(rnd, text, number):
    chars = list(text)
    for _ in range(number):
        place = rnd.randrange(len(chars))
        kind = rnd.randrange(3)
        if kind == 0:
            chars[place] = rnd.choice("abcdefgh")
        elif kind == 1:
            del chars[place]
        else:
            chars.insert(place, rnd.choice("abcdefgh"))
    return "".join(chars)


def test_benchmark_items_are_found_within_the_edit_budget(spark):
    rnd = random.Random(6)

    def prose(n):
        return "".join(rnd.choice("abcdefgh klmnoprst") for _ in range(n))

    items = [(k, prose(rnd.randrange(45, 140))) for k in range(12)]
    docs = []
    for k in range(80):
        item = items[k % 12][1]
        docs.append((k, prose(rnd.randrange(0, 80)) + " " + edited(rnd, item, rnd.randrange(0, 18)) + " " + prose(rnd.randrange(0, 80)), 0))
    docs += [(200, None, 0), (201, "", 0), (202, "short", 0), (3, docs[3][1], 0), (None, items[0][1].upper().replace(" ", "\n "), 0)]
    docs.append((203, prose(60_000) + items[5][1] + prose(1000), 0))
    df = spark.createDataFrame(docs, "doc_id long, text string, item_ids int")
    extra = [(90, None), (None, prose(60)), (91, ""), (92, "too short")]
    benchmark = spark.createDataFrame(items + extra + items[:2], "item_id long, text string")
    got = {r.doc_id: set(r.item_ids) for r in decontamination.report(df, benchmark).collect()}
    for i, text, _ in docs:
        text = decontamination.normal(text)
        want = set()
        for name, item in items:
            item = decontamination.normal(item)
            if len(text) < 1000 and distance_inside(item, text) <= decontamination.budget(len(item))[0]:
                want.add(name)
        assert got[i] == (want if i != 203 else {5})
    small = {r.doc_id: set(r.item_ids) for r in decontamination.report(df, benchmark, block_chars=200).collect()}
    assert small == got
    clean = decontamination.clean(df, benchmark)
    assert clean.columns == df.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, found in got.items() if not found)
    assert decontamination.report(df, benchmark.limit(0)).where("contaminated").count() == 0
    assert decontamination.report(df.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("hits", [4_000_000, 50])
def test_short_items(spark, monkeypatch, hits):
    monkeypatch.setattr(decontamination, "SLICE_HITS", hits)
    rnd = random.Random(7)
    long = "a benchmark item of thirty-nine letters"
    assert len(long) == 39 and decontamination.budget(39)[0] == 3 and decontamination.budget(10)[0] == 0
    texts = ["say abc now", "xabc abcd", "(ABC)", "abc", "ten letter", "often letters", "so ten\n letter!", "ten lettar", long.upper(), "z" * 90 + long.replace("item", "idem") + "q", long[:20], None, ""]
    texts += ["".join(rnd.choice("abc ") for _ in range(300)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "abc"), (2, "ten letter"), (3, long), (4, "ABC "), (5, "")], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontamination.report(df, benchmark).collect()}
    for k, text in enumerate(texts):
        text = decontamination.normal(text)
        want = []
        if re.search(r"(?<![a-z0-9])abc(?![a-z0-9])", text):
            want += [1, 4]
        if "ten letter" in text:
            want.append(2)
        if text and distance_inside(long, text) <= 3:
            want.append(3)
        assert got[k] == sorted(want)
    left = {r.doc_id for r in decontamination.clean(df, benchmark).collect()}
    assert left == {k for k, found in got.items() if not found}
    only = {r.doc_id: r.item_ids for r in decontamination.report(df, benchmark.where("item_id = 1")).collect()}
    assert only[0] == [1] and only[1] == []


def toxic_tables(spark):
    rnd = random.Random(8)
    docs, labels = [], []
    for k in range(600):
        said = [rnd.choice("bcdfgklmnprst") + rnd.choice("aeiou") + rnd.choice("bdfgkmnprt") + rnd.choice("aeiou") for _ in range(rnd.randrange(20, 60))]
        bad = k % 5 == 0
        if bad:
            for term in rnd.sample(["grubby", "nasty", "vile", "rotten"], 2):
                said[rnd.randrange(len(said))] = term
        docs.append((k, " ".join(said), 7))
        labels.append((k, int(bad)))
    docs += [(900, None, 7), (901, "", 7), (902, "vile " * 30_000, 7), (None, "nothing", 7), (1, docs[1][1], 7)]
    labels += [(None, 1), (3, None), (4, 5), (0, 1), (5000, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, score int"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_tables(spark)
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) >= 0.97 * len(held)
    by = {r.doc_id: r for r in got}
    assert by[902].predicted == 1 and by[900].score == by[901].score < 0.2
    used = {n for r in got for n in r.nearest}
    assert used and not any(zlib.crc32(str(n).encode()) % 3 == 1 for n in used)
    nothing = toxicity.scored(docs, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5}
    assert toxicity.scored(docs.limit(0), labels).count() == 0


def test_nearest_examples_are_exact(spark):
    docs, labels = toxic_tables(spark)
    model = toxicity.fit(docs, labels)
    dense = np.zeros((len(model.names), len(model.terms)))
    for k, vector in enumerate(model.vectors):
        for term, value in vector:
            dense[k, term] = value
    rnd = random.Random(9)
    for _ in range(100):
        terms = rnd.sample(range(len(model.terms)), rnd.randrange(1, len(model.terms)))
        query = tuple(sorted((t, rnd.randrange(1, 4)) for t in terms))
        term, value = model.weighted(query)
        near = [(round(float(s), 9), k) for k, s in enumerate(dense[:, term] @ value) if s > 0]
        want = sorted(near, key=lambda one: (-one[0], one[1]))[: model.neighbours]
        assert np.allclose([s for s, _ in model.nearest(query)], [s for s, _ in want])


def luhn(digits):
    total = 0
    for k, char in enumerate(reversed(digits)):
        value = int(char) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def test_pseudonyms_keep_formats_and_links(spark):
    rnd = random.Random(10)
    cards = [d for d in (str(rnd.randrange(10**15, 10**16)) for _ in range(400)) if luhn(d)]
    false = "4795522935961214"
    start = datetime.date(1800, 1, 1)
    dates = [str(start + datetime.timedelta(days=rnd.randrange(146_097))) for _ in range(40)]
    hosts = [".".join(str(rnd.randrange(256)) for _ in range(4)) for _ in range(40)]
    phones = [f"+1 ({rnd.randrange(1000):03}) 555-{rnd.randrange(10000):04}" for _ in range(40)]
    values = cards + dates + hosts + phones
    rows = [(k, f"see {v}, then {v}$$$", 1) for k, v in enumerate(values)]
    rows += [(1000, None, 1), (1001, "", 1), (1002, f"{false} 300.1.2.3 2023-02-29 1.2.3", 1), (1003, "a.b@mail.example.com", 1), (None, "x", 1)]
    rows += [(1004, "quiet words " * 30_000 + cards[0], 1), (0, rows[0][1], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_card int")
    got = {r.doc_id: r for r in pseudonyms.pseudonymised(df, "secret").collect()}
    new = {}
    for k, v in enumerate(values):
        a, b = re.fullmatch(r"see (.*), then (.*)\$\$\$", got[k].text).groups()
        assert a == b != v and re.sub(r"\d", "9", a).count("9") >= 4
        new[v] = a
    assert len(set(new.values())) == len(set(values))
    assert all(luhn(new[c]) and len(new[c]) == 16 for c in cards)
    assert all(start <= datetime.date.fromisoformat(new[d]) < start + datetime.timedelta(days=146_097) for d in dates)
    assert all(max(map(int, new[h].split("."))) <= 255 for h in hosts)
    assert all(re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new[p]) for p in phones)
    assert got[1000].text is None and got[1001].text == ""
    assert got[1002].text == f"{false} 300.1.2.3 2023-02-29 1.2.3" and got[1002].n_card == 0
    assert re.fullmatch(r"u[0-9a-f]{16}@mail\.example\.com", got[1003].text)
    assert got[1004].text.endswith(new[cards[0]]) and got[1004].n_card == 1
    other = {r.doc_id: r.text for r in pseudonyms.pseudonymised(df, "other").collect()}
    assert other[0] != got[0].text
    assert pseudonyms.pseudonymised(df.limit(0)).count() == 0


def test_values_without_another_trigger_are_replaced(spark):
    values = ["378 282 246 310 005", "4 222 222 222 222", "10.20.30.40", "2020-02-29", "a@b.example", "+1 (555) 123-4567", "0a" * 16]
    texts = [f"see {v} there" for v in values] + [f"see {v} there, in 2024" for v in values]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pseudonyms.pseudonymised(df, "secret").collect()}
    for k, value in enumerate(values):
        assert value not in got[k]
        assert got[k + len(values)] == f"{got[k]}, in 2024"


@pytest.mark.parametrize("left,right", [(3, 5), (10, 1), (189, 773)])
def test_feistel_is_a_permutation(spark, left, right):
    from pyspark.sql import functions as F

    ids = spark.range(left * right)
    made = pseudonyms.permuted(F.floor(F.col("id") / right), F.col("id") % right, F.lit(left).cast("long"), F.lit(right).cast("long"), "k", F.lit("t"))
    sample = ids.where("id < 2000").select(made.alias("x")).select("x.*").collect()
    assert len({tuple(r) for r in sample}) == min(2000, left * right)
    assert all(0 <= r.a < left and 0 <= r.b < right for r in sample)
