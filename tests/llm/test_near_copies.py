"""SimHash groups and passage removal against brute force."""

import hashlib
import itertools
import random
import time

import numpy as np
import pytest
import xxhash

from verdin.llm import simhash, suffixes
from verdin.llm.components import components

SCHEMA = "doc_id long, text string, fingerprint string, block int"


def table(spark, rows):
    """Rows with extra columns whose names clash with those the operators use."""
    return spark.createDataFrame([(i, t, "x", 5) for i, t in rows], SCHEMA)


def sentence(rnd, n):
    return " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "Epsilon", "zeta,", "été", "theta."]) + str(rnd.randrange(9)) for _ in range(n))


def corpus():
    rnd = random.Random(3)
    base = [sentence(rnd, rnd.randrange(1, 90)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(base)]
    for k, text in enumerate(base[:12]):
        words = text.split()
        words[rnd.randrange(len(words))] = "changed"
        rows.append((100 + k, " ".join(words)))
        rows.append((200 + k, text.upper()))
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "one"), (304, "ONE"), (305, "two words"), (0, base[0]), (None, base[1]), (None, "only here")]
    rows.append((306, sentence(rnd, 20_000)))
    return rows


def fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    bits = [sum(xxhash.xxh64_intdigest(p, 42) >> i & 1 for p in parts) for i in range(64)]
    return sum(1 << i for i, n in enumerate(bits) if 2 * n > len(parts))


def closed(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_golay_keys_meet_within_two_bits():
    rnd = np.random.default_rng(1)
    words = rnd.integers(0, 1 << 23, 400)
    for bits in (0, 1, 2):
        other = words.copy()
        for k in range(len(other)):
            for place in rnd.choice(23, bits, replace=False):
                other[k] ^= 1 << int(place)
        mine, theirs = ({}, {})
        for keys, values in ((mine, words), (theirs, other)):
            for row, key in zip(*simhash.golay_keys(values), strict=True):
                keys.setdefault(int(row), set()).add(int(key))
        assert all(mine[k] & theirs[k] for k in range(len(words)))
        assert {len(one) for one in mine.values()} <= {1, 6}


def test_fingerprints_within_two_bits_share_a_join_key():
    rnd = random.Random(2)
    values = [rnd.getrandbits(64) for _ in range(200)]
    near = [v ^ sum({1 << rnd.randrange(64), 1 << rnd.randrange(64)}) for v in values]
    rows, keys = simhash.join_keys(np.array(values + near, dtype=np.uint64))
    found = {}
    for row, key in zip(rows.tolist(), keys.tolist(), strict=True):
        found.setdefault(row, set()).add(key)
    assert all(found[k] & found[k + 200] for k in range(200))


def test_bits_of_signed_fingerprints():
    rnd = np.random.default_rng(4)
    left, right = (rnd.integers(-(1 << 63), 1 << 63, 500, dtype=np.int64) for _ in range(2))
    want = [((int(a) ^ int(b)) & (1 << 64) - 1).bit_count() for a, b in zip(left, right, strict=True)]
    assert simhash._apart(left, right).tolist() == want


def test_simhash_groups_equal_all_pairs(spark):
    rows = corpus()
    got = simhash.near_duplicates(table(spark, rows)).collect()
    assert len(got) == len(rows)
    marks = {fingerprint(t) for _, t in rows}
    roots = closed(sorted(marks), lambda a, b: (a ^ b).bit_count() <= 2)
    heads = {}
    for i, t in rows:
        if i is not None:
            root = roots[fingerprint(t)]
            heads[root] = min(heads.get(root, i), i)
    want = sorted(((i, f"{fingerprint(t):016x}", heads.get(roots[fingerprint(t)])) for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_crowded_buckets_give_the_same_components(spark):
    rnd = random.Random(5)
    centre = rnd.getrandbits(64)
    values = {centre ^ (1 << a) ^ (1 << b) ^ (1 << c) for a, b, c in ((rnd.randrange(64), rnd.randrange(64), rnd.randrange(64)) for _ in range(120))}
    values |= {rnd.getrandbits(64) for _ in range(50)}
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fingerprint long")
    found = {r.node: r.root for r in components(simhash.links(df, most=4)).collect()}
    roots = closed(sorted(values), lambda a, b: (a ^ b).bit_count() <= 2)
    mine, theirs = {}, {}
    for value, number in signed.items():
        mine.setdefault(found.get(number, number), set()).add(value)
        theirs.setdefault(roots[value], set()).add(value)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_a_path_and_of_nothing(spark):
    path = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(7, 7), (None, 3), (90, 80), (80, 90)], "a long, b long")
    assert {(r.node, r.root) for r in components(path).collect()} == {(k, 0) for k in range(41)} | {(80, 80), (90, 80)}
    assert components(path.limit(0)).count() == 0


def test_one_of_each_group_of_near_copies_stays(spark):
    rows = [(i, t) for i, t in corpus() if i is None or i < 400]
    df = table(spark, rows)
    kept = simhash.without_near_copies(df)
    assert kept.columns == df.columns

    def parts(text):
        words = (text or "").encode().lower().split()
        return frozenset(b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4)))

    nodes = {parts(t) for _, t in rows}
    roots = closed(sorted(nodes, key=sorted), lambda a, b: len(a & b) >= 0.8 * len(a | b))
    groups = {}
    for i, t in rows:
        groups.setdefault(roots[parts(t)], []).append((i is None, i, t))
    want = sorted([min(v, key=lambda x: (x[0], x[1] or 0))[1:] for v in groups.values()], key=repr)
    got = sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr)
    assert [g[0] for g in got] == [w[0] for w in want]


def shingles(text):
    found = text.lower().split()
    return frozenset(" ".join(found[k : k + 5]) for k in range(max(1, len(found) - 4)))


def assert_groups_equal_all_pairs(spark, rows):
    """Texts must differ and have ids of their own; returns the number of groups."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: shingles(t) for i, t in rows}
    roots = closed(sorted(sets), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    want = {}
    for i, root in roots.items():
        want.setdefault(root, set()).add(i)
    got = {}
    for r in simhash.similar_groups(df).collect():
        got.setdefault(r.root, set()).add(r.doc_id)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    return len(want)


def test_crowded_buckets_equal_all_pairs(spark):
    rnd = random.Random(11)
    common = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(250):  # near copies of one text
        words = list(common)
        words[rnd.randrange(60)] = f"x{k}"
        rows.append((k, " ".join(words)))
    for k in range(60):  # groups of two with the same words in another order: fingerprints of words are equal
        words = rnd.sample(common, 60)
        rows.append((1000 + k, " ".join(words)))
        rows.append((2000 + k, " ".join([*words[:-1], f"y{k}"])))
    for k in range(120):  # one passage with differing surroundings, mostly below the similarity
        rows.append((3000 + k, " ".join(common[:40] + [f"z{k}_{j}" for j in range(rnd.randrange(3, 12))])))
    rnd.shuffle(rows)
    assert 60 < assert_groups_equal_all_pairs(spark, rows) < 300


def test_appended_and_truncated_copies_equal_all_pairs(spark):
    rnd = random.Random(12)
    rows = []
    for k in range(150):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.randrange(80, 160))]
        n = len(words)
        more = [f"w{rnd.randrange(3000)}" for _ in range(n)]
        rows.append((10 * k, " ".join(words)))
        rows.append((10 * k + 1, " ".join(words + more[: rnd.randrange(n // 5, n // 4)])))  # 0.80 to 0.84
        rows.append((10 * k + 2, " ".join(words[: n - rnd.randrange(n // 7, n // 5)])))  # 0.79 to 0.86
        rows.append((10 * k + 3, " ".join(more[: n // 4] + words)))  # just below or at 0.8
    rnd.shuffle(rows)
    assert 150 <= assert_groups_equal_all_pairs(spark, rows) < 450


def brute_removed(rows, length):
    first = {}
    for i, t in rows:
        data, name = (t or "").encode(), float("inf") if i is None else i
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            first[s] = min(first.get(s, name), name)
    out = []
    for i, t in rows:
        data, name = (t or "").encode(), float("inf") if i is None else i
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < name:
                gone[p : p + length] = [True] * length
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [50, 33, 64])
def test_passages_of_earlier_documents_go(spark, length):
    rnd = random.Random(length)
    passage = sentence(rnd, 30)
    rows = corpus()[:-1]
    rows += [(400 + k, sentence(rnd, 5) + " " + passage + " " + sentence(rnd, 5)) for k in range(8)]
    rows += [(500, "ab" * 300), (501, "ab" * 100 + "c"), (502, "a" * 400), (503, "a" * 90), (504, passage + passage), (505, "x" * (length - 1))]
    rows += [(506, rows[-3][1]), (506, rows[-3][1])]
    got = sorted((tuple(r) for r in suffixes.deduplicated(table(spark, rows), length).collect()), key=repr)
    assert got == brute_removed(rows, length)


def test_empty_tables(spark):
    none = table(spark, []).limit(0)
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.without_near_copies(none).count() == 0
    assert suffixes.deduplicated(none).count() == 0


def test_simhash_links_come_first_and_are_checked(spark, monkeypatch):
    rnd = random.Random(15)
    rows = []
    for k in range(20):
        words = [f"w{rnd.randrange(3000)}" for _ in range(300)]
        rows.append((10 * k, " ".join(words)))
        rows.append((10 * k + 1, " ".join([*words[:-1], "other"])))
    twice = " ".join(f"v{k}" for k in range(300))
    block = " ".join(f"u{k} u{k} u{k}" for k in range(4))
    rows += [(900, twice), (901, f"{twice} {twice}"), (902, block), (903, f"{block} {block} {block}")]  # equal or near fingerprints, unlike sets
    sets = {i: shingles(t) for i, t in rows}
    seen = []
    kept = simhash.verified
    monkeypatch.setattr(simhash, "verified", lambda pairs, *rest: seen.append((pairs.count(), (found := kept(pairs, *rest)).count())) or found)
    monkeypatch.setattr(simhash, "with_pivots", lambda rows, *rest: rows.sparkSession.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(simhash, "close_pairs", lambda rows, *rest: rows.sparkSession.createDataFrame([], "a long, b long"))
    groups = {}
    for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        groups.setdefault(r.root, []).append(r.doc_id)
    linked = [one for one in groups.values() if len(one) > 1]
    assert len(linked) >= 10 and seen[0][0] >= seen[0][1] == sum(len(one) - 1 for one in linked)
    assert all(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a, b in linked)


def test_many_texts_around_one_passage_make_few_pairs(spark, monkeypatch):
    """Similarities of 0.6 to 0.79 among 2,000 texts, some pairs above: only links and what a bound cannot rule out become rows."""
    rnd = random.Random(13)
    passage = [f"p{k}" for k in range(50)]
    rows = []
    for k in range(2000):
        rows.append((k, " ".join(passage + [f"o{k}_{j}" for j in range(rnd.randrange(7, 14))])))
    for k in range(0, 200, 10):  # links between texts of the passage
        rows.append((5000 + k, rows[k][1] + " tail"))
    rnd.shuffle(rows)
    made = []
    kept = simhash.close_pairs
    monkeypatch.setattr(simhash, "close_pairs", lambda *args, **options: made.append(kept(*args, **options).count()) or kept(*args, **options))
    number = assert_groups_equal_all_pairs(spark, rows)
    assert 1900 < number < 2020 and made[0] < 2000


def test_portions_of_a_large_bucket_meet(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 7)
    rnd = random.Random(14)
    earlier = [np.array([0] * 7 + [rnd.randrange(40)], dtype=np.uint64) for _ in range(180)]  # 0: no key before
    rows = [(k % 3, k, 20, 0, rnd.randrange(12), 60, earlier[k].tobytes()) for k in range(180)]
    df = spark.createDataFrame(rows, "key long, digest long, n long, place long, root long, members long, before binary")
    base = [1] * 17 + [0] * (simhash.CELLS - 17)
    sets = {}
    for k in range(180):
        sets[k] = np.array(base, dtype=np.uint8)
        for cell in rnd.sample(range(17, 30), 3):
            sets[k][cell] += 1
    sets[5][0] = sets[8][0] = 255  # full cells bound nothing
    sketches = spark.createDataFrame([(k, one.tobytes()) for k, one in sets.items()], "digest long, cells binary")
    want = set()
    for a, b in itertools.combinations(range(180), 2):
        common = np.minimum(sets[a], sets[b]).astype(int).sum()
        met = earlier[a][7] == earlier[b][7] != 0
        if rows[a][0] == rows[b][0] and rows[a][4] != rows[b][4] and common >= 18 and not met:
            want.add((a, b))
    for portion in (2048, 25):
        assert {tuple(r) for r in simhash.close_pairs(df, sketches, 0.8, portion).collect()} == want
    assert len(want) > 100


def test_a_stored_table_leaves_no_shuffle_files(spark):
    from pathlib import Path

    from verdin.session import stored

    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {path.name for folder in folders for path in Path(folder).rglob("shuffle_*")}

    before = shuffled()
    kept = stored(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
    assert sorted(map(tuple, kept.collect())) == [(k, 143 if k < 6 else 142) for k in range(7)]
    deadline = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < deadline:  # removed in the background
        time.sleep(0.2)
    assert not shuffled() - before
