"""Mixing, URL filters, language, token files, and the pipeline as a whole."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from verdin.llm import decontamination, languages, mixing, pseudonyms, simhash, tokens, urls
from verdin.llm.queries import QUERIES, TWINS

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"


def best_sum(lengths, counts, budget):
    reach = {0}
    for size, count in zip(lengths, counts, strict=True):
        reach = {s + k * size for s in reach for k in range(count + 1) if s + k * size <= budget}
    return max(reach)


def test_fill_reaches_the_best_sum():
    rnd = random.Random(1)
    for _ in range(200):
        lengths = rnd.sample(range(1, 40), rnd.randrange(1, 6))
        counts = [rnd.randrange(1, 5) for _ in lengths]
        budget = rnd.randrange(0, 150)
        taken = mixing.fill(lengths, counts, budget)
        total = sum(size * n for size, n in taken.items())
        assert total <= max(0, budget) and all(n <= counts[lengths.index(size)] for size, n in taken.items())
        if max(lengths) * 8 > budget:
            assert budget - total <= budget - best_sum(lengths, counts, budget) + max(lengths)
    assert sum(s * n for s, n in mixing.fill(list(range(1, 400)), [50] * 399, 1_234_567).items()) == 1_234_567


def mix_rows():
    rnd = random.Random(2)
    rows = []
    for k in range(600):
        source = rnd.choice(["a", "a", "a", "b", "c", "Z", "é", None])
        rows.append((k, " ".join("w" for _ in range(rnd.randrange(0, 60))), source, 9))
    rows += [(700, None, "a", 9), (701, "", "empty", 9), (702, "v " * 20_000, "b", 9), (5, rows[5][1], rows[5][2], 9), (None, "x y", "a", 9)]
    return rows


def test_mixing_meets_its_targets(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mixed(df).collect()
    assert len(got) == len(rows)
    size = defaultdict(int)
    for _, text, source, _ in rows:
        size[source] += len((text or "").split())
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, target = sum(size.values()), set(order), {}
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * size[s]}
        if not full:
            break
        for s in full:
            target[s] = 3.0 * size[s]
            left -= target[s]
        open_ -= full
    target |= {s: weight[s] * level for s in open_}
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    longest = {s: max(len((t or "").split()) for _, t, o, _ in rows if o == s) for s in order}
    assert all(abs(taken[s] - target[s]) <= 1 or s == "b" and abs(taken[s] - target[s]) <= longest[s] for s in order)
    assert sorted(map(tuple, mixing.mixed(df.repartition(5)).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    rows_out = mixing.mixture(df)
    assert rows_out.columns == df.columns
    number = Counter((r.doc_id, r.source) for r in rows_out.collect())
    assert number == Counter({(r.doc_id, r.source): 0 for r in got}) + Counter(k for r in got for k in [(r.doc_id, r.source)] * r.copies)
    assert mixing.mixed(df.limit(0)).count() == 0 and mixing.mixture(df.limit(0)).count() == 0


def test_url_rules(spark):
    html = '<a href="https://spam.net/x">a</a><a href=\'//good.example.org/\'>b</a><a href="/own">c</a>'
    cases = [
        (1, "http://a.example.org/es/1", html, "example.org/es/", "block"), (2, "https://Example.ORG/en/17?x", "", "example.org/en/1", "block"),
        (3, "https://www.example.org/en/2", None, "org/", "allow"), (4, "http://x.com/fr/", "", "com/fr/", "allow"), (5, "http://x.com/de/a#b", "", "com/de/", "block"),
        (6, "http://notexample.org", "", None, "allow"), (7, None, html, None, "allow"), (8, "no address", "", None, "allow"), (9, "", None, None, "allow"),
        (10, "ftp://spam.net", '<a href="http://x.com/de/">', None, "block"), (11, "http://x.net/a", '<a href="http://spam.net/">', None, "block"),
        (12, "http://quiet.net/a/b?c", "", None, "allow"), (12, "http://quiet.net/a/b?c", "", None, "allow"), (None, "http://x.net/c", "", None, "block"),
        (13, "http://evilorg/", "", None, "allow"), (14, "http://org/", "", "org/", "allow"), (15, "x://y.org:80/z", "", None, "allow"),
    ]
    df = spark.createDataFrame([(i, u, h, "r", 1.0) for i, u, h, _, _ in cases], "page_id long, url string, html string, rule string, trust double")
    got = urls.judged(df).collect()
    assert sorted(((r.page_id, r.rule, r.verdict) for r in got), key=repr) == sorted(((i, r, v) for i, _, _, r, v in cases), key=repr)
    by = {r.page_id: (r.host, r.path) for r in got}
    assert by[2] == ("example.org", "/en/17") and by[6] == ("notexample.org", "") and by[7] == ("", "") and by[15] == ("y.org:80", "/z")
    assert urls.judged(df.limit(0)).count() == 0


def test_propagation_equals_the_walk(spark):
    rnd = random.Random(3)
    hosts = [f"h{k}" for k in range(12)]
    edges = {(a, b): rnd.random() for a in hosts for b in rnd.sample(hosts, 2) if a != b}
    total = Counter()
    for (a, _), w in edges.items():
        total[a] += w
    share = {(a, b): w / total[a] for (a, b), w in edges.items()}
    seeds = {"h0": 3.0, "h1": 1.0}
    want = dict.fromkeys(hosts, 0.0)
    for _ in range(13):  # the seeds and twelve rounds
        want = {h: 0.15 * seeds.get(h, 0.0) + 0.85 * sum(want[a] * s for (a, b), s in share.items() if b == h) for h in hosts}
    got = urls.propagate(
        spark.createDataFrame(list(seeds.items()), "host string, mass double"),
        spark.createDataFrame([(a, b, s) for (a, b), s in share.items()], "source string, target string, share double"),
        rounds=12,
    )
    found = {r.host: r.score for r in got.collect()}
    assert all(abs(found.get(h, 0.0) - want[h]) < 1e-6 for h in hosts)
    assert sum(found.values()) <= 4.0 and abs(sum(found.values()) - 4.0 * (1 - 0.85**13)) < 1e-6


def test_language_of_pages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").withColumnsRenamed({}).selectExpr("*", "'x' as lang", "0 as l0")
    got = languages.identified(pages, docs, sample=60).collect()
    said = {r.page_id: re.search(r"://[^/]*/(\w\w)/", r.url) for r in pages.collect()}
    known = [r for r in got if said[r.page_id]]
    assert len(got) == pages.count() and sum(r.lang == said[r.page_id][1] for r in known) >= 0.97 * len(known)
    odd = spark.createDataFrame(
        [(1, None, None), (2, "", ""), (3, "http://a.fr/", "<html lang='fr'><p>le la les des une est dans</p>"), (3, "http://a.fr/", "<p>" * 9), (None, "http://a.fr/x", "")],
        "page_id long, url string, html string",
    )
    rows = languages.identified(odd, docs, sample=60).collect()
    assert len(rows) == 5 and all(r.lang in ("de", "en", "es", "fr") and 0 < r.confidence <= 1 for r in rows)
    assert languages.identified(odd.limit(0), docs, sample=5).count() == 0
    assert {r.lang for r in languages.identified(odd, docs.limit(0)).collect()} == {None}


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 100, 257])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    payload = tokens.pack(ids, kind, block=50)
    assert np.array_equal(tokens.unpack(payload), ids)
    assert np.array_equal(tokens.unpack(payload, 1, 3), ids[50:150])


def test_token_files(spark):
    rnd = random.Random(5)
    marks = ["the", "The.", "it's", "naïve,", "ÉTÉ!!", "a<|endoftext|>b", "don't.", "x\u00a0y", "ΣΑΣ", "e\u0301t", "12.5%", "''", "ß$$$", "\x1cq", "🙂ok.", "İx."]
    texts = [" ".join(rnd.choice(marks) for _ in range(rnd.randrange(0, 40))) for _ in range(60)] + [None, "", " \n", "word " * 150_000, "\u0301 a", "ab.\u0301"]
    ids = rnd.sample(range(-50, 1000), len(texts))
    rows = [(i, t, 3) for i, t in zip(ids, texts, strict=True)] + [(ids[0], texts[0], 3), (None, "last one", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(4)
    got = tokens.token_output(df, TOKENIZER).orderBy("start").collect()
    plain, place, want = Tokenizer.from_file(TOKENIZER), 0, []
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want.append((i, place, len(data), zlib.crc32(data.tobytes())))
        place += len(data)
    assert [tuple(r) for r in got] == want
    assert tokens.token_output(df.limit(0), TOKENIZER).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "decontamination", "mixing", "token output"]
    benchmark = {decontamination.normal(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), docs.schema)
        after = docs.collect()
        assert docs.columns == columns
        if number == 0:
            bad = {r.doc_id for r in before if brute_failed(r.text)}
            assert {r.doc_id for r in before} - {r.doc_id for r in after} == bad
        elif number == 1:
            assert {r.doc_id for r in after} == survivors(before)
        elif number == 2:
            dirty = {r.doc_id for r in before if any(item in decontamination.normal(r.text) for item in benchmark)}
            assert {r.doc_id for r in before} - {r.doc_id for r in after} == dirty
        else:
            total = sum(len(r.text.split()) for r in before)
            assert abs(sum(len(r.text.split()) for r in after) - total) <= 0.05 * total
            assert max(Counter(r.doc_id for r in after).values()) <= 3
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(r.doc_id for r in whole) == Counter(r.doc_id for r in docs.collect())


def brute_failed(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(found)

    def inside(size):
        """Words in windows of ``size`` words found twice or more."""
        windows = Counter(tuple(found[k : k + size]) for k in range(n - size + 1))
        return len({k + step for k in range(n - size + 1) if windows[tuple(found[k : k + size])] > 1 for step in range(size)})

    return n < 50 or 100 * inside(3) > 50 * n or 100 * inside(8) > 12 * n or inside(121) > 0


def survivors(rows):
    def parts(text):
        words = text.encode().lower().split()
        return frozenset(b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4)))

    sets, root = {r.doc_id: parts(r.text) for r in rows}, {r.doc_id: r.doc_id for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(sets)
    for k, a in enumerate(names):
        for b in names[:k]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {find(name) for name in names}


def test_every_operator_has_its_query():
    assert {re.match(r"op(\d+)_", name)[1] for name in QUERIES} == {str(n) for n in range(1, 14)}
    assert set(TWINS) <= set(QUERIES)


def test_helper_columns_make_way_for_clashing_names(spark):
    names = ["_doc_id", "_content", "_source", "_copies", "_copy", "_new", "_DOC_ID_"]
    rows = [(k, f"some words of text {k} and 4 more of them", "a", *[f"{name}{k}" for name in names]) for k in range(6)]
    df = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, source string, " + ", ".join(f"{name} string" for name in names))
    for operator in (simhash.without_near_copies, mixing.mixture, pseudonyms.pseudonymised):
        got = operator(df)
        assert got.columns[: len(df.columns)] == df.columns
        found = {r.doc_id: r for r in got.collect()}
        assert found and all(found[k][name] == f"{name}{k}" for k in found for name in names)
    assert simhash.without_near_copies(df).count() == 6


def brute_languages(pages, docs):
    """The posterior by hand: text likelihood, declared language, and a host prior smoothed towards suffix and world."""

    def grams(data):
        words = b" ".join(bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in data.lower()).split())
        padded = b" " + words + b" "
        return [((padded[k] << 16 | padded[k + 1] << 8 | padded[k + 2]) * 0x9E3779B1 % 2**32) >> 16 for k in range(len(padded) - 2)] if words else []

    langs = sorted({lang for _, lang in docs if lang is not None})
    counts = {lang: Counter() for lang in langs}
    for text, lang in docs:
        if lang is not None:
            counts[lang].update(grams((text or "").encode()))
    total = {lang: sum(c.values()) + 0.5 * 65536 for lang, c in counts.items()}
    rows = []
    for i, url, html in pages:
        html = html or ""
        seen = re.sub(r"(?is)<!--.*?-->|<(script|style|template)\b.*?</\1\s*>|<[^>]*>", " ", html)
        seen = re.sub(r"&#?\w{1,10};", " ", seen)
        logs = {lang: 0.3 * sum(math.log((counts[lang][g] + 0.5) / total[lang]) for g in grams(seen.encode())) for lang in langs}
        top = max(logs.values())
        whole = top + math.log(sum(math.exp(v - top) for v in logs.values()))
        host = re.match(r".*?://([^/?#]*)", url, re.S)[1].lower() if url and "://" in url else ""
        said = re.search(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", html) or re.search(r"(?is)<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?([a-z]{2,3})", html)
        suffix = re.sub(r":\d*$", "", host).rsplit(".", 1)[-1]
        rows.append((i, host, suffix, said[1].lower() if said else "", {lang: math.exp(v - whole) for lang, v in logs.items()}))

    def summed(place):
        out = defaultdict(lambda: dict.fromkeys(langs, 0.0))
        for row in rows:
            for lang in langs:
                out[row[place]][lang] += row[4][lang]
        return out

    hosts, suffixes, markup = summed(1), summed(2), summed(3)
    every = {lang: sum(row[4][lang] for row in rows) for lang in langs}
    world = {lang: (every[lang] + 1) / (sum(every.values()) + len(langs)) for lang in langs}
    for i, host, suffix, said, own in rows:
        score = {}
        for lang in langs:
            above = (suffixes[suffix][lang] + 50 * world[lang]) / (sum(suffixes[suffix].values()) + 50)
            prior = (max(hosts[host][lang] - own[lang], 0) + 8 * above) / (sum(hosts[host].values()) - 1 + 8)
            score[lang] = own[lang] * (markup[said][lang] + 5 / len(markup)) / (every[lang] + 5) * prior
        best = max(langs, key=lambda lang: (score[lang], [-ord(c) for c in lang]))
        yield i, host, suffix, said, best, score[best] / sum(score.values())


def test_languages_equal_the_posterior_by_hand(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    pages = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url", "html").orderBy("page_id").limit(60).collect()]
    pages += [
        (10_001, None, None), (10_002, "", ""), (10_003, "http://A.fr:80/x?y", "<html lang='FR'><script>the the</script>le la &amp; les"), (10_004, "http://a.fr:80/", None),
        (10_005, "http://b.org/", '<meta http-equiv="Content-Language" content="es"><p>el la de los'), (10_005, "http://b.org/", "<!-- der die das -->"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted((r.page_id, r.host, r.suffix, r.declared, r.lang, r.confidence) for r in languages.identified(df, docs, sample=10_000).collect())
    want = sorted(brute_languages(pages, [(r.text, r.lang) for r in docs.collect()]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], atol=2e-4)
