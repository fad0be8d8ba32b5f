"""Text functions against plain Python on hand-made rows."""

import html
import re
import time
import unicodedata
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from verdin.functions import outcomes, parsers, phrases, text, transcripts

SAMPLES = [
    "",
    "  Hola,  ¿Cómo está?\tBuenos\n\ndías!  ",
    "Straße œuvre ﬁn ½ № ™ … ²",
    "Niño pequeño — “comillas” ﬀ ﬆ",
    "été combinado",
    "ÁÉÍÓÚÑ ÀÈ ÇA Ä",
    "no_guion bajo 123-456",
    "日本語 and ｆｕｌｌｗｉｄｔｈ",
    "línea\r\nuno\x0cdos\x1ftres",
    None,
]


def run(spark, column, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, text {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def words(t):
    t = unicodedata.normalize("NFKD", (t or "").lower()).encode("ascii", "ignore").decode()
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", t)).strip()


def line(t):
    t = "".join(c for c in unicodedata.normalize("NFD", t.lower()) if unicodedata.category(c) != "Mn")
    return re.sub(r"\s+", " ", t).strip()


def test_normalisers(spark):
    assert run(spark, text.normalise_words(F.col("text")), SAMPLES) == [words(s) for s in SAMPLES]
    got = run(spark, text.normalise_line(F.col("text")), SAMPLES)
    assert [unicodedata.normalize("NFC", g) if g is not None else None for g in got] == [
        None if s is None else unicodedata.normalize("NFC", line(s)) for s in SAMPLES
    ]
    keys = run(spark, text.normalise_key(F.col("text")), SAMPLES)
    for got, s in zip(keys, SAMPLES):
        if s is None:
            assert got is None
        else:
            want = unicodedata.normalize("NFKD", s.upper()).encode("ascii", "ignore").decode()
            assert got == " ".join(want.split())


def test_counts_of_words_and_sentences(spark):
    rows = ["", "¿Qué? ¡Sí! uno; dos\n\n tres...", "a_b c-d 12 ñandú", "   "]
    assert run(spark, text.word_count(F.col("text")), rows) == [len(re.findall(r"\w+", r)) for r in rows]
    want = [len([p for p in re.split(r"[.!?¡¿;\n\r]+", r) if p.strip()]) for r in rows]
    assert run(spark, F.size(text.sentences(F.col("text"))), rows) == want
    assert run(spark, text.token_count(text.normalise_words(F.col("text"))), rows) == [len(words(r).split()) for r in rows]


DICTIONARY = {"a": ["si", "sí que necesita", "hola"], "b": ["de paso", "paso", "paso"], "c": ["(x)", "100%"]}
TALKS = ["si que necesita, SI hola holas", "de paso paso a paso", "cuesta 100% (x) 100%x", "", "sí"]


def test_three_count_modes(spark):
    norm = [words(t) for t in TALKS]

    def alternation(t, entries):
        known = sorted({text.phrase_token(p) for p in entries})
        return len(re.findall(r"(?<!\w)(" + "|".join(map(re.escape, known)) + r")(?!\w)", t))

    for category, entries in DICTIONARY.items():
        got = run(spark, phrases.count_alternation(text.normalise_words(F.col("text")), entries), TALKS)
        assert got == [alternation(t, entries) for t in norm], category
        got = run(spark, phrases.count_per_phrase(text.normalise_line(F.col("text")), entries), TALKS)
        want = [sum(len(re.findall(rf"(?<!\w){re.escape(line(p))}(?!\w)", line(t))) for p in entries) for t in TALKS]
        assert got == want, category
        got = run(spark, phrases.count_substring(text.normalise_words(F.col("text")), entries), TALKS)
        assert got == [len(re.findall("|".join(re.escape(words(p)) for p in entries), t)) for t in norm], category
    assert phrases.unreachable(DICTIONARY) == {"a": [], "b": [], "c": ["(x)", "100%"]}


def test_rubric_reaches_threshold_in_order(spark):
    counts = {c: F.lit(1 if c != "objecion" else 0) for c in phrases.EVEN_RUBRIC}
    score = run(spark, phrases.rubric_score(counts, phrases.EVEN_RUBRIC), ["x"])[0]
    assert score == pytest.approx(5 / 6) and score >= phrases.EFFECTIVE_FROM
    counts = {c: F.lit(0 if c in ("saludo", "objecion") else 1) for c in phrases.TRAINER_RUBRIC}
    assert run(spark, phrases.rubric_score(counts, phrases.TRAINER_RUBRIC), ["x"])[0] >= phrases.EFFECTIVE_FROM


def test_top_words_ties_by_first_appearance(spark):
    rows = ["casa perro gato perro casa sol mar pez", "la de", None, "ñandú ñandú Casa"]

    def brute(t):
        found = [w for w in re.findall("[a-záéíóúñ]{3,}", (t or "").lower()) if w not in text.COMMENT_STOP_WORDS]
        return ", ".join(w for w, _ in Counter(found).most_common(5)) or None

    assert run(spark, text.top_words(F.col("text")), rows) == [brute(r) for r in rows]


def test_post_keywords_keep_repeats(spark):
    got = run(spark, text.post_keywords(F.col("text")), ["¡Becas, becas para Todos! año sol_y", None])
    assert got == [["becas", "becas", "sol_y"], []]


def test_polarity_counts_inside_words(spark):
    got = run(spark, text.polarity(text.normalise_line(F.col("text"))), ["No me gusta", "gracias, EXCELENTE", "", "malo"])
    assert got == [0.0, 1.0, 0.0, -1.0]
    labels = run(spark, text.polarity_label(F.col("text").cast("double")), ["0.1", "-0.1", "0.05"])
    assert labels == ["positivo", "negativo", "neutro"]


def chunked(t, size):
    t = t.strip()
    if len(t) <= size:
        return [t]
    out, start = [], 0
    while start < len(t):
        end = min(len(t), start + size)
        cut = t.rfind(".", start, end)
        cut = end if cut == -1 or cut <= start + int(size * 0.6) else cut + 1
        if t[start:cut].strip():
            out.append(t[start:cut].strip())
        start = cut
    return out


@pytest.mark.parametrize("size", [1, 7, 10, 50])
def test_chunks(spark, size):
    rows = ["", "  short. ", "Uno dos. Tres cuatro cinco. " * 9, "x" * 95, ". . . . . " * 6, "ñé. " * 20]
    df = spark.createDataFrame([*enumerate(rows), (99, None)], "id int, text string")
    got = {}
    for r in text.chunk_rows(df, "text", size).orderBy("id", "place").collect():
        got.setdefault(r.id, []).append(r.piece)
    assert got == {99: [""], **{k: chunked(r, size) for k, r in enumerate(rows)}}


def test_chunks_of_a_very_long_text_take_linear_time(spark):
    seconds = []
    for million in (5, 50):
        df = spark.range(1).select(F.repeat(F.lit("una frase de prueba. "), million * 50_000).alias("text"))
        start = time.perf_counter()
        found = text.chunk_rows(df, "text", 900).agg(F.count("*").alias("n"), F.sum(F.length("piece")).alias("size")).first()
        seconds.append(time.perf_counter() - start)
        assert found.n >= million * 1_050_000 / 900 and found.size >= 0.99 * million * 1_050_000
    assert seconds[1] < 30 * max(seconds[0], 1.0)


def test_head_and_tail(spark):
    t = "a" * 70 + "b" * 60 + "c" * 30
    assert run(spark, text.head_and_tail(F.col("text"), 100), [t, " x ", None]) == ["a" * 70 + "\n...\n" + "c" * 30, "x", ""]


TRANSCRIPT = "ignored line\n#Ana Ruíz : Hola \n  sigo aquí  \n\n#Sistema: aviso\nmás aviso\nLuis : \n texto\n#System :\n: sin nombre"


def test_turns_and_automatic_speakers(spark):
    got = [tuple(t) for t in run(spark, transcripts.turns(F.col("text")), [TRANSCRIPT])[0]]
    assert got == [
        ("Ana Ruíz", "Hola\n  sigo aquí"),
        ("Sistema", "aviso\nmás aviso"),
        ("Luis", " texto"),
        ("System", ": sin nombre"),
    ]
    clean = run(spark, transcripts.without_automatic(transcripts.turns(F.col("text"))), [TRANSCRIPT, None, "no speaker"])
    assert clean == ["#Ana Ruíz : Hola\n  sigo aquí\n#Luis : texto", "", ""]


def test_unescape_knows_all_entities(spark):
    rows = ["&lt;b&gt; &amp;amp; &eacute; &#241; &#x1F600; &notanentity; &hellip;", None]
    assert run(spark, transcripts.unescape(F.col("text")), rows) == [html.unescape(rows[0]), None]


def test_unescape_of_closed_entities_only(spark):
    rows = ["a &amp &amp; &amp;lt; &copy; &copy &notit; &#241; &#241 &amp", "ver&&&amp;", None]
    want = ["a &amp & &lt; © &copy &notit; ñ &#241 &amp", "ver&&&", None]
    assert run(spark, transcripts.unescape(F.col("text"), closed=True), rows) == want


def test_outcome_rules(spark):
    rows = [
        "x " * 100 + "lo voy a pensar pero te llamo mañana",
        "x " * 100 + "ya pagué hoy",
        "x " * 100 + "te vuelvo a llamar",
        "x " * 100 + "mas adelante",
        "nada",
        "ya pague " + "x " * 80,
    ]
    flags = outcomes.outcome_flags(text.normalise_words(F.col("text")))
    assert run(spark, outcomes.outcome_score(flags)["outcome_score"], rows) == [0.65, 0.85, 0.7, 0.15, 0.3, 0.3]
    reasons = run(spark, outcomes.review_reason(F.lit(0.8), F.lit(0), flags), rows)
    assert reasons == [
        "contradiccion_indecision_vs_cierre_seguimiento", "borderline_score", "validar_resultado_cierre_o_seguimiento",
        "anti_cierre_en_final", "borderline_score", "borderline_score",
    ]
    assert run(spark, outcomes.needs_person(F.col("text")), ["0.64", "0.65", "bad", None]) == [1, 0, 1, 1]


def test_tail_share_counts_as_written(spark):
    rows = ["x" * n + "y" * (m - n) for m, n in ((10, 7), (90, 63), (130, 91), (190, 133), (11, 7))]  # 0.7 * 90 is below 63 in doubles
    assert run(spark, text.tail(F.col("text")), rows) == ["y" * r.count("y") for r in rows]


def test_parsers(spark):
    mail = run(spark, parsers.mail_in_key(F.col("text")), ["Grabaciones/ana.perez@example.edu/llamada.wav", "x/sin/llamada.wav"])
    assert mail == ["ana.perez@example.edu", None]
    assert len(run(spark, parsers.job_name(F.col("text"), "20240101-000000"), ["a" * 1000 + ".wav"])[0]) <= 200
    assert run(spark, parsers.stem(F.col("text")), ["a/b.c.txt", ".hidden", "plain"]) == ["b.c", ".hidden", "plain"]
    assert run(spark, parsers.phone_in_text(F.col("text")), ["+57 3001234567", "tel 1234567", "12"]) == ["+573001234567", "1234567", ""]
    assert run(spark, parsers.last_ten_digits(F.col("text")), ["0057 300-123-4567", None, "12"]) == ["3001234567", "", "12"]
    assert run(spark, parsers.slug(F.col("text")), ["José  Pérez/Díaz-2", None]) == ["Jose_Perez_Diaz-2", ""]
    assert run(spark, parsers.origin_host(F.col("text")), ["HTTPS://www.A.com:80/x", " tw ", "http://"]) == ["a.com:80", "tw", "url"]
    assert run(spark, parsers.unquote(F.col("text")), ["a+b%20c", "50%"]) == ["a b c", "50%"]
    names = run(spark, parsers.adviser_name(F.col("text")), ["+57 by ana_maria-lopez@x.com 1.txt", "solo_nombre.txt"])
    assert names == ["Ana Maria Lopez", "Solo Nombre"]
    assert run(spark, parsers.target_name(F.col("text"), [".wav"]), [" Abc.WAV nota", "x.mp3"]) == ["abc", "x.mp3"]
    assert run(spark, parsers.document_number(F.col("text"), F.lit("id 12345678 z")), ["C.C. 123-456", "12"]) == ["123456", "12345678"]


def test_all_of_unicode_is_folded(spark):
    df = spark.createDataFrame([("① 𝐀 ㎏ ½ ﬁ Å",), ("é️ x⃗ שָ",)], "t STRING")
    ascii_only = [r[0] for r in df.select(text.to_ascii(F.col("t"))).collect()]
    assert ascii_only[0] == "1 A kg 12 fi A"
    assert df.select(text.strip_marks(F.col("t"))).collect()[1][0] == "e x ש"


def test_batches_on_their_way_to_python_are_bounded_by_bytes(spark):
    """A batch of long texts does not grow to the number of rows it may hold."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    rows = spark.range(3000).coalesce(1).select(F.repeat(F.lit("palabra "), F.lit(1250)).alias("text"))
    found = [r.size for r in rows.mapInArrow(sizes, "size long").collect()]
    assert sum(found) >= 30_000_000 and max(found) < 6_000_000


def test_texts_are_written_one_by_one_and_read_back(spark):
    from verdin.session import scratch_path
    from verdin.sources import readers, staged

    rows = [("a/b", "uno\ndos\u2028tres"), ("a/b", "uno\ndos\u2028tres"), ("web", ""), (None, "\r\n"), ("web", "é" * 300_000), *[("many", f"text {k}") for k in range(2001)]]
    path = scratch_path(spark, "texts")
    staged.write_texts(spark.createDataFrame(rows, "source string, text string").repartition(3), path, "text", "source")
    found = readers.read_corpus(spark, path).select(F.regexp_extract("path", "source=([^/]+)", 1), "text", "size").collect()
    name = {"a/b": "a%2Fb", None: "__HIVE_DEFAULT_PARTITION__"}
    assert sorted(map(tuple, found)) == sorted((name.get(s, s), t + "\n", len(t.encode()) + 1) for s, t in rows)


def test_listening_exports_come_from_the_columns_as_written(spark):
    from verdin.operators import listening
    from verdin.plans.texts import listened
    from verdin.session import scratch_path

    df = listened(spark, "/root/testdata/sf0.001")
    paths = listening.export_tables(df, scratch_path(spark, "listening"))
    for name, frame in listening.listening_tables(df).items():
        written = spark.read.parquet(paths[name])
        assert written.dtypes == frame.dtypes and sorted(map(str, written.collect())) == sorted(map(str, frame.collect())), name


ODD_TEXTS = ["", " ", "\t\n", "  ", " " * 600, "é" * 501, "😀" * 500, "x", None, None, "x", ""]


def twin_rows(spark, folder, name, labelled):
    """Rows of a query and of its SQL over documents with odd texts, of which some have labels."""
    import duckdb

    from verdin.plans import QUERIES, TWINS

    tables = {"documents": (list(enumerate(ODD_TEXTS)), "doc_id LONG, text STRING"), "labels": ([(k,) for k in labelled], "doc_id LONG")}
    base = duckdb.connect()
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{table}.parquet")
        base.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    answer = base.execute(TWINS[name])
    heads = [d[0] for d in answer.description]
    return sorted(map(tuple, QUERIES[name](spark, folder).select(heads).collect())), sorted(answer.fetchall())


def test_classifier_answers_blank_and_missing_texts_as_its_sql(spark, tmp_path):
    got, want = twin_rows(spark, str(tmp_path), "x5_classifier", [])
    assert got == want and len(got) == len(ODD_TEXTS)


@pytest.mark.parametrize("labelled", [[0, 5, 7], [5, 8], [8], [1, 99], [99]])
def test_answer_cache_tells_known_texts_as_its_sql(spark, tmp_path, labelled):
    """Labelled: an empty text, missing texts, only missing ones, a blank one, and none."""
    got, want = twin_rows(spark, str(tmp_path), "x6_answer_cache", labelled)
    assert got == want and len(got) == len(ODD_TEXTS)


def test_corpus_files_are_listed_and_read_by_tasks(spark, tmp_path):
    """The same files as Spark's reader finds, whose list of files the driver holds."""
    from verdin.sources import readers

    deep = tmp_path / "a/source=x%2Fy/c d/e/f"
    for folder in (deep, tmp_path / "_hidden", tmp_path / ".git", tmp_path / "_by=1", tmp_path / "_metadata_x", tmp_path / "empty"):
        folder.mkdir(parents=True)
        for name in ("a.txt", "b c#1?.txt", "_x.txt", "_x=1.txt", "_metadata.txt", ".y.txt", "z.txt._COPYING_", "n.md", "ñ.txt") if folder.name != "empty" else ():
            (folder / name).write_bytes(f"{folder.name} {name}".encode("latin-1"))
    (tmp_path / "top.txt").write_bytes(b"")
    (deep / "long.txt").write_bytes(b"0" * 9_000_000)
    (tmp_path / "link.txt").symlink_to(deep / "a.txt")
    (tmp_path / "linked").symlink_to(deep.parent)
    (tmp_path / "nowhere.txt").symlink_to(tmp_path / "missing")
    counts = []
    for pattern in ("*.txt", "*.{txt,md}", "[ab]*", "?.txt"):
        found = readers.read_corpus(spark, f"file://{tmp_path}/", pattern)
        assert "binaryFile" not in found._jdf.queryExecution().executedPlan().toString() and not found.inputFiles()
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
        want = reader.load(str(tmp_path)).select("path", "length", F.decode("content", "ISO-8859-1")).collect()
        assert sorted(map(tuple, found.select("path", "size", "text").collect())) == sorted(map(tuple, want))
        assert sorted(r.path for r in readers.read_corpus(spark, str(tmp_path), pattern).collect()) == sorted(r.path for r in want)
        counts.append(len(want))
    assert all(counts)
    one = readers.read_corpus(spark, f"{deep}/long.txt").first()
    assert (one.file_name, one.size, one.text) == ("long.txt", 9_000_000, "0" * 9_000_000)
    with pytest.raises(AnalysisException):
        readers.read_corpus(spark, f"{tmp_path}/missing")


def test_corpus_contents_are_handed_on_by_bytes(tmp_path):
    from verdin.sources import readers

    for k in range(2500):
        (tmp_path / f"{k}").write_bytes(b"1" * (3_000_000 if k in (7, 8, 9) else 5_000_000 if k == 10 else 1))
    places = pa.RecordBatch.from_pydict({"place": [f"{tmp_path}/{k}" for k in range(2500)]})
    parts = list(readers._contents(iter([places, places.slice(0, 0)])))
    assert [len(p) for p in parts] == [8, 1, 1, 1, 1000, 1000, 489]
    assert [p for part in parts for p in part.column(0).to_pylist()] == [f"file:{tmp_path}/{k}" for k in range(2500)]
