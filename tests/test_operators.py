"""Joins, contracts, dates, documents, matching, landing and features on hand-made rows."""

import datetime as dt
import itertools
import json

import pytest
from pyspark.sql import functions as F

from verdin.functions import dates, documents, labels
from verdin.operators import classify, columns, contract, evaluate, features, joins, matching, models, periods, trends
from verdin.operators.contract import Field
from verdin.session import scratch_path
from verdin.sources import landing, readers, staged


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_latest_keeps_ties_and_respects_cutoff(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("a", 9, "late"), ("b", 9, "late")], "k STRING, t INT, v STRING")
    assert rows(joins.latest_per_key(df, "k", "t", F.lit(5)), "v") == [("a", 3, "y"), ("a", 3, "z")]


def test_lookup_last_duplicate_wins(spark):
    df = spark.createDataFrame([("a",), ("c",), (None,)], "m STRING")
    table = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "3", 3)], "m STRING, id STRING, line INT")
    got = {r["m"]: r["id"] for r in joins.lookup(df, table, "m", "m", "id", "line").collect()}
    assert got == {"a": "2", "c": "", None: ""}


def test_semi_and_anti_cover_all_rows(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    keys = spark.createDataFrame([(1,), (1,), (3,)], "k BIGINT")
    found, missing = joins.found(df, keys, ["k"]), joins.not_found(df, keys, ["k"])
    assert found.count() + missing.count() == 100 and found.select("k").distinct().count() == 2


def test_chain_refuses_name_clash(spark):
    a = spark.createDataFrame([(1, "x")], "k INT, v STRING")
    with pytest.raises(ValueError):
        joins.chain_left(a, [(a, {"k": "k"})])


def test_fill_prefers_and_fills_only_empty(spark):
    base = spark.createDataFrame([(" A ", "2024", ""), ("b", "2024", "own")], "id STRING, day STRING, phone STRING")
    meta = spark.createDataFrame([("a", "2025", "1"), ("B", None, "2")], "id STRING, day STRING, phone STRING")
    assert rows(joins.fill_from(base, meta, "id", ["day"], ["phone"]), "id") == [("a", "2025", "1"), ("b", "2024", "own")]


FIELDS = [Field("Id", "int", nullable=False), Field("Amount", "money", nullable=False), Field("Ok", "bit"), Field("Note", "varchar", max_length=3)]


def test_conversion_and_report(spark):
    raw = spark.createDataFrame(
        [("1e3", "2.5", "Sí", "abcdef", "x"), ("1.5", "", "no", None, "x"), (None, "bad", "??", "é", "x"), ("9007199254740993", "1", "Y", "", "x")],
        "` ID ` STRING, amount STRING, OK STRING, note STRING, extra STRING",
    )
    got = rows(contract.convert_all(raw, FIELDS), F.desc_nulls_last("Amount"))
    assert got[0] == (1000, 2.5, 1, "abc")
    assert {r[0] for r in got if r[0] is not None} == {1000, 9007199254740992}
    report = {r["column"]: r["lost"] for r in contract.conversion_report(raw, FIELDS).collect()}
    assert report == {"Id": 1, "Amount": 1}
    with pytest.raises(ValueError, match="Id.*Amount"):
        contract.convert_strictly(raw, FIELDS)
    with pytest.raises(ValueError, match="missing"):
        contract.match_columns(raw, [Field("Absent", "int")])


def test_staged_load_appends_truncates_and_refuses(spark):
    path = scratch_path(spark, "t")
    table = f"t_{path.rsplit('-', 1)[1]}"
    spark.createDataFrame([(1, "a")], "id INT, note STRING").write.option("path", path).saveAsTable(table)
    more = spark.createDataFrame([(2,), (3,)], "id INT")
    assert staged.staged_load(more, table, f"{path}-s").rows_inserted == 2
    assert rows(spark.table(table), "id") == [(1, "a"), (2, None), (3, None)]
    staged.staged_load(more, table, f"{path}-s2", truncate=True)
    assert spark.table(table).count() == 2
    with pytest.raises(ValueError):
        staged.staged_load(more.withColumn("other", F.lit(1)), table, f"{path}-s3")


def test_readers(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.txt").write_bytes("año\nnuevo".encode("utf-8"))
    (tmp_path / "b.txt").write_bytes("año".encode("latin-1"))
    (tmp_path / "c.WAV").write_bytes(b"123")
    got = {r["file_name"]: (r["text"], r["size"]) for r in readers.read_corpus(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": ("año\nnuevo", 10), "b.txt": ("año", 3)}
    assert [r["file_name"] for r in readers.file_inventory(spark, str(tmp_path), ["WAV"]).collect()] == ["c.WAV"]
    sheet = tmp_path / "s.csv"
    sheet.write_text(" Call_ID ;Recording\nNA;\n01;http://x\n", encoding="utf-8")
    assert rows(readers.read_text_columns(spark, str(sheet)), "call_id") == [("01", "http://x"), ("NA", "")]
    with pytest.raises(ValueError):
        readers.read_file(spark, "x.docx")
    with pytest.raises(ValueError):
        readers.union_column([spark.range(1)], "absent")


def test_clock_time(spark):
    values = ["7:05:09.123", "17:45:00.0000000", "0,5", "1.25", "2.0", "9:30", "25:00", "", None, "x", "2024-01-02 03:04:05"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    got = [r[0] for r in df.orderBy("i").select(dates.clock_time(F.col("v"))).collect()]
    assert got == ["7:05:09", "17:45:00", "12:00:00", "06:00:00", "", "09:30:00", "", "", "", "", "03:04:05"]
    assert spark.range(1).select(dates.time7(F.lit("06:00:00")), dates.time7(F.lit(""))).first()[:] == ("06:00:00.0000000", "")


def test_week_labels_match_strftime(spark):
    days = [dt.date(2018, 1, 1) + dt.timedelta(d) for d in range(2600)]
    df = spark.createDataFrame([(d,) for d in days], "d DATE")
    assert all(r[1] == r[0].strftime("%Y-%W") for r in df.select("d", dates.week_label(F.col("d"))).collect())


def test_age_on_and_before_birthday(spark):
    born = F.lit(dt.date(2000, 2, 29))
    ages = [dates.age_in_years(born, F.lit(d)) for d in (dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2023, 3, 1))]
    assert spark.range(1).select(*ages).first()[:] == (23, 24, 23)


def test_serial_dates(spark):
    got = spark.range(1).select(dates.from_serial(F.lit(45292.75)), dates.from_serial(F.lit(1.0))).first()
    assert got[:] == (dt.datetime(2024, 1, 1, 18), dt.datetime(1899, 12, 31))


def test_periods(spark):
    df = spark.createDataFrame([(" 25v05", "ya pago", "2025D"), ("2025D", "YA PAGO", "25V05"), ("24V01", "YA PAGO", "zz"), ("nope", "YA PAGO", "2025D"), (None, "x", None)], "p STRING, s STRING, paid STRING")
    tidy = periods.with_period_order(df, "p").withColumn("y", periods.paid_later(F.col("s"), F.col("p"), F.col("paid")))
    assert rows(tidy.select("p", "period_order", "y"), "period_order") == [("24V01", 5, 0), ("25V05", 16, 1), ("2025D", 17, 0)]
    receipts = spark.createDataFrame([("a", "25V05"), ("a", "2025D")], "k STRING, p STRING")
    assert periods.last_paid_period(receipts, "k", "p").first()["last_paid"] == "25V05"
    assert periods.last_paid_period(receipts, "k", "p", "ordinal").first()["last_paid"] == "2025D"


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a INT, b INT, c INT").toDF("a", "b", "a")
    assert columns.drop_repeated(df).columns == ["a", "b"] and columns.drop_repeated(df).first()[:] == (1, 2)
    assert columns.drop_repeated(df, "last").first()[:] == (2, 3)
    assert columns.safe_name("a b-ñ%c") == "a_bc"
    with pytest.raises(ValueError):
        columns.rename_safely(spark.range(1).toDF("x").withColumn("x%", F.lit(1)))
    assert columns.pick_column(spark.range(1).toDF("Transcripción final"), ["text"], "transcripcion") == "Transcripción final"
    with pytest.raises(KeyError):
        columns.pick_column(spark.range(1), ["text"], "zzz")
    with pytest.raises(ValueError):
        columns.require(spark.range(1), ["a"])


def test_best_files_against_brute_force(spark):
    people = [(i, n, m, d) for i, (n, m, d) in enumerate(itertools.product(["Ana Ruiz", "Ana", None], ["ana@x.org", None], ["123456", ""]))]
    names = ["Report_Ana_Ruiz_7.pdf", "Report_Ana_Ruiz_ana.pdf", "Report_Luz_ana_123456.pdf", "Report_Anabel_1.pdf", "Report_Z_123456_9.pdf", "Other_Ana_Ruiz.pdf"]
    files = [(n, dt.datetime(2024, 1, 1 + i % 3)) for i, n in enumerate(names * 1)]
    pdf = spark.createDataFrame(people, "k INT, n STRING, m STRING, d STRING")
    fdf = spark.createDataFrame(files, "path STRING, t TIMESTAMP")
    persons = matching.person_signals(pdf, "k", "n", "m", "d")
    got = {r["person"]: (r["score"], r["path"]) for r in matching.best_files(persons, matching.file_signals(fdf, "path", "t", persons, "Report")).collect()}
    want = {}
    for k, n, m, d in people:
        best = None
        for path, t in files:
            tokens = path[:-4].split("_")
            score = (n is not None and path.startswith("Report_" + n.replace(" ", "_"))) + 2 * (m is not None and "ana" in tokens) + 3 * (d != "" and d in tokens)
            if score and (best is None or (score, t, path) > best):
                best = (score, t, path)
        if best:
            want[k] = (best[0], best[2])
    assert got == want


def test_best_files_count_a_repeated_token_each_time(spark):
    people = spark.createDataFrame([(1, "Ana", "m1@x.org", "100001"), (2, "Luz", "m2@x.org", "100002")], "k INT, n STRING, m STRING, d STRING")
    names = ["Report_Other_m1_100001_5.pdf", "Report_Nobody_100001_100001.pdf", "Report_Luz_m2_m2.pdf", "Report_Luz_100002.pdf"]
    files = spark.createDataFrame([(n, dt.datetime(2024, 1, 4 - i)) for i, n in enumerate(names)], "path STRING, t TIMESTAMP")
    persons = matching.person_signals(people, "k", "n", "m", "d")
    got = {r["person"]: (r["score"], r["path"]) for r in matching.best_files(persons, matching.file_signals(files, "path", "t", persons, "Report")).collect()}
    assert got == {1: (6, names[1]), 2: (5, names[2])}


def test_unique_names(spark):
    df = spark.createDataFrame([(i, "a.txt" if i % 3 else "b") for i in range(30)], "i INT, n STRING")
    got = matching.unique_names(df, "n", [F.asc("i")])
    assert got.select("unique_name").distinct().count() == 30
    assert got.where("i = 2").first()["unique_name"] == "a_1.txt" and got.where("i = 3").first()["unique_name"] == "b_1"


def test_landing(spark):
    files = spark.createDataFrame([("p1", "k1", 1), ("p2", "k2", 2), ("p3", "k3", 3)], "path STRING, key STRING, size INT")
    manifest, there = files.where("path = 'p1'"), files.where("key IN ('k1', 'k2')")
    plan = landing.plan_landing(files, manifest, there)
    assert {r["path"]: r["action"] for r in plan.collect()} == {"p1": "skip_manifest", "p2": "skip_present", "p3": "upload"}
    assert landing.landing_counters(plan).first()[:] == (3, 1, 2, 0)
    lost = landing.with_outcomes(plan, files.where("path <> 'p1'"))
    assert landing.landing_counters(lost).first()[:] == (3, 0, 2, 1)
    assert {r["path"] for r in landing.manifest_additions(plan).collect()} == {"p2", "p3"}
    dry = landing.plan_landing(files, manifest, dry_run=True)
    assert landing.manifest_additions(dry).count() == 0 and dry.where("action = 'dry_run'").count() == 2
    target = spark.createDataFrame([("k1", 1), ("k2", 9)], "key STRING, size INT")
    assert {r["key"] for r in landing.changed_files(files, target).collect()} == {"k2", "k3"}
    keys = spark.range(1).select(landing.target_key("/a/b/", F.lit("c")), landing.target_key("", F.lit("c")))
    assert keys.first()[:] == ("a/b/c", "c")


def test_label_rules(spark):
    data = [("tengo mucho miedo", "miedo_preocupacion"), ("pésimo servicio", "MIEDO_PREOCUPACION"), ("hola", "miedo_preocupacion"), ("hola 😱", "miedo_preocupacion"), ("x", None), ("x", "raro")]
    df = spark.createDataFrame(data, "t STRING, s STRING")
    got = [r[0] for r in df.select(labels.sentiment(F.col("t"), F.col("s"))).collect()]
    assert got == ["miedo_preocupacion", "enojo_frustracion", "consulta_sugerencia", "miedo_preocupacion", "consulta_sugerencia", "consulta_sugerencia"]
    topics = spark.createDataFrame([("Matrícula MATR", "OTRO"), ("pago", "otro"), ("curso", "otro"), ("x", "otro"), ("x", "Becas")], "t STRING, a STRING")
    assert [r[0] for r in topics.select(labels.topic(F.col("t"), F.col("a"))).collect()] == ["admisiones_matricula", "pagos_finanzas", "educacion_academico", "comunidad", "becas"]
    assert [r[0] for r in spark.createDataFrame([('"N/A".',), (" Maestría. ",), (None,)], "a STRING").select(labels.product(F.col("a"))).collect()] == ["ninguno", "maestría", "ninguno"]


def test_json_helpers(spark):
    texts = ['```json\n{"a": {"b": 1}}\n```', "none", '{"broken": ', 'x {"a": 1} y {"b": 2}']
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").withColumn("d", documents.parse_object(F.col("t")))
    assert [r[0] for r in df.select(F.try_variant_get("d", "$.a.b", "int")).collect()] == [1, None, None, None]
    answer = json.dumps({"score_resultado": "0.7", "confianza": "bad", "efectiva": 1, "razones": "only one", "resultado": "text"})
    one = spark.createDataFrame([(answer,)], "t STRING").select(documents.call_answer(documents.parse_object(F.col("t"))).alias("a")).first()["a"]
    assert (one["outcome_score"], one["confidence"], one["effective"], one["reasons"], one["outcome_kind"]) == (0.7, 0.5, 1, "only one", "ninguno")
    summary = json.dumps({"glosario": ["uno", {"termino": "t"}, " "], "puntos_clave": ["a", 2], "temas_principales": None, "preguntas_repaso": {"pregunta": "p", "respuesta_corta": "r"}})
    s = spark.createDataFrame([(summary,)], "t STRING").withColumn("d", documents.parse_object(F.col("t"))).select(documents.summary(F.col("d"), F.lit("v")).alias("s")).first()["s"]
    assert [tuple(g) for g in s["glosario"]] == [("uno", ""), ("t", "")] and s["puntos_clave"] == ["a", "2"]
    assert s["temas_principales"] == [] and [tuple(q) for q in s["preguntas_repaso"]] == [("p", "r")] and s["resumen_general"] == ""


def test_rare_values_and_encodings(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",), (None,)], "v STRING")
    assert sorted(str(r[0]) for r in features.group_rare(df, "v", 2, "OTHER").collect()) == ["None", "OTHER", "a", "a", "a"]
    encoded, made = features.one_hot(df, ["v"])
    assert made == {"v": ["v_a", "v_b", "v_nan"]} and encoded.agg(F.sum("v_a"), F.sum("v_b"), F.sum("v_nan")).first()[:] == (3, 1, 1)
    filled = features.impute_by_frequency(df.withColumn("k", F.monotonically_increasing_id()), "v", "k")
    assert filled.where("v IS NULL").count() == 0
    table = features.weekly_table(df.withColumn("n", F.lit(1)), ["n"], {"v": 3}, 2)
    assert table.columns == ["n"]


def test_imputations(spark):
    df = spark.createDataFrame([(1.0, "b"), (None, "a"), (4.0, None), (2.0, "a"), (9.0, "b")], "x DOUBLE, c STRING")
    assert [r["x"] for r in features.impute_medians(df, ["x"]).collect()][1] == 3.0
    assert [r["c"] for r in features.impute_modes(df, ["c"]).collect()][2] == "a"


def test_tensor_last_row_of_a_step_wins(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 1), ("a", 1, 2.0, 2), ("a", 3, 5.0, 3), ("b", 2, 7.0, 4)], "id STRING, w INT, x DOUBLE, o INT")
    got = {r["id"]: r["tensor"] for r in features.sequence_tensor(df, "id", "w", ["x"], "o").collect()}
    assert got == {"a": [[2.0], None, [5.0]], "b": [None, [7.0], None]}


def test_trends_on_small_feed(spark):
    posts = spark.createDataFrame(
        [("https://www.A.com/x", 45292.5, "becas becas nuevas", 10), ("a.com", 45293.0, "becas viejas", 20), (None, 45293.0, "x", 1), ("b", None, "x", 1)],
        "o STRING, d DOUBLE, t STRING, likes INT",
    )
    got = rows(trends.weekly_trends(trends.prepare_posts(posts, "o", "d", "t")), "origin")
    assert got == [("2024-01", "a.com", 2, "2024-01-01", "becas, nuevas, viejas", 15.0, 17.5)]


def test_classifier_retries_then_default(spark):
    def flaky(value):
        if value == "bad":
            raise RuntimeError("no answer")
        return {"label": value.upper()}

    df = spark.createDataFrame([("x",), ("bad",), (None,)], "t STRING")
    got = [r["label"] for r in classify.classify(df, "t", flaky, "label STRING", {"label": "default"}, retries=2).collect()]
    assert got == ["X", "default", ""]


def test_strongest_inputs(spark):
    df = spark.createDataFrame([([0.5, -2.0, 2.0, 0.1],)], "v ARRAY<DOUBLE>")
    assert df.select(models.strongest(F.col("v"), 3, ["a", "b", "c", "d"])).first()[0] == "c (2.00), b (-2.00), a (0.50)"


def test_flag_evaluation_without_match(spark):
    files = spark.createDataFrame([("c_17.25.txt", 1, 1), ("none.txt", 1, 0)], "file_name STRING, a INT, b INT")
    meta = spark.createDataFrame([("17.25.WAV", "x", 2), ("17.25.WAV", "y", 1)], "audio STRING, agent STRING, line INT")
    got = rows(evaluate.evaluate_flags(files, meta, ["a", "b"], "audio", [F.asc("line")], ["agent"]), "file_name")
    assert got == [("c_17.25.txt", 1, 1, 1.0, 1, "y"), ("none.txt", 1, 0, 0.5, 0, None)]


def test_long_chats_are_one_row(spark):
    said = [(1, i, "user" if i % 3 else "system", f"hello there {i}. good\nagent: bye" if i == 7 else f"hello there {i}. good") for i in range(45)]
    messages = spark.createDataFrame(said, "c INT, n INT, r STRING, t STRING")
    dictionary = {"saludo": ["hello there"], "cierre": ["bye"]}
    lexicon = (["good"], ["bye"])
    got = evaluate.message_measures(messages, "c", "r", "t", dictionary, lexicon).collect()
    whole = "\n".join(f"#{r} : {t}" for _, _, r, t in said)
    chat = spark.createDataFrame([(whole,)], "transcript STRING")
    want = evaluate.with_chat_measures(chat, F.col("transcript"), dictionary, lexicon).first()
    assert len(got) == 1 and all(got[0][k] == want[k] for k in ("saludo", "cierre", "_good", "_bad", "words", "sentences"))
    assert got[0]["saludo"] == 30 and got[0]["cierre"] == 1
    turns = evaluate.message_turns(messages, "c", "n", "r", "t").orderBy("place").collect()
    assert [t.place for t in turns] == list(range(46)) and turns[8].speaker == "agent"


def test_unique_names_pass_over_taken_ones(spark):
    names = ["a.txt", "a.txt", "a_1.txt", "a.txt", "a_2.txt", "a_1.txt", "b", "b", None]
    df = spark.createDataFrame(list(enumerate(names)), "i INT, name STRING")
    got = {r.i: r.unique_name for r in matching.unique_names(df, "name", [F.asc("i")]).collect()}
    made = [v for v in got.values() if v is not None]
    assert len(set(made)) == len(made) == 8
    assert got[0] == "a.txt" and got[2] == "a_1.txt" and got[4] == "a_2.txt" and got[7] == "b_1"
    assert {got[1], got[3]} == {"a_3.txt", "a_4.txt"} and got[5] == "a_1_1.txt"


def test_frequent_values_fill_nulls(spark):
    rows = [(i, "x" if i % 4 else "y") for i in range(400)] + [(1000 + i, None) for i in range(400)]
    df = spark.createDataFrame(rows, "k INT, v STRING")
    got = features.impute_by_frequency(df, "v", "k")
    again = features.impute_by_frequency(df.repartition(3), "v", "k")
    assert got.columns == df.columns and got.where("v IS NULL").count() == 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))
    drawn = got.where("k >= 1000 AND v = 'y'").count()
    assert 60 <= drawn <= 140
    assert features.impute_by_frequency(df.where("v IS NULL"), "v", "k").where("v IS NULL").count() == 400
