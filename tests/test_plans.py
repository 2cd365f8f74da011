import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from qaloom.config import Config
from qaloom.operators.bm25 import scores, top_segments
from qaloom.operators.contains_join import contains_join
from qaloom.operators.judge import confirmed
from qaloom.plans import acquire, extract, profile, report
from qaloom.plans.catalogue import fake_fetcher, fake_judge, fake_pdf
from qaloom.sources import files
from qaloom.streaming import ingest

QUICK = Config(delay_seconds=0.0)


def questions(spark):
    rows = [
        (1, '{"urls": ["http://h/a.pdf", "http://h/page"]}', "who is it", "Bob", ["", "It was bob. He ran.", "bob"]), (2, None, "what is that", "zzq", ["first thing\n\nsecond that is\n\nthird"]),
        (3, "{'urls': ['http://h/x.txt']}", "q", None, []), (4, "[1]", "", "a", ["a"]), (5, None, "q", " ", None),
    ]
    return spark.createDataFrame(rows, "row_id long, metadata string, problem string, answer string, documents array<string>")


def test_profile(spark):
    got = {r["row_id"]: r for r in profile.profile(questions(spark)).collect()}
    one = got[1]
    assert (one["num_documents"], one["document_formats"], one["avg_document_length_words"]) == (2, ["pdf"], 3.0)
    assert (one["answer_found_in_doc_index"], one["answer_position_words"], one["answer_position_chars"]) == (0, 2, 7)
    assert got[2]["document_formats"] == ["unknown"] and not got[2]["answer_found_in_documents"]
    assert got[3]["num_documents"] == 0 and got[3]["document_formats"] == [] and got[5]["num_documents"] == 0
    again = profile.profile(profile.profile(questions(spark)))
    assert again.columns == profile.profile(questions(spark)).columns


def test_summary_and_report(spark):
    done = profile.profile(questions(spark))
    one, histogram = profile.summary(done), profile.format_histogram(done)
    r = one.first()
    assert (r["rows"], r["without_documents"], r["answers_found"], r["documents_max"]) == (5, 2, 2, 2.0)
    assert "Rows: 5" in report.render_statistics(one, histogram)
    assert profile.summary(done.limit(0)).first()["documents_avg"] == 0.0
    assert profile.summary(done.limit(1)).first()["documents_sd"] == 0.0


def test_extract(spark):
    got = {r["row_id"]: r["long_answer"] for r in extract.extract(profile.profile(questions(spark))).collect()}
    assert got == {1: "It was bob. He ran.", 2: "first thing", 3: "", 4: "", 5: ""}
    judged = {r["row_id"]: r["long_answer"] for r in extract.extract(profile.profile(questions(spark)), make_judge=lambda: lambda q, a, s: "2").collect()}
    assert judged[2] == "second that is" and judged[1] == got[1]
    assert extract.fill_ratio(extract.extract(profile.profile(questions(spark)))).first() == (2, 5)


def okapi(corpus, query):
    tokens = [re.findall(r"\w+", s.lower()) for s in corpus]
    n, avg = len(tokens), sum(map(len, tokens)) / len(tokens)
    df = Counter(t for ts in tokens for t in set(ts))
    idf = {t: math.log(n - d + 0.5) - math.log(d + 0.5) for t, d in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {t: v if v >= 0 else 0.25 * mean for t, v in idf.items()}
    return [sum(idf.get(t, 0) * ts.count(t) * 2.5 / (ts.count(t) + 1.5 * (0.25 + 0.75 * len(ts) / avg)) for t in re.findall(r"\w+", query.lower())) for ts in tokens]


def test_bm25(spark):
    corpus = ["a b c", "a a d", "b b b e f", "a", "", "g h a b", "z"]
    rows = spark.createDataFrame([(k, i, s, q) for k, q in enumerate(["a b b", "???", None]) for i, s in enumerate(corpus)], "g int, seg_idx int, segment string, question string")
    got = {(r["g"], r["seg_idx"]): r["score"] for r in scores(rows, ["g"]).collect()}
    assert all(abs(got[0, i] - s) < 1e-6 for i, s in enumerate(okapi(corpus, "a b b")))
    top = top_segments(rows, ["g"], 3).collect()
    want = sorted(sorted(range(7), key=lambda i: (-round(okapi(corpus, "a b b")[i], 9), i))[:3])
    assert sorted(r["seg_idx"] for r in top if r["g"] == 0) == want
    assert sorted(r["seg_idx"] for r in top if r["g"] == 1) == [0, 1, 2] and len([r for r in top if r["g"] == 2]) == 7


def test_contains_join(spark):
    long = "x" * 300 + "Needle in here" + "y" * 300
    texts = spark.createDataFrame([(1, "A party of art"), (2, long), (3, None), (4, ""), (5, "ab" * 200)], "id int, text string")
    needles = spark.createDataFrame([("n1", "ART"), ("n2", "needle in here"), ("n3", ""), ("n4", None), ("n5", "a"), ("n6", "ab" * 150)], "nid string, needle string")
    got = {(r["id"], r["nid"]): r["chars"] for r in contains_join(texts, needles).collect()}
    want = {}
    for i, t in [(1, "A party of art"), (2, long), (5, "ab" * 200)]:
        for k, n in [("n1", "art"), ("n2", "needle in here"), ("n5", "a"), ("n6", "ab" * 150)]:
            if n in t.lower():
                want[i, k] = t.lower().find(n)
    assert got == want
    assert contains_join(texts, needles.limit(0)).count() == 0


def test_acquire(spark):
    qa = spark.createDataFrame(
        [(1, '{"urls": ["http://h/b.txt", "http://h/a.pdf", "http://h/b.txt", "https://en.wikipedia.org/wiki/T"]}'), (2, "none here"), (3, '{"urls": ["http://h/bad9"]}')], "row_id long, metadata string"
    )
    done, log = acquire.acquire(qa, fake_fetcher, fake_pdf, config=QUICK)
    got = {r["row_id"]: r["documents"] for r in done.collect()}
    assert len("http://h/bad9") % 7 != 0 and got[2] == []
    kept = [f"{k} {u}" for k, u in (("txt", "http://h/b.txt"), ("pdf", "http://h/a.pdf"), ("txt", "http://h/b.txt")) if len(u) % 7]
    assert got[1] == [*kept, "T\n\n\n\ntwo"]
    r = acquire.run_report(done, acquire.question_urls(qa), log).first()
    assert r["lookups"] == 5 and r["total_requests"] == 4 and r["cached_requests"] == 1 and r["api_success"] == 1
    assert r["ok_rows"] + r["failed_rows"] == r["total_rows"] and r["successful_downloads"] + r["failed_downloads"] == r["total_requests"]
    assert "Requests: 4" in report.render_run(acquire.run_report(done, acquire.question_urls(qa), log))


def test_csv_and_restart(spark, tmp_path):
    rows = [(1, 'quo"te, and\nnewline', " lead "), (2, "NA", None), (3, "", "x")]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    files.write_csv(df, str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), "id int, a string, b string", parts=2)
    assert sorted(map(tuple, back.collect()))[:2] == rows[:2] and back.count() == 3
    files.checkpoint_batch(df.filter("id < 3"), str(tmp_path / "done"), 0)
    assert [r["id"] for r in files.remaining(df, spark.read.parquet(str(tmp_path / "done")), "id").collect()] == [3]
    path = str(tmp_path / "swap")
    files.replace_parquet(df, path)
    files.replace_parquet(spark.read.parquet(path).filter("id = 1"), path)
    assert spark.read.parquet(path).count() == 1
    cells = spark.createDataFrame([("['a', ' ', 'b\"c']",), ('["x", "it\'s"]',), ("plain text",), ("'one'",), ("[]",), (None,), ("5",)], "c string")
    assert [r[0] for r in cells.select(files.legacy_documents(F.col("c"))).collect()] == [["a", 'b"c'], ["x", "it's"], ["plain text"], ["one"], [], [], []]
    assert [r[0] for r in cells.select(files.legacy_documents(F.col("c"), strict=True)).collect()][2] == []


def test_judge(spark):
    rows = spark.createDataFrame([("q", "a", "p")], "problem string, answer string, passage string")
    assert rows.select(confirmed(lambda: lambda q, a, s: "Yes.", "problem", "answer", "passage")).first()[0] is True
    assert fake_judge()("q", "a", []) == "2"


def test_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"url": "http://h/b.txt", "ts": "2024-01-01T00:00:00"}\n{"url": "http://h/b.txt", "ts": "2024-01-01T00:01:00"}\n{"url": "http://h/cc.txt", "ts": "2024-01-01T00:02:00"}\n')
    asked = ingest.questions(spark, str(folder), "url string, ts timestamp")
    query = ingest.fetch_stream(ingest.new_urls(asked), fake_fetcher, str(tmp_path / "out"), str(tmp_path / "state"), fake_pdf, QUICK)
    query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).select("url").distinct().count() == spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_every_query_has_rows_and_names(spark):
    import __spark_entry__ as entry

    assert {k for k in entry.oracle_sql()} <= {k for k in entry.queries()}
    assert entry.entry(spark).columns == ["row_id", "long_answer"]


def test_contains_join_keeps_repeated_rows(spark):
    from qaloom.operators.contains_join import contains_join

    texts = spark.createDataFrame([(None, "xx The Needle in hay"), (None, "xx The Needle in hay"), (1, None), (2, ""), (3, "a long needle that is well beyond an anchor, truly")], "id long, text string")
    needles = spark.createDataFrame([("n", "needle"), ("n", "needle"), (None, ""), ("l", "NEEDLE that is well beyond an anchor")], "name string, needle string")
    got = sorted((str(r["id"]), r["name"], r["chars"]) for r in contains_join(texts, needles).collect())
    assert got == [("3", "l", 7), ("3", "n", 7), ("3", "n", 7), *[("None", "n", 7)] * 4]


def test_replace_keeps_old_data_if_the_swap_fails(spark, tmp_path, monkeypatch):
    from qaloom.sources import files

    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    files.replace_parquet(spark.read.parquet(path).selectExpr("id + 1 AS id"), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [1, 2, 3] and len(list(tmp_path.iterdir())) == 1
    (tmp_path / "blocked").write_text("a file where a folder must go")
    with pytest.raises(Exception):
        files.replace_parquet(spark.range(2), str(tmp_path / "blocked" / "x"))
    files.checkpoint_batch(spark.range(2), str(tmp_path / "batches"), 0)
    files.checkpoint_batch(spark.range(2), str(tmp_path / "batches"), 0)
    assert spark.read.parquet(str(tmp_path / "batches")).count() == 2


def test_command_line(spark, tmp_path):
    from qaloom import __main__ as line
    from qaloom.config import Config
    from qaloom.plans.catalogue import fake_fetcher
    from qaloom.sources.files import write_csv

    rows = [(1, '{"urls": ["http://h/some.txt", "http://h/other.html"]}', "Which?", "h/other"), (2, None, "What?", "x")]
    write_csv(spark.createDataFrame(rows, "row_id long, metadata string, problem string, answer string"), str(tmp_path / "in.csv"))
    config = Config(delay_seconds=0.0)
    a, b, c = (str(tmp_path / n) for n in ("a.csv", "b.parquet", "c.parquet"))
    text = line.run(spark, "acquire", str(tmp_path / "in.csv"), a, config, make_fetcher=fake_fetcher)
    assert "Rows: 2; with documents: 1" in text and (tmp_path / "a_report.txt").read_text() == text

    def never():
        raise AssertionError("asked again")

    assert line.run(spark, "acquire", str(tmp_path / "in.csv"), a, config, make_fetcher=lambda: lambda u, p: never()) [22:] != ""
    assert "Rows: 2" in line.run(spark, "profile", a, b, config)
    assert line.run(spark, "extract", b, c, config) == "Passages: 1 of 2 rows\n"
    assert {r["row_id"]: bool(r["long_answer"]) for r in spark.read.parquet(c).collect()} == {"1": True, "2": False}
