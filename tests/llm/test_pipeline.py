"""Every stage of the pipeline against plain Python, each on its own input."""

import pytest

import corpus_pipeline
from qaloom.llm import bpe

from .test_models import clusters
from .test_native import FOLD, hits

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).cache()
        out.append(docs)
    return [spark.read.parquet(f"{SMALL}/documents.parquet"), *out]


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_shape(stages):
    assert all(d.columns == stages[0].columns for d in stages[:-1])
    assert set(rows(stages[1])) <= set(rows(stages[0])) and len(rows(stages[1])) > 0.8 * len(rows(stages[0]))


def test_lines(stages):
    before, after = rows(stages[1]), rows(stages[2])
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    seen = {}
    for i, t in before.items():
        for k in {key(x) for x in t.split("\n")}:
            seen.setdefault(k, set()).add(i)
    assert after == {i: "\n".join(x for x in t.split("\n") if not key(x) or len(seen[key(x)]) < 10) for i, t in before.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_near(stages):
    before, after = rows(stages[2]), rows(stages[3])
    assert set(after) == {i for i, (_, _, kept) in clusters(list(before.items()), 80).items() if kept}


def test_leaks(spark, stages):
    before, after = rows(stages[3]), rows(stages[4])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert set(after) == {i for i, t in before.items() if not hits(t, items)[1]}


def test_tokens(stages):
    before, last = rows(stages[4]), stages[5].collect()
    encoding = bpe._encoding(bpe.default_ranks(), bpe.default_pattern())
    assert {r["doc_id"]: (r["ids"], r["n_tokens"], r["text"]) for r in last} == {i: (e := encoding.encode_ordinary(t), len(e), t) for i, t in before.items()}


def test_run(spark, stages):
    assert rows(corpus_pipeline.run(spark, SMALL)) == rows(stages[5])


HARD = "doc_id long, text string, lang string, source string, n_chars long, _text string, _k1 string, node int, score string"


@pytest.fixture(scope="module")
def fixture_dir(spark, tmp_path_factory):
    """Tables of nulls, empty and long texts, ties, repeats and clashing names; and the same tables without rows."""
    own = lambda i, n=40: " ".join(f"w{i}x{j}" for j in range(n))
    leak = own(77, 12)
    docs = [(None, own(1)), (1, None), (1, None), (2, ""), (3, " \n\t"), (4, own(4)), (5, own(4)), (6, own(4)), (6, own(4)), (7, own(7, 200_000)), (8, f"{own(8)} {leak} {own(9)}"), (9, f"{own(10)}\nonly here"), (None, None)]
    docs += [(100 + i, f"Common line \n{own(100 + i)}\n\ncommon LINE") for i in range(10)]
    rows = [(i, t, None, "hot", len(t or ""), "own", "own", 1, "own") for i, t in docs]
    at = str(tmp_path_factory.mktemp("hard"))
    for name, kind, given in (("documents", HARD, rows), ("benchmark", "item_id string, text string", [("a", leak), (None, None), ("b", ""), ("a", leak)]), ("labels", "doc_id long, quality int, toxic int", [(4, 0, 0), (None, 1, 1), (900, 1, 1), (9, None, None), (4, 0, 0)])):
        made = spark.createDataFrame(given, kind)
        made.write.parquet(f"{at}/full/{name}.parquet")
        made.limit(0).write.parquet(f"{at}/none/{name}.parquet")
    return at


def test_hard_rows(spark, fixture_dir):
    at = f"{fixture_dir}/full"
    docs, left = spark.read.parquet(f"{at}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, at).cache()
        left.append([(r["doc_id"], r["text"]) for r in docs.collect()])
        assert docs.columns == (before.columns if len(left) < 5 else ["doc_id", "n_tokens", "ids", "text"])
    given = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{at}/documents.parquet").collect()]
    order = lambda rows: sorted(rows, key=str)
    assert order(left[0]) == order(given)  # one class is labelled: nothing is rejected
    cut = [(i, (t or "").replace("Common line \n", "").replace("\ncommon LINE", "")) for i, t in given]
    assert order(left[1]) == order(cut)
    assert order(left[2]) == order(r for r in cut if r[0] not in (5, 6))
    assert order(left[3]) == order(r for r in cut if r[0] not in (5, 6, 8))
    assert order(left[4]) == order(left[3])


def test_empty_tables(spark, fixture_dir):
    docs = spark.read.parquet(f"{fixture_dir}/none/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, f"{fixture_dir}/none")
        assert docs.count() == 0
    assert corpus_pipeline.run(spark, f"{fixture_dir}/none").columns == ["doc_id", "n_tokens", "ids", "text"]
