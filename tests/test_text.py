import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qaloom.config import Config
from qaloom.functions import html, text

LETTERS = st.text(st.sampled_from(list("ab .!?。\n\t\x1c\x85 İéX'")), max_size=60)
SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def run(spark, rows, **columns):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, " + ", ".join(f"c{k} {t}" for k, t in enumerate(columns.pop("types", ["string"] * len(rows[0])))))
    return [tuple(r) for r in df.select("i", *[c.alias(n) for n, c in columns.items()]).orderBy("i").drop("i").collect()]


@SLOW
@given(st.lists(LETTERS, min_size=20, max_size=40))
def test_words_strip_and_paragraphs_are_pythons(spark, texts):
    got = run(spark, [(t,) for t in texts], n=text.count_words(F.col("c0")), s=text.strip(F.col("c0")), p=text.paragraphs(F.col("c0")), f=text.flatten_lines(F.col("c0")))
    for t, (n, s, p, f) in zip(texts, got, strict=True):
        assert n == len(t.split()) and s == t.strip()
        assert p == [x.strip() for x in t.split("\n\n") if x.strip()]
        assert f == " ".join(x for line in t.splitlines() for x in (y.strip() for y in line.strip().split("  ")) if x)


@SLOW
@given(st.lists(st.integers(0, 60), min_size=10, max_size=20))
def test_chunks_end_once_the_end_is_covered(spark, sizes):
    config = Config(chunk_words=10, overlap_words=3)
    texts = [" ".join(f"w{i}" for i in range(n)) for n in sizes]
    for t, (got,) in zip(texts, run(spark, [(t,) for t in texts], c=text.chunks(F.col("c0"), config)), strict=True):
        w, want = t.split(), []
        for i in range(0, len(w), 7):
            want.append(" ".join(w[i : i + 10]))
            if i + 10 >= len(w):
                break
        assert got == want


def window(document, answer, pos, config):
    start, end = max(0, pos - config.context_chars), min(len(document), pos + len(answer) + config.context_chars)
    low, high = start, end
    if start > 0:
        before = document[max(0, start - config.extension_chars) : start]
        for s in text.SENTENCE_ENDS:
            if s in before:
                low = max(0, start - config.extension_chars + before.rfind(s) + 1)
                break
    if end < len(document):
        for s in text.SENTENCE_ENDS:
            k = document[end : end + config.extension_chars].find(s)
            if k >= 0:
                high = end + k + 1
                break
    return document[low:high].strip() if document else ""


@SLOW
@given(st.lists(st.tuples(LETTERS, st.integers(0, 50)), min_size=20, max_size=40))
def test_context_window(spark, rows):
    config = Config(context_chars=8, extension_chars=6)
    got = run(spark, [(t, min(p, len(t))) for t, p in rows], types=["string", "int"], w=text.context_window(F.col("c0"), F.lit("ab"), F.col("c1"), config))
    for (t, p), (w,) in zip(rows, got, strict=True):
        assert w == window(t, "ab", min(p, len(t)), config)


def test_answer_position_and_its_blank_answer(spark):
    rows = [(" X ", "no x here"), ("zzq", "x"), (None, "x"), ("x", None), ("  ", "a"), ("İ", "aİ b")]
    at = text.answer_position(F.col("c0"), F.col("c1"))
    got = run(spark, rows, w=at["words"], c=at["chars"])
    assert got[:5] == [(1, 3), (None, None), (None, None), (None, None), (None, None)] and got[5][1] == 1
    compat = text.answer_position(F.col("c0"), F.col("c1"), Config(blank_answer_found=True))
    assert run(spark, rows, c=compat["chars"])[4] == (0,)


def test_paragraph_modes(spark):
    doc = "\n\n\n\n".join("abcdefghi" + chr(97 + i) for i in range(14))
    got = run(spark, [(doc,)], drift=text.paragraph_at(F.col("c0"), F.lit(140)), exact=text.paragraph_at(F.col("c0"), F.lit(140), Config(paragraph_mode="exact")))
    assert got == [("abcdefghil", "abcdefghik")]
    assert run(spark, [("one",)], p=text.paragraph_at(F.col("c0"), F.lit(0))) == [(None,)]


def test_segments_choose(spark):
    long = " ".join(["w"] * 601)
    rows = [("a\n\n\nb",), ("a",), (f"a\n\n{long}",), ("",), (None,)]
    got = [s for (s,) in run(spark, rows, s=text.segments(F.col("c0")))]
    assert got[0] == ["a", "b"] and got[1] == ["a"] and len(got[2]) == 2 and got[3] == [] and got[4] == []


@pytest.mark.parametrize(("reply", "choice"), [("2", 1), ("0", -1), ("9", 0), ("none", 0), ("chunk 3.", 2), ("99999999999", 0)])
def test_reply(spark, reply, choice):
    assert run(spark, [(reply,)], k=text.reply_choice(F.col("c0"), F.lit(3))) == [(choice,)]


def test_html(spark):
    page = "<html><head><style>p{}</style><script>var t='</p>';</script></head><body><!-- c --><p>a\tb   c</p>x &amp; y<br>z</body></html>"
    got = run(spark, [(page,), (None,)], a=html.html_text(F.col("c0")), b=html.native(F.col("c0")), c=html.html_paragraphs(F.col("c0")))
    assert got[0] == ("a\tb cx & yz", "a\tb cx & yz", "a\tb   c\n\n\n\nx & y\n\nz") and got[1] == (None, None, None)


def test_tokens(spark):
    (got,) = run(spark, [("Ab_1 é² x-y İ",)], t=text.tokens(F.col("c0")))
    assert got[0][:4] == ["ab_1", "é²", "x", "y"] and re.match("i", got[0][4])
