"""Extract: the passage that supports each answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.text import contains_answer, context_window, count_words, find, paragraph_at, real_documents, segments, strip
from ..operators.bm25 import two_stage
from ..operators.judge import Judge, pick


def fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that the optimizer evaluates once: it copies a projection's expressions into every filter and
    projection above it, which doubles them at each step, but never through a generator."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def known_passage(qa: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """qa with _passage: around the known place of the answer, or around its first occurrence; null without one."""
    docs, answer, place, index = F.col("_docs"), F.col("_answer"), F.col("answer_position_chars"), F.col("answer_found_in_doc_index")
    known = F.col("answer_found_in_documents") & place.isNotNull() & index.isNotNull()
    seen = fixed(qa, _doc=F.when(known & (index >= 0) & (index < F.size(docs)), F.get(docs, index)))
    seen = fixed(seen, _near=paragraph_at(F.col("_doc"), place, config), _window=context_window(F.col("_doc"), answer, place, config))
    fit = count_words(F.col("_near")) <= config.max_paragraph_words
    seen = fixed(seen, _first=F.when(F.col("_doc").isNotNull(), F.when(F.col("_near").isNotNull() & fit, F.col("_near")).otherwise(F.col("_window"))))
    seen = fixed(seen, _other=F.when(known & (F.coalesce("_first", F.lit("")) == ""), F.get(F.filter(docs, lambda d: contains_answer(answer, d)), F.lit(0))))
    seen = fixed(seen, _spot=find(answer, F.col("_other")))
    seen = fixed(seen, _far=F.when(F.col("_other").isNotNull(), F.coalesce(paragraph_at(F.col("_other"), F.col("_spot"), config), context_window(F.col("_other"), answer, F.col("_spot"), config))))
    passage = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("_first", "_far")])
    return fixed(seen, _passage=passage).drop("_doc", "_near", "_window", "_first", "_other", "_spot", "_far")


def document_segments(qa: DataFrame, key: str, question: str = "_question", config: Config = DEFAULT) -> DataFrame:
    """key, question, doc_idx, seg_idx, segment."""
    docs = qa.select(key, F.col(question).alias("question"), F.posexplode("_docs").alias("doc_idx", "doc"))
    return docs.select(key, "question", "doc_idx", F.posexplode(segments(F.col("doc"), config)).alias("seg_idx", "segment"))


def extract(qa: DataFrame, key: str = "row_id", make_judge: Callable[[], Judge] | None = None, config: Config = DEFAULT) -> DataFrame:
    """qa (with documents and the profile's columns) with long_answer: '' where there is nothing to choose from.

    Rows whose answer has a known place are a projection. Only the others are cut into segments and ranked, which
    shuffles by question; the judge sees one row for each of those, with a few segments.
    """
    text = lambda c: strip(F.coalesce(F.col(c), F.lit("")))
    ready = qa.drop("long_answer").withColumns({"_docs": real_documents(F.col("documents")), "_question": text("problem"), "_answer": text("answer")})
    able = (F.size("_docs") > 0) & (F.col("_question") != "")
    seen = known_passage(ready, config)
    open_rows = seen.filter(able & F.col("_passage").isNull())
    best = two_stage(document_segments(open_rows, key, config=config), key, config.segments_per_document, config.segments_for_judge)
    listed = best.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "segment"))), lambda x: x["segment"]).alias("segments"))
    asked = open_rows.select(key, "problem", "answer").join(listed, key)
    chosen = asked.select(key, pick(asked, make_judge, config=config).alias("_chosen"))
    joined = seen.join(chosen, key, "left")
    found = F.coalesce(F.when(able, F.coalesce("_passage", "_chosen")), F.lit(""))
    return joined.withColumn("long_answer", found).drop("_docs", "_question", "_answer", "_passage", "_chosen")


def fill_ratio(done: DataFrame) -> DataFrame:
    return done.agg(F.count_if(F.col("long_answer") != "").alias("filled"), F.count("*").alias("total"))
