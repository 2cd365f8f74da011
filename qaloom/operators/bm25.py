"""BM25 ranking of the segments of each group, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import tokens

#: Okapi's parameters; a negative idf becomes EPSILON times the mean idf of the group's vocabulary. Fixed values.
K1, B, EPSILON = 1.5, 0.75, 0.25


def scores(segments: DataFrame, keys: list[str], index: str = "seg_idx", segment: str = "segment", question: str = "question") -> DataFrame:
    """segments with `score`, rounded to 9 decimals: each group (keys) is a corpus of its own, and has one question.
    A question's repeated terms count each time. A group without any term has scores of 0.

    The exploded terms carry their lengths and the question's terms, not the text. One shuffle by group and term counts
    documents for each term, one by group sums up the vocabulary's idf (over all of it, before terms are narrowed to
    the question's); the scores join the segments once.
    """
    own, group = [*keys, index], Window.partitionBy(*keys)
    cut = segments.select(*own, tokens(F.col(segment)).alias("_t"), tokens(F.col(question)).alias("_q")).withColumn("_dl", F.size("_t"))
    cut = cut.withColumns({"_n": F.count("*").over(group), "_avgdl": F.avg("_dl").over(group)})
    terms = cut.select(*own, "_q", "_dl", "_n", "_avgdl", F.explode("_t").alias("_term"))
    asked = F.when(F.array_contains("_q", F.col("_term")), F.size(F.filter("_q", lambda q: q == F.col("_term")))).otherwise(0)
    # a segment's scalars ride along as grouping columns, so that the counts are a hash aggregate
    tf = terms.select(*own, "_dl", "_n", "_avgdl", "_term", asked.alias("_qn")).groupBy(*own, "_dl", "_n", "_avgdl", "_term", "_qn").agg(F.count("*").alias("_tf"))
    counted = tf.withColumn("_df", F.count("*").over(Window.partitionBy(*keys, "_term")))
    plain = counted.withColumn("_idf", F.log(F.col("_n") - F.col("_df") + 0.5) - F.log(F.col("_df") + 0.5))
    mean = plain.withColumn("_mean", F.sum(F.col("_idf") / F.col("_df")).over(group) / F.sum(F.lit(1.0) / F.col("_df")).over(group))
    asked = mean.filter("_qn > 0")
    weight = F.col("_qn") * F.when(F.col("_idf") < 0, EPSILON * F.col("_mean")).otherwise(F.col("_idf"))
    part = weight * F.col("_tf") * (K1 + 1) / (F.col("_tf") + K1 * (1 - B + B * F.col("_dl") / F.col("_avgdl")))
    summed = asked.groupBy(*own).agg(F.sum(part).alias("score"))
    return segments.join(summed, own, "left").withColumn("score", F.round(F.coalesce("score", F.lit(0.0)), 9))


def top_segments(segments: DataFrame, keys: list[str], k: int, index: str = "seg_idx", segment: str = "segment", question: str = "question") -> DataFrame:
    """The k best segments of each group, with their score; ties go to the earlier one. Groups of up to k segments,
    and groups without a question, stay whole; a question or a corpus without terms leaves the first k."""
    ranked = scores(segments, keys, index, segment, question)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), index))
    size = F.count("*").over(Window.partitionBy(*keys))
    blank = F.coalesce(F.col(question), F.lit("")) == ""
    return ranked.withColumns({"_place": place, "_size": size}).filter((F.col("_size") <= k) | blank | (F.col("_place") <= k)).drop("_place", "_size")


def two_stage(segments: DataFrame, key: str, per_document: int = 5, overall: int = 8) -> DataFrame:
    """segments (key, doc_idx, seg_idx, segment, question): the best of each document, and of those, as a new corpus,
    the best of each key; pos is the place among a key's survivors, in document order."""
    first = top_segments(segments, [key, "doc_idx"], per_document).drop("score")
    numbered = first.withColumn("pos", F.row_number().over(Window.partitionBy(key).orderBy("doc_idx", "seg_idx")) - 1)
    second = top_segments(numbered, [key], overall, index="pos").drop("score")
    return second.withColumn("pos", F.row_number().over(Window.partitionBy(key).orderBy("pos")) - 1)
