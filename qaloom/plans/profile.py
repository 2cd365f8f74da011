"""Profile: statistics of each question's documents, and of the whole dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.text import answer_position, count_words, real_documents
from ..functions.urls import known_formats, metadata_urls

COLUMNS = ["num_documents", "document_formats", "avg_document_length_words", "answer_found_in_documents", "answer_position_words", "answer_position_chars", "answer_found_in_doc_index"]


def first_answer(documents: Column, answer: Column, config: Config = DEFAULT) -> Column:
    """struct<index, at<words, chars>> of the first document that holds the answer; null if none does."""
    places = F.transform(documents, lambda d, i: F.struct(i.alias("index"), answer_position(answer, d, config).alias("at")))
    return F.get(F.filter(places, lambda p: p["at"].isNotNull()), F.lit(0))


def profile(qa: DataFrame, documents: str = "documents", answer: str = "answer", metadata: str = "metadata", config: Config = DEFAULT) -> DataFrame:
    """qa with the seven COLUMNS, replaced if they are there. Rows without documents get 0, [], 0.0, false and nulls.
    One projection: no shuffle, no Python."""
    real = qa.drop(*COLUMNS).withColumn("_docs", real_documents(F.col(documents)))
    real = real.withColumn("_hit", first_answer(F.col("_docs"), F.col(answer), config))
    n = F.size("_docs")
    words = F.aggregate("_docs", F.lit(0).cast("long"), lambda z, d: z + count_words(d))
    return real.withColumns({
        "num_documents": n,
        "document_formats": F.when(n > 0, known_formats(metadata_urls(F.col(metadata)))).otherwise(F.array().cast("array<string>")),
        "avg_document_length_words": F.coalesce(F.try_divide(words.cast("double"), n), F.lit(0.0)),
        "answer_found_in_documents": F.col("_hit").isNotNull(),
        "answer_position_words": F.col("_hit.at.words"), "answer_position_chars": F.col("_hit.at.chars"), "answer_found_in_doc_index": F.col("_hit.index"),
    }).drop("_docs", "_hit")


def spread(value: Column, name: str) -> list[Column]:
    """Mean, exact median, maximum and minimum; 0 where there is nothing."""
    return [F.coalesce(f(value).cast("double"), F.lit(0.0)).alias(f"{name}_{f.__name__}") for f in (F.avg, F.median, F.max, F.min)]


def summary(profiled: DataFrame) -> DataFrame:
    """One row: the dataset's statistics, in one aggregate."""
    long = F.col("avg_document_length_words")
    n = F.count("*")
    return profiled.agg(
        n.alias("rows"), *spread(F.col("num_documents"), "documents"), F.coalesce(F.stddev_samp("num_documents"), F.lit(0.0)).alias("documents_sd"),
        F.count_if(F.col("num_documents") == 0).alias("without_documents"), F.try_divide(100.0 * F.count_if(F.col("num_documents") == 0), n).alias("without_documents_percent"),
        *spread(F.when(long > 0, long), "length"),
        F.count_if("answer_found_in_documents").alias("answers_found"), F.try_divide(100.0 * F.count_if("answer_found_in_documents"), n).alias("answers_found_percent"),
        *spread(F.col("answer_position_words"), "position"),
    )


def format_histogram(profiled: DataFrame, formats: str = "document_formats") -> DataFrame:
    """format, n, percent of all entries. Known formats count once a URL, 'unknown' once a row."""
    counted = profiled.select(F.explode(formats).alias("format")).groupBy("format").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("_total"))  # one row
    return counted.join(F.broadcast(total), F.lit(True)).select("format", "n", (100.0 * F.col("n") / F.col("_total")).alias("percent"))
