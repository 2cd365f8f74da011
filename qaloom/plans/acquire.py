"""Acquire: metadata to URLs to documents, with a run report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.urls import metadata_urls, valid_urls
from ..sources.fetch import Fetcher, PdfDecoder, fetch
from ..sources.files import checkpoint_batch, remaining


def question_urls(qa: DataFrame, key: str = "row_id", metadata: str = "metadata") -> DataFrame:
    """key, url_idx, url: the valid URLs of each row, in order, repeats included."""
    return qa.select(key, F.posexplode(valid_urls(metadata_urls(F.col(metadata)))).alias("url_idx", "url"))


def with_documents(qa: DataFrame, fetched: DataFrame, key: str = "row_id", metadata: str = "metadata") -> DataFrame:
    """qa with documents: the texts of its URLs that could be fetched, in URL order; [] if there are none."""
    asked = question_urls(qa, key, metadata)
    texts = asked.join(fetched.filter("text is not null").select("url", "text"), "url")
    listed = texts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("url_idx", "text"))), lambda x: x["text"]).alias("documents"))
    return qa.drop("documents").join(listed, key, "left").withColumn("documents", F.coalesce("documents", F.array().cast("array<string>")))


def acquire(qa: DataFrame, make_fetcher: Callable[[], Fetcher], pdf: PdfDecoder | None = None, key: str = "row_id", metadata: str = "metadata", config: Config = DEFAULT, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """qa with documents, and the log of fetches: a row for each distinct URL.

    With store, a folder, the log is written there and read back, so the network is asked once; a restart asks only for
    URLs that no earlier batch in the folder has. Without it, write the log before using both, or the network is asked
    twice.
    """
    asked = question_urls(qa, key, metadata)
    if store is None:
        log = fetch(asked, make_fetcher, pdf, config)
    else:
        spark, number = qa.sparkSession, 0
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            done = spark.read.parquet(store)
            number, asked = done.agg(F.max("batch_id")).first()[0] + 1, remaining(asked, done, "url")
        checkpoint_batch(fetch(asked, make_fetcher, pdf, config), store, number)
        log = spark.read.parquet(store).drop("batch_id")
    return with_documents(qa, log, key, metadata), log


def run_report(qa: DataFrame, asked: DataFrame, fetched: DataFrame, documents: str = "documents") -> DataFrame:
    """One row of counts: questions with and without documents, lookups, those answered by an earlier one, fetches
    that gave text or not, and how the encyclopedia's API did."""
    rows = qa.agg(F.count("*").alias("total_rows"), F.count_if(F.coalesce(F.size(documents), F.lit(0)) <= 0).alias("failed_rows"))
    lookups = asked.filter("url is not null").agg(F.count("*").alias("lookups"))
    log = fetched.agg(
        F.count("*").alias("total_requests"), F.count_if("ok").alias("successful_downloads"), F.count_if(~F.col("ok")).alias("failed_downloads"),
        F.count_if("via_api").alias("api_requests"), F.count_if("api_ok").alias("api_success"),
    )
    one = rows.join(lookups, F.lit(True)).join(log, F.lit(True))  # one row each
    percent = lambda a, b: F.try_divide(100.0 * F.col(a), F.col(b))
    counted = one.withColumns({"ok_rows": F.col("total_rows") - F.col("failed_rows"), "cached_requests": F.col("lookups") - F.col("total_requests")})
    return counted.withColumns({"failed_percent": percent("failed_rows", "total_rows"), "cache_efficiency": percent("cached_requests", "lookups")})
