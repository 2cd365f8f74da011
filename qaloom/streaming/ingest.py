"""Questions that arrive as files: each micro-batch is acquired and appended, and no URL is fetched twice in a while."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..config import DEFAULT, Config
from ..plans.profile import profile
from ..sources.fetch import Fetcher, PdfDecoder, fetch

QUESTIONS = "row_id long, metadata string, problem string, answer string, ts timestamp"


def questions(spark: SparkSession, folder: str, schema: str = QUESTIONS, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def new_urls(asked: DataFrame, delay: str = "1 hour") -> DataFrame:
    """url, ts: each URL once within the watermark's delay. asked: a stream of url, ts."""
    return asked.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["url"])


def fetch_stream(urls: DataFrame, make_fetcher: Callable[[], Fetcher], path: str, checkpoint: str, pdf: PdfDecoder | None = None, config: Config = DEFAULT, once: bool = True) -> StreamingQuery:
    """Append the fetches of each micro-batch to path, under its batch number: a repeated batch replaces its own rows."""

    def write(batch: DataFrame, number: int) -> None:
        fetch(batch, make_fetcher, pdf, config).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = urls.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def profile_stream(qa: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """The profile's columns, row by row, as questions with documents arrive."""
    writer = profile(qa).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def hourly_found(profiled: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Rows and found answers by hour of arrival."""
    return profiled.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour").alias("hour")).agg(F.count("*").alias("rows"), F.count_if("answer_found_in_documents").alias("found"))
