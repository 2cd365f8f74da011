"""The command line: python -m qaloom acquire|profile|extract IN OUT, each over a table of questions.

IN and OUT are CSV where the name ends in .csv, else Parquet; a report is written beside OUT, as OUT without its ending
plus _report.txt, and logged."""

from __future__ import annotations

import argparse
import logging
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config
from .plans import acquire, extract, profile, report
from .sources.fetch import http_fetcher, pypdf_decoder
from .sources.files import legacy_documents, read_csv_text, write_csv

log = logging.getLogger("qaloom")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table, with row_id (made from the place in the file where it is missing) and documents as a list."""
    if path.endswith(".csv"):
        names = spark.read.options(header="true", quote='"', escape='"', multiLine="true").csv(path).columns
        df = read_csv_text(spark, path, names)
    else:
        df = spark.read.parquet(path)
    if "row_id" not in df.columns:
        df = df.withColumn("row_id", F.monotonically_increasing_id())
    if dict(df.dtypes).get("documents") == "string":
        df = df.withColumn("documents", legacy_documents(F.col("documents")))
    return df


def write(df: DataFrame, path: str) -> None:
    write_csv(df, path, "overwrite") if path.endswith(".csv") else df.write.mode("overwrite").parquet(path)


def beside(path: str) -> str:
    """Where the report of an output goes."""
    name = path.rstrip("/")
    ending = name.rsplit("/", 1)[-1].rpartition(".")
    return (name[: -len(ending[2]) - 1] if ending[0] else name) + "_report.txt"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def run(spark: SparkSession, stage: str, source: str, target: str, config: Config, limit: int | None = None, store: str | None = None, make_fetcher=None) -> str:
    """Run one stage, and return its report."""
    qa = read(spark, source)
    qa = qa.orderBy("row_id").limit(limit) if limit else qa
    if stage == "acquire":
        store = store or target.rstrip("/") + "_fetched"
        done, fetched = acquire.acquire(qa, make_fetcher or http_fetcher(config), pypdf_decoder(), config=config, store=store)
        write(done, target)
        text = report.render_run(acquire.run_report(done, acquire.question_urls(qa), fetched))
    elif stage == "profile":
        done = profile.profile(qa, config=config)
        write(done, target)
        text = report.render_statistics(profile.summary(done), profile.format_histogram(done))
    else:
        done = extract.extract(profile.profile(qa, config=config), config=config)
        write(done, target)
        ratio = extract.fill_ratio(done).first()
        text = f"Passages: {ratio['filled']:,} of {ratio['total']:,} rows\n"
    write_text(spark, beside(target), text)
    log.info("%s", text)
    return text


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="qaloom", description=__doc__)
    parser.add_argument("stage", choices=["acquire", "profile", "extract"])
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--limit", type=int, help="the first rows only")
    parser.add_argument("--store", help="folder of fetched documents, which a restart goes on with")
    for f in fields(Config):
        parser.add_argument("--" + f.name.replace("_", "-"), type=(lambda x: x == "true") if isinstance(f.default, bool) else type(f.default), default=f.default)
    got = vars(parser.parse_args(args))
    logging.basicConfig(level=logging.INFO)
    run(SparkSession.builder.getOrCreate(), got["stage"], got["source"], got["target"], Config(**{f.name: got[f.name] for f in fields(Config)}), got["limit"], got["store"])


if __name__ == "__main__":
    main()
