"""CSV and Parquet: reading, writing, replacing, restarting."""

from __future__ import annotations

import ast
import json
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_CSV = {"header": "true", "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: str | StructType, parts: int | None = None) -> DataFrame:
    """Cells may hold quotes, commas and newlines; only an unquoted empty cell is null. A file of such cells is one
    split, so `parts` deals its rows out."""
    read = spark.read.schema(schema).options(**_CSV, multiLine="true", nullValue="", emptyValue="", maxCharsPerColumn="-1", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    return read.repartition(parts) if parts else read


def read_csv_text(spark: SparkSession, path: str, names: list[str], parts: int | None = None) -> DataFrame:
    """The same with every column a string."""
    return read_csv(spark, path, ", ".join(f"`{n}` string" for n in names), parts)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Arrays and structs become JSON; white space stays."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(f"`{c}`") for c, t in df.dtypes]
    df.select(*flat).write.mode(mode).options(**_CSV, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", nullValue="", emptyValue='""').csv(path)


def replace_parquet(df: DataFrame, path: str) -> None:
    """Write df where it may come from: to a staging folder beside it, then swapped in."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    staging, old = f"{path.rstrip('/')}.{uuid.uuid4().hex}", f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    df.write.parquet(staging)
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    move = lambda a, b: fs.rename(jvm.org.apache.hadoop.fs.Path(a), jvm.org.apache.hadoop.fs.Path(b))
    there = fs.exists(at)
    # rename tells failure by its result; the old data goes last, when the new is in its place
    if there and not move(path, old):
        raise OSError(f"{path} could not be set aside; the new data is in {staging}")
    if not move(staging, path):
        if there and not move(old, path):
            raise OSError(f"{path} could not be replaced; its data is in {old}, the new in {staging}")
        raise OSError(f"{path} could not be replaced and is as it was; the new data is in {staging}")
    if there:
        fs.delete(jvm.org.apache.hadoop.fs.Path(old), True)


def remaining(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a restart still has to do."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def checkpoint_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a finished batch as its own partition of path, so that a repeated one replaces itself; remaining() reads
    them all."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def _legacy(cell, strict: bool) -> list[str]:
    """A cell that holds a list's repr, JSON or one text. strict: only lists and literal strings count."""
    if not isinstance(cell, str) or cell.strip() in ("", "[]", "''", '""'):
        return []
    kept = lambda xs: [str(x) for x in xs if x and str(x).strip()]
    text = cell if strict else cell.strip()
    for read in (ast.literal_eval, json.loads):
        try:
            value = read(text)
        except Exception:
            continue
        if isinstance(value, list):
            return kept(value)
        if isinstance(value, str) and read is ast.literal_eval and value.strip():
            return [value.strip() if strict else value]
        return []
    return [] if strict else [text]


def legacy_documents(cell: Column, strict: bool = False) -> Column:
    """Documents of a legacy CSV cell; strict drops what isn't a list or a literal, where the default keeps it as one
    document. A pandas UDF, as only Python reads its own repr."""

    @F.pandas_udf("array<string>")
    def parsed(cells: pd.Series) -> pd.Series:
        return cells.map(lambda c: _legacy(c, strict))

    return parsed(cell)
