"""What the operators of this subpackage share: tables, tables written to the shared folder, ASCII folding."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where the setting is absent: a temporary folder in
    local mode, as in tests; on a cluster, other machines couldn't see one, so that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        named = tempfile.mkdtemp(prefix="qaloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


_of_thread = threading.local()


def _written() -> list[str]:
    """The paths that this thread has settled and not swept: queries of other threads keep theirs."""
    if not hasattr(_of_thread, "paths"):
        _of_thread.paths = []
    return _of_thread.paths


def settled() -> int:
    """How many tables this thread has settled and not swept."""
    return len(_written())


def sweep(spark: SparkSession, since: int, keep: DataFrame) -> None:
    """Delete what this thread has settled after the first `since` tables, but for what keep reads. For callers who know that
    nothing else waits to be computed from those, such as a pipeline whose stage has been written."""
    inputs = keep.inputFiles()
    for path in [p for p in _written()[since:] if not any(f"/{p.rsplit('/', 1)[-1]}/" in x for x in inputs)]:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _written().remove(path)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage ends there, so a lost executor costs only
    the tasks that read it, and Python work before it is never repeated."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/qaloom-{name}-{uuid.uuid4().hex}"
    _written().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int, each: int = 50_000) -> DataFrame:
    """df in no more partitions than so many rows need: what is small is then read, and joined, as small."""
    return df.coalesce(rows // each + 1) if rows // each + 1 < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def settle_by(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """settle, with the rows in so many buckets by column: what joins or groups them by column later doesn't
    shuffle them again. The catalogue forgets the table at once: it names it only while buckets are read from it."""
    name = f"qaloom_{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}"
    _written().append(path)
    df.write.format("parquet").option("path", path).bucketBy(buckets, column).saveAsTable(name)
    table = df.sparkSession.table(name)
    df.sparkSession.sql(f"DROP TABLE `{name}`")  # of a table with a path of its own, the files stay
    return table


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only. lower() does just that, and fast, where every character is one byte long."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo modulus; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def row_key(df: DataFrame, *columns: str) -> list[Column]:
    """128 bits that identify a row by content, so that null and repeated ids do no harm."""
    given = [F.col(c) for c in columns]
    return [F.xxhash64(*given).alias("_k1"), F.xxhash64(F.lit("second"), *given[::-1]).alias("_k2")]


def join_spread(rows: DataFrame, side: DataFrame, keys: list[str], spread: Column, salts: int = 16, how: str = "left") -> DataFrame:
    """rows joined with side, which has a row for each key: a key's rows are dealt to so many tasks by spread, and
    side's row goes to each. Both sides are shuffled for this join alone, so AQE can split what is still too large."""
    salted = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).join(salted, [*keys, "_salt"], how).drop("_salt")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once: inside a lambda a plain expression would be evaluated for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Entries of a block in running(); its cost grows with n * BLOCK and with the square of n / BLOCK.
BLOCK = 256


def running(steps: Column) -> Column:
    """The sums of the entries before each, of an array of numbers: an array of long, as long as steps. Appending to a
    list copies it, so entries are summed in blocks, then the blocks, and both are laid together."""
    zero = F.array().cast("array<bigint>")
    grown = F.struct(F.lit(0).cast("long").alias("at"), zero.alias("sums"))
    push = lambda z, x: F.struct((z["at"] + x).alias("at"), F.concat(z["sums"], F.array(z["at"])).alias("sums"))

    def laid(given: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(given) - 1) / BLOCK).cast("int"))
        blocks = F.transform(starts, lambda b: F.aggregate(F.slice(given, b * BLOCK + 1, BLOCK), grown, push))
        whole = lambda own: let(F.aggregate(F.transform(own, lambda b: b["at"]), grown, push), lambda t: F.flatten(F.zip_with(own, t["sums"], lambda b, o: F.transform(b["sums"], lambda x: x + o))))
        return let(blocks, whole)

    return F.when(F.size(steps) > 0, let(F.transform(steps, lambda x: x.cast("long")), laid)).otherwise(zero)


def values(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table of numbers, strings and nulls, as SQL VALUES: no Python runs for it."""
    told = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    names = ", ".join(c.split()[0] for c in schema.split(", "))
    table = spark.sql(f"SELECT * FROM VALUES {', '.join('(' + ', '.join(map(told, r)) + ')' for r in rows)} AS t({names})")
    return table.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")])
