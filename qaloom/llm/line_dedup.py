"""Line dedup: lines whose key stands in many documents go, from every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_ascii, join_spread, row_key, settle

#: Bytes of common lines' hashes, at 64 each, up to which they go to every executor; beyond, all lines shuffle to them.
#: The same bound holds for the rows' lists of lines to drop.
HASH_BYTES = 64 << 20
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks `[\\x20\\x09-\\x0D]` at its ends, A-Z lower-cased."""
    return F.btrim(fold_ascii(line), F.lit(BLANKS))


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, with `text` rewritten and n_lines, n_dropped (long) added.

    A text is split at \\n. Keys (line_key) of at least min_chars code points found in at least min_docs rows
    lose all their lines everywhere; the others stay, joined by \\n in their order.

    Null or empty text: one empty line, which stays (its key has no code point); null becomes ''. Each row is a
    document of its own, so repeated rows count each, while a line repeated within one row counts once. Null ids
    are ordinary values. Other columns pass through, whatever their names, but for n_lines and n_dropped, which
    are replaced. An empty table gives an empty table. Texts of any length are split whole.

    Plan: explode the distinct line hashes of each row (128 bits), count with map-side partial sums, keep hashes
    over the threshold and write them down. If their counted number times 64 bytes is within HASH_BYTES, they go to
    every executor, and only lines that are met leave the row, as positions; else the exploded (row, position, hash)
    shuffle to them, a common line's rows dealt to 16 tasks. Positions to drop are gathered by row and joined to the
    texts, again as a broadcast within the bound. Only hashes and positions meet by line. Python runs nowhere.
    """
    extra = [c for c in docs.columns if c not in (id_col, text_col, "n_lines", "n_dropped")]
    kept = F.struct(*[F.col(f"`{c}`") for c in extra]).alias("_rest") if extra else F.lit(None).cast("string").alias("_rest")
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), kept)
    keyed = rows.select("*", *row_key(rows, "_id", "_text"))
    keys = F.transform(F.split("_text", "\n", -1), line_key)
    hashed = F.transform(keys, lambda k: F.when(F.length(k) >= max(1, min_chars), F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit("line"), k).alias("h2"))))
    lines = keyed.select("_k1", "_k2", hashed.alias("_lines"))
    common = (
        lines.select(F.explode(F.array_distinct("_lines")).alias("l"))
        .filter("l is not null").select("l.h1", "l.h2").groupBy("h1", "h2").agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_docs).select("h1", "h2")
    )
    placed = lines.select("_k1", "_k2", F.posexplode("_lines").alias("pos", "l")).filter("l is not null").select("_k1", "_k2", "pos", "l.h1", "l.h2")
    common = settle(common, "common-lines")
    few = common.count() * 64 <= HASH_BYTES
    met = placed.join(F.broadcast(common), ["h1", "h2"]) if few else join_spread(placed, common, ["h1", "h2"], F.col("_k1"), how="inner")
    dropped = settle(met.groupBy("_k1", "_k2").agg(F.collect_set("pos").alias("_drop")), "dropped-lines")
    size = dropped.agg(F.coalesce(F.sum(F.lit(64) + 4 * F.size("_drop")), F.lit(0))).first()[0]
    dropped = F.broadcast(dropped) if size <= HASH_BYTES else dropped
    split = F.split("_text", "\n", -1)
    whole = keyed.join(dropped, ["_k1", "_k2"], "left").withColumn("_split", split)
    none = F.array().cast("array<int>")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_split") - 1), F.coalesce(F.col("_drop"), none))
    text = F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("_split", i)), "\n"))
    made = {id_col: F.col("_id"), text_col: text} | {c: F.col("_rest").getField(c) for c in extra}
    order = [c for c in docs.columns if c in made]
    return whole.select(*[made[c].alias(c) for c in order], F.size("_split").cast("long").alias("n_lines"), F.size(F.coalesce(F.col("_drop"), none)).cast("long").alias("n_dropped"))


def query(docs: DataFrame) -> DataFrame:
    done = drop_common_lines(docs.select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts, row_number() OVER () AS rid FROM documents),
lines AS (SELECT rid, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM cut),
keyed AS (SELECT rid, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT rid) >= 10),
kept AS (SELECT rid, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n FROM keyed WHERE k NOT IN (SELECT k FROM often) GROUP BY rid)
SELECT cut.doc_id, CAST(len(parts) AS BIGINT) AS n_lines, CAST(len(parts) - coalesce(n, 0) AS BIGINT) AS n_dropped, sha256(coalesce(text, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (rid)
"""
