"""A join on substrings: which texts hold which needles, and where first, without a nested loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of an anchor, and the distance between the anchors of a text.
ANCHOR, STRIDE = 12, 16


def contains_join(texts: DataFrame, needles: DataFrame, text: str = "text", needle: str = "needle") -> DataFrame:
    """Inner join of texts and needles on contains(lower(text), lower(needle)), with chars: the 0-based place of the
    first occurrence in the lower-cased text. Empty and null needles and null texts match nothing. Columns of both
    sides stay; their names must differ. Rows that repeat, with or without ids, are rows like any other.

    A text gives an anchor of ANCHOR characters at every STRIDE-th place. A long needle, wherever it lies, covers one of
    these places with one of its first STRIDE anchors, so an equi-join on anchors finds every candidate, and locate()
    confirms them. Anchors carry 128-bit hashes of the texts and needles only; a text meets its needles once. Needles too short for that are met at every place, by as many first characters as they have, up
    to ANCHOR. Work is linear in a text's length; AQE broadcasts the needles' side if its size allows.
    """
    low = needles.withColumn("_needle", F.lower(F.col(needle))).filter("_needle <> ''").withColumn("_long", F.length("_needle") >= ANCHOR + STRIDE - 1)
    low = low.withColumns(_hashes("_needle", "_n"))
    offsets = F.when(F.col("_long"), F.sequence(F.lit(1), F.lit(STRIDE))).otherwise(F.array(F.lit(1)))
    anchored = low.select("_n1", "_n2", F.explode(F.array_distinct(F.transform(offsets, lambda o: F.substring("_needle", o, F.lit(ANCHOR))))).alias("_anchor")).distinct()
    kinds = low.select("_long", F.least(F.length("_needle"), F.lit(ANCHOR)).alias("n")).distinct().collect()  # a row for each length up to ANCHOR, and one
    cuts = {(STRIDE if k["_long"] else 1, k["n"]) for k in kinds}
    rows = texts.withColumn("_low", F.lower(F.col(text))).filter("_low is not null").withColumns(_hashes("_low", "_t"))
    grams = [F.regexp_extract_all("_low", F.lit(rf"(?s)(?=(.{{{n}}})).{{1,{stride}}}"), F.lit(1)) for stride, n in sorted(cuts)]
    met = rows.select("_t1", "_t2", F.explode(F.array_distinct(F.concat(*grams) if grams else F.array().cast("array<string>"))).alias("_anchor")).join(anchored, "_anchor")
    pairs = met.select("_t1", "_t2", "_n1", "_n2").distinct().join(low, ["_n1", "_n2"])
    both = rows.join(pairs, ["_t1", "_t2"])
    place = F.call_function("locate", F.col("_needle"), F.col("_low")) - 1
    return both.withColumn("chars", place).filter("chars >= 0").select(*texts.columns, *needles.columns, "chars")


def _hashes(column: str, name: str) -> dict:
    return {f"{name}1": F.xxhash64(column), f"{name}2": F.xxhash64(F.lit("second"), column)}
