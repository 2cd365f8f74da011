"""Connected components of a table of links, without moving them to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, sized


def components(links: DataFrame, name: str = "labels") -> DataFrame:
    """node, label for each end of the links (src, dst): label is the least node that can be reached.

    Each round maps every node to the least of itself and its neighbours, the links' ends with it, and drops links
    within one node and repeated ones; so links shrink from round to round, and a node with very many neighbours is
    gone after the first. A round's tables are written to the shared folder in as many files as their rows need;
    Spark broadcasts those under its size limit, and shuffles the others. The driver sees only how many links are
    left. No links, or links with null ends, give no rows.
    """
    left = settle(links.select("src", "dst").filter("src is not null and dst is not null"), f"{name}-links")
    rows, whole = left.count(), None
    nodes = 2 * rows
    while True:
        both = left.union(left.select("dst", "src"))
        least = both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low")).select("node", F.least("node", "low").alias("label"))
        step = settle(sized(least, 2 * rows), f"{name}-step")
        if whole is None:
            whole = step
        else:
            onward = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
            whole = settle(sized(whole.join(onward, "label", "left").select("node", F.coalesce("further", "label").alias("label")), nodes), name)
        ends = step.select(F.col("node").alias("src"), F.col("label").alias("one")), step.select(F.col("node").alias("dst"), F.col("label").alias("two"))
        mapped = left.join(ends[0], "src").join(ends[1], "dst").filter("one <> two")
        left = settle(sized(mapped.select(F.least("one", "two").alias("src"), F.greatest("one", "two").alias("dst")).distinct(), rows), f"{name}-links")
        rows = left.count()
        if not rows:
            return whole
