"""MinHash near-dedup with HyperMinHash sketches: registers of leading zeros and mantissa bits, banded."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_spread, row_key, settle, sized
from .components import components
from .words import BASE, mix, pieces, shingles, tidied, word_hashes

#: 32 bands of 5 registers: a pair at similarity 0.85 is missed once in 1e8, one at 0.8 once in 3e5.
BANDS, ROWS, MANTISSA = 32, 5, 10
K = BANDS * ROWS
#: Candidates whose estimate is below this go; seven standard deviations under 0.8.
FLOOR = 0.5
#: Bytes of row keys, at 16 each, up to which they go to every executor; beyond, the texts are shuffled to them.
BROADCAST_BYTES = 64 << 20
#: Nodes of a block; groups of more than HUB nodes are compared with one hub first, in so many rounds.
BLOCK, HUB, ROUNDS = 256, 4096, 1
#: Rows with full sets that a task takes at least.
SETS = 4000
#: Registers in use from which an estimate may rule out a pair, and the deviations under the threshold for that.
SURE, DEVIATIONS = 40, 6
_probes = (mix(np.arange(2048 * K, dtype=np.uint64) + np.uint64(77)) % np.uint64(K)).astype(np.int64).reshape(2048, K)


def registers(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One-permutation HyperMinHash: of each text, K registers of 1 + 1024 * leading zeros + mantissa of the least
    hash in the bucket; 0 for an empty bucket."""
    texts = len(bounds) - 1
    bucket = ((values >> np.uint64(32)) * np.uint64(K)) >> np.uint64(32)
    rank = mix(values * np.uint64(BASE) + np.uint64(1)) >> np.uint64(11)
    low = np.full(texts * K, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(low, np.repeat(np.arange(texts), np.diff(bounds)) * K + bucket.astype(np.int64), rank)
    fraction, power = np.frexp(np.maximum(low, 1).astype(np.float64))
    made = 1 + ((53 - np.clip(power, 1, 53)) << MANTISSA) + ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    return np.where(low == np.iinfo(np.uint64).max, 0, made).astype(np.uint16).reshape(texts, K)


def densified(regs: np.ndarray) -> np.ndarray:
    """Empty registers take the value of the first full one in a fixed random order, the same for every text."""
    full = regs.copy()
    text, slot = np.nonzero((regs == 0) & regs.any(axis=1)[:, None])
    for probe in _probes:
        if not len(text):
            break
        got = regs[text, probe[slot]]
        full[text, slot] = got
        left = got == 0
        text, slot = text[left], slot[left]
    if len(text):  # once in 4e5 registers of a one-shingle text
        full[text, slot] = regs.max(axis=1)[text]
    return full


def band_keys(regs: np.ndarray) -> np.ndarray:
    full = densified(regs).reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), full.shape[:2]).copy()
    for j in range(ROWS):
        key = mix(key * np.uint64(BASE) + full[:, :, j])
    return key.view(np.int64)


def chance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How likely registers of unrelated sets agree, by the number of hashes in the bucket: the chance that both
    minima fall in one cell of the grid of leading zeros and mantissa."""
    total = np.zeros(len(a))
    for zeros in range(53):
        high, low = 2.0**-zeros, 2.0 ** -(zeros + 1)
        s = np.maximum(a + b - 1, 1.0)
        total += low / (1 << MANTISSA) * (a * b / s) * ((1 - low) ** s - (1 - high) ** s)
    return np.clip(total, 0, 0.5)


def estimate(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers, less the agreement that chance makes."""
    used = ((x > 0) | (y > 0)).sum(axis=1)
    same = ((x == y) & (x > 0)).sum(axis=1)
    by_chance = chance(np.maximum(nx / K, 1.0), np.maximum(ny / K, 1.0)) * used
    return np.where(used > 0, (same - by_chance) / np.maximum(used - by_chance, 1e-9), 0.0)


def _sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    values, bounds = shingles(*word_hashes(texts), k)
    sums = []
    for salt in (3, 5):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values * np.uint64(BASE) + np.uint64(salt)), out=total[1:])
        sums.append(total[bounds[1:]] - total[bounds[:-1]])
    both = np.stack(sums, axis=1).astype(">u8")
    return values, bounds, [r.tobytes() for r in both]


def _sketch(k: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch["_text"]):
                part = batch.slice(a, b - a)
                values, bounds, nodes = _sets(part["_text"], k)
                regs, n = registers(values, bounds), np.diff(bounds)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, len(n) * BANDS + 1, BANDS), pa.int32()), pa.array(band_keys(regs).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part["_id"], part["_k1"], part["_k2"], pa.array(n, pa.int64()), pa.array([x if m else None for x, m in zip(nodes, n, strict=True)], pa.binary()), bands, pa.array([r.tobytes() for r in regs], pa.binary())],
                    names=["_id", "_k1", "_k2", "n", "node", "bands", "regs"],
                )

    return made


def _full_sets(k: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch["_text"]):
                part = batch.slice(a, b - a)
                values, bounds, nodes = _sets(part["_text"], k)
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array([values[s:e].tobytes() for s, e in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], names=["node", "set"])

    return made


def _regs_of(rows) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.uint16).reshape(-1, K)


def _regs(column: pa.Array) -> np.ndarray:
    return _regs_of(column.to_pylist())


def _ruled_in(same: np.ndarray, used: np.ndarray, limit: float) -> np.ndarray:
    """Whether a pair at the threshold could have so few agreeing registers, out of those in use."""
    return (used < SURE) | (same / np.maximum(used, 1) >= limit - DEVIATIONS * np.sqrt(limit * (1 - limit) / np.maximum(used, 1)))


def _settled(x: np.ndarray, y: np.ndarray, limit: float) -> np.ndarray:
    """Whether y agrees with its pivot x so well that whatever links with y has an estimate of FLOOR or more with x:
    such a row differs from y in few registers, and agrees with x in all others in which y does."""
    own = (y > 0).sum(axis=1)
    far = 1 - limit + DEVIATIONS * np.sqrt(limit * (1 - limit) / np.maximum(own, 1))
    differ = far * np.minimum(K, own / np.maximum(1 - far, 0.01))
    used, same = ((x > 0) | (y > 0)).sum(axis=1), ((x == y) & (x > 0)).sum(axis=1)
    return (own >= SURE) & (same - differ >= (FLOOR + 0.01) * np.minimum(K, used + differ))


def _estimated(percent: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _regs(batch["regs_a"]), _regs(batch["regs_b"])
                near = estimate(x, y, batch["n_a"].to_numpy(), batch["n_b"].to_numpy())
                yield pa.RecordBatch.from_arrays([batch["src"], batch["dst"], batch["shared"], pa.array(near), pa.array(_settled(x, y, percent / 100))], names=["src", "dst", "shared", "near", "settled"])

    return made


def _in_buckets(percent: int):
    """Two blocks of one bucket against each other: candidates that join what isn't joined yet. Rows joined with the
    bucket's pivot are one already; two guests meet in the size class below."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = percent / 100
        for batch in batches:
            src, dst = [], []
            for i in range(batch.num_rows):
                both = [batch[c].slice(i, 1).to_pylist()[0] for c in ("block_a", "block_b")]
                n, joined, guest = ([np.array([x[f] for x in block]) for block in both] for f in ("n", "joined", "guest"))
                near = np.minimum(n[0][:, None], n[1][None, :]) >= limit * np.maximum(n[0][:, None], n[1][None, :]) - 1e-6
                k, m = np.nonzero(near & ~(joined[0][:, None] & joined[1][None, :]) & ~(guest[0][:, None] & guest[1][None, :]))
                regs, kept = [_regs_of(x["regs"] for x in block) for block in both], []
                for at in range(0, len(k), 1 << 14):
                    one, two = k[at : at + (1 << 14)], m[at : at + (1 << 14)]
                    x, y = regs[0][one], regs[1][two]
                    used, same = ((x > 0) | (y > 0)).sum(axis=1), ((x == y) & (x > 0)).sum(axis=1)
                    ok = _ruled_in(same, used, limit)
                    ok[ok] = estimate(x[ok], y[ok], n[0][one[ok]], n[1][two[ok]]) >= FLOOR
                    kept.append(np.stack([one[ok], two[ok]]))
                label = {x["node"]: b"" if x["joined"] else x["node"] for block in both for x in block}
                for one, two in np.concatenate(kept, axis=1).T.tolist() if kept else []:
                    a, b = both[0][one]["node"], both[1][two]["node"]
                    if label[a] != label[b]:
                        src.append(a)
                        dst.append(b)
                        gone, stays = label[a], label[b]
                        label = {x: stays if c == gone else c for x, c in label.items()}
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.binary()), pa.array(dst, pa.binary())], names=["src", "dst"])

    return made


def _jaccard(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and union of sorted sets."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    met = int((both[1:] == both[:-1]).sum())
    return met, len(both) - met


def _to_hub(percent: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [_jaccard(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(batch["set"].to_pylist(), batch["hub_set"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["cid"], batch["node"], batch["hub"], pa.array([m / u for m, u in got], pa.float64()), pa.array([100 * m >= percent * u for m, u in got], pa.bool_())], names=["cid", "node", "hub", "j", "linked"])

    return made


def _in_blocks(percent: int):
    """Two blocks of nodes against each other: links that join what isn't joined yet within the two, so one less than
    there are nodes at most. Sketches rule out pairs first; the others are confirmed on full sets."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = percent / 100
        for batch in batches:
            src, dst = [], []
            for i in range(batch.num_rows):
                left, right = (batch[c].slice(i, 1).to_pylist()[0] for c in ("block_a", "block_b"))
                a, b = (_regs_of(x["regs"] for x in block)[None if k else slice(None), slice(None) if k else None] for k, block in enumerate((left, right)))
                n_a, n_b = np.array([len(x["set"]) for x in left])[:, None], np.array([len(x["set"]) for x in right])[None, :]
                near = np.minimum(n_a, n_b) >= limit * np.maximum(n_a, n_b) - 1e-6
                used = np.maximum(((a > 0) | (b > 0)).sum(axis=2), 1)
                near &= _ruled_in(((a == b) & (a > 0)).sum(axis=2), used, limit)
                if left[0]["j"] is not None:  # similarity is one less a metric, so distances from the hub bound it
                    near &= np.abs(np.array([x["j"] for x in left])[:, None] - np.array([x["j"] for x in right])[None, :]) <= 1 - limit + 1e-9
                    joined = dict.fromkeys((x["node"] for x in left), b"")  # linked with the hub, so with each other
                else:
                    joined = {x["node"]: x["node"] for x in left}
                joined |= {x["node"]: x["node"] for x in right if x["node"] not in joined}
                for k, m in zip(*np.nonzero(near), strict=True):
                    x, y = left[k], right[m]
                    one, two = joined[x["node"]], joined[y["node"]]
                    if one == two:
                        continue
                    met, union = _jaccard(np.frombuffer(x["set"], np.uint64), np.frombuffer(y["set"], np.uint64))
                    if 100 * met >= percent * union:
                        src.append(x["node"])
                        dst.append(y["node"])
                        joined = {n: one if c == two else c for n, c in joined.items()}
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.binary()), pa.array(dst, pa.binary())], names=["src", "dst"])

    return made


def _left_over(told: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Candidates (src, dst) that the buckets' pivots don't show. told: the stars with their bands, near and settled.

    A bucket whose pivot is unlike one of its members isn't done: that member may link with any other but the settled
    ones. So these, and the members joined with the pivot but not settled, are compared in blocks by sketch. Sizes of
    linked rows differ by a factor of percent at most, so rows meet by bucket and size class, and as guests one above.
    """
    rest = told.filter("not settled").select(F.explode("bands").alias("band"), F.col("dst").alias("node"), (F.col("near") >= FLOOR).alias("joined"))
    undone = rest.groupBy("band").agg(F.count("*").alias("_n"), F.bool_and("joined").alias("_all")).filter("_n > 1 and not _all").select("band")
    step = max(-math.log(max(percent, 1) / 100) * 1.001, 0.001)
    kind = F.floor(F.log("n") / step).cast("int")
    listed = rest.join(undone, "band").join(nodes.select("node", "n", "regs", kind.alias("kind")), "node")
    dealt = listed.withColumn("guest", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("kind", F.col("kind") + F.col("guest").cast("int"))
    sizes = dealt.groupBy("band", "kind").agg(F.count("*").alias("m"), F.bool_and("joined").alias("_all"), F.bool_and("guest").alias("_guests")).filter("m > 1 and not _all and not _guests").select("band", "kind", "m")
    open_rows = join_spread(dealt, sizes, ["band", "kind"], F.col("node"), how="inner")
    parts = F.ceil(F.col("m") / BLOCK).cast("int")
    left = open_rows.groupBy("band", "kind", parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).cast("int").alias("part_a")).agg(F.collect_list(F.struct("node", "joined", "guest", "n", "regs")).alias("block_a"))
    left = settle(left, "buckets")
    right = left.withColumnsRenamed({"part_a": "part_b", "block_a": "block_b"}).drop("parts")
    pairs = left.withColumn("part_b", F.explode(F.sequence("part_a", F.col("parts") - 1))).join(right, ["band", "kind", "part_b"])
    return pairs.select("block_a", "block_b").mapInArrow(tidied(_in_buckets(percent)), "src binary, dst binary")


def _blocks(rows: DataFrame, name: str) -> DataFrame:
    """cid, part, parts, and the rows of each group (of m nodes) in `parts` lists of some BLOCK."""
    parts = F.ceil(F.col("m") / BLOCK).cast("int")
    return rows.groupBy("cid", parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).cast("int").alias(f"part_{name}")).agg(F.collect_list(F.struct("node", "j", "regs", "set")).alias(f"block_{name}"))


def _verified(members: DataFrame, percent: int) -> DataFrame:
    """The links (src, dst) within each group cid that give its true components.

    A group of up to HUB rows is compared in blocks, by sketch and then on full sets. A larger one first takes as
    hub the row that shares most bands, and confirms every row against it on full sets. Linked rows are then
    one component. A row that isn't linked can only link to them if it lies within twice the distance and the
    distances differ by no more than one (1 - similarity is a metric); such rows are compared with them in blocks.
    What is still open is compared with itself in blocks. So every pair that could link has been ruled out or
    compared, a task holds a block and a batch, and only links are told, not pairs.
    """
    large, open_rows, links = members.filter(F.col("m") > HUB), members.filter(F.col("m") <= HUB), []
    some = large.count()
    for turn in range(ROUNDS if some else 0):
        top = large if turn == 0 else large.drop("top").join(large.groupBy("cid").agg(F.max(F.struct("score", "node")).alias("top")), "cid")
        hubs = top.filter(F.col("node") == F.col("top.node")).select("cid", F.col("node").alias("hub"), F.col("set").alias("hub_set"))
        seen = settle(sized(join_spread(top, hubs, ["cid"], F.col("node")).select("cid", "node", "hub", "set", "hub_set").mapInArrow(tidied(_to_hub(percent)), "cid binary, node binary, hub binary, j double, linked boolean"), some, SETS), "hubs")
        links.append(seen.filter("linked and node <> hub").select(F.col("node").alias("src"), F.col("hub").alias("dst")))
        apart = seen.filter("not linked").select("cid", "node", "j")
        close = apart.filter(F.col("j") >= 2 * percent / 100 - 1 - 1e-9)
        inside = seen.filter("linked").select("cid", "node", "j")
        told = _compared(large.drop("j").join(inside, ["cid", "node"]), large.drop("j").join(close, ["cid", "node"]), percent)
        links.append(settle(sized(told, some, SETS), "links"))
        large = settle(sized(large.drop("j").join(apart.select("cid", "node"), ["cid", "node"]), some, SETS), "open")
    open_rows = open_rows.unionByName(large) if some else open_rows
    alike = open_rows.withColumn("j", F.lit(None).cast("double"))
    links.append(_compared(alike, None, percent))
    made = links[0]
    for more in links[1:]:
        made = made.unionByName(more)
    return made


def _compared(rows: DataFrame, others: DataFrame | None, percent: int) -> DataFrame:
    """Links between rows and others of a group, or, without others, among the rows."""
    left = _blocks(rows, "a")
    right = (_blocks(others, "b") if others is not None else left.withColumnsRenamed({"part_a": "part_b", "block_a": "block_b"})).drop("parts")
    first = F.lit(0) if others is not None else F.col("part_a")
    # by group and block, so that the pairs of a large group's blocks are dealt to many tasks
    pairs = left.withColumn("part_b", F.explode(F.sequence(first, F.col("parts") - 1))).join(right, ["cid", "part_b"])
    return pairs.select("block_a", "block_b").mapInArrow(tidied(_in_blocks(percent)), "src binary, dst binary")


def groups(docs: DataFrame, percent: int = 80, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, n_shingles (long), component_id, kept, and _k1, _k2, 128 bits
    of the id and text.

    Rows are linked when 100 * |A and B| >= percent * |A or B| for their sets of distinct k-word shingles;
    component_id is the least id in reach, kept says that the row has it. Links are confirmed on full sets.

    Null, empty or blank text: no shingles, linked with nothing, so kept. Null ids: never a component's name unless
    all its ids are null; a row with a null id is kept only then. Repeated ids: each row counts by its own text,
    and all rows that carry the component's name are kept. An empty table gives an empty table; texts are taken
    whole; other columns aren't looked at.

    Plan: (1) one Python pass makes sketches, some 600 bytes a row, in a table of the shared folder; (2) equal sets
    become one node, so groups of copies shrink to one row before anything is paired; (3) nodes that share a band
    meet its least node first (a star, not all pairs) and stay if the collision-corrected estimate is FLOOR or more;
    what that leaves undone in a bucket is compared in blocks, see _left_over;
    (4) components of these stars are groups to confirm; only their texts are read again; (5) see _verified;
    (6) components of the confirmed links, and the least id of each.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), *row_key(docs, id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    sketches = settle(rows.mapInArrow(tidied(_sketch(k)), "_id long, _k1 long, _k2 long, n long, node binary, bands array<long>, regs binary"), "sketches")
    nodes = settle(sketches.filter("n > 0").select("node", "n", "bands", "regs", "_k1", "_k2").dropDuplicates(["node"]), "nodes")
    bands = nodes.select("node", F.explode("bands").alias("band"))
    pivots = bands.groupBy("band").agg(F.min("node").alias("src"), F.max("node").alias("most")).filter("src <> most").select("band", "src")
    stars = bands.join(pivots, "band").filter("node <> src").groupBy("src", F.col("node").alias("dst")).agg(F.count("*").alias("shared"), F.collect_list("band").alias("bands"))
    known = lambda end, tag: nodes.select(F.col("node").alias(end), F.col("regs").alias(f"regs_{tag}"), F.col("n").alias(f"n_{tag}"))
    stars = settle(stars, "stars")
    told = stars.drop("bands").join(known("src", "a"), "src").join(known("dst", "b"), "dst").mapInArrow(tidied(_estimated(percent)), "src binary, dst binary, shared long, near double, settled boolean")
    told = settle(told, "told")
    more = _left_over(told.filter("not settled").join(stars.drop("shared"), ["src", "dst"]), nodes, percent)
    near = settle(told.filter(F.col("near") >= FLOOR).select("src", "dst", "shared").unionByName(more.withColumn("shared", F.lit(1).cast("long"))), "near")
    base = sketches.select("_id", "_k1", "_k2", "n", "node")
    links = near.count()
    if links:
        score = near.select(F.col("src").alias("node"), "shared").unionByName(near.select(F.col("dst").alias("node"), "shared")).groupBy("node").agg(F.sum("shared").alias("score"))
        found = settle(sized(components(near, "candidates").withColumnRenamed("label", "cid").join(score, "node"), 2 * links), "found")
        sizes = found.groupBy("cid").agg(F.count("*").alias("m"), F.max(F.struct("score", "node")).alias("top"))
        found = join_spread(found, sizes, ["cid"], F.col("node"))  # before the sets: a group's rows are small here
        listed = settle(nodes.select("node", "regs", "_k1", "_k2").join(found, "node"), "listed")  # not sized: it reads all nodes
        keys = listed.select("_k1", "_k2").distinct()
        many = listed.count()
        keys = F.broadcast(keys) if many * 16 <= BROADCAST_BYTES else keys
        sets = rows.join(keys, ["_k1", "_k2"], "left_semi").select("_text").mapInArrow(tidied(_full_sets(k)), "node binary, set binary").dropDuplicates(["node"])
        members = settle(sized(sets.join(listed.select("node", "cid", "score", "regs", "m", "top"), "node"), many, SETS), "members")
        labels = components(_verified(members, percent), "labels").withColumnRenamed("label", "root")
    else:
        labels = spark.createDataFrame([], "node binary, root binary")
    # the rows of one node or root are dealt to many tasks; only what links has a label, only shared roots a least id
    rooted = join_spread(base, labels, ["node"], F.col("_k1")).withColumn("root", F.coalesce("root", "node"))
    least = rooted.filter("root is not null").groupBy("root").agg(F.min("_id").alias("least"), F.count("*").alias("m")).filter("m > 1").select("root", "least")
    named = join_spread(rooted, least, ["root"], F.col("_k1")).withColumn("component_id", F.coalesce("least", "_id"))
    return named.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"), "_k1", "_k2")


def drop_near_duplicates(docs: DataFrame, percent: int = 80, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each near-duplicate group; see groups for nulls, ties and repeats."""
    gone = groups(docs, percent, k, id_col, text_col).filter("not kept").select("_k1", "_k2").distinct()
    keyed = docs.select(*row_key(docs, id_col, text_col), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return keyed.join(gone, ["_k1", "_k2"], "left_anti").select("_row.*")


def query(docs: DataFrame) -> DataFrame:
    return groups(docs.select("doc_id", "text"), percent=85).drop("_k1", "_k2")


#: Brute force: every pair that shares a shingle, and a recursion over the links.
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * m >= 85 * (len(x.s) + len(y.s) - m)),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) USING (doc_id)
"""
