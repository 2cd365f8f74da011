"""LM scoring with a log-frequency Bloom filter: quantised n-gram counts, read by repeated membership probes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .chunks import CHUNK, chunk_ids, part_count, planes, unplanes
from .common import remainder, settle
from .words import BASE, mix, pieces, tidied, word_hashes

#: Bits for each insertion and probes for each: one false answer in 45.
BITS, PROBES = 8, 5
#: Bytes of bigram filter that go to every executor, and of unigram filter a quarter of that. Filters beyond it aren't
#: sent: the chunks' probes go to the parts instead, where the same bits answer them.
BROADCAST_BYTES = 128 << 20
#: Tokens scored at once.
SCORED = 1 << 18
#: Levels: a count c stands at level 1 + floor(log(c) / log(base)); no count is beyond 2**62.
UNIGRAM_BASE, BIGRAM_BASE, MOST = 2**0.25, 2.0, 62
#: Weight, in counts, of the unigram model against what has been seen after the word before.
PRIOR = 300.0
END = np.uint64(0x5EED0FE2D)
START = np.uint64(0x57A27)


def levels(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(base) + 1e-9).astype(np.int64)


def middle(level: np.ndarray, base: float) -> np.ndarray:
    """The count that a level stands for: the middle of the whole counts that it holds, 0 for level 0."""
    low = np.ceil(base ** (np.maximum(level, 1) - 1.0) - 1e-6)
    high = np.maximum(low, np.ceil(base ** np.maximum(level, 1.0) - 1e-6) - 1)
    return np.where(level > 0, (low + high) / 2, 0.0)


def _hashes(keys: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    one = mix(keys * np.uint64(BASE) + level.astype(np.uint64))
    return one, mix(one + np.uint64(BASE)) | np.uint64(1)


def _spot(one: np.ndarray, two: np.ndarray, k: int, bits: np.ndarray) -> np.ndarray:
    """The place, below bits, of the k-th probe."""
    return (((one + two * np.uint64(k)) >> np.uint64(32)) * bits) >> np.uint64(32)


def build(keys: np.ndarray, counts: np.ndarray, base: float, bits_each: float) -> np.ndarray:
    """A part's filter: each key at every level from 1 to its own."""
    top = levels(counts, base)
    size = max(64, math.ceil(top.sum() * bits_each / 64) * 64)
    held = np.zeros(size, bool)
    for level in range(1, int(top.max(initial=0)) + 1):
        there = keys[top >= level]
        one, two = _hashes(there, np.full(1, level))
        for k in range(PROBES):
            held[_spot(one, two, k, np.uint64(size))] = True
    return np.packbits(held, bitorder="little")


class Filter:
    """Some parts' filters end to end. A key's part is known from its high bits, so it is probed in one place."""

    def __init__(self, rows: Iterator[tuple[int, bytes]], sizes: dict[int, int], base: float, parts: int):
        self.parts, self.base = parts, base
        self.bits, self.start = np.zeros(parts, np.uint64), np.zeros(parts, np.int64)
        self.data, at = np.empty(sum(sizes.values()), np.uint8), 0
        for part, blob in rows:
            self.bits[part], self.start[part] = len(blob) * 8, at
            self.data[at : at + len(blob)] = np.frombuffer(blob, np.uint8)
            at += len(blob)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Probe level after level, until one isn't there."""
        out = np.zeros(len(keys), np.int64)
        part = part_of(keys, self.parts)
        alive, level = np.flatnonzero(self.bits[part] > 0), 0
        while len(alive) and level <= MOST / math.log2(self.base):  # so that even a filter of ones comes to an end
            level += 1
            own = keys[alive], self.bits[part[alive]], self.start[part[alive]]
            one, two = _hashes(own[0], np.full(1, level))
            for k in range(PROBES):
                spot = _spot(one, two, k, own[1])
                held = (self.data[own[2] + (spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 > 0
                alive, one, two, own = alive[held], one[held], two[held], tuple(x[held] for x in own)
            out[alive] = level
        return out

    def count(self, keys: np.ndarray) -> np.ndarray:
        return middle(self.level(keys), self.base)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """48 bits for a bigram, as the high bits of a key."""
    return mix(before * np.uint64(BASE) + word) & ~np.uint64(0xFFFF)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each text with one END after them, and bounds."""
    words, bounds = word_hashes(texts)
    texts_n = len(bounds) - 1
    out = np.full(len(words) + texts_n, END, np.uint64)
    ends = bounds[1:] + np.arange(texts_n)
    there = np.ones(len(out), bool)
    there[ends] = False
    out[there] = words
    return out, np.concatenate([[0], ends + 1]).astype(np.int64)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same, a few MB at a time: hashing takes some 60 bytes for each byte of text."""
    got, at = [], 0
    bounds = [np.zeros(1, np.int64)]
    for a, b in pieces(texts):
        t, own = tokens(texts.slice(a, b - a))
        got.append(t)
        bounds.append(own[1:] + at)
        at += len(t)
    return np.concatenate(got) if got else np.zeros(0, np.uint64), np.concatenate(bounds)


def _before(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[bounds[:-1]] = START
    return out


def _train(batch: pa.RecordBatch, bounds: np.ndarray) -> np.ndarray:
    return np.repeat(~batch["_held"].to_numpy(zero_copy_only=False), np.diff(bounds))


def _cut_schema(id_type: str) -> str:
    return f"chunk long, part int, ids array<{id_type}>, held array<boolean>, lengths binary, spots binary, words binary, counts binary"


def _runs(keys: np.ndarray, parts: int) -> tuple[np.ndarray, list[slice]]:
    """The parts of sorted keys, and where each part's keys are."""
    owner = part_of(keys, parts)
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    return owner[starts], [slice(a, b) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True)]


def _cut(parts: int):
    """A row for each chunk (part -1) with its texts' tokens, as places among its distinct ones; and a row for each
    part with those that belong to it, and their training counts."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = chunk_ids()
        for batch in batches:
            for a, b in pieces(batch["_text"], CHUNK):
                part = batch.slice(a, b - a)
                seq, bounds = _tokens(part["_text"])
                known, where = np.unique(seq, return_inverse=True)
                counts = np.bincount(where[_train(part, bounds)], minlength=len(known))
                owner, runs = _runs(known, parts)
                n = 1 + len(runs)
                col = lambda first, rest, kind: pa.array([first, *rest], kind)
                none, ids = [None] * (n - 1), pa.ListArray.from_arrays(pa.array([0, *[b - a] * n], pa.int32()), part["_id"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([next(names)] * n, pa.int64()), col(-1, owner.tolist(), pa.int32()), ids, col(part["_held"].to_pylist(), none, pa.list_(pa.bool_())), col(planes(np.diff(bounds)), none, pa.binary()), col(planes(where), none, pa.binary()),
                        col(known.tobytes(), [known[r].tobytes() for r in runs], pa.binary()), col(None, [planes(counts[r]) for r in runs], pa.binary()),
                    ],
                    names=["chunk", "part", "ids", "held", "lengths", "spots", "words", "counts"],
                )

    return made


_COUNTED = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("counts", pa.binary()), ("n", pa.int64()), ("v", pa.int64()), ("insertions", pa.int64()), ("keys", pa.binary()), ("totals", pa.binary())])


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, their sums, and where each given key stands among them."""
    known, where = np.unique(np.concatenate(keys), return_inverse=True)
    return known, np.bincount(where, weights=np.concatenate(counts), minlength=len(known)).astype(np.int64), where


def _count(table: pa.Table) -> pa.Table:
    """A part's exact training counts, over all chunks; told to each chunk for the tokens it holds."""
    keys = [np.frombuffer(x, np.uint64) for x in table["words"].to_pylist()]
    known, sums, where = _summed(keys, [unplanes(x) for x in table["counts"].to_pylist()])
    answers = np.split(sums[where], np.cumsum([len(k) for k in keys])[:-1])
    seen = sums > 0
    part = table["part"][0].as_py()
    rows = [(c, part, planes(a), None, None, None, None, None) for c, a in zip(table["chunk"].to_pylist(), answers, strict=True)]
    rows.append((None, part, None, int(sums.sum()), int(seen.sum()), int(levels(sums[seen], UNIGRAM_BASE).sum()), known[seen].tobytes(), planes(sums[seen])))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _COUNTED, strict=True)], schema=_COUNTED)


def _sequence(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's tokens and bounds again."""
    return np.frombuffer(row["words"], np.uint64)[unplanes(row["spots"])], np.concatenate([[0], np.cumsum(unplanes(row["lengths"]))]).astype(np.int64)


def _short(keys: np.ndarray) -> bytes:
    """Bigram keys without the two bytes that are 0."""
    return keys.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _long(blob: bytes) -> np.ndarray:
    full = np.zeros((len(blob) // 6, 8), np.uint8)
    full[:, 2:] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return full.view(np.uint64).ravel()


def _pairs(parts: int, train: bool):
    """For each chunk and part, the chunk's distinct bigrams and their counts: those of training texts, or all."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                seq, bounds = _sequence(row)
                keys = pair_keys(_before(seq, bounds), seq)
                known, counts = np.unique(keys[np.repeat(~np.array(row["held"], bool), np.diff(bounds))] if train else keys, return_counts=True)
                owner, runs = _runs(known, parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]] * len(runs), pa.int64()), pa.array(owner, pa.int32()), pa.array([_short(known[r]) for r in runs], pa.binary()), pa.array([planes(counts[r]) for r in runs], pa.binary())],
                    names=["chunk", "part", "pairs", "counts"],
                )

    return made


def _pair_filter(bits: int):
    def made(table: pa.Table) -> pa.Table:
        known, sums, _ = _summed([_long(x) for x in table["pairs"].to_pylist()], [unplanes(x) for x in table["counts"].to_pylist()])
        blob = build(known, sums, BIGRAM_BASE, bits).tobytes()
        return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()), "size": pa.array([len(blob)], pa.int64()), "bits": pa.array([blob], pa.binary())})

    return made


def _unigram_filter(bits: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [build(np.frombuffer(k, np.uint64), unplanes(t), UNIGRAM_BASE, bits).tobytes() for k, t in zip(batch["keys"].to_pylist(), batch["totals"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["part"], pa.array([len(x) for x in blobs], pa.int64()), pa.array(blobs, pa.binary())], names=["part", "size", "bits"])

    return made


def _answered(parts: int, base: float, read):
    """A part's filter, asked for what each chunk has there."""

    def made(asked: pa.Table, filters: pa.Table) -> pa.Table:
        blobs = [(r["part"], r["bits"]) for r in filters.select(["part", "bits"]).to_pylist()]
        one = Filter(iter(blobs), {p: len(x) for p, x in blobs}, base, parts)
        return pa.table({"chunk": asked["chunk"], "part": asked["part"], "levels": pa.array([planes(one.level(read(x))) for x in asked["keys"].to_pylist()], pa.binary())})

    return made


def _scored(unigrams, bigrams, total: int, distinct: int, starts: int, id_type: pa.DataType):
    """One chunk: for each text its tokens, those known, its base score and the model's score. Counts come from the
    filters at hand, or from the levels that the parts have told."""

    def made(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        doc, told = rows[0], {k: np.concatenate([unplanes(r["levels"]) for r in rows if r["kind"] == k] or [np.zeros(0, np.int64)]) for k in ("count", "one", "two")}
        words, spots, bounds = _words(doc["words"]), unplanes(doc["spots"]), np.concatenate([[0], np.cumsum(unplanes(doc["lengths"]))]).astype(np.int64)
        exact = told["count"]
        counts = unigrams.value.count(words) if unigrams else middle(told["one"], UNIGRAM_BASE)
        base, alone = np.log10(exact + 0.1) - math.log10(total + 0.1 * (distinct + 1)), (counts + 0.1) / (total + 0.1 * (distinct + 1))
        asked = None if bigrams else np.unique(pair_keys(_before(words[spots], bounds), words[spots]))
        sums, a = np.empty((3, len(bounds) - 1)), 0
        while a < len(bounds) - 1:  # some texts at a time: probing takes some hundred bytes a token
            b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + SCORED, "right")) - 1)
            here, ends = spots[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
            seq = words[here]
            pairs, at = np.unique(pair_keys(_before(seq, ends), seq), return_inverse=True)
            both = bigrams.value.count(pairs) if bigrams else middle(told["two"][np.searchsorted(asked, pairs)], BIGRAM_BASE)
            after = np.empty(len(seq))
            after[1:] = counts[here[:-1]]
            after[ends[:-1]] = starts
            values = np.log10((np.minimum(both[at], np.minimum(after, counts[here])) + PRIOR * alone[here]) / (after + PRIOR))
            sums[:, a:b] = [np.add.reduceat(x, ends[:-1]) for x in ((exact[here] > 0).astype(float), base[here], values)]
            a = b
        return pa.table({
            "_id": pa.array(doc["ids"], id_type), "held_out": pa.array(doc["held"], pa.bool_()), "n_tokens": pa.array(np.diff(bounds), pa.int64()), "n_known": pa.array(sums[0].astype(np.int64), pa.int64()),
            "base_score": pa.array(sums[1], pa.float64()), "score": pa.array(sums[2], pa.float64()),
        })

    return made


def _words(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint64)


def _sizes(table: DataFrame) -> dict[int, int]:
    """Bytes of each part's filter: a row for each part, and those are as many as the session's tasks."""
    return {r[0]: r[1] for r in table.select("part", "size").orderBy("part").collect()}


def _gathered(table: DataFrame, sizes: dict[int, int], base: float, parts: int) -> Filter:
    """The filter of the parts in sizes, whose sum has been checked; taken a few partitions at a time."""
    own = table.filter(F.col("part").between(min(sizes), max(sizes))).select("part", "bits").coalesce(8) if sizes else table.limit(0).select("part", "bits")
    return Filter(((r[0], bytes(r[1])) for r in own.toLocalIterator()), sizes, base, parts)


def score(docs: DataFrame, held_out: str | None = None, modulus: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: its id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens: words `[^\x20\x09-\x0D]+`, A-Z lower-cased, then one end. Rows with crc32(id as text) mod modulus = 0
    are held out of the counts (a null id counts as empty text, and so is held out). base_score comes from exact
    unigram counts. score is the log10 probability of a bigram model whose counts come from the filters:
    (c(uv) + PRIOR p(v)) / (c(u) + PRIOR), with p as in the base; log10 of the product over the tokens. A filter answers
    a level too high for one probe in 45, whatever the size of the corpus; so much the score differs from that of
    exact levels.

    Null or empty text: the end alone. Repeated rows: ordinary, each counts. An empty table gives an empty table;
    without training rows every count is 0. Other columns aren't looked at; texts are taken whole.

    Plan: one pass over the texts makes chunks of some CHUNK bytes, in a table of the shared folder; all else works on
    those. Exact counts: distinct tokens of each chunk shuffle to parts by hash, are summed, and answer the chunks
    (chunks.py). Bigrams: 6 bytes for each distinct one of a chunk shuffle to parts; each part builds its own piece
    of the filter. The filters' sizes are summed first. Up to BROADCAST_BYTES go to every executor, and chunks probe
    them there; beyond, the chunks' distinct n-grams go to the parts and their levels come back. Both ways read the
    same bits, so scores are the same; either way, work and shuffle are in proportion to the text. Texts themselves
    are never shuffled, and a chunk's rows meet once, for its result.
    """
    spark = docs.sparkSession
    parts = part_count(spark)
    held = F.col(held_out) if held_out else remainder(F.col(id_col), modulus) == 0
    rows = docs.select(F.col(id_col).alias("_id"), held.alias("_held"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType
    cut = settle(rows.mapInArrow(tidied(_cut(parts)), _cut_schema(kind.simpleString())), "tokens")
    whole, split = cut.filter("part < 0"), cut.filter("part >= 0")
    counted = settle(split.select("chunk", "part", "words", "counts").groupBy("part").applyInArrow(tidied(_count), "chunk long, part int, counts binary, n long, v long, insertions long, keys binary, totals binary"), "counts")
    total, distinct = map(int, counted.filter("chunk is null").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first())
    starts = int(whole.agg(F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0))).first()[0])
    filters = "part int, size long, bits binary"
    few = settle(counted.filter("chunk is null and v > 0").select("part", "keys", "totals").mapInArrow(tidied(_unigram_filter(BITS)), filters), "unigrams")
    grams = "chunk long, part int, pairs binary, counts binary"
    many = settle(whole.mapInArrow(tidied(_pairs(parts, True)), grams).groupBy("part").applyInArrow(tidied(_pair_filter(BITS)), filters), "bigrams")
    told = [counted.filter("chunk is not null").select("chunk", "part", F.col("counts").alias("levels"), F.lit("count").alias("kind"))]
    kept = []
    asked = {"one": lambda: split.select("chunk", "part", F.col("words").alias("keys")), "two": lambda: whole.mapInArrow(tidied(_pairs(parts, False)), grams).select("chunk", "part", F.col("pairs").alias("keys"))}
    for name, table, base, room, read in (("one", few, UNIGRAM_BASE, BROADCAST_BYTES / 4, _words), ("two", many, BIGRAM_BASE, BROADCAST_BYTES, _long)):
        if table.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] <= room:
            kept.append(spark.sparkContext.broadcast(_gathered(table, _sizes(table), base, parts)))
        else:
            kept.append(None)
            both = asked[name]().groupBy("part").cogroup(table.select("part", "bits").groupBy("part"))
            told.append(both.applyInArrow(tidied(_answered(parts, base, read)), "chunk long, part int, levels binary").withColumn("kind", F.lit(name)))
    both = whole.select("chunk", "part", "ids", "held", "lengths", "spots", "words")
    for more in told:
        both = both.unionByName(more, allowMissingColumns=True)
    done = both.groupBy("chunk").applyInArrow(tidied(_scored(*kept, total, distinct, starts, to_arrow_type(kind))), f"_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return done.select(F.col("_id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def query(docs: DataFrame) -> DataFrame:
    return score(docs.select("doc_id", "text"))
