"""Toxicity from two Kneser-Ney models, one of toxic and one of ordinary text, that share their backoff counts."""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import remainder
from .lm import END, START, _before
from .words import BASE, MARK, mix, pieces, tidied, word_hashes

#: Labelled rows of each class that the models are fitted on at most, those of least hash, and bytes of text in all:
#: a row with which a class would pass half of them is left out as a whole. These bound the fitting task and the model;
#: scoring covers every row.
PER_CLASS, FIT_BYTES = 4000, 64 << 20
#: The discounts of a count, in distinct contexts: so much of itself, so many times what the other class has in
#: proportion, and so many deviations of chance.
DISCOUNT, RATIO, DEVIATIONS = 2.0, 3.0, 3.0
#: Levels of backoff below the word: its first bytes, which inflected and disguised words share.
HEADS = (6, 4)
LEVELS = ("word", *(f"head{k}" for k in HEADS))
FOLDS = 4
#: Tokens or pairs that are sorted, weighed or scored at a time: what more a step takes than its input is in proportion to these.
BLOCK = 1 << 18


class Models:
    """Two interpolated Kneser-Ney bigram models, of ordinary and of toxic text, as sorted key arrays; all their state,
    and so what is broadcast.

    p_c(w | v) = (own_c(v w) + held_c(v) p_c(w)) / n_c(v), or p_c(w) if the class lacks v;
    p_c(w) = (own_c(w) + held_c p_c(h) p(w | h)) / n_c, with the word's head h in the place of w at the next level;
    p(w | h) = (shared(w) + 1 / (kinds(h) + 1)) / (shared(h) + 1), and so p(h) for the shortest heads; one place in
    kinds + 1 is for all that isn't seen below h.

    n_c(v w) counts the distinct words before v w in the class, n_c(w) those before w, n_c(h) is the sum of those of
    its words: Kneser-Ney's counts, to which copies of a text add nothing. own is n less the discounts: DISCOUNT, RATIO times
    what the other class has in proportion, and DEVIATIONS of chance. held is what discounts keep back of a sum, and shared
    what they keep back of both classes: the counts of the backoff. So what is rare, or alike in both classes, backs off
    to counts that both share.
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.arrays)
        return out.getvalue()

    @staticmethod
    def load(blob: bytes) -> Models:
        return Models(dict(np.load(io.BytesIO(blob))))

    def _read(self, level: str, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The level's place of each key, and whether it is there."""
        keys = self.arrays[level]
        if not len(keys):
            return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return at, keys[at] == asked

    def probabilities(self, before: np.ndarray, seq: np.ndarray) -> np.ndarray:
        """p_c(word | before) by class and token; seq has the hashes of the word and its heads."""
        a = self.arrays
        low = np.repeat(a["unseen"][:, None], seq.shape[1], axis=1)
        for level, asked in list(zip(LEVELS, seq, strict=True))[::-1]:
            at, there = self._read(level, asked)
            low[:, there] = a[f"{level}_p"][:, at[there]]
        at, there = self._read("context", before)
        if not len(a["context"]):
            return low
        total, held = np.where(there, a["context_n"][:, at], 0), np.where(there, a["context_held"][:, at], 0)
        at, there = self._read("pair", mix(before * np.uint64(BASE) + seq[0]))
        own = np.where(there, a["pair_own"][:, at], 0) if len(a["pair"]) else 0
        return np.where(total > 0, (own + held * low) / np.maximum(total, 1), low)

    def ratios(self, seq: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each text the sum of log(p_toxic / p_ordinary) over all its tokens."""
        before, out = _before(seq[0], bounds), np.empty(seq.shape[1])
        for a in range(0, len(out), 1 << 17):
            p = np.log(self.probabilities(before[a : a + (1 << 17)], seq[:, a : a + (1 << 17)]))
            out[a : a + (1 << 17)] = p[1] - p[0]
        return np.add.reduceat(out, bounds[:-1])

    def score(self, seq: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(self.ratios(seq, bounds), np.diff(bounds)) @ self.arrays["weights"], -30, 30)))


def features(ratio: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What the calibration sees: the log ratio by length and by the root of length, and the length's logarithm."""
    return np.stack([np.ones(len(n)), ratio / n * 10, ratio / np.sqrt(n), np.log(n) / 5], axis=1)


class Rows(NamedTuple):
    """The tokens of labelled texts: words has the hashes of the distinct words (and of START), sorted, and of their heads;
    ids has each token's place there. So a token takes 4 bytes, not the 24 of its hashes."""

    words: np.ndarray
    ids: np.ndarray
    bounds: np.ndarray

    @staticmethod
    def of(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Rows:
        """Of what _tokens gives for some texts after others."""
        words, ids, sizes = [np.full((1 + len(HEADS), 1), START, np.uint64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for seq, bounds in parts:
            _, some, at = np.unique(seq[0], return_index=True, return_inverse=True)
            words.append(seq[:, some])
            ids.append(at.astype(np.uint32))
            sizes.append(np.diff(bounds))
        begin = np.cumsum([w.shape[1] for w in words])
        words = np.concatenate(words, axis=1)
        _, some, at = np.unique(words[0], return_index=True, return_inverse=True)
        at = at.astype(np.uint32)
        for i, b in enumerate(begin[:-1], 1):
            ids[i] = at[b + ids[i]]
        return Rows(words[:, some], np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64))

    def before(self) -> np.ndarray:
        """Of each token the one before it."""
        out = np.empty_like(self.ids)
        out[1:] = self.ids[:-1]
        out[self.bounds[:-1]] = np.searchsorted(self.words[0], START)
        return out

    def ratios(self, model: Models, which: np.ndarray) -> np.ndarray:
        """The model's ratios of some texts, of as many at a time as BLOCK tokens hold, or one."""
        out, at = [np.zeros(0)], 0
        ends = np.cumsum(np.diff(self.bounds)[which])
        while at < len(which):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right")))
            spots = [self.ids[self.bounds[t] : self.bounds[t + 1]] for t in which[at:to]]
            out.append(model.ratios(self.words[:, np.concatenate(spots)], np.concatenate([[0], np.cumsum([len(x) for x in spots])])))
            at = to
        return np.concatenate(out)


class Pairs(NamedTuple):
    """The distinct pairs v w, by hash, with the places of v and w in Rows.words; and each word before a pair, once in a
    class: the place of its pair, the class, and a bit for each fold that has it."""

    key: np.ndarray
    before: np.ndarray
    word: np.ndarray
    pair: np.ndarray
    label: np.ndarray
    folds: np.ndarray


def pairs_of(rows: Rows, label: np.ndarray, fold: np.ndarray) -> Pairs:
    """Pairs are sorted by ranges of their hash, of some BLOCK tokens each: what a sort holds doesn't grow with the rows."""
    ids, before, n = rows.ids, rows.before(), len(rows.ids)
    bits = max(0, n // BLOCK).bit_length()
    key, where = np.empty(n, np.uint64), np.zeros(n, np.uint16)
    for a in range(0, n, BLOCK):
        b = a + BLOCK
        key[a:b] = mix(rows.words[0, before[a:b]] * np.uint64(BASE) + rows.words[0, ids[a:b]])
        if bits:
            where[a:b] = key[a:b] >> np.uint64(64 - bits)
    mark = np.repeat((label + (1 << fold + 1)).astype(np.uint8), np.diff(rows.bounds))
    start, got, many = np.searchsorted(rows.words[0], START), [[] for _ in Pairs._fields], 0
    for p in range(1 << bits):
        at = np.flatnonzero(where == p)
        own = key[at]
        first = before[at] == start  # before START stands START
        three = mix(rows.words[0, np.where(first, start, before[at - 1])] * np.uint64(BASE) + own) ^ (mark[at] & 1).astype(np.uint64)
        order = np.argsort(three, kind="stable")
        order = order[np.argsort(own[order], kind="stable")]
        own, three = own[order], three[order]
        once = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (three[1:] != three[:-1])])[: len(own)])
        seen = np.bitwise_or.reduceat(mark[at[order]], once) if len(once) else np.zeros(0, np.uint8)
        at, own = at[order[once]], own[once]
        new = np.concatenate([[True], own[1:] != own[:-1]])[: len(own)]
        for column, x in zip(got, (own[new], before[at[new]], ids[at[new]], (many + np.cumsum(new) - 1).astype(np.uint32), mark[at] & 1, seen >> 1), strict=True):
            column.append(x)
        many += int(new.sum())
    del key, where, before, mark
    return Pairs(*(np.concatenate(got.pop(0)) for _ in Pairs._fields))


def count(seq: np.ndarray, bounds: np.ndarray, label: np.ndarray) -> Models:
    """Both models' counts."""
    rows = Rows.of([(seq, bounds)])
    return counted(rows.words, pairs_of(rows, label, np.zeros(len(label), np.int64)))


def counted(words: np.ndarray, pairs: Pairs, without: int | None = None) -> Models:
    """Both models' counts, from all folds or without one."""
    over = lambda at, weights, n: np.stack([np.bincount(at, weights=weights[c], minlength=n) for c in (0, 1)])
    there = pairs.folds & ~np.uint8(0 if without is None else 1 << without) != 0
    pair_n = np.stack([np.bincount(pairs.pair[there & (pairs.label == c)], minlength=len(pairs.key)) for c in (0, 1)])
    some = pair_n.any(axis=0)
    key, before, word, pair_n = pairs.key[some], pairs.before[some], pairs.word[some], pair_n[:, some]
    # the levels from the word up: distinct keys, counts, and where each stands in the level above
    counts = over(word, pair_n > 0, words.shape[1])
    below = np.flatnonzero(counts.any(axis=0))
    counts = counts[:, below]
    tree = [[words[0, below], counts, None]]
    for asked in words[1:]:
        known, some, at = np.unique(asked[below], return_index=True, return_inverse=True)
        tree[-1][2] = at
        counts = over(at, counts, len(known))
        tree.append([known, counts, None])
        below = below[some]
    total = counts.sum(axis=1)
    each = np.maximum(total, 1)[:, None]
    # and from the shortest heads down: p by class of each key, and of all that isn't seen below the level above
    p, missing, arrays = np.ones((2, 1)), [np.ones((2, 1))], {}
    for level, (known, n, _), above in zip(LEVELS[::-1], tree[::-1], [np.zeros(len(tree[-1][0]), np.int64), *(t[2] for t in tree[-2::-1])], strict=True):
        own = _own(n, np.broadcast_to(total[:, None], n.shape))
        kept, parents = (n - own).sum(axis=0), p.shape[1]
        kinds, shared = np.bincount(above, minlength=parents), np.bincount(above, weights=kept, minlength=parents)
        held = np.where(total > 0, total - own.sum(axis=1), 1)[:, None] / each
        missing = [held * m for m in missing[:-1]] + [held * p / ((kinds + 1) * (shared + 1))]
        p = own / each + held * p[:, above] * ((kept + 1 / (kinds[above] + 1)) / (shared[above] + 1))
        arrays |= {level: known}
        missing.append(p)
    names = ["unseen", *(f"{level}_p" for level in LEVELS[::-1])]
    arrays |= dict(zip(names, [missing[0][:, 0], *missing[1:]], strict=True))
    context_n = over(before, pair_n, words.shape[1])
    # pairs that no class has as its own need no place: their count is 0
    some, pair_own = [np.zeros(0, np.int64)], [np.zeros((2, 0))]
    for a in range(0, len(key), BLOCK):
        own = _own(pair_n[:, a : a + BLOCK], context_n[:, before[a : a + BLOCK]])
        some.append(a + np.flatnonzero(own.any(axis=0)))
        pair_own.append(own[:, some[-1] - a])
    some, pair_own = np.concatenate(some), np.concatenate(pair_own, axis=1)
    context_held = context_n - over(before[some], pair_own, words.shape[1])
    differ = (context_held < context_n).any(axis=0)  # in all other contexts p_c(w | v) is p_c(w)
    return Models(arrays | {"pair": key[some], "pair_own": pair_own, "context": words[0, differ], "context_n": context_n[:, differ], "context_held": context_held[:, differ]})


def _own(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What each class has of its own: counts, out of its totals, less their discounts."""
    scale = np.stack([total[c] / np.maximum(total[1 - c], 1) for c in (0, 1)])
    other = n[::-1] * scale
    return np.maximum(n - RATIO * other - DEVIATIONS * np.sqrt(n + other * scale) - DISCOUNT, 0)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each token of each text (its words, without punctuation, then one end) the hash of the word and of its
    heads; and bounds."""
    got, bounds, at = [np.zeros((1 + len(HEADS), 0), np.uint64)], [np.zeros(1, np.int64)], 0
    for a, b in pieces(texts):
        words, own, *heads = word_hashes(texts.slice(a, b - a), MARK, HEADS)
        ends = own[1:] + np.arange(b - a)
        out = np.full((1 + len(HEADS), len(words) + b - a), END, np.uint64)
        there = np.ones(out.shape[1], bool)
        there[ends] = False
        out[:, there] = np.stack([words, *heads])
        got.append(out)
        bounds.append(ends + 1 + at)
        at += out.shape[1]
    return np.concatenate(got, axis=1), np.concatenate(bounds)


def fit(rows: Rows, label: np.ndarray, shares: np.ndarray) -> Models:
    """Both models from all given rows, and the calibration from ratios that models of the other folds give. shares:
    rows of each class among all labelled training rows, which the calibration is weighted to."""
    fold = np.arange(len(label)) % FOLDS
    pairs = pairs_of(rows, label, fold)
    x, y = [], []
    for f in range(FOLDS):
        inside = np.flatnonzero(fold == f)
        if 0 < len(inside) < len(label):
            x.append(features(rows.ratios(counted(rows.words, pairs, f), inside), np.diff(rows.bounds)[inside]))
            y.append(label[inside])
    model = counted(rows.words, pairs)
    weights = np.zeros(4)
    if x and 0 < label.sum() < len(label):
        x, y = np.concatenate(x), np.concatenate(y)
        each = np.where(y == 1, shares[1] / max(1, (y == 1).sum()), shares[0] / max(1, (y == 0).sum()))
        each = each / each.sum() * len(y)
        for _ in range(50):  # Newton's method; the ridge keeps separable data finite
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            step = np.linalg.solve(x.T @ (x * (each * p * (1 - p))[:, None]) + 1e-3 * np.eye(4), x.T @ (each * (y - p)) - 1e-3 * weights)
            weights = weights + step
            if np.abs(step).max() < 1e-8:
                break
    else:
        weights[0] = 30.0 if len(label) and label.all() else -30.0
    return Models(model.arrays | {"weights": weights})


def train(docs: DataFrame, labels: DataFrame, held_out: str | None = None, modulus: int = 5, per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> bytes:
    """The models, as bytes, from labelled rows that aren't held out: crc32(id as text) mod modulus is not 0 (or, if
    held_out is named, that column of labels is false). Of each class the per_class rows of least id hash are used:
    a sample that depends on the ids alone, not on order or source; a row for which FIT_BYTES has no room is left out.
    Both bound what one task and the driver hold.
    Labels other than 0 and 1, null ids and ids without a document are left out."""
    spark = docs.sparkSession
    ids, held = F.col(id_col), F.col(held_out) if held_out else remainder(F.col(id_col), modulus) == 0
    known = labels.filter(ids.isNotNull() & F.col(label_col).isin(0, 1) & ~held).select(ids.alias("_id"), F.col(label_col).cast("int").alias("_label")).distinct()
    shares = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    rank = F.xxhash64(F.lit("sample"), "_id")
    some = known.filter("_label = 0").orderBy(rank, "_id").limit(per_class).union(known.filter("_label = 1").orderBy(rank, "_id").limit(per_class))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(F.broadcast(some), "_id").orderBy(F.xxhash64("_id", "_text"), "_label").limit(2 * per_class)
    both, half = np.array([shares.get(0, 0), shares.get(1, 0)], float), FIT_BYTES / 2

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, room = [np.zeros(0, np.int64)], [half] * 2

        def tokens() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                own, sizes = batch["_label"].to_numpy(), pc.binary_length(batch["_text"]).to_numpy()
                keep = np.zeros(len(own), bool)
                for i, (label, size) in enumerate(zip(own, sizes, strict=True)):
                    if size <= room[label]:
                        room[label] -= size
                        keep[i] = True
                labels.append(own[keep].astype(np.int64))
                some = batch["_text"].filter(pa.array(keep))
                for a, b in pieces(some):
                    yield _tokens(some.slice(a, b - a))

        sample = Rows.of(tokens())
        yield pa.RecordBatch.from_arrays([pa.array([fit(sample, np.concatenate(labels), both).dump()], pa.binary())], names=["model"])

    made = rows.select("_text", "_label").coalesce(1).mapInArrow(tidied(fitted), "model binary").first()
    return bytes(made[0]) if made else fit(Rows.of([]), np.zeros(0, np.int64), both).dump()  # no partition at all


def score(docs: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """docs with score (double, 0 to 1, higher for toxic) added; the text alone decides. Null or empty text has a
    score too, that of the end token alone. Repeated rows and null ids are ordinary; an empty table stays empty. A
    column named score is replaced. One pass without a shuffle; the model, bounded by train's sample, is broadcast."""
    kept = docs.sparkSession.sparkContext.broadcast(model)
    left = docs.drop("score") if text_col != "score" else docs
    at = left.columns.index(text_col)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = Models.load(kept.value)
        for batch in batches:
            for a, b in pieces(batch.column(at), 4 << 20):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(models.score(*_tokens(part.column(at))), pa.float64())], names=[*part.schema.names, "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema)
    return left.mapInArrow(tidied(made), f"{schema}, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows whose score is 0.5 or more; columns and other rows stay as they are."""
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    packed = docs.select(F.col(text_col).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("_rest"))
    kept = score(packed, model, "_text").filter("score < 0.5")
    return kept.select(*[(F.col("_text") if c == text_col else F.col("_rest").getField(c)).alias(c) for c in docs.columns])


def query(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
