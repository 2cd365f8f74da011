"""Byte-level BPE encoding and decoding through a global shuffle of distinct words."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import CHUNK, chunk_ids, part_count, planes, squeeze, unplanes, unsqueeze
from .common import settle_by
from .words import pieces, tidied, tidy

#: Unicode white space, as fixed values.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@lru_cache
def splitter(pattern: str) -> regex.Pattern:
    """The pattern with white space spelt out, so that it doesn't depend on a library's notion of it."""
    inside = regex.sub(r"\[\^\\s", lambda _: rf"[^{_WHITE}", pattern)
    return regex.compile(inside.replace(r"\S", f"[^{_WHITE}]").replace(r"\s", f"[{_WHITE}]"))


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens={})


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


def _cut(pattern: str, parts: int):
    """A row for each chunk: the positions of its words, and for each part the distinct words that it is asked for."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, names = splitter(pattern).findall, chunk_ids()
        for batch in batches:
            for a, b in pieces(batch["_text"], CHUNK):
                part = batch.slice(a, b - a)
                numbers: defaultdict[str, int] = defaultdict(count().__next__)
                spots, bounds = [], [0]
                for text in part["_text"]:
                    found = find(text.as_py() or "")
                    spots.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
                    bounds.append(bounds[-1] + len(found))
                words = [w.encode("utf-8", "surrogatepass") for w in numbers]
                owner = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
                order = np.argsort(owner, kind="stable")
                chunk = next(names)
                asked = []
                for p, own in zip(*_runs(owner[order], order), strict=True):
                    mine = [words[i] for i in own]
                    asked.append({"part": int(p), "words": squeeze(b"".join(mine)), "sizes": planes(np.fromiter(map(len, mine), np.int64, len(mine)))})
                yield _batch([(chunk, part["_id"].to_pylist(), planes(np.diff(bounds)), planes(np.concatenate(spots)), planes(order), asked)], _CUT)
                del part, numbers, spots, words, owner, order, asked, found  # before the next chunk's are made
                tidy()

    return made


_ASKED = pa.struct([("part", pa.int32()), ("words", pa.binary()), ("sizes", pa.binary())])
_CUT = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("spots", pa.binary()), ("order", pa.binary()), ("asked", pa.list_(_ASKED))])
_ANSWER = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("words", pa.binary()), ("sizes", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[list, list]:
    at = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[at].tolist(), np.split(values, at[1:]) if len(at) else []


def _apart(blob: bytes, sizes: np.ndarray) -> list[bytes]:
    ends = np.cumsum(sizes).tolist()
    return [blob[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _encode_words(ranks, pattern: str):
    """A part's distinct words are encoded once each; every chunk that asked gets the ids of its words."""

    def made(table: pa.Table) -> pa.Table:
        encode = _encoding(ranks.value, pattern)._encode_single_piece
        known: dict[bytes, np.ndarray] = {}
        out = []
        for chunk, part, blob, sizes in zip(*(table[c].to_pylist() for c in ("chunk", "part", "words", "sizes")), strict=True):
            got = []
            for word in _apart(unsqueeze(blob), unplanes(sizes)):
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = np.array(encode(word), np.uint32)
                got.append(ids)
            out.append((chunk, part, planes(np.concatenate(got)), planes(np.fromiter(map(len, got), np.int64, len(got)))))
        return pa.Table.from_batches([_batch(out, _ANSWER)])

    return made


def _texts(lists: pa.ListArray, look: dict[int, bytes]) -> list[bytes]:
    """The bytes of each list of ids, end to end."""
    return [b"".join(map(look.__getitem__, ids.values.to_numpy().tolist() if ids.is_valid else ())) for ids in lists]


def _assembled(table):
    """_assemble, with the ids decoded in the same task if the table of tokens' bytes is given."""

    def made(docs: pa.Table, answers: pa.Table) -> pa.Table:
        out = _assemble(docs, answers)
        if table is None:
            return out
        return out.append_column("decoded", pa.array(_texts(out["ids"].combine_chunks(), table.value), pa.binary()))

    return made


def _assemble(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """One chunk: its positions, and the ids of its words from every part."""
    doc, told = docs.to_pylist()[0], sorted(answers.to_pylist(), key=lambda r: r["part"])
    order, spots, lengths = (unplanes(doc[c]) for c in ("order", "spots", "lengths"))
    sizes, begin = np.empty(len(order), np.int32), np.empty(len(order), np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *(unplanes(r["words"]).astype(np.int32) for r in told)])
    given = np.concatenate([np.zeros(0, np.int64), *(unplanes(r["sizes"]) for r in told)])
    sizes[order], begin[order] = given, np.cumsum(given) - given
    bounds = np.concatenate([[0], np.cumsum(sizes[spots], dtype=np.int64)])[np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)]
    ids, at = np.empty(bounds[-1], np.int32), 0
    for a in range(0, len(spots), 1 << 18):  # some at a time: places take four times the memory of ids
        n = sizes[spots[a : a + (1 << 18)]]
        ends = np.cumsum(n)
        if len(n) and ends[-1]:
            ids[at : at + ends[-1]] = flat[np.repeat(begin[spots[a : a + (1 << 18)]] - ends + n, n) + np.arange(ends[-1])]
            at += ends[-1]
    return pa.table({"_id": pa.array(doc["ids"], pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))})


def encode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """One row for each row of docs: its id (long) and ids, the token ids of the text in order (array<int>); with
    back, also `decoded`, as decode() makes it of the ids, but in the task that laid them out.

    Each match of pattern is a word; a word's ids depend on the ranks only; no special tokens. Null or empty
    text: no ids. Null and repeated ids, repeated rows: ordinary, one row each. An empty table gives an empty
    table; other columns aren't looked at; texts of any length are taken whole (memory: some 40 bytes a byte of
    the longest text or of CHUNK, whichever is more).

    Plan: chunks of texts are cut into words with positions, in a table of the shared folder (positions pack to
    some 1.5 bytes each), bucketed by chunk; each chunk's distinct words shuffle to parts by hash, where each
    distinct word of the corpus is encoded once; the ids return to the chunks' buckets and are laid out by
    position. So positions never shuffle. The ranks are a file of
    fixed size, and are broadcast. The plan that explodes each word into a row would shuffle some 30 bytes a word.
    """
    spark = docs.sparkSession
    kept = spark.sparkContext.broadcast(ranks)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = settle_by(rows.mapInArrow(tidied(_cut(pattern, part_count(spark))), "chunk long, ids array<long>, lengths binary, spots binary, order binary, asked array<struct<part:int,words:binary,sizes:binary>>"), "words", "chunk", buckets)
    asked = cut.select("chunk", F.explode("asked").alias("a")).select("chunk", "a.part", "a.words", "a.sizes")
    answers = asked.groupBy("part").applyInArrow(tidied(_encode_words(kept, pattern)), "chunk long, part int, words binary, sizes binary")
    placed = cut.select("chunk", "ids", "lengths", "spots", "order").groupBy("chunk").cogroup(answers.groupBy("chunk"))
    table = token_bytes(spark, ranks) if back else None
    return placed.applyInArrow(tidied(_assembled(table)), "_id long, ids array<int>" + ", decoded binary" * back).withColumnRenamed("_id", id_col)


def token_bytes(spark: SparkSession, ranks: bytes):
    """The table of a token's bytes, a row for each rank: of fixed size, and so broadcast."""
    return spark.sparkContext.broadcast({i: b for b, i in read_ranks(ranks).items()})


def decode(encoded: DataFrame, ranks: bytes, ids_col: str = "ids") -> DataFrame:
    """encoded, with `decoded` (binary): the bytes of its ids, end to end. The table of a token's bytes has one row
    for each rank, fixed in size, and is joined as an array in each task. Null ids: no bytes; an id that isn't in the
    table fails the job, as it can't come from these ranks."""
    table = token_bytes(encoded.sparkSession, ranks)
    at = encoded.columns.index(ids_col)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = table.value
        for batch in batches:
            lists = batch.column(at)
            for a in range(0, len(lists), 256):
                part = batch.slice(a, 256)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(_texts(part.column(at), look), pa.binary())], names=[*part.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "decoded")
    return encoded.mapInArrow(tidied(made), f"{schema}, decoded binary")


def default_ranks() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return file.read()


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def query(docs: DataFrame) -> DataFrame:
    ranks = default_ranks()
    done = encode(docs.select("doc_id", "text"), ranks, default_pattern(), back=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def brute_force(rows: list[tuple], ranks: bytes, pattern: str) -> list[tuple]:
    """What query() returns, from the library alone; for tests."""
    encoding = _encoding(ranks, pattern)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    out = []
    for key, text in rows:
        ids = encoding.encode_ordinary(text or "")
        out.append((key, len(ids), sha(",".join(map(str, ids)).encode()), sha(encoding.decode_bytes(ids))))
    return out
