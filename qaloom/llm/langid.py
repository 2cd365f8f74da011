"""Language ID: evidence from text, declared markup language, address suffix and host, fused as probabilities."""

from __future__ import annotations

import html as markup
import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_spread, settle
from .words import LOWERED, pieces, raw, tidied

#: Distinct texts of each language that the text model is fitted on, about: those whose hash is under the share that
#: gives so many. Statistics of hosts, suffixes and markup cover all rows.
PER_LANGUAGE = 2000
#: Languages that the model has room for (at 256 KB each). Every labelled language is taken; if there are more than
#: this, training fails and says so, instead of leaving some out.
LANGUAGES = 500
CELLS = 1 << 16
#: Trigrams that count in full; a longer text counts as if it had so many, since its trigrams aren't independent.
TRUST = 60.0
#: Weights, in rows, of the level above in the chain all rows, domain, host; and of all rows for suffix and markup.
ABOVE, WEIGHT = 5.0, 20.0
#: A tag, comment or script that nothing closes runs to the end: so each character is looked at a few times only.
_DROP = re.compile(r"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[!/a-z][^>]*(?:>|\Z)")
_DECLARED = r"""(?i)<html\b[^<>]*?\blang\s*+=\s*+["']?+\s*+([A-Za-z]{2,8})"""


def visible(html: str) -> str:
    """The text of a page, in time linear in its length."""
    return markup.unescape(_DROP.sub(" ", html))


def _cells(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each trigram of bytes (A-Z lower-cased) of each text, and bounds."""
    data, off = raw(texts)
    low = LOWERED[data].astype(np.int64)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    cell = (low[:-2] * 0x9E3779B1 + low[1:-1] * 0x85EBCA77 + low[2:] * 0xC2B2AE3D) >> 7 & (CELLS - 1)
    lengths = np.maximum(np.diff(off) - 2, 0)
    inside = np.ones(len(cell), bool)
    for back in (1, 2):  # trigrams that reach into the next text
        cut = off[1:-1] - back
        inside[cut[(cut >= 0) & (cut < len(cell))]] = False
    kept = np.concatenate([[0], np.cumsum(inside)])
    bounds = kept[np.minimum(off, len(cell))]
    assert (np.diff(bounds) == lengths).all() or len(off) > 1
    return cell[inside], bounds


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], bytes]:
    """The languages, sorted, and the log probabilities of trigram cells under each. Null languages and texts are left
    out; a text that repeats counts once. No labelled rows: no languages. More than LANGUAGES: ValueError.

    Plan: distinct text hashes are counted by language; a text is in the sample if its hash is under its language's
    share, so no rows are ranked or sorted; the sample, and so the model, is bounded by languages times per_language.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("k"), F.col(text_col).alias("text"))
    distinct = known.select("lang", "k").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    sizes = {r["lang"]: r["n"] for r in distinct.limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages: raise langid.LANGUAGES, with 256 KB of memory for each, or clean the labels")
    langs = sorted(sizes)
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(min(1 << 31, -(-(per_language << 31) // n)))) for x, n in sizes.items()], F.lit(0))
    rows = known.filter(F.pmod(F.xxhash64(F.lit("sample"), "k"), F.lit(1 << 31)) < share).dropDuplicates(["lang", "k"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(langs), CELLS), np.int64)
        for batch in batches:
            own = np.array([langs.index(x) for x in batch["lang"].to_pylist()], np.int64)
            for a, b in pieces(batch["text"]):
                cells, bounds = _cells(batch["text"].slice(a, b - a))
                totals += np.bincount(np.repeat(own[a:b], np.diff(bounds)) * CELLS + cells, minlength=totals.size).reshape(totals.shape)
        cell = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(cell[0] * CELLS + cell[1], pa.int32()), pa.array(totals[cell], pa.int64())], names=["cell", "n"])

    summed = rows.mapInArrow(tidied(counted), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # at most languages x cells
    counts = np.full(len(langs) * CELLS, 0.5)
    for r in summed:
        counts[r["cell"]] += r["n"]
    counts = counts.reshape(len(langs), CELLS)
    out = io.BytesIO()
    np.save(out, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))
    return langs, out.getvalue()


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def identify(pages: DataFrame, langs: list[str], model: bytes, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of pages: its id, lang, confidence, text_lang, declared, host.

    lang has the largest product of: the text's likelihood by trigrams (tempered to TRUST trigrams); the declared
    language's and the address suffix's likelihoods, P(value | lang); and the host's prior, P(lang | host), smoothed
    towards its domain (last two labels) and that towards all rows. These three are sums of the text's own
    posteriors over all rows by value, host or domain, without the row's own part in its host's. Ties go to the first
    language by name. text_lang goes by the text alone.

    Null or empty text: all languages alike, so the other evidence decides. No declared language, no url, no host:
    that evidence is left out. Null and repeated ids and repeated rows are ordinary. An empty table gives an empty
    table; other columns aren't looked at; texts are read whole.

    Plan: one Python pass for the text, written to the shared folder; then aggregates with map-side sums, and joins
    back in which a host's rows are dealt to 16 tasks, so one very common host holds nobody up.
    """
    spark = pages.sparkSession
    kept, n = spark.sparkContext.broadcast(model), len(langs)
    if not n:
        raise ValueError("no language to choose from")
    url, html = F.col(url_col), F.coalesce(F.col(html_col), F.lit(""))
    host = host_of(url)
    said = F.lower(F.regexp_extract(html, _DECLARED, 1))
    rows = pages.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col).cast("string"), url).alias("_k"), host.alias("host"), said.alias("declared"), html.alias("_html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = np.load(io.BytesIO(kept.value))
        for batch in batches:
            for a, b in pieces(batch["_html"]):
                part = batch.slice(a, b - a)
                cells, bounds = _cells(pa.array([visible(h) for h in part["_html"].to_pylist()], pa.large_string()))
                size = np.diff(bounds)
                sums = np.stack([np.diff(np.concatenate([[0.0], np.cumsum(logs[k][cells], dtype=np.float64)])[bounds]) for k in range(n)], axis=1)
                sums *= np.minimum(1, TRUST / np.maximum(size, 1))[:, None]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, n), pa.int32()), pa.array(sums.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], names=[*part.schema.names[:-1], "_text"])

    id_type = rows.schema["_id"].dataType.simpleString()
    seen = settle(rows.mapInArrow(tidied(read), f"_id {id_type}, _k long, host string, declared string, _text array<double>"), "pages")
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)\.?$", 1)
    seen = seen.withColumns({"domain": F.when(domain == "", F.col("host")).otherwise(domain), "suffix": F.regexp_extract("host", r"\.([a-z]{2,})\.?$", 1), "_p": _softmax(F.col("_text"))})
    sums = [F.sum(F.get("_p", F.lit(i))).alias(f"s{i}") for i in range(n)]
    packed = lambda: F.array(*[f"s{i}" for i in range(n)])
    total = seen.agg(*sums).first()
    all_rows = [float(x or 0.0) + 1.0 for x in total]
    general = F.array(*[F.lit(x / sum(all_rows)) for x in all_rows])
    by = lambda key: seen.filter(F.col(key) != "").groupBy(key).agg(*sums).select(key, packed().alias(f"_{key}"))
    own, spread = seen, F.col("_k")
    for key in ("host", "domain", "suffix", "declared"):
        own = join_spread(own, by(key), [key], spread)
    less = F.when(F.col("_host").isNotNull(), F.zip_with("_domain", "_p", lambda a, b: F.greatest(a - b, F.lit(0.0))))
    from_domain = _smoothed(less, general, ABOVE)
    from_host = _smoothed(F.zip_with("_host", "_p", lambda a, b: F.greatest(a - b, F.lit(0.0))), from_domain, ABOVE)
    prior = F.when(F.col("_host").isNull(), general).otherwise(from_host)
    logs = F.zip_with(F.col("_text"), prior, lambda t, p: t + F.log(p))
    for key in ("_suffix", "_declared"):
        # P(value | lang) is in proportion to P(lang | value) / P(lang)
        ratio = F.zip_with(_smoothed(F.zip_with(key, "_p", lambda a, b: F.greatest(a - b, F.lit(0.0))), general, WEIGHT), general, lambda a, b: F.log(a / b))
        logs = F.when(F.col(key).isNull(), logs).otherwise(F.zip_with(logs, ratio, lambda a, b: a + b))
    names = F.array(*[F.lit(x) for x in langs])
    first = lambda p: F.get(names, (F.array_position(p, F.array_max(p)) - 1).cast("int"))
    told = own.withColumn("_all", _softmax(logs))
    return told.select(F.col("_id").alias(id_col), first(F.col("_all")).alias("lang"), F.array_max("_all").alias("confidence"), first(F.col("_p")).alias("text_lang"), "declared", "host")


def _softmax(logs: Column) -> Column:
    shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def _smoothed(counts: Column, above: Column, weight: float) -> Column:
    n = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(counts, above, lambda c, p: (c + weight * p) / (n + weight))


def query(spark: SparkSession, docs: DataFrame, pages: DataFrame) -> DataFrame:
    return identify(pages.select("page_id", "url", "html"), *train(docs.select("text", "lang")))
