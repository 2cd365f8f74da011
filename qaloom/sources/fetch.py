"""Fetching documents: each distinct URL once, by a pluggable fetcher, decoded, and laid back onto the questions."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..config import DEFAULT, Config
from ..functions.html import html_plain, html_structured
from ..functions.text import flatten_lines, paragraph_lines
from ..functions.urls import dispatch, is_wiki, url_hash, wiki_api, wiki_extract


class Reply(NamedTuple):
    ok: bool
    content_type: str | None = None
    body: bytes | None = None


#: (address, parameters) to a reply; made once in each worker by the factory that is passed in, as sessions can't be sent.
Fetcher = Callable[[str, dict | None], Reply]
PdfDecoder = Callable[[bytes], str]

#: Tasks that may ask one host, each with so many threads and such a delay as Config says.
HOST_TASKS = 8

_RAW = "url string, via_api boolean, api_body string, ok boolean, content_type string, body binary"


def http_fetcher(config: Config = DEFAULT) -> Callable[[], Fetcher]:
    """The fetcher of the real network, for use as a factory."""

    def make() -> Fetcher:
        import requests

        session = requests.Session()
        session.headers["User-Agent"] = "Mozilla/5.0 (compatible; qaloom)"

        def get(address: str, params: dict | None) -> Reply:
            try:
                got = session.get(address, params=params, timeout=config.timeout_seconds)
                got.raise_for_status()
                return Reply(True, got.headers.get("content-type"), got.content)
            except requests.RequestException:
                return Reply(False)

        return get

    return make


def fetch(urls: DataFrame, make_fetcher: Callable[[], Fetcher], pdf: PdfDecoder | None = None, config: Config = DEFAULT, parts: int | None = None) -> DataFrame:
    """urls (url) to one row for each distinct url: url, url_md5, via_api, api_ok, ok, content_type, text.

    Encyclopedia pages go to their API first and to the page if that gives no text. Failures are rows too, with ok
    false and null text, so they aren't asked for again. A task may run twice, so fetchers must be idempotent.
    """
    wiki = is_wiki(F.col("url"))
    asked = urls.select("url").filter("url is not null").dropDuplicates(["url"]).withColumn("api", F.when(wiki & F.coalesce(wiki_api(F.col("url"))["titles"] != "", F.lit(False)), wiki_api(F.col("url"))))
    # by host, so that HOST_TASKS tasks at most ask one host; a stated number of partitions isn't packed into fewer
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    asked = asked.repartition(parts or int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions")), host, F.pmod(F.xxhash64("url"), F.lit(HOST_TASKS)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = make_fetcher()

        def one(url: str, api) -> tuple:
            if api is not None:
                reply = get(api["address"], {k: api[k] for k in ("action", "prop", "format", "titles")})
                if reply.ok and b'"extract"' in (reply.body or b""):
                    return url, True, (reply.body or b"").decode("utf-8", "replace"), True, None, None
            reply = get(url, None)
            return url, api is not None, None, reply.ok, reply.content_type, reply.body

        with ThreadPoolExecutor(config.fetch_threads) as pool:
            for batch in batches:
                rows = []
                for start in range(0, len(batch), config.fetch_threads):
                    part = batch.iloc[start : start + config.fetch_threads]
                    rows += pool.map(one, part["url"], [None if a is None or isinstance(a, float) else a for a in part["api"]])
                    time.sleep(config.delay_seconds)
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in _RAW.split(", ")])

    raw = asked.mapInPandas(run, _RAW)
    # Python works on plain columns, and what follows is column by column
    read = raw.withColumn("_extract", wiki_extract(F.col("api_body"))).withColumn("_api", html_structured(F.col("_extract")))
    read = read.withColumn("_api", paragraph_lines(F.col("_api"))).withColumn("_kind", dispatch(F.col("content_type"), F.col("url")))
    read = with_text(read, F.col("_kind"), F.col("body"), pdf, "_page")
    text = F.when(F.col("_api") != "", F.col("_api")).otherwise(F.when(F.col("_page") != "", F.col("_page")))
    done = read.withColumn("text", F.when(F.col("ok"), text))
    return done.select("url", url_hash(F.col("url")).alias("url_md5"), "via_api", (F.col("via_api") & F.col("api_body").isNotNull() & (F.col("_api") != "")).alias("api_ok"), F.col("text").isNotNull().alias("ok"), "content_type", "text")


def with_text(df: DataFrame, kind: Column, body: Column, pdf: PdfDecoder | None = None, name: str = "text") -> DataFrame:
    """df with the text of a reply, by the decoder that dispatch() names; without a PDF decoder, PDFs have none."""

    @F.pandas_udf(StringType())
    def pages(bodies: pd.Series) -> pd.Series:
        def one(b):
            try:
                return pdf(b).strip() if b is not None else None
            except Exception:  # a file that can't be read has no text
                return ""

        return bodies.map(one)

    plain = F.make_valid_utf8(body.cast("string"))
    split = df.withColumns({"_plain": plain, "_binary": F.when(kind == "pdf", body), "_markup": F.when(~kind.isin("pdf", "text"), plain)})
    read = split.withColumns({"_pdf": pages(F.col("_binary")) if pdf is not None else F.lit(None).cast("string"), "_html": html_plain(F.col("_markup"))})
    text = F.when(kind == "pdf", F.col("_pdf")).when(kind == "text", F.col("_plain")).otherwise(flatten_lines(F.col("_html")))
    return read.withColumn(name, text).drop("_plain", "_binary", "_markup", "_pdf", "_html")


def pdf_text(files: DataFrame, pdf: PdfDecoder) -> DataFrame:
    """Rows of Spark's binaryFile source, with text."""
    return with_text(files, F.lit("pdf"), F.col("content"), pdf).select("path", "text")


def pypdf_decoder() -> PdfDecoder | None:
    """The text of a PDF's pages by the package pypdf; None if it isn't installed, and then PDFs have no text."""
    try:
        import pypdf  # noqa: F401
    except ImportError:
        return None

    def decode(body: bytes) -> str:
        import io

        from pypdf import PdfReader

        return "\n".join(page.extract_text() or "" for page in PdfReader(io.BytesIO(body)).pages)

    return decode
