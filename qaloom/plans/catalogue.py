"""The engine's queries over the fixture tables, each with the SQL that gives the same rows.

Questions are made from whole tables: each conversation is a question (its first turn), whose documents are the
conversation as paragraphs and then its later turns; its answer is words 3 to 5 of the last turn for even ids, and
absent text for odd ones; its metadata cell holds the address of the page of the same number, as JSON or not."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html, text, urls
from ..operators.bm25 import scores, top_segments, two_stage
from ..operators.contains_join import contains_join
from ..operators.judge import pick
from ..sources.fetch import Reply, fetch, with_text
from ..sources.files import legacy_documents, read_csv, remaining, write_csv
from . import acquire, extract, profile


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- fixtures -------------------------------------------------------------------------------------------------------


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, doc: each conversation's turns by a blank line."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return turns.select("conv_id", F.col("t").alias("turns"), F.array_join(F.transform("t", lambda x: x["text"]), "\n\n").alias("doc"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, metadata, problem, answer, documents."""
    t = threads(spark, sf_dir)
    w = text.words(F.try_element_at("turns", F.lit(-1))["text"])
    answer = F.when(F.col("conv_id") % 2 == 0, F.array_join(F.slice(w, 3, 3), " ")).otherwise("zzqx vvkk")
    later = F.transform(F.expr("slice(turns, 2, size(turns))"), lambda x: x["text"])
    base = t.select(F.col("conv_id").alias("row_id"), F.get("turns", F.lit(0))["text"].alias("problem"), answer.alias("answer"), F.concat(F.array("doc"), later).alias("documents"))
    page = table(spark, sf_dir, "pages").select(F.col("page_id").alias("row_id"), "url")
    cell = F.when(F.col("row_id") % 2 == 0, F.format_string('{"topic": "x", "urls": ["%s", " ftp://b ", "%s.pdf"]}', "url", "url")).otherwise(F.format_string("{'urls': ['%s', 'http://h/a.txt']}", "url"))
    return base.join(page, "row_id", "left").withColumn("metadata", F.when(F.col("url").isNotNull(), cell)).select("row_id", "metadata", "problem", "answer", "documents")


def profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile(questions(spark, sf_dir))


def document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, seg_idx, segment, question: every document's chunks, and the benchmark item that it is asked with."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.chunks(F.col("text"))).alias("seg_idx", "segment"))
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("question"))
    n = items.agg(F.count("*").alias("n"))  # one row
    return docs.join(F.broadcast(n), F.lit(True)).withColumn("item_id", F.col("doc_id") % F.col("n")).join(items, "item_id").select("doc_id", "seg_idx", "segment", "question")


URLS = [
    "https://en.wikipedia.org/wiki/A%20b", "https://en.m.wikipedia.org/wiki/A", "https://en.wikipedia.org/w/A", "https://en.wikipedia.org/wiki/C%2B%2B_a+b#x", "http://h/A.PDF",
    "http://h/b.htm", "http://h/c.txt", "http://h/a.pdf?x=1", "http://h/a.pdf/view", "http://h/", " http://a ", "ftp://b", "HTTP://c", "", "https://xen.wikipedia.org/wiki/Z;p", "http://h/d.html;v=1",
]


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url: those above and those of all pages."""
    fixed = spark.createDataFrame([(u,) for u in URLS], "url string")
    return table(spark, sf_dir, "pages").select("url").unionByName(fixed)


def fake_fetcher():
    """Replies made from the address alone: every seventh by length fails; PDFs and texts say what they are."""

    def get(address: str, params: dict | None) -> Reply:
        if params is not None:
            page = f'{{"query": {{"pages": {{"1": {{"extract": "<p>{params["titles"]}</p><p>two</p>"}}}}}}}}'
            return Reply(True, "application/json", page.encode())
        if len(address) % 7 == 0:
            return Reply(False)
        if address.lower().endswith(".pdf"):
            return Reply(True, "application/pdf", f"pdf {address}".encode())
        if address.lower().endswith(".txt"):
            return Reply(True, "text/plain", f"txt {address}".encode())
        return Reply(True, "text/html", f"<html><b>page</b>  {address}</html>".encode())

    return get


def fake_pdf(content: bytes) -> str:
    return content.decode() + "\n"


def fake_judge():
    return lambda question, answer, segments: "2" if len(question) % 2 else "none"


def _quick():
    from ..config import Config

    return Config(delay_seconds=0.0)


# --- queries --------------------------------------------------------------------------------------------------------


def word_count(s, d):
    return table(s, d, "documents").select("doc_id", text.count_words(F.col("text")).cast("long").alias("n_words"))


def bm25_tokens(s, d):
    t = text.tokens(F.col("text"))
    return table(s, d, "documents").select("doc_id", F.size(t).cast("long").alias("n_tokens"), F.md5(F.array_join(t, " ").cast("binary")).alias("tokens_md5"))


def answer_position(s, d):
    needles = table(s, d, "benchmark").select("item_id", F.col("text").alias("needle"))
    met = contains_join(table(s, d, "documents").select("doc_id", "text"), needles)
    before = text.count_words(F.substring("text", F.lit(1), F.col("chars")))
    return met.select("doc_id", "item_id", F.col("chars").cast("long").alias("chars"), before.cast("long").alias("words"))


def answer_first_document(s, d):
    hit = profile.first_answer(text.real_documents(F.col("documents")), F.col("answer"))
    found = questions(s, d).withColumn("hit", hit).filter("hit is not null")
    return found.select("row_id", F.col("hit.index").cast("long").alias("doc_idx"), F.col("hit.at.chars").cast("long").alias("chars"), F.col("hit.at.words").cast("long").alias("words"))


def chunks(s, d):
    made = table(s, d, "documents").select("doc_id", F.posexplode(text.chunks(F.col("text"))).alias("i", "chunk"))
    return made.select("doc_id", F.col("i").cast("long").alias("i"), F.md5(F.col("chunk").cast("binary")).alias("chunk_md5"))


def paragraphs(s, d):
    made = threads(s, d).select("conv_id", F.posexplode(text.paragraphs(F.col("doc"))).alias("i", "paragraph"))
    return made.select("conv_id", F.col("i").cast("long").alias("i"), "paragraph")


def segments(s, d):
    both = threads(s, d).select(F.lit("thread").alias("kind"), F.col("conv_id").alias("id"), F.col("doc")).unionByName(table(s, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("doc")))
    made = both.select("kind", "id", F.posexplode(text.segments(F.col("doc"))).alias("i", "segment"))
    return made.select("kind", "id", F.col("i").cast("long").alias("i"), F.md5(F.col("segment").cast("binary")).alias("segment_md5"))


def paragraph_at_position(s, d):
    spot = F.floor(F.length("doc") / 2).cast("int")
    return threads(s, d).select("conv_id", text.paragraph_at(F.col("doc"), spot).alias("paragraph"))


def context_window(s, d):
    """A window around the middle of each document, for an answer of 5 characters."""
    spot = F.floor(F.length("text") / 2).cast("int")
    return table(s, d, "documents").select("doc_id", F.md5(text.context_window(F.col("text"), F.lit("12345"), spot).cast("binary")).alias("window_md5"))


def bm25_scores(s, d):
    return scores(document_chunks(s, d), ["doc_id"]).select("doc_id", F.col("seg_idx").cast("long").alias("seg_idx"), F.round("score", 6).alias("score"))


def bm25_topk(s, d):
    return top_segments(document_chunks(s, d), ["doc_id"], 5).select("doc_id", F.col("seg_idx").cast("long").alias("seg_idx"))


def bm25_two_stage(s, d):
    qa = questions(s, d).select("row_id", F.col("problem").alias("_question"), text.real_documents(F.col("documents")).alias("_docs"))
    best = two_stage(extract.document_segments(qa, "row_id"), "row_id")
    return best.select("row_id", F.col("pos").cast("long").alias("pos"), F.col("doc_idx").cast("long").alias("doc_idx"), F.col("seg_idx").cast("long").alias("seg_idx"))


def long_answer_no_judge(s, d):
    return extract.extract(profiled(s, d)).select("row_id", "long_answer")


REPLIES = ["2", "0", "9", "none", "", "chunk 3.", "a1", "12 3", "-1", "1", None]


def judge_reply_parse(s, d):
    rows = s.createDataFrame(list(enumerate(REPLIES)), "id long, reply string")
    return rows.select("id", text.reply_choice(F.coalesce("reply", F.lit("")), F.lit(3)).cast("long").alias("choice"), text.reply_confirms(F.coalesce("reply", F.lit(""))).alias("confirms"))


def url_format(s, d):
    return addresses(s, d).select("url", urls.url_format(F.col("url")).alias("format"))


def format_histogram(s, d):
    return profile.format_histogram(profiled(s, d)).select("format", "n", F.round("percent", 6).alias("percent"))


def valid_urls(s, d):
    listed = addresses(s, d).select(urls.valid_urls(F.array("url", F.concat(F.lit("x"), "url"), F.lit(" http://y "))).alias("u"))
    return listed.select(F.explode("u").alias("url")).groupBy("url").agg(F.count("*").alias("n"))


def wiki_urls(s, d):
    return addresses(s, d).select("url", urls.is_wiki(F.col("url")).alias("wiki"), urls.wiki_language(F.col("url")).alias("language"))


def wiki_title(s, d):
    return addresses(s, d).select("url", urls.wiki_title(F.col("url")).alias("title"))


def url_dedup_cache(s, d):
    twice = addresses(s, d).unionByName(table(s, d, "pages").select("url"))
    return twice.groupBy("url").agg(F.count("*").alias("lookups")).select(urls.url_hash(F.col("url")).alias("url_md5"), "lookups")


CELLS = [
    '{"urls": ["http://a/x.pdf"]}', "{'topic': 'S', 'urls': ['http://a/x.pdf', 'http://b']}", "[1]", None, "", '{"urls": null}', '{"urls": "http://one"}', "see https://c/d and http://e'f", '{"a": 1}', "5",
]


def metadata_urls(s, d):
    fixed = s.createDataFrame(list(enumerate(CELLS)), "row_id long, metadata string").withColumn("row_id", -1 - F.col("row_id"))
    cells = questions(s, d).select("row_id", "metadata").unionByName(fixed)
    return cells.select("row_id", F.array_join(urls.metadata_urls(F.col("metadata")), "|").alias("urls"))


def event_props(s, d):
    got = F.from_json("props", "k int", {"allowSingleQuotes": "false"})["k"]
    return table(s, d, "events").select("event_id", got.cast("long").alias("k"))


def html_text(s, d):
    return table(s, d, "pages").select("page_id", F.md5(html.native(F.col("html")).cast("binary")).alias("text_md5"))


def html_text_parsed(s, d):
    return table(s, d, "pages").select("page_id", F.md5(html.html_text(F.col("html")).cast("binary")).alias("text_md5"))


def content_dispatch(s, d):
    both = addresses(s, d).withColumn("content_type", F.explode(F.array(*[F.lit(k) for k in ("text/html", "application/pdf", "text/plain", "")], F.lit(None).cast("string"))))
    return both.select("url", "content_type", urls.dispatch(F.col("content_type"), F.col("url")).alias("decoder"))


def profile_columns(s, d):
    return profiled(s, d).select(
        "row_id", F.col("num_documents").cast("long").alias("num_documents"), F.array_join("document_formats", ",").alias("document_formats"), F.round("avg_document_length_words", 6).alias("avg_document_length_words"),
        "answer_found_in_documents", *[F.col(c).cast("long").alias(c) for c in ("answer_position_words", "answer_position_chars", "answer_found_in_doc_index")],
    )


def profile_summary(s, d):
    one = profile.summary(profiled(s, d))
    return one.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in one.dtypes])


def run_report(s, d):
    """Of a made-up log: pages whose number divides by 7 failed, those that divide by 5 went to the API."""
    i = F.col("page_id")
    log = table(s, d, "pages").select("url", (i % 7 != 0).alias("ok"), (i % 5 == 0).alias("via_api"), ((i % 5 == 0) & (i % 7 != 0)).alias("api_ok"), F.when(i % 7 != 0, F.lit("text")).alias("text"))
    qa = questions(s, d).drop("documents")
    with_docs = acquire.with_documents(qa, log)
    one = acquire.run_report(with_docs, acquire.question_urls(qa), log)
    return one.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in one.dtypes])


def limit_rows(s, d):
    """The first 10 rows: the limit is the operator."""
    return table(s, d, "documents").orderBy("doc_id").limit(10).select("doc_id", "n_chars")


def restart_remaining(s, d):
    todo, done = table(s, d, "documents"), table(s, d, "labels")
    return remaining(todo, done, "doc_id").select("doc_id", "lang")


def fetch_fake(s, d):
    got = fetch(addresses(s, d).filter("url <> ''"), fake_fetcher, fake_pdf, _quick())
    return got.select("url", "via_api", "api_ok", "ok", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def acquire_fake(s, d):
    done, _ = acquire.acquire(questions(s, d).drop("documents"), fake_fetcher, fake_pdf, config=_quick())
    return done.select("row_id", F.size("documents").alias("n"), F.md5(F.array_join("documents", "|").cast("binary")).alias("documents_md5"))


def pdf_fake(s, d):
    return with_text(addresses(s, d), F.lit("pdf"), F.col("url").cast("binary"), fake_pdf)


def judge_fake(s, d):
    qa = threads(s, d).select("conv_id", F.col("turns")[0]["text"].alias("problem"), F.lit("a").alias("answer"), text.segments(F.col("doc")).alias("segments"))
    return qa.select("conv_id", pick(qa, fake_judge).alias("passage"))


def long_answer_judge(s, d):
    return extract.extract(profiled(s, d), make_judge=fake_judge).select("row_id", "long_answer")


def csv_roundtrip(s, d):
    """The conversations, written as CSV and read back."""
    base = s.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="qaloom-csv-")
    path = f"{base.rstrip('/')}/qaloom-csv-{uuid.uuid4().hex}"
    write_csv(table(s, d, "conversations").select("conv_id", "turn", "role", "text"), path)
    return read_csv(s, path, "conv_id long, turn long, role string, text string")


LEGACY = [
    "['a', ' ', 'b\"c']", '["x", "it\'s"]', "plain text", "'one'", "[]", None, "5", "['multi\\nline']", "  ['padded']  ",
]


def legacy_cells(s, d):
    rows = s.createDataFrame(list(enumerate(LEGACY)), "id long, cell string")
    read = rows.withColumns({"loose": legacy_documents(F.col("cell")), "strict": legacy_documents(F.col("cell"), strict=True)})
    return read.select("id", F.array_join("loose", "|").alias("loose"), F.array_join("strict", "|").alias("strict"))


def wiki_requests(s, d):
    asked = urls.wiki_api(F.col("url"))
    return addresses(s, d).select("url", asked["address"].alias("address"), asked["titles"].alias("titles"))


def html_paragraphs(s, d):
    return table(s, d, "pages").select("page_id", html.html_paragraphs(F.col("html")).alias("text"))


def fill_ratio(s, d):
    return extract.fill_ratio(extract.extract(profiled(s, d)))


QUERIES = {
    f.__name__: f
    for f in (
        word_count, bm25_tokens, answer_position, answer_first_document, chunks, paragraphs, segments, paragraph_at_position, context_window, bm25_scores, bm25_topk, bm25_two_stage, long_answer_no_judge,
        judge_reply_parse, url_format, format_histogram, valid_urls, wiki_urls, wiki_title, url_dedup_cache, metadata_urls, event_props, html_text, html_text_parsed, content_dispatch, profile_columns,
        profile_summary, run_report, limit_rows, restart_remaining, fetch_fake, acquire_fake, pdf_fake, judge_fake, long_answer_judge, csv_roundtrip, legacy_cells, wiki_requests, html_paragraphs, fill_ratio,
    )
}
