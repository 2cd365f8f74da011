"""Benchmark decontamination: documents that hold word windows of a benchmark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_ascii, join_spread, let, row_key, settle

#: Bytes of window hashes, at 64 a window, up to which the set goes to every executor; beyond, the windows shuffle.
BROADCAST_BYTES = 128 << 20
#: Bytes of row keys, at 64 each, up to which the rows with hits are known to every executor; beyond, texts shuffle.
KEY_BYTES = 64 << 20
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the A-Z-folded text; none of null."""
    return F.array_remove(F.split(fold_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, -1), "")


def window_hashes(array: Column, length: int) -> Column:
    """The hash of every run of `length` words, by 0-based start: of two runs' hashes that of both together, so that
    it takes a few steps a word, however long the run."""

    def joined(a: Column, b: Column, ahead: int) -> Column:
        return F.zip_with(a, F.slice(b, ahead + 1, F.size(b)), lambda x, y: F.xxhash64(x, y))

    def grown(size: int, run: Column, done: Column | None, covered: int) -> Column:
        # run: of `size` words, a power of 2; done: of `covered` words; what reaches beyond the text is cut at the end
        if length & size:
            done, covered = run if done is None else joined(done, run, covered), covered + size
        if covered == length:
            return F.slice(done, 1, F.greatest(F.size(done) - length + 1, F.lit(0)))
        onward = lambda d: let(joined(run, run, size), lambda twice: grown(2 * size, twice, d, covered))
        return onward(None) if done is None else let(done, onward)

    return let(F.transform(array, lambda w: F.xxhash64(w)), lambda h: grown(1, h, None, 0))


def benchmark_windows(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """gram (the window's words), length, items (distinct ids): one row for each distinct window. An item of
    fewer words than `window`, but not none, is one window; null ids count as the id ''."""
    cut = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    own = F.transform(F.sequence(F.lit(0), F.size("w") - length), lambda i: F.slice("w", i + 1, length))
    gram = cut.select("item", length.alias("length"), F.explode(own).alias("gram"))  # the item's other words stay behind
    return gram.groupBy("gram", "length").agg(F.collect_set("item").alias("items"))


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", bench_text_col: str = "text") -> DataFrame:
    """For each row of docs: its id, n_words (long), hits (sorted 0-based word positions inside any occurrence of a
    benchmark window), items (sorted ids, as text, of the items whose windows occur), and _k1, _k2, 128 bits of the
    id and text.

    Null or wordless text: no words, no hits. Null and repeated ids, and repeated rows, are ordinary: one result
    row for each row. Either table may be empty. Columns beyond the id and text are not looked at here. Texts are
    taken whole, in time and memory linear in their length.

    Plan: the distinct windows form a broadcast hash set when their counted number times 64 bytes is within
    BROADCAST_BYTES, else the windows shuffle by hash, a common one's rows dealt to 16 tasks. A text is cut once; of
    each window only row key, place and hash leave the row, and rows met are written down: each text's count, and its
    hits. Then only the texts with hits are read again, by their keys (broadcast if their counted number times 64
    bytes is within KEY_BYTES), and every hit is confirmed on the words themselves.
    """
    bench = settle(benchmark_windows(benchmark, window, item_col, bench_text_col), "windows")
    stated = bench.groupBy("length").agg(F.count("*").alias("n")).orderBy("length").collect()  # a row for each length up to window
    lengths, total = [r["length"] for r in stated], sum(r["n"] for r in stated)
    hashed = [F.when(F.col("length") == n, F.get(window_hashes(F.col("gram"), n), F.lit(0))) for n in lengths]
    bench = bench.withColumn("h", F.coalesce(*hashed, F.lit(None).cast("long")))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = "array<struct<length:int,n_words:int,hashes:array<bigint>>>"
    made = lambda w: F.array(F.struct(F.lit(0), F.size(w), F.lit(None)), *[F.struct(F.lit(n), F.lit(0), window_hashes(w, n)) for n in lengths]).cast(kind)
    cut = rows.select("_id", *row_key(rows, "_id", "_text"), F.inline(let(words(F.col("_text")), made)))
    flat = cut.select("_id", "_k1", "_k2", "length", "n_words", F.posexplode_outer("hashes").alias("i", "h"))
    known = bench.select("h", "length", F.lit(True).alias("_met")).distinct()
    if total * 64 <= BROADCAST_BYTES:
        met = flat.join(F.broadcast(known), ["h", "length"], "left").filter("_met or length = 0")
    else:
        far = join_spread(flat.filter("i is not null"), known, ["h", "length"], F.col("_k1"), how="inner")
        met = flat.filter("length = 0").withColumn("_met", F.lit(None).cast("boolean")).unionByName(far)
    met = settle(met, "met")
    own = met.filter("length = 0").select("_id", "_k1", "_k2", F.col("n_words").cast("long").alias("n_words"))
    # by row and window, so that a window's words and items come once for each row, however often it stands there
    spots = met.filter("length > 0").groupBy("_k1", "_k2", "h", "length").agg(F.collect_set("i").alias("at"))
    told = join_spread(spots, bench, ["h", "length"], F.col("_k1"), how="inner") if total * 64 > BROADCAST_BYTES else spots.join(F.broadcast(bench), ["h", "length"])
    byrow = settle(told.groupBy("_k1", "_k2").agg(F.collect_list(F.struct("gram", "length", "items", "at")).alias("told")), "hits")
    keys = byrow.select("_k1", "_k2")
    near = F.broadcast if byrow.count() * 64 <= KEY_BYTES else lambda x: x
    texts = rows.select(*row_key(rows, "_id", "_text"), "_text").join(near(keys), ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"])
    read = texts.join(byrow, ["_k1", "_k2"]).select("_k1", "_k2", "told", words(F.col("_text")).alias("_w"))
    sure = let(F.col("_w"), lambda w: F.transform("told", lambda t: F.struct(t["length"].alias("length"), t["items"].alias("items"), F.filter(t["at"], lambda i: F.slice(w, i + 1, t["length"]) == t["gram"]).alias("at"))))
    checked = read.select("_k1", "_k2", F.filter(sure, lambda t: F.size(t["at"]) > 0).alias("sure"))
    inside = F.flatten(F.transform("sure", lambda t: F.flatten(F.transform(t["at"], lambda i: F.sequence(i, i + t["length"] - 1)))))
    final = settle(checked.select("_k1", "_k2", F.array_sort(F.array_distinct(inside)).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.transform("sure", lambda t: t["items"])))).alias("items")), "confirmed")
    both = own.join(near(final), ["_k1", "_k2"], "left")
    return both.select(F.col("_id").alias(id_col), "n_words", F.coalesce("hits", F.array().cast("array<int>")).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), "_k1", "_k2")


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """docs without the rows in which a benchmark window occurs; columns and other rows stay as they are."""
    bad = find(docs.select("doc_id", "text"), benchmark, window).filter(F.size("hits") > 0).select("_k1", "_k2").distinct()
    keyed = docs.select(*row_key(docs, "doc_id", "text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return keyed.join(bad, ["_k1", "_k2"], "left_anti").select("_row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id and text without the hit words: each maximal run of hit words goes with the separators after it.
    What stands before the first word always stays."""
    found = find(docs, benchmark, window).filter(F.size("hits") > 0).select("_k1", "_k2", "hits").dropDuplicates(["_k1", "_k2"])
    found = docs.select("doc_id", "text", *row_key(docs, "doc_id", "text")).join(found, ["_k1", "_k2"], "left")
    part = F.expr(r"regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*', 0)")
    lead = F.regexp_extract("text", r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    stay = F.array_except(F.sequence(F.lit(0), F.size(part) - 1), F.col("hits"))
    rest = F.array_join(F.transform(stay, lambda i: F.get(part, i)), "")
    return found.select("doc_id", F.when(F.col("hits").isNull(), F.col("text")).otherwise(F.concat(lead, rest)).alias("text"))


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


_W = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
SQL = f"""
WITH items AS (SELECT item_id, {_W} AS w FROM benchmark),
grams AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + least(len(w), 10) - 1] AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM items WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM grams),
docs AS (SELECT doc_id, row_number() OVER () AS rid, {_W} AS w FROM documents),
runs AS (SELECT rid, n, i, w[i:i + n - 1] AS g FROM (SELECT rid, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM docs, lens WHERE len(w) >= n)),
met AS (SELECT rid, runs.n, i, item_id FROM runs JOIN grams ON runs.g = grams.g),
spots AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM met) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN spots USING (rid) LEFT JOIN found USING (rid)
"""
