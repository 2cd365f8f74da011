"""Secret scans: rules as regular expressions, candidates from a trigram inverted index, spans from the rules."""

from __future__ import annotations

from itertools import product
from re import _constants as sre
from re import _parser as sre_parse  # the standard library's own parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_ascii, let, row_key, running, settle, values



class Rule(NamedTuple):
    """kind: its name. pattern: a regular expression, the same to Java and to Python. group, least: matches whose
    group has fewer code points fall, after they have used up their text."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # `AKIA[A-Z0-9]+` of 20 and `[0-9a-f]+` of 24 or more: a shorter run holds no later match of that length
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]
RULES = [
    *BASE,
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
#: Bytes of candidates' keys, at 64 each, up to which they go to every executor; beyond, texts shuffle to them.
KEY_BYTES = 64 << 20
MOST = 64  # alternatives kept apart; beyond, the pieces are cut and each stands for itself


class Need(NamedTuple):
    """exact: all strings that the part can match, or None if they aren't few. needs: alternatives, each a set of
    trigrams that a match through it must hold; an empty set among them stands for "no condition"."""

    exact: frozenset[str] | None
    needs: frozenset[frozenset[str]]


ANY = frozenset([frozenset()])


def _grams(strings) -> frozenset[frozenset[str]]:
    return frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _both(a: frozenset[frozenset[str]], b: frozenset[frozenset[str]]) -> frozenset[frozenset[str]]:
    if len(a) * len(b) > MOST:
        return a if frozenset() not in a else b
    return frozenset(x | y for x in a for y in b)


def _sequence(parts: list[Need]) -> Need:
    needs, run, whole = ANY, frozenset([""]), True
    for p in parts:
        if p.exact is not None and len(run) * len(p.exact) <= MOST:
            run = frozenset(x + y for x, y in product(run, p.exact))
            continue
        needs, whole = _both(needs, _grams(run)), False
        if p.exact is not None:
            run = p.exact
        else:
            needs, run = _both(needs, p.needs), frozenset([""])
    return Need(run if whole else None, _both(needs, _grams(run)))


def _need(parsed) -> Need:
    parts = []
    for op, arg in parsed:
        if op is sre.LITERAL:
            parts.append(Need(frozenset([chr(arg).lower()]), ANY))
        elif op is sre.IN and len(arg) <= 8 and all(o is sre.LITERAL for o, _ in arg):
            parts.append(Need(frozenset(chr(a).lower() for _, a in arg), ANY))
        elif op is sre.SUBPATTERN:
            parts.append(_need(arg[-1]))
        elif op is sre.BRANCH:
            ways = [_need(w) for w in arg[1]]
            exact = frozenset().union(*(w.exact for w in ways)) if all(w.exact is not None for w in ways) else None
            parts.append(Need(exact if exact is None or len(exact) <= MOST else None, frozenset().union(*(w.needs for w in ways))))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = arg[0], arg[1], _need(arg[2])
            if (low, high) == (0, 1) and inner.exact is not None:
                parts.append(Need(inner.exact | {""}, ANY))
            elif low == 0:
                parts.append(Need(None, ANY))
            else:
                parts += [inner] * min(low, 3) + ([Need(None, ANY)] if high > min(low, 3) else [])
        elif op is sre.AT:
            continue
        else:
            parts.append(Need(None, ANY))
    return _sequence(parts)


def trigram_query(pattern: str) -> frozenset[frozenset[str]]:
    """An OR of ANDs of lower-case trigrams: a text whose folded form fulfils none of them can't match. Holds an
    empty set if the pattern demands no trigram; then every text is scanned."""
    needs = _need(sre_parse.parse(pattern)).needs
    return ANY if frozenset() in needs else frozenset(n for n in needs if not any(m < n for m in needs))


def index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: a posting (gram, _k1, _k2) for each of the trigrams that a row's folded text holds. Only
    trigrams of some rule's query get postings, so its size is bounded by rows times the rules' trigrams."""
    grams = F.array(*[F.lit(t) for t in trigrams])
    # binary search of bytes in the text: no list of all its trigrams is made
    held = F.filter(grams, lambda t: F.contains(F.col("_low"), t))
    return docs.select("_k1", "_k2", fold_ascii(F.col("_text")).alias("_low")).select("_k1", "_k2", F.explode(held).alias("gram"))


def candidates(docs: DataFrame, rules: list[Rule]) -> DataFrame | None:
    """_k1, _k2, _rules: the numbers of the rules whose trigram query the row's postings fulfil. None if every rule
    scans fully."""
    queries = [(k, a, sorted(alt)) for k, r in enumerate(rules) for a, alt in enumerate(sorted(map(sorted, trigram_query(r.pattern)))) if alt]
    if not queries:
        return None
    spark = docs.sparkSession
    asked = values(spark, "rule int, alt int, want int, gram string", [(k, a, len(alt), t) for k, a, alt in queries for t in alt])  # of the rules, not of the data
    postings = index(docs, sorted({t for *_, alt in queries for t in alt}))
    # repeated rows share their key: each gram counts once
    met = postings.join(F.broadcast(asked), "gram").groupBy("_k1", "_k2", "rule", "alt", "want").agg(F.size(F.collect_set("gram")).alias("n"))
    return met.filter("n = want").groupBy("_k1", "_k2").agg(F.collect_set("rule").alias("_rules"))


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """start, order, end of the rule's leftmost non-overlapping matches, in code points, end exclusive. What stands
    between the matches and the matches themselves, laid end to end, are the text: that gives the places. Texts
    without a match, which are most, are read once, up to the end."""
    empty = F.array().cast("array<struct<start:int,ord:int,end:int>>")
    between, whole = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    lengths = lambda parts: F.transform(parts, lambda x: F.length(x))

    def placed(own: Column) -> Column:
        """own: lengths of gaps and of matches. The n-th match begins after n + 1 gaps and n matches."""
        gaps = F.slice(own["gaps"], 1, F.size(own["all"]))
        start = F.zip_with(running(F.zip_with(gaps, own["all"], lambda a, b: a + b)), gaps, lambda a, b: (a + b).cast("int"))
        return F.zip_with(start, own["all"], lambda a, b: F.struct(a.alias("start"), F.lit(order).alias("ord"), (a + b).alias("end")))

    found = let(F.struct(lengths(between).alias("gaps"), lengths(whole).alias("all")), placed)
    if rule.least > 1:
        sizes = lengths(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)))
        both = F.zip_with(found, sizes, lambda x, n: F.when(n >= rule.least, x))
        found = F.filter(both, lambda x: x.isNotNull())
    return F.when(F.rlike(text, F.lit(rule.pattern)), found).otherwise(empty)


def scan(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of docs: its id and spans, an array of (kind, start, end) in code points, end exclusive, sorted
    by start and then by the order of the rules.

    Each rule's matches are leftmost and don't overlap; spans of different rules may. Null or empty text: no spans.
    Null ids, repeated ids and repeated rows are ordinary: one result row for each row. An empty table gives an
    empty table; columns beyond the id and text are not looked at. Texts of any length are scanned whole.

    Plan: postings for the trigrams that the rules demand; an intersection by row and alternative; the surviving
    (row, rules) pairs are written down and join the texts (as a broadcast, if their counted number times 64 bytes is
    within KEY_BYTES: then no text is shuffled), and a rule runs only on its candidates. A rule without mandatory
    trigrams (here hex) runs on every text. Keys are 128-bit row hashes, so no trigram is a shuffle key.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    keyed = rows.select("*", *row_key(rows, "_id", "_text"))
    found = candidates(keyed, rules)
    if found is not None:
        found = settle(found, "candidates")
        found = F.broadcast(found) if found.count() * 64 <= KEY_BYTES else found
    joined = keyed.join(found, ["_k1", "_k2"], "left") if found is not None else keyed.withColumn("_rules", F.lit(None).cast("array<int>"))
    parts = []
    for k, r in enumerate(rules):
        got = spans_of(F.col("_text"), r, k)
        parts.append(got if frozenset() in trigram_query(r.pattern) else F.when(F.array_contains("_rules", k), got).otherwise(F.array().cast("array<struct<start:int,ord:int,end:int>>")))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    named = F.transform(F.array_sort(F.concat(*parts)), lambda s: F.struct(F.get(kinds, s["ord"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return joined.select(F.col("_id").alias(id_col), named.alias("spans"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(docs: DataFrame) -> DataFrame:
    done = scan(docs.select("doc_id", "text"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return done.select("doc_id", *counts, F.sha2(listed(of(*[r.kind for r in BASE])).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _sql() -> str:
    """Between the matches of a pattern stand the pieces that a split leaves; their lengths give the places."""
    parts = []
    stated = [RULES[0], Rule("access", "AKIA[A-Z0-9]+", 0, 20), Rule("hex", "[0-9a-f]+", 0, 24), *RULES[3:]]
    for k, r in enumerate(stated):
        p = r.pattern.replace("'", "''")
        parts.append(
            f"SELECT rid, {k} AS ord, '{r.kind}' AS kind, s, s + length(m[i]) AS e FROM (SELECT rid, m, g, i, CAST(coalesce(list_sum(list_transform(b[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s "
            f"FROM (SELECT rid, m, g, b, unnest(generate_series(1, len(m))) AS i FROM (SELECT rid, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {r.group}) AS g, string_split_regex(t, '{p}') AS b FROM docs) WHERE len(m) > 0)) WHERE length(g[i]) >= {r.least}"
        )
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
found AS ({" UNION ALL ".join(parts)}),
lists AS (SELECT rid, count(*) FILTER (WHERE ord = 0) AS n_assign, count(*) FILTER (WHERE ord = 1) AS n_access, count(*) FILTER (WHERE ord = 2) AS n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) FILTER (WHERE ord < 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS spans FROM found GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN lists USING (rid)
"""


SQL = _sql()
