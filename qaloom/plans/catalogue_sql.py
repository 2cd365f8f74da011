"""For each query of the catalogue, SQL for DuckDB that gives the same rows; written from the semantics, not the plans."""

from __future__ import annotations

from ..functions.html import ENTITIES
from ..functions.text import SENTENCE_ENDS
from ..functions.urls import WIKI_HOSTS
from .catalogue import CELLS, REPLIES, URLS

W = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def q(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{W}+|{W}+$', '', 'g')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{W}+'), lambda w: w <> '')"


def paragraphs(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, chr(10) || chr(10)), lambda p: {strip('p')}), lambda p: p <> '')"


def chunks(w: str) -> str:
    return f"CASE WHEN len({w}) = 0 THEN CAST([] AS VARCHAR[]) ELSE list_transform(generate_series(0, greatest(CAST(ceil((len({w}) - 400) / 320.0) AS BIGINT), 0)), lambda i: array_to_string({w}[i * 320 + 1:i * 320 + 400], ' ')) END"


def tokens(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]+')"


def window(t: str, answer_length: str, place: str) -> str:
    """From a row with the text and place, as a scalar subquery."""
    last = "coalesce(" + ", ".join(f"CASE WHEN contains(b, {q(s)}) THEN length(b) - strpos(reverse(b), {q(s)}) + 1 END" for s in SENTENCE_ENDS) + ")"
    first = "coalesce(" + ", ".join(f"nullif(strpos(f, {q(s)}), 0)" for s in SENTENCE_ENDS) + ")"
    return f"""(SELECT {strip("substr(t, lo + 1, hi - lo)")} FROM (SELECT t, CASE WHEN st > 0 AND {last} IS NOT NULL THEN greatest(st - 200 + {last}, 0) ELSE st END AS lo,
 CASE WHEN en < length(t) AND {first} IS NOT NULL THEN en + {first} ELSE en END AS hi FROM (SELECT t, st, en, substr(t, st - least(st, 200) + 1, least(st, 200)) AS b, substr(t, en + 1, 200) AS f
 FROM (SELECT {t} AS t, greatest({place} - 400, 0) AS st, least({place} + {answer_length} + 400, length({t})) AS en))))"""


def paragraph_at(p: str, place: str) -> str:
    """From a list of paragraphs."""
    ends = f"list_transform(generate_series(1, len({p})), lambda i: list_sum(list_transform({p}[1:i], lambda x: length(x) + 2)))"
    return f"CASE WHEN len({p}) >= 2 THEN coalesce({p}[list_position(list_transform({ends}, lambda e: e > {place}), true)], {p}[len({p})]) END"


def path(u: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace({u}, '[?#](?s:.)*$', ''), '^([A-Za-z][A-Za-z0-9+.\-]*:)?//[^/]*', ''), ';[^/]*$', '')"


def url_format(u: str) -> str:
    low, at = f"lower({u})", f"lower({path(u)})"
    ends = f"WHEN ends_with({low}, '.pdf') THEN 'pdf' WHEN ends_with({low}, '.html') OR ends_with({low}, '.htm') THEN 'html' WHEN ends_with({low}, '.txt') THEN 'txt'"
    return f"CASE {ends} WHEN contains({at}, '.pdf') THEN 'pdf' WHEN contains({at}, '.htm') THEN 'html' WHEN contains({at}, '.txt') THEN 'txt' ELSE 'unknown' END"


def host(u: str) -> str:
    return rf"lower(regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1))"


def urls_of(m: str) -> str:
    none = "CAST([] AS VARCHAR[])"
    listed = f"coalesce(CAST(json_extract({m}, '$.urls') AS VARCHAR[]), {none})"
    kind = f"json_type({m}, '$.urls')"
    given = f"CASE WHEN json_type({m}) <> 'OBJECT' OR {kind} IS NULL THEN {none} WHEN {kind} = 'ARRAY' THEN {listed} WHEN {kind} = 'VARCHAR' THEN [json_extract_string({m}, '$.urls')] ELSE {none} END"
    return rf"CASE WHEN {m} IS NULL OR {m} = '' THEN {none} WHEN json_valid({m}) THEN {given} ELSE regexp_extract_all({m}, 'https?://[^\s''""]+') END".replace('""', '"')


THREADS = "threads AS (SELECT conv_id, list(text ORDER BY turn, role, text) AS turns, string_agg(text, chr(10) || chr(10) ORDER BY turn, role, text) AS doc FROM conversations GROUP BY conv_id)"
QUESTIONS = f"""{THREADS}, questions AS (SELECT conv_id AS row_id,
 CASE WHEN url IS NULL THEN NULL WHEN conv_id % 2 = 0 THEN format('{{{{"topic": "x", "urls": ["{{}}", " ftp://b ", "{{}}.pdf"]}}}}', url, url) ELSE format('{{{{''urls'': [''{{}}'', ''http://h/a.txt'']}}}}', url) END AS metadata,
 turns[1] AS problem, CASE WHEN conv_id % 2 = 0 THEN array_to_string({words("turns[len(turns)]")}[3:5], ' ') ELSE 'zzqx vvkk' END AS answer, list_prepend(doc, turns[2:]) AS documents
 FROM threads LEFT JOIN pages ON page_id = conv_id)"""
REAL = f"real AS (SELECT *, list_filter(documents, lambda d: {strip('d')} <> '') AS docs, {strip('answer')} AS clean FROM questions)"
HITS = f"""spots AS (SELECT row_id, i - 1 AS doc_idx, docs[i] AS doc, strpos(lower(docs[i]), lower(clean)) - 1 AS chars FROM (SELECT *, unnest(generate_series(1, len(docs))) AS i FROM real) WHERE clean <> '' AND contains(lower(docs[i]), lower(clean))),
 hits AS (SELECT row_id, doc_idx, doc, chars, len({words("substr(doc, 1, chars)")}) AS words FROM spots QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY doc_idx) = 1)"""
PROFILED = f"""{QUESTIONS}, {REAL}, {HITS}, shaped AS (SELECT *, list_filter(list_transform({urls_of("metadata")}, lambda u: {url_format("u")}), lambda f: f <> 'unknown') AS known FROM real),
 profiled AS (SELECT shaped.row_id, problem, clean, docs, len(docs) AS num_documents, CASE WHEN len(docs) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(known) > 0 THEN known ELSE ['unknown'] END AS document_formats,
 CASE WHEN len(docs) = 0 THEN 0.0::DOUBLE ELSE list_sum(list_transform(docs, lambda d: len({words("d")})))::DOUBLE / len(docs) END AS avg_document_length_words, hits.row_id IS NOT NULL AS answer_found_in_documents,
 words AS answer_position_words, chars AS answer_position_chars, doc_idx AS answer_found_in_doc_index, doc FROM shaped LEFT JOIN hits USING (row_id))"""
ADDRESSES = "addresses AS (SELECT url FROM pages UNION ALL SELECT unnest([" + ", ".join(map(q, URLS)) + "]))"
CHUNKED = f"""items AS (SELECT item_id, text AS question FROM benchmark), cut AS (SELECT doc_id, {words("text")} AS w FROM documents), listed AS (SELECT doc_id, {chunks("w")} AS c FROM cut),
 segs AS (SELECT doc_id AS g, seg_idx, segment, question FROM (SELECT doc_id, unnest(generate_series(0, len(c) - 1)) AS seg_idx, unnest(c) AS segment FROM listed WHERE len(c) > 0) JOIN items ON item_id = doc_id % (SELECT count(*) FROM benchmark))"""


def bm25(src: str, out: str, idx: str = "seg_idx") -> str:
    """CTEs that add score to src (g, idx, segment, question)."""
    p = out
    return f"""{p}_t AS (SELECT g, {idx} AS i, {tokens("segment")} AS t FROM {src}), {p}_c AS (SELECT g, count(*) AS n, avg(len(t)) AS avgdl FROM {p}_t GROUP BY g),
 {p}_f AS (SELECT g, i, term, count(*) AS tf FROM (SELECT g, i, unnest(t) AS term FROM {p}_t) GROUP BY ALL), {p}_d AS (SELECT g, term, count(*) AS df FROM {p}_f GROUP BY ALL),
 {p}_i AS (SELECT g, term, avgdl, ln(n - df + 0.5) - ln(df + 0.5) AS idf FROM {p}_d JOIN {p}_c USING (g)), {p}_m AS (SELECT g, avg(idf) AS mean FROM {p}_i GROUP BY g),
 {p}_q AS (SELECT g, term, count(*) AS qn FROM (SELECT g, unnest({tokens("question")}) AS term FROM (SELECT g, any_value(question) AS question FROM {src} GROUP BY g)) GROUP BY ALL),
 {p}_s AS (SELECT f.g, f.i, sum(qn * CASE WHEN idf < 0 THEN 0.25 * mean ELSE idf END * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(t) / avgdl))) AS s FROM {p}_f f JOIN {p}_q USING (g, term) JOIN {p}_i USING (g, term) JOIN {p}_m USING (g) JOIN {p}_t t ON t.g = f.g AND t.i = f.i GROUP BY ALL),
 {out} AS (SELECT src.*, round(coalesce(s, 0), 9) AS score FROM {src} src LEFT JOIN {p}_s z ON z.g = src.g AND z.i = src.{idx})"""


def best(src: str, out: str, k: int, idx: str = "seg_idx") -> str:
    return f"{out} AS (SELECT * FROM {src} QUALIFY count(*) OVER (PARTITION BY g) <= {k} OR coalesce(question, '') = '' OR row_number() OVER (PARTITION BY g ORDER BY score DESC, {idx}) <= {k})"


def segments(src: str, key: str, doc: str) -> str:
    """A select of key, doc_idx-less rows: key, i, segment of each doc."""
    p = paragraphs(doc)
    return f"SELECT {key}, unnest(generate_series(0, len(s) - 1)) AS i, unnest(s) AS segment FROM (SELECT *, CASE WHEN len(p) >= 2 AND list_bool_and(list_transform(p, lambda x: len({words('x')}) <= 600)) THEN p ELSE {chunks('w')} END AS s FROM (SELECT *, {p} AS p, {words(doc)} AS w FROM {src})) WHERE len(s) > 0"


def two_stage(src: str) -> str:
    """From src (row_id, question, docs): CTE best2 (row_id, doc_idx, seg_idx, segment, pos)."""
    return f"""each AS (SELECT row_id, question, unnest(generate_series(0, len(docs) - 1)) AS doc_idx, unnest(docs) AS d FROM {src} WHERE len(docs) > 0),
 one AS (SELECT concat(row_id, ':', doc_idx) AS g, row_id, doc_idx, i AS seg_idx, segment, question FROM ({segments("each", "row_id, doc_idx, question", "d")})),
 {bm25("one", "one_scored")}, {best("one_scored", "one_best", 5)},
 two AS (SELECT row_id AS g, row_id, doc_idx, seg_idx, segment, question, row_number() OVER (PARTITION BY row_id ORDER BY doc_idx, seg_idx) - 1 AS pos FROM one_best),
 {bm25("two", "two_scored", "pos")}, {best("two_scored", "two_best", 8, "pos")},
 best2 AS (SELECT row_id, doc_idx, seg_idx, segment, row_number() OVER (PARTITION BY row_id ORDER BY pos) - 1 AS pos FROM two_best)"""


def four(x: str, name: str) -> str:
    return ", ".join(f"round(coalesce({f}({x}), 0)::DOUBLE, 6) AS {name}_{f}" for f in ("avg", "median", "max", "min"))


def flatten(x: str) -> str:
    pieces = f"list_transform(string_split_regex({x}, '{BREAK}'), lambda l: list_transform(string_split({strip('l')}, '  '), lambda p: {strip('p')}))"
    return f"array_to_string(list_filter(flatten({pieces}), lambda p: p <> ''), ' ')"


def html(x: str) -> str:
    return flatten(markup(x))


def markup(x: str, structured: bool = False) -> str:
    tags = [(r"(?i)<br\b[^>]*>", "\n"), (r"(?i)</p\s*>", "\n\n")] if structured else []
    for pattern, by in [(r"(?is)<script\b.*?(</script\s*>|\z)", ""), (r"(?is)<style\b.*?(</style\s*>|\z)", ""), (r"(?s)<!--.*?(-->|\z)", ""), *tags, (r"<[!/a-zA-Z][^>]*(>|\z)", "")]:
        x = f"regexp_replace({x}, '{pattern}', '{by}', 'g')"
    for entity, char in ENTITIES.items():
        x = f"replace({x}, {q(entity)}, {q(char)})"
    return x


def paragraph_lines(x: str) -> str:
    lines = f"list_transform(string_split_regex({x}, '{BREAK}'), lambda l: {strip('l')})"
    return f"(SELECT regexp_replace(array_to_string(list_filter(a, lambda x, i: x <> '' OR (i > 1 AND a[i - 1] <> '')), chr(10) || chr(10)), '^\\n+|\\n+\\z', '', 'g') FROM (SELECT {lines} AS a))"


_DISPATCH = "CASE WHEN contains(k, 'pdf') OR ends_with(lower(url), '.pdf') THEN 'pdf' WHEN contains(k, 'html') OR ends_with(lower(url), '.html') OR ends_with(lower(url), '.htm') THEN 'html' WHEN contains(k, 'text') OR ends_with(lower(url), '.txt') THEN 'text' ELSE 'guess' END"
_WIKI = "(" + " OR ".join(f"ends_with({host('url')}, '{h}')" for h in WIKI_HOSTS) + f") AND contains({path('url')}, '/wiki/')"
_TITLE = f"CASE WHEN contains({path('url')}, '/wiki/') THEN url_decode(string_split({path('url')}, '/wiki/')[-1]) END"
_LISTED_URLS = f"SELECT unnest([url, 'x' || url, ' http://y ']) AS u FROM addresses"
_LONG = f"""{PROFILED}, todo AS (SELECT row_id, {strip("problem")} AS question, docs FROM profiled WHERE NOT answer_found_in_documents AND {strip("coalesce(problem, '')")} <> ''), {two_stage("todo")},
 near AS (SELECT row_id, problem, docs, doc, clean, answer_position_chars AS spot, {paragraph_at(paragraphs("doc"), "answer_position_chars")} AS p FROM profiled WHERE answer_found_in_documents AND {strip("coalesce(problem, '')")} <> ''),
 told AS (SELECT row_id, CASE WHEN p IS NOT NULL AND len({words("p")}) <= 600 THEN p ELSE {window("doc", "length(clean)", "spot")} END AS passage FROM near)
SELECT row_id, coalesce(passage, segment, '') AS long_answer FROM profiled LEFT JOIN told USING (row_id) LEFT JOIN (SELECT row_id, segment FROM best2 WHERE pos = 0) USING (row_id)"""

# What the made-up fetcher answers: an encyclopedia page its title; of the others every seventh by length nothing, and the
# rest a page, text or PDF with the address.
FETCHED = f"""got AS (SELECT url, {_WIKI} AND coalesce({_TITLE}, '') <> '' AS via, {_TITLE} AS title FROM asked_urls GROUP BY url),
 fetched AS (SELECT url, via, via OR length(url) % 7 <> 0 AS ok, CASE WHEN via THEN {strip("title")} || repeat(chr(10), 4) || 'two' WHEN length(url) % 7 = 0 THEN NULL
 WHEN ends_with(lower(url), '.pdf') THEN {strip("'pdf ' || url")} WHEN ends_with(lower(url), '.txt') THEN 'txt ' || url ELSE {flatten("'page  ' || url")} END AS text FROM got)"""
ASKED = f"""asked AS (SELECT row_id, i, {strip("u[i]")} AS url FROM (SELECT row_id, u, unnest(generate_series(1, len(u))) AS i FROM (SELECT row_id, {urls_of("metadata")} AS u FROM questions)) WHERE starts_with({strip("u[i]")}, 'http'))"""
_CHOSEN = "(SELECT row_id, segment FROM (SELECT b.row_id, pos, segment, count(*) OVER (PARTITION BY b.row_id) AS m, problem FROM best2 b JOIN (SELECT row_id, problem FROM profiled) USING (row_id)) WHERE pos = CASE WHEN length(problem) % 2 = 1 AND m >= 2 THEN 1 ELSE 0 END)"

ORACLES = {
    "fetch_fake": f"WITH {ADDRESSES}, asked_urls AS (SELECT url FROM addresses WHERE url <> ''), {FETCHED} SELECT url, via AS via_api, via AS api_ok, ok, md5(text) AS text_md5 FROM fetched",
    "acquire_fake": f"WITH {QUESTIONS}, {ASKED}, asked_urls AS (SELECT url FROM asked), {FETCHED}, listed AS (SELECT row_id, count(*) AS n, string_agg(text, '|' ORDER BY i) AS d FROM asked JOIN fetched USING (url) WHERE text IS NOT NULL GROUP BY row_id) SELECT row_id, CAST(coalesce(n, 0) AS INTEGER) AS n, md5(coalesce(d, '')) AS documents_md5 FROM questions LEFT JOIN listed USING (row_id)",
    "pdf_fake": f"WITH {ADDRESSES} SELECT url, {strip('url')} AS text FROM addresses",
    "judge_fake": f"WITH {THREADS}, cut AS ({segments('threads', 'conv_id, turns', 'doc')}), told AS (SELECT conv_id, segment FROM (SELECT *, count(*) OVER (PARTITION BY conv_id) AS m FROM cut) WHERE i = CASE WHEN length(turns[1]) % 2 = 1 AND m >= 2 THEN 1 ELSE 0 END) SELECT conv_id, segment AS passage FROM threads LEFT JOIN told USING (conv_id)",
    "long_answer_judge": "WITH " + _LONG.replace("(SELECT row_id, segment FROM best2 WHERE pos = 0)", _CHOSEN),
    "html_paragraphs": f"SELECT page_id, {paragraph_lines(markup('html', True))} AS text FROM pages",
    "word_count": f"SELECT doc_id, CAST(len({words('text')}) AS BIGINT) AS n_words FROM documents",
    "bm25_tokens": f"SELECT doc_id, CAST(len({tokens('text')}) AS BIGINT) AS n_tokens, md5(array_to_string({tokens('text')}, ' ')) AS tokens_md5 FROM documents",
    "answer_position": f"SELECT doc_id, item_id, chars, CAST(len({words('substr(t, 1, chars)')}) AS BIGINT) AS words FROM (SELECT doc_id, item_id, d.text AS t, CAST(strpos(lower(d.text), lower(b.text)) - 1 AS BIGINT) AS chars FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text)) WHERE b.text <> '')",
    "answer_first_document": f"WITH {QUESTIONS}, {REAL}, {HITS} SELECT row_id, CAST(doc_idx AS BIGINT) AS doc_idx, CAST(chars AS BIGINT) AS chars, CAST(words AS BIGINT) AS words FROM hits",
    "chunks": f"SELECT doc_id, i, md5(c) AS chunk_md5 FROM (SELECT doc_id, unnest(generate_series(0, len(c) - 1)) AS i, unnest(c) AS c FROM (SELECT doc_id, {chunks('w')} AS c FROM (SELECT doc_id, {words('text')} AS w FROM documents)) WHERE len(c) > 0)",
    "paragraphs": f"WITH {THREADS} SELECT conv_id, unnest(generate_series(0, len(p) - 1)) AS i, unnest(p) AS paragraph FROM (SELECT conv_id, {paragraphs('doc')} AS p FROM threads) WHERE len(p) > 0",
    "segments": f"WITH {THREADS}, both_kinds AS (SELECT 'thread' AS kind, conv_id AS id, doc FROM threads UNION ALL SELECT 'document', doc_id, text FROM documents) SELECT kind, id, i, md5(segment) AS segment_md5 FROM ({segments('both_kinds', 'kind, id', 'doc')})",
    "paragraph_at_position": f"WITH {THREADS} SELECT conv_id, {paragraph_at('p', 'spot')} AS paragraph FROM (SELECT conv_id, length(doc) // 2 AS spot, {paragraphs('doc')} AS p FROM threads)",
    "context_window": f"SELECT doc_id, md5(CASE WHEN text = '' THEN '' ELSE {window('text', '5', '(length(text) // 2)')} END) AS window_md5 FROM documents",
    "bm25_scores": f"WITH {CHUNKED}, {bm25('segs', 'scored')} SELECT g AS doc_id, seg_idx, round(score, 6) AS score FROM scored",
    "bm25_topk": f"WITH {CHUNKED}, {bm25('segs', 'scored')}, {best('scored', 'top', 5)} SELECT g AS doc_id, seg_idx FROM top",
    "bm25_two_stage": f"WITH {QUESTIONS}, {REAL}, ready AS (SELECT row_id, problem AS question, docs FROM real), {two_stage('ready')} SELECT row_id, pos, CAST(doc_idx AS BIGINT) AS doc_idx, CAST(seg_idx AS BIGINT) AS seg_idx FROM best2",
    "long_answer_no_judge": f"WITH {_LONG}",
    "judge_reply_parse": rf"SELECT id, CAST(CASE WHEN k = 0 THEN -1 WHEN k BETWEEN 1 AND 3 THEN k - 1 ELSE 0 END AS BIGINT) AS choice, contains(lower(r), 'yes') OR contains(lower(r), 'да') AS confirms FROM (SELECT id, r, try_cast(regexp_extract(r, '\b(\d+)\b', 1) AS BIGINT) AS k FROM (SELECT generate_subscripts(l, 1) - 1 AS id, coalesce(unnest(l), '') AS r FROM (SELECT [{', '.join(map(q, REPLIES))}] AS l)))",
    "url_format": f"WITH {ADDRESSES} SELECT url, {url_format('url')} AS format FROM addresses",
    "format_histogram": f"WITH {PROFILED}, f AS (SELECT unnest(document_formats) AS format FROM profiled) SELECT format, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM f)::DOUBLE, 6)::DOUBLE AS percent FROM f GROUP BY format",
    "valid_urls": f"WITH {ADDRESSES} SELECT url, count(*) AS n FROM (SELECT {strip('u')} AS url FROM ({_LISTED_URLS})) WHERE starts_with(url, 'http') GROUP BY url",
    "wiki_urls": f"WITH {ADDRESSES} SELECT url, {_WIKI} AS wiki, CASE WHEN contains({host('url')}, '.wikipedia.org') THEN string_split({host('url')}, '.')[1] ELSE 'en' END AS language FROM addresses",
    "wiki_title": f"WITH {ADDRESSES} SELECT url, {_TITLE} AS title FROM addresses",
    "url_dedup_cache": f"WITH {ADDRESSES}, twice AS (SELECT url FROM addresses UNION ALL SELECT url FROM pages) SELECT md5(url) AS url_md5, count(*) AS lookups FROM twice GROUP BY url",
    "metadata_urls": f"WITH {QUESTIONS}, cells AS (SELECT row_id, metadata FROM questions UNION ALL SELECT -generate_subscripts(l, 1), unnest(l) FROM (SELECT [{', '.join(map(q, CELLS))}] AS l)) SELECT row_id, array_to_string({urls_of('metadata')}, '|') AS urls FROM cells",
    "event_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "html_text": f"SELECT page_id, md5({html('html')}) AS text_md5 FROM pages",
    "html_text_parsed": f"SELECT page_id, md5({html('html')}) AS text_md5 FROM pages",
    "content_dispatch": f"WITH {ADDRESSES} SELECT url, content_type, {_DISPATCH} AS decoder FROM (SELECT url, content_type, coalesce(content_type, '') AS k FROM (SELECT url, unnest(['text/html', 'application/pdf', 'text/plain', '', NULL]) AS content_type FROM addresses))",
    "profile_columns": f"WITH {PROFILED} SELECT row_id, CAST(num_documents AS BIGINT) AS num_documents, array_to_string(document_formats, ',') AS document_formats, round(avg_document_length_words, 6) AS avg_document_length_words, answer_found_in_documents, CAST(answer_position_words AS BIGINT) AS answer_position_words, CAST(answer_position_chars AS BIGINT) AS answer_position_chars, CAST(answer_found_in_doc_index AS BIGINT) AS answer_found_in_doc_index FROM profiled",
    "profile_summary": f"""WITH {PROFILED} SELECT count(*) AS rows, {four("num_documents", "documents")}, round(coalesce(stddev_samp(num_documents), 0), 6) AS documents_sd, count(*) FILTER (WHERE num_documents = 0) AS without_documents,
 round(100.0::DOUBLE * count(*) FILTER (WHERE num_documents = 0) / count(*), 6) AS without_documents_percent, {four("CASE WHEN avg_document_length_words > 0 THEN avg_document_length_words END", "length")}, count(*) FILTER (WHERE answer_found_in_documents) AS answers_found,
 round(100.0::DOUBLE * count(*) FILTER (WHERE answer_found_in_documents) / count(*), 6) AS answers_found_percent, {four("answer_position_words", "position")} FROM profiled""",
    "run_report": f"""WITH {QUESTIONS}, log AS (SELECT url, page_id % 7 <> 0 AS ok, page_id % 5 = 0 AS via FROM pages), asked AS (SELECT row_id, url FROM (SELECT row_id, {strip("u")} AS url FROM (SELECT row_id, unnest({urls_of("metadata")}) AS u FROM questions)) WHERE starts_with(url, 'http')),
 have AS (SELECT DISTINCT row_id FROM asked JOIN log USING (url) WHERE ok), r AS (SELECT (SELECT count(*) FROM questions) AS total_rows, (SELECT count(*) FROM questions) - (SELECT count(*) FROM have) AS failed_rows, (SELECT count(*) FROM asked) AS lookups,
 count(*) AS total_requests, count(*) FILTER (WHERE ok) AS successful_downloads, count(*) FILTER (WHERE NOT ok) AS failed_downloads, count(*) FILTER (WHERE via) AS api_requests, count(*) FILTER (WHERE via AND ok) AS api_success FROM log)
SELECT *, total_rows - failed_rows AS ok_rows, lookups - total_requests AS cached_requests, round(100.0::DOUBLE * failed_rows / total_rows, 6) AS failed_percent, round(100.0::DOUBLE * (lookups - total_requests) / lookups, 6) AS cache_efficiency FROM r""",
    "limit_rows": "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 10",
    "restart_remaining": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
    "csv_roundtrip": "SELECT conv_id, turn, role, text FROM conversations",
    "legacy_cells": """SELECT * FROM (VALUES (0, 'a|b"c', 'a|b"c'), (1, 'x|it''s', 'x|it''s'), (2, 'plain text', ''), (3, 'one', 'one'), (4, '', ''), (5, '', ''), (6, '', ''), (7, 'multi' || chr(10) || 'line', 'multi' || chr(10) || 'line'), (8, 'padded', 'padded')) AS t(id, loose, strict)""",
    "wiki_requests": f"WITH {ADDRESSES} SELECT url, 'https://' || CASE WHEN contains({host('url')}, '.wikipedia.org') THEN string_split({host('url')}, '.')[1] ELSE 'en' END || '.wikipedia.org/w/api.php' AS address, {_TITLE} AS titles FROM addresses",
    "fill_ratio": f"WITH {_LONG.replace('SELECT row_id, coalesce(passage', 'SELECT count(*) FILTER (WHERE coalesce(passage').replace(', segment, ' + chr(39) + chr(39) + ') AS long_answer FROM', ', segment, ' + chr(39) + chr(39) + ') <> ' + chr(39) + chr(39) + ') AS filled, count(*) AS total FROM')}",
}
