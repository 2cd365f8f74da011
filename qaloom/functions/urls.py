"""URL and metadata functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: Encyclopedia hosts, by their ends. Fixed values.
WIKI_HOSTS = [
    "en.wikipedia.org", "ru.wikipedia.org", "de.wikipedia.org", "fr.wikipedia.org", "es.wikipedia.org", "it.wikipedia.org",
    "ja.wikipedia.org", "zh.wikipedia.org", "pt.wikipedia.org", "pl.wikipedia.org", "www.wikipedia.org",
]
_NO_URLS = "cast(array() as array<string>)"


def metadata_urls(metadata: Column) -> Column:
    """The urls of a metadata cell: those of a strict JSON object; else, if it isn't JSON, whatever looks like one.
    A single JSON string for urls is one url; null cells and objects without urls have none."""
    parsed = F.try_parse_json(metadata)
    strict = {"allowSingleQuotes": "false"}
    listed = F.from_json(metadata, "urls array<string>", strict)["urls"]
    single = F.from_json(metadata, "urls string", strict)["urls"]
    one = F.when(F.trim(single).startswith("["), F.expr(_NO_URLS)).otherwise(F.array(single))
    found = F.regexp_extract_all(metadata, F.lit(r"(?U)https?://[^\s\x1c-\x1f'\"]+"), F.lit(0))
    is_object = F.ltrim(metadata).startswith("{")
    given = F.when(is_object, F.coalesce(listed, F.when(single.isNotNull(), one), F.expr(_NO_URLS))).otherwise(F.expr(_NO_URLS))
    return F.when(metadata.isNull() | (metadata == ""), F.expr(_NO_URLS)).when(parsed.isNotNull(), given).otherwise(found)


def valid_urls(urls: Column) -> Column:
    """Stripped; only those that begin with http."""
    return F.filter(F.transform(F.coalesce(urls, F.expr(_NO_URLS)), strip), lambda u: F.startswith(u, F.lit("http")))


def host(url: Column) -> Column:
    """What stands between // and the path, as given."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def path(url: Column) -> Column:
    """The path, without query, fragment and the last part's parameters."""
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#][\s\S]*\z", ""), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/]*", "")
    return F.regexp_replace(bare, r";[^/]*\z", "")


def url_format(url: Column) -> Column:
    """pdf, html or txt by the url's end, else by what its path holds, else unknown."""
    low = F.lower(url)
    at = F.lower(path(url))
    ends = F.when(F.endswith(low, F.lit(".pdf")), "pdf").when(F.endswith(low, F.lit(".html")) | F.endswith(low, F.lit(".htm")), "html").when(F.endswith(low, F.lit(".txt")), "txt")
    holds = F.when(F.contains(at, F.lit(".pdf")), "pdf").when(F.contains(at, F.lit(".htm")), "html").when(F.contains(at, F.lit(".txt")), "txt")
    return F.coalesce(ends, holds, F.lit("unknown"))


def known_formats(urls: Column) -> Column:
    """The formats of the urls, unknown ones left out; ['unknown'] if none is left."""
    known = F.filter(F.transform(F.coalesce(urls, F.expr(_NO_URLS)), url_format), lambda f: f != "unknown")
    return F.when(F.size(known) > 0, known).otherwise(F.array(F.lit("unknown")))


def is_wiki(url: Column) -> Column:
    at = F.lower(host(url))
    ends = F.exists(F.array(*[F.lit(h) for h in WIKI_HOSTS]), lambda h: F.endswith(at, h))
    return ends & F.contains(path(url), F.lit("/wiki/"))


def wiki_title(url: Column) -> Column:
    """The decoded title of an encyclopedia url; null if its path has no /wiki/."""
    title = F.substring_index(path(url), "/wiki/", -1)
    return F.when(F.contains(path(url), F.lit("/wiki/")), F.coalesce(F.try_url_decode(F.replace(title, F.lit("+"), F.lit("%2B"))), title))


def wiki_language(url: Column) -> Column:
    at = F.lower(host(url))
    return F.when(F.contains(at, F.lit(".wikipedia.org")), F.substring_index(at, ".", 1)).otherwise("en")


def wiki_api(url: Column) -> Column:
    """The address and parameters of the MediaWiki request for an encyclopedia url's text."""
    return F.struct(F.concat(F.lit("https://"), wiki_language(url), F.lit(".wikipedia.org/w/api.php")).alias("address"), wiki_title(url).alias("titles"), F.lit("query").alias("action"), F.lit("extracts").alias("prop"), F.lit("json").alias("format"))


def wiki_extract(body: Column) -> Column:
    """The first non-empty extract of a MediaWiki reply; null without one."""
    pages = F.from_json(body, "query struct<pages: map<string, struct<extract: string>>>")["query"]["pages"]
    texts = F.filter(F.transform(F.map_values(pages), lambda p: p["extract"]), lambda x: x.isNotNull() & (x != ""))
    return F.get(texts, F.lit(0))


def url_hash(url: Column) -> Column:
    return F.md5(url.cast("binary"))


def dispatch(content_type: Column, url: Column) -> Column:
    """Which decoder a reply goes to: pdf, html, text or guess (as HTML, else as it is)."""
    kind, low = F.lower(F.coalesce(content_type, F.lit(""))), F.lower(url)
    return (
        F.when(F.contains(kind, F.lit("pdf")) | F.endswith(low, F.lit(".pdf")), "pdf")
        .when(F.contains(kind, F.lit("html")) | F.endswith(low, F.lit(".html")) | F.endswith(low, F.lit(".htm")), "html")
        .when(F.contains(kind, F.lit("text")) | F.endswith(low, F.lit(".txt")), "text")
        .otherwise("guess")
    )
