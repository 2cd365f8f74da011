"""Text functions with Python's notion of white space, on Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, Config

#: The characters that str.isspace accepts; Java's \s alone misses 23 of them. Fixed value.
WS = r"(?U)[\s\x1c-\x1f]"
#: Where str.splitlines breaks a line. Fixed value.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}]"
#: Sentence ends, in the order in which they are tried. Fixed values.
SENTENCE_ENDS = [".", "!", "?", "。", "！", "？", "\n"]


def bind(value: Column, use) -> Column:
    """use(value), with value evaluated once: an expression that stands in many places is planned as one."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{WS}+|{WS}+\z", "")


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), rf"{WS}+", -1), lambda w: w != "")


def count_words(text: Column) -> Column:
    return F.size(words(text))


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def find(needle: Column, text: Column) -> Column:
    """0-based place of needle in text, both lower-cased; null if it isn't there or either is null."""
    place = F.call_function("locate", F.lower(needle), F.lower(text)) - 1
    return F.when(place >= 0, place)


def answer_position(answer: Column, text: Column, config: Config = DEFAULT) -> Column:
    """struct<words, chars> of the stripped answer's first occurrence; null without one. Blank answers are not found,
    unless the configuration says so."""

    def at(clean):
        given = (answer != "") & (text != "")
        return F.when(given if config.blank_answer_found else given & (clean != ""), find(clean, text))

    def both(chars):
        return F.when(chars.isNotNull(), F.struct(count_words(F.substring(text, F.lit(1), chars)).alias("words"), chars.alias("chars")))

    return bind(bind(strip(answer), at), both)


def contains_answer(answer: Column, text: Column) -> Column:
    return F.contains(F.lower(text), F.lower(answer))


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n", -1), strip), lambda p: p != "")


def chunks(text: Column, config: Config = DEFAULT) -> Column:
    """Overlapping windows of words, joined by single spaces; the last is the first that reaches the end."""
    step, size = config.chunk_words - config.overlap_words, config.chunk_words

    def cut(w):
        last = F.greatest(F.ceil((F.size(w) - size) / F.lit(float(step))).cast("int"), F.lit(0))
        made = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(w, i * step + 1, size), " "))
        return F.when(F.size(w) > 0, made).otherwise(F.array().cast("array<string>"))

    return bind(words(text), cut)


def segments(text: Column, config: Config = DEFAULT) -> Column:
    """Paragraphs, if there are enough and none is too long; else chunks."""

    def choose(p):
        fit = (F.size(p) >= config.min_paragraphs) & F.forall(p, lambda x: count_words(x) <= config.max_paragraph_words)
        return F.when(fit, p).otherwise(chunks(text, config))

    return bind(paragraphs(text), choose)


def paragraph_at(text: Column, place: Column, config: Config = DEFAULT) -> Column:
    """The paragraph that holds a 0-based place, or the last; null if there are too few paragraphs.

    In mode "cumulative" a paragraph ends at the sum of stripped lengths plus 2 each; in mode "exact" at its true end.
    """

    def step(z, part):
        end = z["end"] + F.length(part) + 2
        hit = F.when(z["hit"].isNull() & (strip(part) != "") & (end > place), strip(part)).otherwise(z["hit"])
        return F.struct(end.alias("end"), hit.alias("hit"))

    def choose(p):
        parts = F.split(F.coalesce(text, F.lit("")), "\n\n", -1) if config.paragraph_mode == "exact" else p
        hit = F.aggregate(parts, F.struct(F.lit(0).alias("end"), F.lit(None).cast("string").alias("hit")), step, lambda z: z["hit"])
        return F.when(F.size(p) >= config.min_paragraphs, F.coalesce(hit, F.try_element_at(p, F.lit(-1))))

    return bind(paragraphs(text), choose)


def context_window(text: Column, answer: Column, place: Column, config: Config = DEFAULT) -> Column:
    """The text around an occurrence, widened on either side to the first kind of sentence end that is near."""
    n = F.length(text)
    begin = F.greatest(place - config.context_chars, F.lit(0))
    stop = F.least(place + F.length(answer) + config.context_chars, n)
    reach = F.least(begin, F.lit(config.extension_chars))
    view = F.struct(begin.alias("start"), stop.alias("end"), F.substring(text, begin - reach + 1, reach).alias("before"), F.substring(text, stop + 1, F.lit(config.extension_chars)).alias("after"))

    def widened(v):
        before, after = v["before"], v["after"]
        last = F.coalesce(*[F.when(F.contains(before, F.lit(s)), F.length(before) - F.call_function("locate", F.lit(s), F.reverse(before)) + 1) for s in SENTENCE_ENDS])
        first = F.coalesce(*[F.when(F.contains(after, F.lit(s)), F.call_function("locate", F.lit(s), after)) for s in SENTENCE_ENDS])
        low = F.when((v["start"] > 0) & last.isNotNull(), F.greatest(v["start"] - config.extension_chars + last, F.lit(0)))
        return F.struct(F.coalesce(low, v["start"]).alias("low"), F.coalesce(F.when(v["end"] < n, v["end"] + first), v["end"]).alias("high"))

    cut = bind(bind(view, widened), lambda w: strip(F.substring(text, w["low"] + 1, w["high"] - w["low"])))
    return F.when(text.isNull() | place.isNull() | (text == ""), "").otherwise(cut)


def flatten_lines(text: Column) -> Column:
    """One line: lines are stripped and cut at two spaces, the pieces stripped, and those left joined by a space."""
    pieces = F.flatten(F.transform(F.split(text, LINE_BREAK, -1), lambda line: F.transform(F.split(strip(line), "  ", -1), strip)))
    return F.array_join(F.filter(pieces, lambda x: x != ""), " ")


def paragraph_lines(text: Column) -> Column:
    """Stripped lines, runs of blank ones as one, blank ends cut off, all joined by two newlines."""
    lines = F.transform(F.split(text, LINE_BREAK, -1), strip)
    kept = bind(lines, lambda a: F.filter(a, lambda x, i: (x != "") | ((i > 0) & (F.get(a, i - 1) != ""))))
    return F.regexp_replace(F.array_join(kept, "\n\n"), r"^\n+|\n+\z", "")


def real_documents(documents: Column) -> Column:
    """The documents that are neither null nor blank; none of a null list."""
    return F.filter(F.coalesce(documents, F.array().cast("array<string>")), lambda d: d.isNotNull() & (strip(d) != ""))


def reply_choice(reply: Column, n: Column) -> Column:
    """A judge's reply as an index: the first whole number k gives k - 1 if it is one of n, -1 for 0; else 0."""
    first = F.try_element_at(F.regexp_extract_all(reply, F.lit(r"(?U)\b(\d+)\b"), F.lit(1)), F.lit(1))
    k = first.try_cast("int")
    return F.when(k == 0, -1).when((k >= 1) & (k <= n), k - 1).otherwise(0)


def reply_confirms(reply: Column) -> Column:
    return F.contains(F.lower(reply), F.lit("yes")) | F.contains(F.lower(reply), F.lit("да"))
