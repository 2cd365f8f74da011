"""Chat formatting: event logs folded into final messages, rendered with a template, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, running, values

#: The template: <s>[INST]role[/INST]text</s> for each turn. Its control strings can't stand in an escaped text.
OPEN, MID, CLOSE = "<s>[INST]", "[/INST]", "</s>"
_REST = r"s>|/s>|INST\]|/INST\]"
#: A control string, with any number of backslashes after its first character, gets one more; reading takes one away.
_ADD, _TAKE = rf"([<\[])(\\*)({_REST})", rf"([<\[])\\(\\*)({_REST})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ADD, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _TAKE, "$1$2$3")


def fold(events: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: one row for each final message of the log.

    events: conv_id, msg (the message's id), turn (its place), seq (the event's place), kind, role, text. By seq,
    `message` and `edit` set the text, `regenerate` empties it, `delta` adds to it, `delete` takes the message
    away; other kinds change nothing. Role and turn come from the latest event that has them. The text is the
    concatenation from the last event that sets it, so long streams of deltas take linear time.

    Null ids are groups like any other; a null text is empty; ties in seq go by kind, text and role; an event
    that comes twice (same seq, kind, role and text) counts once. A message with no event that sets or adds has
    an empty text. No events give no messages.

    Plan: one shuffle by (conv_id, msg), so that a conversation with very many events is spread over tasks.
    """
    one = F.struct("seq", F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("text", F.lit("")).alias("text"), "role", "turn")
    byid = events.groupBy("conv_id", "msg").agg(F.array_sort(F.array_distinct(F.collect_list(one))).alias("e"))
    sets = F.transform("e", lambda x, i: F.when(x["kind"].isin("message", "edit", "regenerate", "delete"), i + 1).otherwise(0))
    last = byid.withColumn("at", F.greatest(F.array_max(sets), F.lit(1))).withColumn("tail", F.expr("slice(e, at, size(e))"))
    add = F.transform("tail", lambda x: F.when(x["kind"].isin("message", "edit", "delta"), x["text"]).otherwise(""))
    known = lambda f: F.expr(f"element_at(filter(transform(e, x -> x.{f}), y -> y is not null), -1)")
    had = lambda f: F.expr(f"exists(e, x -> x.{f} is not null)")
    return last.filter(F.get("tail", F.lit(0))["kind"] != "delete").select(
        "conv_id", F.when(had("turn"), known("turn")).alias("turn"), F.when(had("role"), known("role")).alias("role"), F.array_join(add, "").alias("text"), "msg"
    )


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans: one row for each conversation; loss_spans are the (start, end, turn) of the
    assistant's escaped texts within formatted: code points, end exclusive, and the 0-based turn. Turns stand by turn, then role, text, msg.
    A null role is the empty role. A conversation is one row of the result, so it meets in one task as a whole;
    its messages are escaped before, in whatever task folded them."""
    piece = F.concat(F.lit(OPEN), escape(F.coalesce("role", F.lit(""))), F.lit(MID))
    ready = messages.select("conv_id", F.struct("turn", "role", "text", "msg").alias("key"), piece.alias("head"), escape(F.coalesce("text", F.lit(""))).alias("body"), (F.coalesce("role", F.lit("")) == "assistant").alias("loss"))
    byconv = ready.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("key", "head", "body", "loss"))).alias("m"))
    formatted = F.array_join(F.transform("m", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "")
    sizes = F.transform("m", lambda x: F.struct(F.length(x["head"]).alias("head"), F.length(x["body"]).alias("body"), x["loss"].alias("loss")))

    def placed(own: Column) -> Column:
        begin = running(F.transform(own, lambda x: x["head"] + x["body"] + len(CLOSE)))
        masked = F.zip_with(own, begin, lambda x, at: F.struct(x["loss"].alias("loss"), (at + x["head"]).cast("int").alias("start"), (at + x["head"] + x["body"]).cast("int").alias("end")))
        numbered = F.transform(masked, lambda x, i: F.struct(x["loss"].alias("loss"), x["start"].alias("start"), x["end"].alias("end"), i.alias("turn")))
        return F.transform(F.filter(numbered, lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["turn"].alias("turn")))

    spans = let(sizes, placed)
    return byconv.select("conv_id", formatted.alias("formatted"), spans.alias("loss_spans"))


def pieces(formatted: Column) -> Column:
    """The rendered turns of a conversation, without what closes each."""
    return let(F.split(formatted, CLOSE, -1), lambda p: F.slice(p, 1, F.size(p) - 1))


def read_back(formatted: Column) -> Column:
    """The turns of a rendered conversation, as an array of (role, text)."""

    def turn(t):
        role = F.substring_index(F.substring(t, len(OPEN) + 1, 2**30), MID, 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(t, F.length(role) + len(OPEN) + len(MID) + 1, F.length(t))).alias("text"))

    return F.transform(pieces(formatted), turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order. Each span is read from its own turn, whose place in the whole
    is the sum of the lengths before it."""

    def read(p: Column) -> Column:
        begin = running(F.transform(p, lambda x: F.length(x) + len(CLOSE)))
        return let(begin, lambda at: F.transform(spans, lambda s: unescape(F.substring(F.get(p, s["turn"]), (s["start"] - F.get(at, s["turn"]) + 1).cast("int"), s["end"] - s["start"]))))

    return F.array_join(let(pieces(formatted), read), "")


def format_log(events: DataFrame) -> DataFrame:
    return render(fold(events))


def events_of(conversations: DataFrame) -> DataFrame:
    """Each row of a table of turns as the events of one message. A user's comes with a draft, which an edit replaces.
    Any other opens empty, takes a first delta, is regenerated, and then comes as two deltas."""
    rows = conversations.select("conv_id", F.monotonically_increasing_id().alias("msg"), "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    draft = F.substring("text", 1, 8)
    half = F.floor(F.length("text") / 2).cast("int")
    log = lambda *events: F.array(*[F.struct(F.lit(k).alias("seq"), F.lit(kind).alias("kind"), text.alias("text")) for k, (kind, text) in enumerate(events)])
    none = F.lit(None).cast("string")
    typed = log(("message", draft), ("edit", F.col("text")))
    streamed = log(("message", F.lit("")), ("delta", draft), ("regenerate", none), ("delta", F.substring(F.col("text"), F.lit(1), half)), ("delta", F.substring(F.col("text"), half + 1, F.length("text"))))
    parts = F.when(F.col("role") == "user", typed).otherwise(streamed)
    return rows.select("conv_id", "msg", "turn", "role", F.inline(parts)).select("conv_id", "msg", "turn", "seq", "kind", "role", "text")


def query(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    extra = values(spark, "conv_id long, turn long, role string, text string", [(-1, 0, "user", hard), (-1, 1, "assistant", hard)])
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    done = format_log(events_of(rows)).withColumn("turns", read_back(F.col("formatted"))).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), sha(told).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        sha(F.col("loss")).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql() -> str:
    esc = lambda c: rf"regexp_replace({c}, '([<\[])(\\*)(s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g')"
    return f"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
done AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  sum(length('<s>[INST]') + length({esc("role")}) + length('[/INST]') + length({esc("text")}) + length('</s>')) AS n FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars FROM done
"""


SQL = _sql()
