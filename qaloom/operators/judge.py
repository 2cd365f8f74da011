"""The pluggable language-model judge: it picks the segment that supports an answer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.text import reply_choice, reply_confirms

#: (question, answer, numbered segments) to a reply; made once in each worker by the factory that is passed in.
Judge = Callable[[str, str, list[str]], str]


def _asking(make_judge: Callable[[], Judge]):
    @F.pandas_udf("string")
    def ask(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        judge = make_judge()
        for questions, answers, segments in batches:
            yield pd.Series([judge(q, a, list(s)) for q, a, s in zip(questions, answers, segments, strict=True)])

    return ask


def pick(rows: DataFrame, make_judge: Callable[[], Judge] | None, question: str = "problem", answer: str = "answer", segments: str = "segments", config: Config = DEFAULT) -> Column:
    """The chosen segment. Without a judge, and where it says none, it is the first. Segments are cut to what a prompt
    may hold before they leave the JVM."""
    first = F.get(F.col(segments), F.lit(0))
    if make_judge is None:
        return first
    short = F.transform(F.slice(F.col(segments), 1, config.segments_for_judge), lambda s: F.substring(s, 1, config.judge_chunk_chars))
    reply = _asking(make_judge)(F.col(question), F.col(answer), short)
    index = reply_choice(reply, F.least(F.size(segments), F.lit(config.segments_for_judge)))
    return F.when(index >= 0, F.get(F.col(segments), index)).otherwise(first)


def confirmed(make_judge: Callable[[], Judge], question: str, answer: str, passage: str, config: Config = DEFAULT) -> Column:
    """Whether the judge confirms the passage; it never changes the passage."""
    return reply_confirms(_asking(make_judge)(F.col(question), F.col(answer), F.array(F.substring(F.col(passage), 1, config.verify_chars))))
