"""The engine's settings, in one frozen dataclass."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    context_chars: int = 400
    extension_chars: int = 200
    chunk_words: int = 400
    overlap_words: int = 80
    segments_per_document: int = 5
    segments_for_judge: int = 8
    max_paragraph_words: int = 600
    min_paragraphs: int = 2
    judge_chunk_chars: int = 1500
    verify_chars: int = 2000
    timeout_seconds: float = 15.0
    delay_seconds: float = 0.1
    fetch_threads: int = 5
    #: "cumulative": stripped lengths plus 2, as in the published semantics; "exact": true offsets.
    paragraph_mode: str = "cumulative"
    #: A blank answer counts as found at the start only if this is set.
    blank_answer_found: bool = False


DEFAULT = Config()
