"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import ann, bpe, chat, decontam, langid, line_dedup, lm, minhash, secret_scan, toxicity
from .common import table


def queries() -> dict:
    return {
        "op1_near_dedup": lambda s, d: minhash.query(table(s, d, "documents")),
        "op2_lm_score": lambda s, d: lm.query(table(s, d, "documents")),
        "op3_chat_format": lambda s, d: chat.query(s, table(s, d, "conversations")),
        "op4_language_id": lambda s, d: langid.query(s, table(s, d, "documents"), table(s, d, "pages")),
        "op5_byte_bpe": lambda s, d: bpe.query(table(s, d, "documents")),
        "op6_line_dedup": lambda s, d: line_dedup.query(table(s, d, "documents")),
        "op7_toxicity": lambda s, d: toxicity.query(s, table(s, d, "documents"), table(s, d, "labels")),
        "op8_decontaminate": lambda s, d: decontam.query(table(s, d, "documents"), table(s, d, "benchmark")),
        "op9_ann": lambda s, d: ann.query(table(s, d, "embeddings")),
        "op10_secret_scan": lambda s, d: secret_scan.query(table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_near_dedup": minhash.SQL, "op3_chat_format": chat.SQL, "op6_line_dedup": line_dedup.SQL, "op8_decontaminate": decontam.SQL, "op10_secret_scan": secret_scan.SQL}
