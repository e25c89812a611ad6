"""Queries and SQL of the operators in this subpackage."""

from __future__ import annotations

from eventrollup.llm.op1_shard import op1_shard
from eventrollup.llm.op2_tokens import op2_tokens
from eventrollup.llm.op3_neardup import op3_neardup
from eventrollup.llm.op4_bpe import op4_bpe
from eventrollup.llm.op5_langid import op5_langid
from eventrollup.llm.op6_decontaminate import op6_decontaminate
from eventrollup.llm.op7_secrets import op7_secrets
from eventrollup.llm.op8_quality import op8_quality
from eventrollup.llm.op9_chat import op9_chat
from eventrollup.llm.op10_pii import op10_pii
from eventrollup.llm.op11_repair import op11_repair
from eventrollup.llm.op12_fim import op12_fim
from eventrollup.llm.op13_simhash import op13_simhash
from eventrollup.llm.sql import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    "op1_shard": op1_shard,
    "op2_tokens": op2_tokens,
    "op3_neardup": op3_neardup,
    "op4_bpe": op4_bpe,
    "op5_langid": op5_langid,
    "op6_decontaminate": op6_decontaminate,
    "op7_secrets": op7_secrets,
    "op8_quality": op8_quality,
    "op9_chat": op9_chat,
    "op10_pii": op10_pii,
    "op11_repair": op11_repair,
    "op12_fim": op12_fim,
    "op13_simhash": op13_simhash,
}
