"""The queries of this folder by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recurra.llm.bpe_codec import op12_bpe_codec
from recurra.llm.conversation_repair import OP11_SQL, op11_conversations
from recurra.llm.decontamination import OP8_SQL, op8_decontamination
from recurra.llm.jaccard import OP9_SQL, op9_jaccard
from recurra.llm.packing import op10_packing
from recurra.llm.quality import op4_quality
from recurra.llm.ranking import OP13_SQL, op13_search
from recurra.llm.sharding import op7_sharding
from recurra.llm.token_counts import op6_token_counts
from recurra.llm.substrings import OP2_SQL, op2_substrings
from recurra.llm.suffixes import OP1_SQL, op1_suffixes
from recurra.llm.topk import OP3_SQL, op3_topk
from recurra.llm.toxicity import op5_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffixes": op1_suffixes,
    "op2_substrings": op2_substrings,
    "op3_topk": op3_topk,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_token_counts": op6_token_counts,
    "op7_sharding": op7_sharding,
    "op8_decontamination": op8_decontamination,
    "op9_jaccard": op9_jaccard,
    "op10_packing": op10_packing,
    "op11_conversations": op11_conversations,
    "op12_bpe_codec": op12_bpe_codec,
    "op13_search": op13_search,
}

ORACLE_SQL: dict[str, str] = {
    "op1_suffixes": OP1_SQL,
    "op2_substrings": OP2_SQL,
    "op3_topk": OP3_SQL,
    "op8_decontamination": OP8_SQL,
    "op9_jaccard": OP9_SQL,
    "op11_conversations": OP11_SQL,
    "op13_search": OP13_SQL,
}
