"""The operators of this package as queries over their whole tables."""

from __future__ import annotations

from clientele.llm.chat import SQL as CHAT_SQL
from clientele.llm.chat import op11_chat
from clientele.llm.embeddings import op2_embeddings
from clientele.llm.importance import op12_importance
from clientele.llm.language import op3_language
from clientele.llm.lloyd import SQL as LLOYD_SQL
from clientele.llm.lloyd import op13_lloyd
from clientele.llm.mixing import op1_mixing
from clientele.llm.packing import op4_packing
from clientele.llm.passages import SQL as PASSAGES_SQL
from clientele.llm.passages import op9_passages
from clientele.llm.quality import SQL as QUALITY_SQL
from clientele.llm.quality import op7_quality
from clientele.llm.simhash import op5_simhash
from clientele.llm.suffixes import SQL as SUFFIXES_SQL
from clientele.llm.suffixes import op8_suffixes
from clientele.llm.token_counts import op6_token_counts
from clientele.llm.toxicity import op10_toxicity

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_embeddings": op2_embeddings,
    "op3_language": op3_language,
    "op4_packing": op4_packing,
    "op5_simhash": op5_simhash,
    "op6_token_counts": op6_token_counts,
    "op7_quality": op7_quality,
    "op8_suffixes": op8_suffixes,
    "op9_passages": op9_passages,
    "op10_toxicity": op10_toxicity,
    "op11_chat": op11_chat,
    "op12_importance": op12_importance,
    "op13_lloyd": op13_lloyd,
}
ORACLE_SQL = {
    "op7_quality": QUALITY_SQL,
    "op8_suffixes": SUFFIXES_SQL,
    "op9_passages": PASSAGES_SQL,
    "op11_chat": CHAT_SQL,
    "op13_lloyd": LLOYD_SQL,
}
