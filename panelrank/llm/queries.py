"""Registered queries of the training-data operators; oracle SQL where DuckDB can express the result."""

from __future__ import annotations

from panelrank.llm import chat, decontaminate, jaccard, lexical_search, periodic_runs, url_filters
from panelrank.llm.chat import op9_chat
from panelrank.llm.decontaminate import op1_decontaminate
from panelrank.llm.html_text import op3_html_text
from panelrank.llm.jaccard import op5_ngram_jaccard
from panelrank.llm.kneser_ney import op8_language_model
from panelrank.llm.lexical_search import op11_lexical_search
from panelrank.llm.packing import op2_packing
from panelrank.llm.periodic_runs import op12_periodic_runs
from panelrank.llm.quality import op6_quality
from panelrank.llm.secrets import op4_secrets
from panelrank.llm.syncmers import op7_syncmers
from panelrank.llm.toxicity import op10_toxicity
from panelrank.llm.url_filters import op13_url_filters

QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_packing, op3_html_text, op4_secrets, op5_ngram_jaccard, op6_quality, op7_syncmers, op8_language_model, op9_chat, op10_toxicity,
    op11_lexical_search, op12_periodic_runs, op13_url_filters,
)}
ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": decontaminate.ORACLE_SQL,
    "op5_ngram_jaccard": jaccard.ORACLE_SQL,
    "op9_chat": chat.ORACLE_SQL,
    "op11_lexical_search": lexical_search.ORACLE_SQL,
    "op12_periodic_runs": periodic_runs.ORACLE_SQL,
    "op13_url_filters": url_filters.ORACLE_SQL,
}
