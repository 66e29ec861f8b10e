"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from .chat import op13_chat_formatting
from .fingerprints import op2_fingerprints
from .lexical import op12_lexical_search
from .licenses import op9_licenses
from .mixing import op1_mixing
from .near_dedup import op5_near_duplicates
from .packing import op6_best_fit_packing
from .repair import op11_conversation_repair
from .search import op10_search
from .substring_dedup import op4_substring_dedup
from .token_counts import op7_token_counts
from .token_files import op8_token_files
from .toxicity import op3_toxicity
from . import sql

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_fingerprints": op2_fingerprints,
    "op3_toxicity": op3_toxicity,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_token_counts": op7_token_counts,
    "op8_token_files": op8_token_files,
    "op9_licenses": op9_licenses,
    "op10_search": op10_search,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_lexical_search": op12_lexical_search,
    "op13_chat_formatting": op13_chat_formatting,
}
SQL = {"op10_search": sql.SEARCH, "op9_licenses": sql.LICENSES, "op4_substring_dedup": sql.SUBSTRING_DEDUP, "op5_near_duplicates": sql.NEAR_DUPLICATES,
       "op11_conversation_repair": sql.CONVERSATION_REPAIR, "op12_lexical_search": sql.LEXICAL_SEARCH,
       "op13_chat_formatting": sql.CHAT_FORMATTING}
