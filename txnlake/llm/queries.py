"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from txnlake.llm.collocations import OP12_SQL, op12_collocations
from txnlake.llm.decontam import op2_decontamination
from txnlake.llm.line_dedup import OP4_SQL, op4_line_dedup
from txnlake.llm.minhash import op7_near_duplicates
from txnlake.llm.packing import op1_best_fit_packing
from txnlake.llm.ranked_search import OP11_SQL, op11_ranked_search
from txnlake.llm.sharding import op5_sharding
from txnlake.llm.suffix_dedup import op9_suffix_dedup
from txnlake.llm.token_store import op8_token_ids
from txnlake.llm.topk import OP6_SQL, op6_top_k
from txnlake.llm.toxicity import op3_toxicity
from txnlake.llm.url_filter import op10_url_filters
from txnlake.llm.vector_dedup import OP13_SQL, op13_vector_dedup

QUERIES = {
    "op9_suffix_dedup": op9_suffix_dedup,
    "op6_top_k": op6_top_k,
    "op7_near_duplicates": op7_near_duplicates,
    "op4_line_dedup": op4_line_dedup,
    "op2_decontamination": op2_decontamination,
    "op1_best_fit_packing": op1_best_fit_packing,
    "op5_sharding": op5_sharding,
    "op3_toxicity": op3_toxicity,
    "op8_token_ids": op8_token_ids,
    "op10_url_filters": op10_url_filters,
    "op11_ranked_search": op11_ranked_search,
    "op12_collocations": op12_collocations,
    "op13_vector_dedup": op13_vector_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": OP4_SQL,
    "op6_top_k": OP6_SQL,
    "op11_ranked_search": OP11_SQL,
    "op12_collocations": OP12_SQL,
    "op13_vector_dedup": OP13_SQL,
}
