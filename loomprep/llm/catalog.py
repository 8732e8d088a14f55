"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import (best_fit_packing, embedding_dedup, hard_negatives, html_extract, jaccard_join, mixing,
               packing, periodic_runs, secret_scan, substring_dedup, suffix_array_dedup, toxicity,
               vector_search)

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_html_extract": html_extract.op2_html_extract,
    "op4_mixing": mixing.op4_mixing,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_suffix_array_dedup": suffix_array_dedup.op6_suffix_array_dedup,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_packing": packing.op9_packing,
    "op10_embedding_dedup": embedding_dedup.op10_embedding_dedup,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op3_vector_search": vector_search.op3_vector_search,
    "op11_best_fit_packing": best_fit_packing.op11_best_fit_packing,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
ORACLE: dict[str, str] = {"op4_mixing": mixing.OP4_SQL, "op13_hard_negatives": hard_negatives.OP13_SQL}
