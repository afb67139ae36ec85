"""The registered queries of these operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from shelfscan.llm import hard_negatives, ranked_search, topk
from shelfscan.llm.bpe import op8_bpe
from shelfscan.llm.jaccard_join import op6_jaccard_join
from shelfscan.llm.langid import op5_language_id
from shelfscan.llm.cascade import op9_quality_rules
from shelfscan.llm.packing import op4_best_fit_packing
from shelfscan.llm.quality_gam import op10_quality_gam
from shelfscan.llm.hard_negatives import op12_hard_negatives
from shelfscan.llm.ranked_search import op11_ranked_search
from shelfscan.llm.simhash import op13_simhash
from shelfscan.llm.substring_dedup import op2_substring_dedup
from shelfscan.llm.token_counts import op3_token_counts
from shelfscan.llm.topk import op7_top_k
from shelfscan.llm.wrapper import op1_html_extraction


def queries() -> dict[str, Callable]:
    return {
        "op1_html_extraction": op1_html_extraction,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_token_counts": op3_token_counts,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_language_id": op5_language_id,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_top_k": op7_top_k,
        "op8_bpe": op8_bpe,
        "op9_quality_rules": op9_quality_rules,
        "op10_quality_gam": op10_quality_gam,
        "op11_ranked_search": op11_ranked_search,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_simhash": op13_simhash,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_top_k": topk.ORACLE_SQL,
        "op11_ranked_search": ranked_search.ORACLE_SQL,
        "op12_hard_negatives": hard_negatives.ORACLE_SQL,
    }
