"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .ann import op5_kmeans_tree
from .chat import op7_chat_examples
from .collocations import op12_collocations
from .decontam import op6_decontaminate
from .langid import op8_language_id
from .licenses import op2_license_scan
from .lm_score import op1_cross_entropy_difference
from .neardup import op10_chosen_path_join
from .oracles import ORACLES
from .packing import op3_best_fit_packing
from .sharding import op9_external_shuffle
from .spelling import op13_spelling_variants
from .substring import op4_repeated_phrases
from .url_rules import op11_url_rules

QUERIES = (op1_cross_entropy_difference, op2_license_scan, op3_best_fit_packing, op4_repeated_phrases, op5_kmeans_tree, op6_decontaminate, op7_chat_examples, op8_language_id, op9_external_shuffle, op10_chosen_path_join, op11_url_rules, op12_collocations, op13_spelling_variants)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_queries() -> dict[str, str]:
    return dict(ORACLES)
