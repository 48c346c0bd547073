"""The training-data queries, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Query and the module that has it.
MODULES = {
    "op8_license_scan": "licenses",
    "op1_decontamination": "decontamination",
    "op5_line_dedup": "line_dedup",
    "op3_embedding_join": "embedding_join",
    "op6_simhash": "simhash",
    "op7_toxicity": "toxicity",
    "op2_pii_spans": "pii",
    "op4_consistent_hash_sharding": "sharding",
    "op9_token_counts": "token_counts",
    "op10_best_fit_packing": "packing",
    "op11_fill_in_middle": "infill",
    "op12_language_id": "language",
    "op13_tokenizer_alignment": "alignment",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(importlib.import_module(f".{module}", __package__), name) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    sql = {"op3_embedding_join": ("embedding_join", "OP3_SQL"), "op11_fill_in_middle": ("infill", "OP11_SQL")}
    return {name: getattr(importlib.import_module(f".{module}", __package__), text) for name, (module, text) in sql.items()}
