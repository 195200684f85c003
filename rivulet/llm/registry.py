"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from importlib import import_module

#: Query name -> module whose ``query`` applies the operator to its whole table.
MODULES = {
    "op1_decontaminate": "decontaminate",
    "op2_substring_dedup": "substring_dedup",
    "op3_warc": "warc",
    "op4_extract": "extract",
    "op5_topk": "topk",
    "op6_toxicity": "toxicity",
    "op7_sentencepiece": "sentencepieces",
    "op8_near_dedup": "near_dedup",
    "op9_language": "language",
    "op10_quality": "quality",
    "op11_packing": "packing",
    "op12_conversation_repair": "conversations",
    "op13_importance_resampling": "resample",
}


def _module(name: str):
    return import_module(f".{MODULES[name]}", __package__)


def queries() -> dict:
    return {name: _module(name).query for name in MODULES}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name in MODULES if (sql := getattr(_module(name), "ORACLE_SQL", None))}
