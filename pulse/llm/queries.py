"""Registered queries of this subpackage and their SQL."""

import corpus_pipeline
from pulse.llm import (
    chat_windows,
    kk_packing,
    license_templates,
    line_dedup,
    line_quality,
    near_dups,
    packed_ids,
    periodic_runs,
    ranked_search,
    scaled_sketch,
    secret_tags,
    toxic_lexicon,
    word_shuffle,
)

_MODULES = {
    "op1_secret_tags": secret_tags,
    "op2_chat_windows": chat_windows,
    "op3_scaled_sketch": scaled_sketch,
    "op4_license_templates": license_templates,
    "op5_packed_ids": packed_ids,
    "op6_near_dups": near_dups,
    "op7_word_shuffle": word_shuffle,
    "op8_line_quality": line_quality,
    "op9_toxic_lexicon": toxic_lexicon,
    "op10_kk_packing": kk_packing,
    "op11_periodic_runs": periodic_runs,
    "op12_ranked_search": ranked_search,
    "op13_line_dedup": line_dedup,
}


def queries():
    found = {name: module.query for name, module in _MODULES.items()}
    return {**found, "pipeline": corpus_pipeline.run}


def oracle_sql():
    """Where SQL can state the result; the others have brute-force tests."""
    return {
        name: module.ORACLE for name, module in _MODULES.items() if getattr(module, "ORACLE", None)
    }
