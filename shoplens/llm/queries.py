"""Registered queries of the numbered operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import (
    decontam,
    importance,
    langid,
    licenses,
    merkle,
    minhash,
    packing,
    pii,
    quality,
    secrets,
    token_files,
    toxicity,
    vector_codes,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bootstrapped_pii": pii.personal_data_query,
        "op2_winnowing_decontamination": decontam.decontamination_query,
        "op3_best_fit_packing": packing.packing_query,
        "op4_ftrl_language_id": langid.language_query,
        "op5_token_files": token_files.token_files_query,
        "op6_merkle_fingerprints": merkle.fingerprint_query,
        "op7_guess_cost_secrets": secrets.secrets_query,
        "op8_rule_ensemble_quality": quality.quality_query,
        "op9_segment_toxicity": toxicity.toxicity_query,
        "op10_minhash_near_dedup": minhash.near_duplicates_query,
        "op11_importance_resampling": importance.importance_query,
        "op12_gnat_vector_codes": vector_codes.vector_codes_query,
        "op13_license_scans": licenses.license_query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_winnowing_decontamination": decontam.ORACLE,
        "op10_minhash_near_dedup": minhash.ORACLE,
        "op11_importance_resampling": importance.ORACLE,
        "op12_gnat_vector_codes": vector_codes.ORACLE,
        "op13_license_scans": licenses.ORACLE,
    }
