"""Data-quality features of a task: auto-correct, then mask, then encrypt; or decrypt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from millrace.config import as_list, is_yes, secret
from millrace.functions.crypto import decrypt_columns, encrypt_columns, key_from_hex
from millrace.functions.mask import mask_from_config
from millrace.operators.lookup import auto_correct


def apply_features(df: DataFrame, features: dict | None, lookup: DataFrame | None = None, key: Column | None = None) -> DataFrame:
    """Every enabled feature runs, always in this order, as projections of one plan."""
    features = features or {}
    if is_yes(features.get("data_decryption_required")):
        df = decrypt_columns(df, as_list(features["data_decryption_columns"]), key if key is not None else _task_key())
    if is_yes(features.get("dq_auto_correction_required")):
        if lookup is None:
            lookup = df.sparkSession.read.options(header=True, inferSchema=True).csv(features["dq_lookup_file_path"])
        df = auto_correct(
            df, lookup, features["dq_lkup_key_column"], features["dq_auto_correct_columns"],
            features.get("dq_lookup_how", "left"),
        )
    if is_yes(features.get("data_masking_required")):
        df = mask_from_config(df, features["data_masking_columns"])
    if is_yes(features.get("data_encryption_required")):
        df = encrypt_columns(df, as_list(features["data_encryption_columns"]), key if key is not None else _task_key())
    return df


def _task_key() -> Column:
    """Hex text of 32, 48 or 64 digits in MILLRACE_SECRET_COLUMN_KEY."""
    return key_from_hex(secret("column_key"))
