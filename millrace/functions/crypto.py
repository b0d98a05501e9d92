"""Column encryption with Spark's AES-GCM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def encrypt(column: Column | str, key: Column, nonce_key: Column | None = None) -> Column:
    """Hex text of nonce + ciphertext + tag. `key` is binary of 16, 24 or 32 bytes.

    With `nonce_key` the nonce is taken from a hash of the value, so equal values stay equal and
    can be joined, and different values never share a nonce. Without it the nonce is random.
    """
    column = F.col(column) if isinstance(column, str) else column
    text = column.cast("string")
    if nonce_key is None:
        return F.hex(F.aes_encrypt(text, key, F.lit("GCM")))
    digest = F.sha2(F.concat(nonce_key, text.cast("binary")), 256)
    nonce = F.unhex(F.substring(digest, 1, 24))
    return F.hex(F.aes_encrypt(text, key, F.lit("GCM"), F.lit("DEFAULT"), nonce))


def decrypt(column: Column | str, key: Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.aes_decrypt(F.unhex(column), key, F.lit("GCM")).cast("string")


def key_from_hex(text: str) -> Column:
    """The key as the one value of a subquery: plans, explain and event logs name the subquery, never the key."""
    return SparkSession.active().createDataFrame([(bytes.fromhex(text),)], "secret binary").scalar()


def derived_key(key: Column, purpose: str) -> Column:
    """A second key for another purpose, so that the cipher key itself is not hashed with values.

    A subquery as well, so it is derived once, not per row.
    """
    digest = F.unhex(F.sha2(F.concat(key, F.lit(purpose).cast("binary")), 256))
    return SparkSession.active().range(1).select(digest.alias("secret")).scalar()


def encrypt_columns(df: DataFrame, columns: list[str], key: Column, joinable: bool = True) -> DataFrame:
    nonce_key = derived_key(key, "nonce") if joinable else None
    return df.withColumns({c: encrypt(c, key, nonce_key) for c in columns})


def decrypt_columns(df: DataFrame, columns: list[str], key: Column) -> DataFrame:
    return df.withColumns({c: decrypt(c, key) for c in columns})
