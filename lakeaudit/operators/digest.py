"""Recomputing stored row digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keccak import keccak256


def digest(payload: Column | str, algorithm: str) -> Column:
    """Digest of a binary column as bytes. SHA-256 stays in the JVM, Keccak-256 runs in Arrow batches."""
    column = F.col(payload) if isinstance(payload, str) else payload
    if algorithm == "sha2-256":
        return F.unhex(F.sha2(column, 256))
    if algorithm == "keccak256":
        return keccak256(column)
    raise ValueError(f"unknown digest algorithm: {algorithm}")


def digest_mismatches(
    df: DataFrame, payload: str, stored: str, algorithm: str = "keccak256", scope: Sequence[str] = ()
) -> DataFrame:
    """Rows whose stored digest is not the digest of the payload: ``(scope..., rows, mismatches)``.

    A narrow job: scan two columns, hash, count. Nothing but one row per task and scope is shuffled.
    """
    checked = df.select(*scope, F.col(stored).alias("_stored"), digest(payload, algorithm).alias("_digest"))
    return checked.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("_digest").eqNullSafe(F.col("_stored"))).alias("mismatches"),
    )
