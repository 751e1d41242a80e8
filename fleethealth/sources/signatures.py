"""Signature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fleethealth import schema as S
from fleethealth.functions import bt


def load_signatures(
    table: DataFrame, positions: Sequence[int], drop_first: int = 3, scale: float = 100.0,
    phase: str | None = None, label: str = "sig_id", position: str = "sig_pos",
) -> DataFrame:
    """Choose signature rows by position, drop the leading readings, scale.

    ``table`` holds position, label and numeric columns, one phase's sheet or
    (with a ``phase`` column) all of them.
    """
    if phase is not None and phase not in S.PHASES:
        raise ValueError(f"unknown flight phase: {phase}")
    ids = [c for c in (S.PHASE, position, label) if c in table.columns]
    numbers = [c for c in table.columns if c not in ids][drop_first:]
    chosen = table.where(bt(position).isin(list(positions)))
    key = [F.lit(phase).alias(S.PHASE)] if phase is not None and S.PHASE not in ids else []
    return chosen.select(
        *key, *map(bt, ids), *[(bt(c).cast("double") * F.lit(float(scale))).alias(c) for c in numbers]
    )
