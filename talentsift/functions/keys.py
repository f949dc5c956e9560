"""Deterministic identifiers, so that a retried write produces the same row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(*parts: Column) -> Column:
    """A hash that differs whenever any part does: the parts are encoded as a JSON list, which keeps NULL apart."""
    return F.sha2(F.to_json(F.array(*[part.cast("string") for part in parts])), 256)


def creator_key(platform: Column, external_id: Column) -> Column:
    """Identity of a creator, computable without looking the creator up."""
    return digest(platform, external_id)
