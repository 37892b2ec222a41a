"""Plan-time helpers on column and file names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def columns_matching(columns: Iterable[str], fragments: Iterable[str]) -> list[str]:
    """Columns whose name contains any of ``fragments`` (substring test)."""
    frags = list(fragments)
    return [c for c in columns if any(f in c for f in frags)]


def run_name(model: Column, seq_len: Column, drop_prod: Column) -> Column:
    """``{model}_seq{n}_{with|no}_prod`` as a column expression."""
    suffix = F.when(drop_prod, F.lit("no_prod")).otherwise(F.lit("with_prod"))
    return F.concat(model, F.lit("_seq"), seq_len.cast("string"), F.lit("_"), suffix)
