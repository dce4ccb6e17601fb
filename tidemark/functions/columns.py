"""Helper columns that leave a caller's columns alone."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame


def put_aside(df: DataFrame, helpers: str) -> tuple[DataFrame, Callable[[str], str], Callable[[DataFrame], DataFrame]]:
    """``df`` with columns whose names match the pattern ``helpers`` renamed, where a column is now, and the way back.

    Names are compared as Spark resolves them, without regard to case. Renaming costs nothing at run time.
    """
    mark = uuid.uuid4().hex
    moved = {c: f"kept_{i}_{mark}" for i, c in enumerate(df.columns) if re.fullmatch(helpers, c, re.I)}
    if not moved:
        return df, lambda name: name, lambda result: result
    return (
        df.withColumnsRenamed(moved),
        lambda name: next((new for old, new in moved.items() if old.lower() == name.lower()), name),
        lambda result: result.withColumnsRenamed({new: old for old, new in moved.items() if new in result.columns}),
    )
