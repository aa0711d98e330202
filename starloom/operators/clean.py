"""Raw text rows to clean typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import clean_column
from starloom.specs import Source


def clean(raw: DataFrame, source: Source, run_ts: Column | None = None) -> DataFrame:
    """One projection: strings trimmed, numbers and dates cast, load time renewed.

    One row out per row in. Nothing is deduplicated or filtered.
    """
    loaded = F.current_timestamp() if run_ts is None else run_ts
    return raw.select(*[clean_column(c) for c in source.columns], loaded.alias(source.loaded_at))
