"""Bring frames with varying columns to an expected layout; all of it is metadata work."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def rename_headers(frame: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Trim and lower-case headers, spaces and dashes to underscores, then apply ``aliases``."""
    tidy = [name.strip().lower().replace(" ", "_").replace("-", "_") for name in frame.columns]
    return frame.toDF(*[aliases.get(name, name) for name in tidy])


def add_missing(frame: DataFrame, expected: Mapping[str, DataType | str]) -> DataFrame:
    """Add each expected column the frame lacks, as typed nulls."""
    missing = {name: F.lit(None).cast(kind) for name, kind in expected.items() if name not in frame.columns}
    return frame.withColumns(missing) if missing else frame


def require_columns(frame: DataFrame, names: Iterable[str], what: str) -> None:
    """Raise unless the frame has every named column."""
    missing = sorted(set(names) - set(frame.columns))
    if missing:
        raise ValueError(f"{what}: missing columns {', '.join(missing)}")


def keep_present(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Select the named columns which exist, in the given order."""
    return frame.select(*[name for name in names if name in frame.columns])


def pick_columns(
    frame: DataFrame, choices: Mapping[str, Sequence[str]], optional: Iterable[str] = ()
) -> DataFrame:
    """Select one source column per target name: the first of its aliases the frame has.

    A target without any of its aliases is an error, unless it is ``optional``: then it is null.
    """
    by_lower = {name.lower(): name for name in frame.columns}
    picked = []
    for target, aliases in choices.items():
        source = next((by_lower[alias] for alias in aliases if alias in by_lower), None)
        if source is None and target not in optional:
            raise ValueError(f"no column for '{target}': expected one of {', '.join(aliases)}")
        column = F.lit(None) if source is None else F.col(f"`{source}`")
        picked.append(column.cast("string").alias(target))
    return frame.select(*picked)
