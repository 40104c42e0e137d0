"""Which files to read: queries over a manifest with columns ``month``, ``name`` and ``size``."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words that stand for "no prefix filter" (fixed values).
NO_FILTER_WORDS = ("all", "todos", "*")

MONTH_PATTERN = r"^\d{4}-\d{2}$"


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of ``folder``: ``month`` (the name of a file's folder), ``name`` and ``size`` of every file below it.

    Only the listing is read, no file.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    part = F.split("path", "/")
    return files.select(F.element_at(part, -2).alias("month"), F.element_at(part, -1).alias("name"), F.col("length").alias("size"))


def parse_prefixes(prefixes: str | Iterable[str] | None) -> tuple[str, ...] | None:
    """Lower-case prefixes split at ``;`` and ``,``; ``None`` when nothing is to be filtered."""
    if prefixes is None:
        return None
    listed = [prefixes] if isinstance(prefixes, str) else [str(item) for item in prefixes if item]
    words = [word.strip().lower() for item in listed for word in re.split("[;,]", item)]
    words = [word for word in words if word]
    if not words or any(word in NO_FILTER_WORDS for word in words):
        return None
    return tuple(words)


def select_prefixes(manifest: DataFrame, prefixes: str | Iterable[str] | None) -> DataFrame:
    """Files whose name starts with one of the prefixes, whatever the case."""
    wanted = parse_prefixes(prefixes)
    if wanted is None:
        return manifest
    matches = F.lit(False)
    for prefix in wanted:
        matches = matches | F.startswith(F.lower("name"), F.lit(prefix))
    return manifest.where(matches)


def family_of(name: Column, families: dict[str, str]) -> Column:
    """Family a file belongs to by its prefix, else null. ``families`` maps family to prefix."""
    routed = F.lit(None).cast("string")
    for family, prefix in families.items():
        routed = F.when(F.startswith(F.lower(name), F.lit(prefix.lower())), family).otherwise(routed)
    return routed


def choose_snapshot(manifest: DataFrame, month: str | None = None, strict: bool = False) -> DataFrame:
    """Files of the given month, or of the latest one. Entries outside ``AAAA-MM`` never count.

    ``strict`` raises if that leaves no file.
    """
    valid = manifest.where(F.col("month").rlike(MONTH_PATTERN))
    if month is not None:
        chosen = valid.where(F.col("month") == month)
    else:
        latest = valid.agg(F.max("month").alias("month"))
        chosen = valid.join(F.broadcast(latest), "month", "left_semi")  # one row
    if strict and chosen.isEmpty():
        raise ValueError(f"no files for month {month or '(latest)'}")
    return chosen


def natural_order(name: Column) -> Column:
    """Sort key in which runs of digits compare as numbers and letters ignore case."""
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"(\d+|\D+)"), 1)

    def key(part):
        number = F.ltrim(part, F.lit("0"))
        by_size = F.concat(F.lpad(F.length(number).cast("string"), 4, "0"), number)
        return F.when(part.rlike(r"^\d"), by_size).otherwise(part)

    return F.transform(parts, key)


def first_files(manifest: DataFrame, count: int) -> DataFrame:
    """The first ``count`` files in natural order; a negative count keeps all."""
    ordered = manifest.orderBy(natural_order(F.col("name")), "name")
    return ordered if count < 0 else ordered.limit(count)


def pending_files(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Files not yet processed; a processed entry of size zero does not count."""
    complete = done.where(F.col("size") > 0).select("month", "name")
    return manifest.join(complete, ["month", "name"], "left_anti")
