"""Key sets, semi-join reduction and one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vinculo.functions.text import is_present


def target_keys(frame: DataFrame, column: str) -> DataFrame:
    """Distinct present values of a string column or of the elements of an array column."""
    values = F.col(column)
    if frame.schema[column].dataType.typeName() == "array":
        values = F.explode(values)
    listed = frame.select(values.alias(column)).withColumn(column, F.col(column).cast("string"))
    return listed.where(is_present(F.col(column))).distinct()


def keep_keys(frame: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose key is among ``keys``. Spark broadcasts the keys if their size allows, unless they are hinted otherwise."""
    return frame.join(keys.select(column), column, "left_semi")


BLANK_KEYS = 64  # stand-ins for the blank key, so that its rows meet in many tasks


def keep_keys_and_blanks(frame: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose key is among ``keys``, and rows whose key is null or blank.

    Blank keys, often a large part of the rows, are dealt to stand-ins, which join the keys.
    """
    row = F.pmod(F.xxhash64(*frame.columns), F.lit(BLANK_KEYS)).cast("string")
    key = F.when(is_present(F.col(column)), F.col(column)).otherwise(F.concat(F.lit("~"), row))
    stand_ins = frame.sparkSession.range(BLANK_KEYS).select(F.concat(F.lit("~"), F.col("id").cast("string")).alias("_key"))
    present = keys.select(F.col(column).alias("_key")).where(is_present(F.col("_key")))
    return frame.withColumn("_key", key).join(present.union(stand_ins), "_key", "left_semi").drop("_key")


def own_key(key: Column, usable: Column, row: Column) -> Column:
    """Key for a left join in which rows that cannot match get one of their own.

    Null and blank keys, often a large part of the rows, would otherwise all meet in one task. ``row`` should
    differ between rows and be the same when a task runs again.
    """
    return F.when(usable, key).otherwise(F.concat(F.lit("~"), row.cast("string")))


def one_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The least row of each key, by ``order`` and then by all other columns.

    Spark keeps the first row of a key in each task before it shuffles, so a key with many copies costs no more than any
    other: one row a task. ``order`` may rank rows by some columns only; the rest of the columns settles ties.
    """
    rest = [name for name in frame.columns if name not in keys]
    if not rest:
        return frame.distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return frame.withColumn("_place", place).where("_place = 1").drop("_place")
