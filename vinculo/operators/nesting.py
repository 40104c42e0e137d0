"""Group rows into sorted lists: one row per key, whatever the data size.

A list is a value of one row, so a key's elements meet in one task: an export for consumers who want lists. Plans take no
facts from lists, and write the flat rows they are made of as child tables first, without ever gathering a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lists:
    """Lists by key: ``table`` has one row per key."""

    keys: tuple[str, ...]
    table: DataFrame

    def renamed(self, key: str, name: str) -> Lists:
        """The same lists with another name for one of the keys."""
        keys = tuple(name if item == key else item for item in self.keys)
        return Lists(keys, self.table.withColumnRenamed(key, name))


def nest(
    frame: DataFrame,
    keys: Sequence[str],
    element: Column,
    into: str,
    copies: Column | None = None,
    total_into: str | None = None,
) -> Lists:
    """One row per key, with ``element`` collected into the sorted list ``into``.

    ``copies`` tells how often an element counts (default: once per row). ``total_into`` names a column for the
    length of the list. Rows are shuffled once, an element with its number of copies; copies are spelt out in the finished
    list. Keys must not be null.
    """
    if copies is None:
        listed, length = F.collect_list(F.struct(element.alias("e"))), F.count(F.lit(1))
        values = F.transform(F.sort_array(listed), lambda item: item["e"])
    else:
        listed, length = F.collect_list(F.struct(element.alias("e"), copies.cast("int").alias("n"))), F.sum(copies)
        values = F.flatten(F.transform(F.sort_array(listed), lambda item: F.array_repeat(item["e"], item["n"])))
    measures = [values.alias(into)]
    if total_into is not None:
        measures.append(length.cast("bigint").alias(total_into))
    return Lists(tuple(keys), frame.groupBy(*keys).agg(*measures))


def attach_lists(frame: DataFrame, lists: Sequence[Lists]) -> DataFrame:
    """Left-join lists made by :func:`nest`; every row comes back once.

    The lists are merged: a table with a row per key grows with the data, whatever its files say about its size.
    """
    for item in lists:
        frame = frame.join(item.table.hint("merge"), list(item.keys), "left")
    return frame
