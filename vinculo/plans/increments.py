"""Silver kept up to date by signed counts: a month's files cost what they change.

A layer holds the distinct partner rows that a change adds or takes away, and by how many copies. The table is what its
layers add up to: a row stands while its copies are above zero, so a row that two files hold vanishes with the second of
them. A change writes its own layer and nothing else; facts per name are derived again only for the names it touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vinculo.plans.partners import companies_of_names, partner_rows, resolved_names, without_documents

COPIES = "_copias"
LAYER = "camada"


def signed_counts(added: DataFrame | None, removed: DataFrame | None) -> DataFrame:
    """Distinct rows of both frames with the copies added less those removed; rows that cancel out are left out."""
    signs = [(frame, sign) for frame, sign in ((added, 1), (removed, -1)) if frame is not None]
    if not signs:
        raise ValueError("a change adds or removes rows")
    first, *others = [frame.withColumn(COPIES, F.lit(sign).cast("long")) for frame, sign in signs]
    for other in others:
        first = first.unionByName(other)
    return _added_up(first).where(F.col(COPIES) != 0)


def _added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*[name for name in rows.columns if name not in (COPIES, LAYER)]).agg(F.sum(COPIES).alias(COPIES))


def add_layer(folder: str, label: str, added: DataFrame | None, removed: DataFrame | None, salt: str) -> DataFrame:
    """Write the change that raw partner rows make as layer ``label`` of ``folder``; returns the layer.

    A layer written again replaces the former one of its label, so a job may be repeated. No bare document is kept.
    """
    kept = [None if raw is None else without_documents(partner_rows(raw), salt) for raw in (added, removed)]
    layer = signed_counts(*kept)
    path = f"{folder}/{LAYER}={label}"
    layer.write.mode("overwrite").parquet(path)
    return layer.sparkSession.read.schema(layer.schema).parquet(path)


def current_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct partner rows that the layers of ``folder`` add up to, for the silver tables to be made of."""
    return _added_up(spark.read.parquet(folder)).where(F.col(COPIES) > 0).drop(COPIES)


def merge_layers(spark: SparkSession, folder: str, target: str, label: str) -> None:
    """Write the layers of ``folder`` as one layer ``label`` of another folder; rows without copies are left out."""
    if folder.rstrip("/") == target.rstrip("/"):
        raise ValueError("merge the layers into a folder of its own")
    _added_up(spark.read.parquet(folder)).where(F.col(COPIES) != 0).write.mode("overwrite").parquet(f"{target}/{LAYER}={label}")


def refreshed_names(facts: DataFrame, rows: DataFrame, layer: DataFrame) -> DataFrame:
    """``facts`` of :func:`vinculo.plans.partners.resolved_names` after a change.

    ``rows`` are the current rows, ``layer`` the change: facts of names it does not touch stay, the others are derived
    again, and a name without a row goes.
    """
    touched = layer.where("tem_nome").select("nome").distinct()
    derived = resolved_names(companies_of_names(rows.join(touched, "nome", "left_semi")))
    return facts.join(touched, "nome", "left_anti").unionByName(derived)
