"""Take in only the files that landed since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def take_new_files(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    bronze: str,
    checkpoint: str,
    kind: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Append files new in ``landing`` to the ``bronze`` table and return that table.

    The checkpoint remembers what was read, so a second run reads nothing twice and a failed run resumes.
    """
    stream = spark.readStream.format(kind).schema(schema).options(**(options or {})).load(landing)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(bronze)
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(bronze)
