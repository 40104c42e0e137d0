"""Registry files as they are published: headerless quoted text, told apart by file name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_registry_files(frame: DataFrame, folder: str, prefix: str, encoding: str = "ISO-8859-1", packed: bool = False) -> int:
    """Write ``frame`` as ``<prefix>0.csv``, ``<prefix>1.csv``, ... into ``folder``; returns the number of files.

    ``packed`` files are compressed and end in ``.csv.gz``; readers unpack them, each in one task. Every value is quoted,
    quotes are doubled, line breaks stay inside their value; null is written as an empty value.
    """
    spark = frame.sparkSession
    aside = f"{folder.rstrip('/')}/_{prefix}"
    frame.write.options(sep=";", encoding=encoding, quoteAll=True, escape='"', emptyValue="", compression="gzip" if packed else "none").csv(aside)
    ending = ".csv.gz" if packed else ".csv"
    place = spark._jvm.org.apache.hadoop.fs.Path
    source = place(aside)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(x.getPath().toString() for x in files.listStatus(source) if x.getPath().getName().startswith("part-"))
    for number, part in enumerate(parts):
        files.rename(place(part), place(f"{folder.rstrip('/')}/{prefix}{number}{ending}"))
    files.delete(source, True)
    return len(parts)
