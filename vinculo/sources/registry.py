"""Registry files: headerless, semicolon-separated text in families told apart by file name."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vinculo.operators.keys import keep_keys, keep_keys_and_blanks
from vinculo.schemas import COMPANY_LAYOUT, ESTABLISHMENT_LAYOUT, PARTNER_LAYOUT, TAX_REGIME_LAYOUT
from vinculo.sources.manifest import choose_snapshot, family_of, first_files, select_prefixes
from vinculo.sources.records import read_records


@dataclass(frozen=True)
class Selection:
    """The files a read was limited to, and the cap that was applied (negative: none)."""

    month: str
    files: tuple[str, ...]
    max_files: int


@dataclass(frozen=True)
class Family:
    """File name prefix and column layout of one kind of registry file."""

    prefix: str
    layout: StructType


FAMILIES = {
    "partners": Family("Socios", PARTNER_LAYOUT),
    "companies": Family("Empresas", COMPANY_LAYOUT),
    "establishments": Family("Estabelecimentos", ESTABLISHMENT_LAYOUT),
    "tax_regime": Family("Simples", TAX_REGIME_LAYOUT),
}


def read_registry(
    spark: SparkSession,
    family: str,
    paths: str | Sequence[str],
    targets: DataFrame | None = None,
    *,
    encoding: str = "ISO-8859-1",
    quote: str = '"',
    pad_with: str | None = None,
    ignore_unreadable: bool = False,
    by_prefix: bool = True,
    multi_line: bool = False,
    whole_records: bool = False,
    blank_keys: bool = False,
) -> DataFrame:
    """Read the files of a family, all columns as text, optionally only the ``targets``' companies.

    Short rows are padded with nulls, or with ``pad_with``; long rows are cut to the layout; blank lines
    are skipped. No ``paths`` give an empty frame of the layout. An empty ``quote`` turns quoting off.
    ``ignore_unreadable`` skips files that cannot be read; :func:`file_report` tells which gave how many rows.
    ``whole_records`` keeps line breaks inside quoted values, whatever byte ranges the files are read in (see
    :func:`vinculo.sources.records.read_records`); ``multi_line`` does so with Spark's own reader, to which a file is one
    task's work. Without either, :func:`torn_lines` counts the lines that such a break has
    torn. Letter case of file names does not matter. Keys are trimmed before they are compared with ``targets``; with
    ``blank_keys``, rows whose key is blank are kept beside the targets' rows.
    """
    layout = FAMILIES[family].layout
    if not paths:
        return spark.createDataFrame([], layout)
    dialect = {"sep": ";", "quote": quote, "escape": quote or "\\", "mode": "PERMISSIVE"}
    glob = file_pattern(family) if by_prefix else None
    if whole_records and quote:
        records = read_records(spark, paths, quote, glob)
        parsed = F.from_csv(F.decode("value", encoding), layout.toDDL(), dialect | {"multiLine": "true"})
        rows = records.select(parsed.alias("row")).select("row.*")
    else:
        reader = spark.read.schema(layout).options(header="false", encoding=encoding, ignoreCorruptFiles=str(ignore_unreadable).lower(), **dialect)
        if glob is not None:
            reader = reader.option("pathGlobFilter", glob)
        if multi_line:
            reader = reader.option("multiLine", "true")
        rows = reader.csv(paths if isinstance(paths, str) else list(paths))
    if pad_with is not None:
        rows = rows.na.fill(pad_with)
    if targets is None:
        return rows
    rows = rows.withColumn("cnpj_basico", F.trim("cnpj_basico"))
    return keep_keys_and_blanks(rows, targets, "cnpj_basico") if blank_keys else keep_keys(rows, targets, "cnpj_basico")


def file_pattern(family: str) -> str:
    """The glob of a family's files, packed or not, in any mixture of letter cases."""
    letters = (f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in FAMILIES[family].prefix)
    return "".join(letters) + "*.[cC][sS][vV]{,.[gG][zZ]}"


def torn_lines(spark: SparkSession, family: str, paths: str | Sequence[str], quote: str = '"') -> DataFrame:
    """(``file``, ``lines``, ``torn``) of each file of a family: lines with an odd number of quotes are torn.

    A line break inside a quoted value leaves two of them.
    """
    lines = spark.read.option("pathGlobFilter", file_pattern(family)).text(paths if isinstance(paths, str) else list(paths))
    odd = (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))) % 2 == 1
    file = F.regexp_extract(F.input_file_name(), "[^/]*$", 0).alias("file")
    return lines.groupBy(file).agg(F.count("*").alias("lines"), F.count_if(odd).alias("torn"))


def file_report(spark: SparkSession, family: str, folder: str, rows: DataFrame) -> DataFrame:
    """(``file``, ``n_rows``, ``read``) of every file of a family in ``folder``: ``rows`` is what was read of it.

    A file that gave no row is reported with ``read`` false: it was skipped as unreadable. Empty files are not listed.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", file_pattern(family)).load(folder)
    name = F.regexp_extract("path", "[^/]*$", 0).alias("file")
    counted = rows.groupBy(F.regexp_extract(F.input_file_name(), "[^/]*$", 0).alias("file")).agg(F.count("*").alias("n"))
    joined = listed.select(name).join(counted, "file", "left")
    return joined.select("file", F.coalesce("n", F.lit(0)).alias("n_rows"), F.col("n").isNotNull().alias("read"))


def read_selected(
    spark: SparkSession,
    manifest: DataFrame,
    folder: str,
    family: str,
    month: str | None = None,
    prefixes: str | Sequence[str] | None = None,
    max_files: int = -1,
    **options,
) -> tuple[DataFrame, Selection]:
    """Read what a manifest, month, prefixes and cap select, from ``folder/month/name``; and what that was.

    The files of the family are taken in natural order of their names. Without a file the frame is empty.
    """
    chosen = select_prefixes(choose_snapshot(manifest, month), prefixes)
    chosen = chosen.where(family_of(F.col("name"), {family: FAMILIES[family].prefix}).isNotNull())
    files = [(row["month"], row["name"]) for row in first_files(chosen, max_files).select("month", "name").collect()]
    rows = read_registry(spark, family, [f"{folder}/{at}/{name}" for at, name in files], by_prefix=False, **options)
    return rows, Selection(files[0][0] if files else (month or ""), tuple(name for _, name in files), max_files)


def read_table(spark: SparkSession, path: str, columns: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Read the named columns of a parquet table; ``optional`` ones only if the table has them."""
    table = spark.read.parquet(path)
    return table.select(*columns, *[name for name in optional if name in table.columns])
