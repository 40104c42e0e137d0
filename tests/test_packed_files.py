"""Files of a run are compressed, and read back whole."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from vinculo.sinks import write_gold, write_registry_files
from vinculo.sources import read_registry


def test_gold_is_packed(spark, tmp_path):
    rows = spark.range(0, 40, 1, 4).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("b"), F.col("id") % 3)).alias("faixa_etaria"))
    assert write_gold(rows, str(tmp_path)) == 40
    files = sorted(tmp_path.rglob("*.parquet"))
    assert files and {pq.ParquetFile(x).metadata.row_group(0).column(0).compression for x in files} == {"ZSTD"}
    split = spark.read.schema(rows.schema).parquet(str(tmp_path / "egressos_por_faixa_etaria")).select("id", "faixa_etaria")
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_registry_files_may_be_packed(spark, tmp_path):
    partner = spark.createDataFrame([("1", "2", 'A "B";\nC', "x", None, None, None, None, None, None, None)], ", ".join(f"c{i} string" for i in range(11))).coalesce(1)
    assert write_registry_files(partner, str(tmp_path / "land"), "sOCIOS", packed=True) == 1
    assert [x.name for x in (tmp_path / "land").iterdir() if not x.name.startswith((".", "_"))] == ["sOCIOS0.csv.gz"]
    read = read_registry(spark, "partners", str(tmp_path / "land"), whole_records=True).collect()
    assert [row["nome_socio"] for row in read] == ['A "B";\nC']
