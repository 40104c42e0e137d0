"""Roster and registry files, manifests, index pages, sinks and incremental intake on small files."""

import csv
import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from vinculo.schemas import PARTNER_COLUMNS
from vinculo.sinks import write_annotated, write_gold, write_lineage, write_registry_files, write_table
from vinculo.sources import (
    choose_snapshot,
    conform_roster,
    file_report,
    first_files,
    list_files,
    month_links,
    parse_prefixes,
    pending_files,
    read_records,
    read_registry,
    read_roster,
    read_selected,
    read_table,
    select_prefixes,
    torn_lines,
    zip_links,
)
from vinculo.streaming import take_new_files


def test_roster_from_csv(spark, tmp_path):
    (tmp_path / "roster.csv").write_text(
        "MatriculaDRE, Nome ,CPF,Data Nascimento,DataIngresso,dataconclusao,Situacao-Curso\n"
        "001,José,529.982.247-25,05/03/1990,1990-03-05,31/02/1990,ATIVO\n"
        '002,"Ana, Maria",,1990-03-05 00:00:00,,,\n',
        encoding="utf-8",
    )
    roster = read_roster(spark, str(tmp_path / "roster.csv"))
    day = dt.date(1990, 3, 5)
    rows = roster.select("matricula", "nome", "cpf", "data_nascimento", "data_ingresso", "data_formacao", "situacao_curso", "nome_pai")
    assert sorted(rows.collect()) == [
        ("001", "José", "529.982.247-25", day, day, None, "ATIVO", None),
        ("002", "Ana, Maria", None, day, None, None, None, None),
    ]
    assert dict(roster.dtypes)["nome_mae"] == "string"


def test_roster_with_typed_dates(spark):
    raw = spark.createDataFrame([(1, dt.datetime(1990, 3, 5, 1))], ["matricula", "data_nascimento"])
    row = conform_roster(raw).first()
    assert (row["matricula"], row["data_nascimento"]) == ("1", dt.date(1990, 3, 5))


def test_registry_files(spark, tmp_path):
    lines = [
        '"11111111";"2";"JOÃO ""D\'ÁVILA"" ; NUNEZ";"***982247**";"49";"20200110";"";"";"";"";"5"',
        "",
        '"22222222";"1"',
        '"33333333";"2";"ANA";"***982247**";"49";"20200110";"";"";"";"";"5";"too";"long"',
    ]
    (tmp_path / "Socios1.csv").write_bytes("\n".join(lines).encode("latin-1"))
    (tmp_path / "Empresas1.csv").write_text('"44444444";"X"')
    rows = {r["cnpj_basico"]: r for r in read_registry(spark, "partners", str(tmp_path)).collect()}
    assert set(rows) == {"11111111", "22222222", "33333333"}
    assert rows["11111111"]["nome_socio"] == "JOÃO \"D'ÁVILA\" ; NUNEZ"
    assert rows["22222222"]["faixa_etaria"] is None
    assert rows["33333333"]["faixa_etaria"] == "5"
    padded = read_registry(spark, "partners", str(tmp_path), pad_with="").where("cnpj_basico = '22222222'").first()
    assert padded["faixa_etaria"] == ""
    targets = spark.createDataFrame([("33333333",), ("33333333",), ("9",)], ["cnpj_basico"])
    assert [r["nome_socio"] for r in read_registry(spark, "partners", str(tmp_path), targets).collect()] == ["ANA"]
    unquoted = read_registry(spark, "companies", str(tmp_path), quote="").first()
    assert unquoted["cnpj_basico"] == '"44444444"'
    empty = read_registry(spark, "partners", [])
    assert empty.columns == list(PARTNER_COLUMNS) and empty.count() == 0


def test_read_table_prunes(spark, tmp_path):
    spark.range(3).withColumn("a", F.lit(1)).write.parquet(str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t"), ["a"], optional=["id", "zzz"]).columns == ["a", "id"]


def test_prefixes():
    assert parse_prefixes("Socios; Empresas,") == ("socios", "empresas")
    assert parse_prefixes(["Socios;X", "", None]) == ("socios", "x")
    for nothing in (None, "", " ; ", "todos", "Socios;ALL", "*"):
        assert parse_prefixes(nothing) is None


@pytest.fixture
def manifest(spark):
    rows = [("2024-09", f"Socios{i}.zip", i) for i in (0, 1, 2, 10)]
    rows += [("2024-10", "Empresas0.zip", 5), ("2024-10", "socios007.zip", 0), ("tmp", "Socios9.zip", 1)]
    return spark.createDataFrame(rows, "month string, name string, size bigint")


def test_manifest(spark, manifest):
    def names(frame):
        return [r["name"] for r in frame.collect()]

    assert sorted(names(choose_snapshot(manifest))) == ["Empresas0.zip", "socios007.zip"]
    assert names(choose_snapshot(manifest, "2023-01")) == []
    with pytest.raises(ValueError, match="2023-01"):
        choose_snapshot(manifest, "2023-01", strict=True)
    september = choose_snapshot(manifest, "2024-09", strict=True)
    assert names(first_files(september, 3)) == ["Socios0.zip", "Socios1.zip", "Socios2.zip"]
    assert names(first_files(september, -1))[-1] == "Socios10.zip"
    assert names(first_files(september, 0)) == []
    assert sorted(names(select_prefixes(manifest, "SOC"))) == sorted(n for n in names(manifest) if n.lower().startswith("soc"))
    assert select_prefixes(manifest, "todos").count() == 7
    assert names(pending_files(september, september.where("name <> 'Socios1.zip'"))) == ["Socios0.zip", "Socios1.zip"]


def test_links(spark):
    html = """<a href="2024-10/">x</a> <a href='2024-09/'>y</a> <a href="2024-09/">y</a> <a href="x/2024-01/">
    <a href="Socios10.zip"><a href="Socios2.zip"><a href='Socios2.zip'><a href="a.txt">"""
    pages = spark.createDataFrame([(html,), (html,)], ["html"])
    assert [r["link"] for r in month_links(pages).collect()] == ["2024-09", "2024-10"]
    assert [r["link"] for r in zip_links(pages).collect()] == ["Socios2.zip", "Socios10.zip"]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "<18"), (2, "65+"), (3, None), (4, "a/b")], "id int, faixa_etaria string")
    assert write_gold(rows, str(tmp_path)) == 4
    split = tmp_path / "egressos_por_faixa_etaria"
    assert len([p for p in split.iterdir() if p.name.startswith("faixa_etaria=")]) == 4
    back = spark.read.schema(rows.schema).parquet(str(split)).select("id", "faixa_etaria")
    assert sorted(back.collect()) == sorted(rows.collect())
    write_lineage(rows, "salt", "2024-09", 3, str(tmp_path / "meta"))
    (meta,) = [json.loads(p.read_text()) for p in (tmp_path / "meta").glob("part-*.json") if p.stat().st_size]
    assert meta["rows"] == 4 and meta["source_month"] == "2024-09" and len(meta["cpf_salt_sha256"]) == 64
    with pytest.raises(ValueError):
        write_annotated(rows, str(tmp_path / "x"), str(tmp_path / "x") + "/")
    assert write_table(rows.where("id > 9"), str(tmp_path / "none")) == 0


def test_take_new_files(spark, tmp_path):
    landing, bronze, checkpoint = (str(tmp_path / name) for name in ("landing", "bronze", "checkpoint"))
    schema = spark.range(1).schema
    counts = []
    for batch in (spark.range(2), None, spark.range(2, 3)):
        if batch is not None:
            batch.coalesce(1).write.mode("append").parquet(landing)
        counts.append(take_new_files(spark, landing, schema, bronze, checkpoint).count())
    assert counts == [2, 2, 3]


def _landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "socios1.CSV").write_bytes('" 1 ";"2";"ANA"\n"2";"2";"BIA\nLIMA"\n'.encode("latin-1"))
    (folder / "SOCIOS2.csv").write_bytes('"3";"2";"ÉVA"\n'.encode("latin-1"))
    (folder / "Empresas1.csv").write_bytes(b'"9";"X"\n')
    (folder / "Socios3.csv").write_bytes(b"")
    return str(folder)


def test_registry_files_in_any_case_and_torn_lines(spark, tmp_path):
    folder = _landing(tmp_path)
    rows = read_registry(spark, "partners", folder)
    assert {row["cnpj_basico"] for row in rows.collect()} >= {" 1 ", "2", "3"}
    report = {row["file"]: (row["lines"], row["torn"]) for row in torn_lines(spark, "partners", folder).collect()}
    assert report == {"socios1.CSV": (3, 2), "SOCIOS2.csv": (1, 0)}
    whole = read_registry(spark, "partners", folder, multi_line=True)
    assert sorted(row[2] for row in whole.collect()) == ["ANA", "BIA\nLIMA", "ÉVA"]
    files = {row["file"]: (row["n_rows"], row["read"]) for row in file_report(spark, "partners", folder, whole).collect()}
    assert files == {"socios1.CSV": (2, True), "SOCIOS2.csv": (1, True)}


def test_target_keys_are_trimmed(spark, tmp_path):
    targets = spark.createDataFrame([("1",)], "cnpj_basico string")
    rows = read_registry(spark, "partners", _landing(tmp_path), targets).collect()
    assert [row["cnpj_basico"] for row in rows] == ["1"]


def test_selected_files_reach_the_reader(spark, tmp_path):
    for month, name, key in (("2024-08", "Socios0.csv", "0"), ("2024-09", "Socios10.csv", "10"), ("2024-09", "socios2.csv", "2"), ("2024-09", "Empresas1.csv", "e")):
        (tmp_path / month).mkdir(exist_ok=True)
        (tmp_path / month / name).write_text(f'"{key}";"2";"ANA"\n')
    manifest = spark.createDataFrame(
        [(m.name, f.name, 1) for m in tmp_path.iterdir() for f in m.iterdir()], "month string, name string, size int"
    )
    rows, selection = read_selected(spark, manifest, str(tmp_path), "partners", max_files=1)
    assert [row["cnpj_basico"] for row in rows.collect()] == ["2"]
    assert (selection.month, selection.files, selection.max_files) == ("2024-09", ("socios2.csv",), 1)
    rows, selection = read_selected(spark, manifest, str(tmp_path), "partners", month="2024-08")
    assert ([row["cnpj_basico"] for row in rows.collect()], selection.files) == (["0"], ("Socios0.csv",))
    rows, selection = read_selected(spark, manifest, str(tmp_path), "partners", prefixes="nothing")
    assert (rows.count(), selection.files) == (0, ())


@pytest.fixture(scope="module")
def broken(tmp_path_factory):
    """Files whose values hold line breaks, quotes and separators; the rows in them."""
    folder = tmp_path_factory.mktemp("broken")
    rng = random.Random(1)
    parts = ["a", "É", "\n", "\r\n", '"', ";", " ", "name", "\n\n"]
    rows = []
    for file in range(3):
        own = [[str(i), "2", "".join(rng.choice(parts) for _ in range(rng.randrange(30))), *"12345678"] for i in range(700)]
        rows += own
        with open(folder / f"Socios{file}.csv", "w", encoding="latin-1", newline="") as out:
            csv.writer(out, delimiter=";", quoting=csv.QUOTE_ALL, lineterminator="\r\n" if file else "\n").writerows(own)
    return str(folder), sorted(map(tuple, rows))


@pytest.mark.parametrize("range_bytes", ["128m", "20k", "700"])
def test_records_are_the_same_in_one_range_and_in_many(spark, broken, range_bytes):
    folder, wanted = broken
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", range_bytes)
    try:
        rows = read_registry(spark, "partners", folder, whole_records=True, pad_with="")
        assert sorted(map(tuple, rows.collect())) == wanted
        assert read_records(spark, folder).count() == len(wanted)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_at_the_end_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'"1";"x"\n\n"2";"open\nto the end')
    (tmp_path / "b.csv").write_bytes(b'"3"\r\n   \n4')
    (tmp_path / "c.csv").write_bytes(b"")
    assert sorted(bytes(r["value"]) for r in read_records(spark, str(tmp_path)).collect()) == [b'"1";"x"', b'"2";"open\nto the end', b'"3"', b"4"]


def test_a_quote_left_open_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'"1";"x\n' + b'"2";"y"\n' * 100)
    with pytest.raises(Exception, match="stays open too long"):
        read_records(spark, str(tmp_path), longest=100).collect()


def test_blank_keys_are_kept_beside_targets(spark, tmp_path):
    (tmp_path / "Socios1.csv").write_text('"1";"2";"ANA"\n"  ";"2";"BIA"\n"9";"2";"EVA"\n"";"2";"LIA"\n')
    targets = spark.createDataFrame([("1",), ("1",), ("",), (None,)], "cnpj_basico string")
    for whole_records in (False, True):
        rows = read_registry(spark, "partners", str(tmp_path), targets, pad_with="", whole_records=whole_records, blank_keys=True)
        assert sorted((r[0], r[2]) for r in rows.collect()) == [("", "BIA"), ("", "LIA"), ("1", "ANA")]


def test_registry_files_are_named_and_listed(spark, tmp_path):
    rows = spark.createDataFrame([("1", "x\ny", None), ("2", '"', "")], "a string, b string, c string").repartition(2)
    count = write_registry_files(rows, str(tmp_path / "2024-09"), "Empresas")
    listed = list_files(spark, str(tmp_path)).where("name LIKE '%.csv'").collect()
    assert sorted((r["month"], r["name"]) for r in listed) == [("2024-09", f"Empresas{i}.csv") for i in range(count)]
    assert sorted((r[0], r[1]) for r in read_registry(spark, "companies", str(tmp_path / "2024-09"), whole_records=True).collect()) == [("1", "x\ny"), ("2", '"')]
