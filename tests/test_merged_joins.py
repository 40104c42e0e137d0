"""Tables that grow with the data are merged: their compressed files, or few rows here, say nothing about their size."""

import datetime

import pytest

from vinculo.catalogue.derived import people, raw_partners, raw_roster
from vinculo.catalogue.entries import Tables
from vinculo.catalogue.linking import _associations, name_scores
from vinculo.operators import nest, within_days
from vinculo.operators.nesting import attach_lists
from vinculo.operators.tiling import tiled_join
from vinculo.plans.companies import build_companies
from vinculo.plans.links import PartnerLinks, numbered, with_flags, with_window_flags
from vinculo.schemas import COMPANY_COLUMNS, ESTABLISHMENT_COLUMNS, TAX_REGIME_COLUMNS
from vinculo.session import staged

DAY = datetime.datetime(2020, 1, 1)


def broadcast_joins(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan
    return [line for line in plan.splitlines() if "BroadcastHashJoin" in line]


def stored(spark, rows, schema):
    return staged(spark.createDataFrame(rows, schema))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("merged")
    rows = {
        "customer": ([(1, 10.0, "BUILDING")], "c_custkey bigint, c_acctbal double, c_mktsegment string"),
        "part": ([(1, "red bolt", "SMALL")], "p_partkey bigint, p_name string, p_type string"),
        "orders": (
            [(7, 1, "F", 12.5, DAY, "5-LOW")],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (
            [(7, 1, 1, 1, 2.0, "N", "O", DAY)],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string, "
            "l_linestatus string, l_shipdate timestamp",
        ),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return Tables(spark, str(folder))


@pytest.mark.parametrize("derive", [people, raw_roster, raw_partners, _associations, name_scores])
def test_derived_tables_are_merged(tables, derive):
    frame = derive(tables)
    assert broadcast_joins(frame) == []
    assert frame.count() == 1


def test_lists_windows_and_tiles_are_merged(spark):
    left = stored(spark, [("a", 1), ("b", 2)], "key string, x int")
    assert broadcast_joins(attach_lists(left, [nest(left, ["key"], left["x"], "xs")])) == []
    events = stored(spark, [("a", DAY.date())], "key string, day date")
    assert broadcast_joins(within_days(events, events.withColumnRenamed("day", "start"), "key", "day", "start", 3)) == []
    # only the tiles of crowded keys, a row per thousands of theirs, may be broadcast
    other = left.withColumnRenamed("x", "y")
    assert all("LeftOuter" in line for line in broadcast_joins(tiled_join(left, other, ["key"])))


def test_facts_of_names_and_persons_are_merged(spark):
    roster = numbered(stored(spark, [("p", "123456", "ANA")], "id_pessoa string, cpf_fragment string, nome_norm string"))
    matches = stored(spark, 
        [("123456", "ANA", "1", "20200101", "ANA")],
        "cpf_fragment string, nome_norm string, cnpj_basico string, data_associacao string, nome_socio string",
    )
    flagged = with_flags(roster, PartnerLinks(roster.select("cpf_fragment"), matches, matches))
    assert all("nome_norm" not in line for line in broadcast_joins(flagged))  # fragments alone may be broadcast
    relations = stored(spark, [("p", 3)], "id_pessoa string, diferenca_dias int")
    rows = stored(spark, [("p",)], "_pessoa string")
    assert broadcast_joins(with_window_flags(rows, relations, {"fundador": 31})) == []


@pytest.mark.parametrize("lists", [True, False])
def test_profiles_are_merged(spark, lists):
    raw = [stored(spark, [("1",) + ("2",) * (len(names) - 1)], list(names)) for names in (COMPANY_COLUMNS, TAX_REGIME_COLUMNS, ESTABLISHMENT_COLUMNS)]
    profiles = build_companies(raw[0].select("cnpj_basico"), *raw, lists=lists)
    assert broadcast_joins(profiles) == []
    assert profiles.count() == 1
