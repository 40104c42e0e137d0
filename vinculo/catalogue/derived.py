"""Roster and registry tables derived from the given tables, in Spark and in SQL.

* A customer is a person. Their document holds the customer number, 211 fragments being shared by all;
  their name is made of the part with the same number and of their segment.
* An order is a degree of its customer (roster row) and also a company.
* A line item is a partner of its order's company, under a spelling of the customer's name that varies with
  the line number, and also an establishment of that company.

All tables grow together, and their files are much smaller than their rows in memory, so they are joined by merging:
by the size of its file Spark would broadcast a table of a million rows through the driver.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinculo.catalogue.entries import Tables
from vinculo.schemas import COMPANY_COLUMNS, ESTABLISHMENT_COLUMNS, PARTNER_COLUMNS, TAX_REGIME_COLUMNS
from vinculo.session import spread

SALT = "sal de teste"
AS_OF = datetime.date(2024, 1, 31)
FRAGMENTS = 211
LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _weighted(base: Column, first_weight: int) -> Column:
    """Sum of the nine digits of ``base``, weights counting down."""
    return sum((F.substring(base, i, 1).cast("int") * (first_weight + 1 - i) for i in range(1, 10)), F.lit(0))


def people(tables: Tables) -> DataFrame:
    """One row per customer: fragment, formatted document, name parts."""
    prefix = _padded(F.floor(F.col("c_custkey") / FRAGMENTS).cast("bigint") % 1000, 3)
    fragment = _padded(F.col("c_custkey") % FRAGMENTS, 6)
    parts = tables.part.select(F.col("p_partkey").alias("c_custkey"), "p_name", "p_type")
    based = tables.customer.hint("merge").join(parts, "c_custkey", "left").select(
        "c_custkey",
        "c_acctbal",
        "c_mktsegment",
        F.coalesce("p_name", F.lit("nobody")).alias("p_name"),
        F.coalesce("p_type", F.lit("NONE")).alias("p_type"),
        fragment.alias("fragment"),
        F.concat(prefix, fragment).alias("base"),
    )
    first = _weighted(F.col("base"), 10) * 10 % 11 % 10
    second = (_weighted(F.col("base"), 11) + first * 2) * 10 % 11 % 10
    checks = F.concat(first.cast("string"), second.cast("string"))
    digits = F.concat("base", F.when(F.col("c_acctbal") < 0, "00").otherwise(checks))
    formatted = F.regexp_replace(digits, r"^(\d{3})(\d{3})(\d{3})(\d{2})$", "$1.$2.$3-$4")
    return based.withColumn("cpf", F.when(F.col("c_acctbal") <= 9900, formatted))


PEOPLE_SQL = f"""
base_people AS (
  SELECT c_custkey, c_acctbal, c_mktsegment,
         coalesce(p_name, 'nobody') AS p_name, coalesce(p_type, 'NONE') AS p_type,
         lpad(CAST(c_custkey % {FRAGMENTS} AS VARCHAR), 6, '0') AS fragment,
         lpad(CAST((c_custkey // {FRAGMENTS}) % 1000 AS VARCHAR), 3, '0')
           || lpad(CAST(c_custkey % {FRAGMENTS} AS VARCHAR), 6, '0') AS base
  FROM customer LEFT JOIN part ON p_partkey = c_custkey
),
first_check AS (
  SELECT *, base || CAST((list_sum(list_transform(range(1, 10),
    lambda i: CAST(substr(base, i, 1) AS INT) * (11 - i))) * 10 % 11) % 10 AS VARCHAR) AS base10
  FROM base_people
),
second_check AS (
  SELECT *, base10 || CAST((list_sum(list_transform(range(1, 11),
    lambda i: CAST(substr(base10, i, 1) AS INT) * (12 - i))) * 10 % 11) % 10 AS VARCHAR) AS base11
  FROM first_check
),
people AS (
  SELECT c_custkey, c_acctbal, c_mktsegment, p_name, p_type, fragment,
         CASE WHEN c_acctbal <= 9900 THEN regexp_replace(
           CASE WHEN c_acctbal < 0 THEN base || '00' ELSE base11 END,
           '^(\\d{{3}})(\\d{{3}})(\\d{{3}})(\\d{{2}})$', '\\1.\\2.\\3-\\4') END AS cpf
  FROM second_check
)"""


def raw_roster(tables: Tables) -> DataFrame:
    """One row per order with headers and dates as roster files have them; ``nome_mae`` is missing."""
    born = F.date_add(F.lit(datetime.date(1930, 1, 1)), (F.col("c_custkey") * 37 % 29000).cast("int"))
    entered, finished = F.col("o_orderdate").cast("date"), F.date_add(F.col("o_orderdate").cast("date"), 1461)
    pattern_of = F.col("o_orderkey") % 3
    entered_text = (
        F.when(pattern_of == 0, F.date_format(entered, "dd/MM/yyyy"))
        .when(pattern_of == 1, F.date_format(entered, "yyyy-MM-dd"))
        .otherwise(F.concat(F.date_format(entered, "yyyy-MM-dd"), F.lit(" 00:00:00")))
    )
    name = F.concat(
        F.lit("  "),
        F.replace("p_name", F.lit("e"), F.lit("é")),
        F.lit("  "),
        F.lower("p_type"),
        F.lit(" de "),
        F.col("c_mktsegment"),
    )
    rows = tables.orders.hint("merge").join(people(tables).withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    rows = spread(rows.withColumn("c_custkey", F.col("o_custkey")), tables.orders, "o_orderkey")
    return rows.select(
        F.col("o_orderkey").cast("string").alias(" MatriculaDRE"),
        name.alias("Nome"),
        F.col("cpf").alias("CPF"),
        F.col("p_name").alias("Pai"),
        F.date_format(born, "dd/MM/yyyy").alias("Data Nascimento"),
        entered_text.alias("DataIngresso"),
        F.when(F.col("o_orderstatus") == "F", F.date_format(finished, "dd-MM-yyyy"))
        .when(F.col("o_orderstatus") == "O", F.lit("31/02/2001"))
        .alias("dataconclusao"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("curso"),
        F.col("o_orderstatus").alias("nivel"),
        F.substring("o_orderpriority", 1, 1).alias("Codigo"),
        F.lit("CONCLUIDO").alias("Situacao-Curso"),
    )


ROSTER_SQL = f"""{PEOPLE_SQL},
roster AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS matricula,
         '  ' || replace(p_name, 'e', 'é') || '  ' || lower(p_type) || ' de ' || c_mktsegment AS nome,
         upper(p_name) || ' ' || p_type || ' DE ' || c_mktsegment AS nome_norm,
         upper(p_name) AS nome_pai_norm,
         cpf, p_name AS nome_pai, fragment,
         DATE '1930-01-01' + CAST(c_custkey * 37 % 29000 AS INT) AS data_nascimento,
         CAST(o_orderdate AS DATE) AS data_ingresso,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 1461 END AS data_formacao,
         nullif(o_orderpriority, '5-LOW') AS curso,
         o_orderstatus AS nivel, substr(o_orderpriority, 1, 1) AS codigo_curso,
         'CONCLUIDO' AS situacao_curso,
         CASE WHEN c_acctbal > 9900 THEN NULL
              WHEN (c_acctbal < 0 AND base_ok = 0) OR repeated THEN ''
              ELSE regexp_replace(cpf, '[^0-9]', '', 'g') END AS cpf_limpo
  FROM orders JOIN (
    SELECT p.*, CASE WHEN base11 = base || '00' THEN 1 ELSE 0 END AS base_ok,
           replace(regexp_replace(p.cpf, '[^0-9]', '', 'g'), substr(p.cpf, 1, 1), '') = '' AS repeated
    FROM people p JOIN second_check s USING (c_custkey)
  ) ON o_custkey = c_custkey
)"""


def raw_partners(tables: Tables) -> DataFrame:
    """One registry partner row per line item."""
    owners = people(tables).select(
        F.col("c_custkey").alias("o_custkey"), "fragment", "p_name", "p_type", "c_mktsegment"
    )
    companies = tables.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    others = tables.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("other_name"))
    owned = companies.hint("merge").join(owners.hint("merge"), "o_custkey")  # before the lines, which then travel once less
    rows = tables.lineitem.join(others.hint("merge"), "l_partkey").join(owned.hint("merge"), "l_orderkey")
    rows = spread(rows, tables.lineitem, *LINE_KEY)
    line, space = F.col("l_linenumber"), F.lit(" ")
    kind = F.when(line == 7, "3").when(F.col("l_returnflag") == "A", "1").otherwise("2")
    shipped = F.col("l_shipdate").cast("date")
    values = {
        "cnpj_basico": F.when(F.col("l_quantity") == 1, "").otherwise(_padded(F.col("l_orderkey"), 8)),
        "identificador_socio": kind,
        "nome_socio": F.upper(
            F.when(line == 1, F.concat("c_mktsegment", space, "p_type", space, "p_name"))
            .when(line == 2, F.concat("p_name", space, "c_mktsegment"))
            .when(line == 3, F.concat(F.replace("p_name", F.lit("i"), F.lit("y")), space, "p_type", space, "c_mktsegment"))
            .when(line == 4, F.concat("p_name", F.lit(" de "), "c_mktsegment", F.lit(" filho")))
            .otherwise(F.concat("other_name", space, "p_type"))
        ),
        "cpf_cnpj_socio": F.when(kind == "1", _padded(F.col("l_suppkey"), 14))
        .when(kind == "2", F.concat(F.lit("***"), "fragment", F.lit("**")))
        .otherwise(""),
        "data_entrada_sociedade": F.when(F.col("l_quantity") == 50, "00000000")
        .when(F.col("l_linestatus") == "O", F.date_format(shipped, "yyyyMMdd"))
        .otherwise(F.date_format(shipped, "yyyy-MM-dd")),
    }
    return rows.select(*[values.get(name, F.lit(None).cast("string")).alias(name) for name in PARTNER_COLUMNS])


PARTNERS_SQL = """
raw_partners AS (
  SELECT CASE WHEN l_quantity = 1 THEN '' ELSE lpad(CAST(l_orderkey AS VARCHAR), 8, '0') END AS cnpj_basico,
         CASE WHEN l_linenumber = 7 THEN '3' WHEN l_returnflag = 'A' THEN '1' ELSE '2' END AS identificador,
         upper(CASE l_linenumber
           WHEN 1 THEN c_mktsegment || ' ' || p.p_type || ' ' || p.p_name
           WHEN 2 THEN p.p_name || ' ' || c_mktsegment
           WHEN 3 THEN replace(p.p_name, 'i', 'y') || ' ' || p.p_type || ' ' || c_mktsegment
           WHEN 4 THEN p.p_name || ' de ' || c_mktsegment || ' filho'
           ELSE other.p_name || ' ' || p.p_type END) AS nome,
         CASE WHEN l_linenumber = 7 THEN '' WHEN l_returnflag = 'A' THEN lpad(CAST(l_suppkey AS VARCHAR), 14, '0')
              ELSE fragment END AS doc_digits,
         CASE WHEN l_quantity = 50 THEN '00000000'
              WHEN l_linestatus = 'O' THEN strftime(l_shipdate, '%Y%m%d')
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS data_entrada_sociedade,
         CASE WHEN l_quantity <> 50 THEN CAST(l_shipdate AS DATE) END AS data_entrada
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN people p ON o_custkey = c_custkey
  JOIN part other ON other.p_partkey = l_partkey
)"""


def raw_companies(tables: Tables) -> DataFrame:
    """One registry company row per order."""
    values = {
        "cnpj_basico": _padded(F.col("o_orderkey"), 8),
        "razao_social": F.concat(F.lit("EMPRESA "), "o_orderpriority"),
        "natureza_juridica": F.col("o_orderstatus"),
        "capital_social": F.floor("o_totalprice").cast("string"),
        "porte_empresa": F.substring("o_orderpriority", 1, 1),
    }
    return tables.orders.select(
        *[values.get(name, F.lit(None).cast("string")).alias(name) for name in COMPANY_COLUMNS]
    )


def raw_tax_regime(tables: Tables) -> DataFrame:
    """One tax-regime row per order that is not pending."""
    values = {
        "cnpj_basico": _padded(F.col("o_orderkey"), 8),
        "optante_simples": F.when(F.col("o_orderstatus") == "F", "S").otherwise("N"),
        "data_opcao_simples": F.date_format("o_orderdate", "yyyyMMdd"),
        "optante_mei": F.lit("N"),
    }
    return tables.orders.where(F.col("o_orderstatus") != "P").select(
        *[values.get(name, F.lit(None).cast("string")).alias(name) for name in TAX_REGIME_COLUMNS]
    )


def raw_establishments(tables: Tables) -> DataFrame:
    """One registry establishment row per line item; line 1 is a head office."""
    started = F.date_add(F.col("l_shipdate").cast("date"), (F.col("l_partkey") % 15).cast("int"))
    values = {
        "cnpj_basico": _padded(F.col("l_orderkey"), 8),
        "cnpj_ordem": _padded(F.col("l_linenumber"), 4),
        "cnpj_dv": F.when(F.col("l_suppkey") % 10 != 0, _padded(F.col("l_suppkey") % 100, 2)),
        "identificador_matriz_filial": F.when(F.col("l_linenumber") == 1, "1").otherwise("2"),
        "nome_fantasia": F.col("l_returnflag"),
        "situacao_cadastral": F.lit("02"),
        "data_inicio_atividade": F.date_format(started, "yyyyMMdd"),
        "cnae_fiscal_principal": _padded(F.col("l_partkey"), 7),
        "uf": F.col("l_linestatus"),
    }
    return spread(tables.lineitem, tables.lineitem, *LINE_KEY).select(
        *[values.get(name, F.lit(None).cast("string")).alias(name) for name in ESTABLISHMENT_COLUMNS]
    )


REGISTRY_SQL = """
raw_companies AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS cnpj_basico, 'EMPRESA ' || o_orderpriority AS razao_social,
         o_orderstatus AS natureza_juridica, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS capital_social,
         substr(o_orderpriority, 1, 1) AS porte_empresa
  FROM orders
),
raw_tax AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS cnpj_basico,
         CASE WHEN o_orderstatus = 'F' THEN 'S' ELSE 'N' END AS optante_simples,
         strftime(o_orderdate, '%Y%m%d') AS data_opcao_simples, 'N' AS optante_mei
  FROM orders WHERE o_orderstatus <> 'P'
),
raw_establishments AS (
  SELECT lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS cnpj_basico,
         lpad(CAST(l_linenumber AS VARCHAR), 4, '0') AS cnpj_ordem,
         CASE WHEN l_suppkey % 10 <> 0 THEN lpad(CAST(l_suppkey % 100 AS VARCHAR), 2, '0') END AS cnpj_dv,
         CASE WHEN l_linenumber = 1 THEN '1' ELSE '2' END AS identificador,
         l_returnflag AS nome_fantasia, '02' AS situacao_cadastral,
         strftime(l_shipdate + to_days(CAST(l_partkey % 15 AS INT)), '%Y%m%d') AS data_inicio_atividade,
         lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS cnae_fiscal_principal, l_linestatus AS uf
  FROM lineitem
),
establishments AS (
  SELECT *, cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj,
         row_number() OVER (
           PARTITION BY cnpj_basico ORDER BY cnpj_ordem, cnpj_dv NULLS FIRST, identificador, nome_fantasia,
           data_inicio_atividade, cnae_fiscal_principal, uf) AS place
  FROM raw_establishments
)"""
