"""Queries over single-row expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculo import functions as V
from vinculo.catalogue.derived import AS_OF, PEOPLE_SQL, SALT, people
from vinculo.catalogue.entries import Entries, Tables
from vinculo.operators import add_missing, keep_present
from vinculo.schemas import DATE_LIST, TEXT_LIST
from vinculo.session import spread
from vinculo.sinks.writers import lineage

ENTRIES = Entries()


def _hmac_sql(value: str, salt: str = SALT) -> str:
    key = salt.encode().ljust(64, b"\0")
    inner, outer = (bytes(b ^ mask for b in key).hex() for mask in (0x36, 0x5C))
    return (
        f"CASE WHEN trim({value}) = '' THEN '' ELSE sha256(unhex('{outer}') || "
        f"unhex(sha256(unhex('{inner}') || encode(trim({value}))))) END"
    )


@ENTRIES.query(
    """
    SELECT doc_id, upper(trim(regexp_replace(strip_accents(replace(text, 'ß', 'ss')), '\\s+', ' ', 'g'))) AS nome_norm
    FROM documents
    """
)
def normalized_text(tables: Tables) -> DataFrame:
    """P1 over whole document texts in four languages."""
    return spread(tables.documents, tables.documents, "doc_id").select("doc_id", V.normalize_name(F.col("text")).alias("nome_norm"))


@ENTRIES.query("SELECT doc_id, regexp_replace(text, '[^0-9]', '', 'g') AS digits FROM documents")
def text_digits(tables: Tables) -> DataFrame:
    """P2 over whole document texts."""
    return spread(tables.documents, tables.documents, "doc_id").select("doc_id", V.digits_only(F.col("text")).alias("digits"))


@ENTRIES.query(
    """
    WITH docs AS (
      SELECT o_orderkey, substr(lpad(CAST(o_orderkey * 7919 AS VARCHAR), 14, '0'), 1 + o_orderkey % 10) AS doc
      FROM orders)
    SELECT o_orderkey, doc, CASE WHEN length(doc) >= 11 THEN substr(doc, 4, 6) ELSE '' END AS roster_fragment,
           CASE WHEN length(doc) >= 11 THEN substr(doc, 4, 6) WHEN length(doc) >= 6 THEN right(doc, 6) ELSE '' END
             AS registry_fragment
    FROM docs
    """
)
def document_fragments(tables: Tables) -> DataFrame:
    """P4 and P5 on documents of 5 to 14 digits."""
    number = F.lpad((F.col("o_orderkey") * 7919).cast("string"), 14, "0")
    start = (F.col("o_orderkey") % 10 + 1).cast("int")
    docs = tables.orders.select("o_orderkey", F.substring(number, start, F.lit(14)).alias("doc"))
    return docs.select(
        "o_orderkey",
        "doc",
        V.roster_fragment(F.col("doc")).alias("roster_fragment"),
        V.registry_fragment(F.col("doc")).alias("registry_fragment"),
    )


@ENTRIES.query(
    f"""
    WITH {PEOPLE_SQL},
    digits AS (SELECT c_custkey, regexp_replace(cpf, '[^0-9]', '', 'g') AS d FROM people)
    SELECT c_custkey, CASE WHEN d IS NULL THEN NULL
      WHEN d <> repeat(substr(d, 1, 1), 11)
       AND list_sum(list_transform(range(1, 10), lambda i: CAST(substr(d, i, 1) AS INT) * (11 - i))) * 10 % 11 % 10
           = CAST(substr(d, 10, 1) AS INT)
       AND list_sum(list_transform(range(1, 11), lambda i: CAST(substr(d, i, 1) AS INT) * (12 - i))) * 10 % 11 % 10
           = CAST(substr(d, 11, 1) AS INT)
      THEN d ELSE '' END AS cpf_limpo
    FROM digits
    """
)
def checked_documents(tables: Tables) -> DataFrame:
    """P3 on formatted documents, some with wrong check digits, some null."""
    return people(tables).select("c_custkey", V.clean_cpf(F.col("cpf")).alias("cpf_limpo"))


@ENTRIES.query(
    f"""
    WITH named AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '  ' ELSE ' ' || c_name END AS v FROM customer)
    SELECT c_custkey, {_hmac_sql('v')} AS id_pessoa FROM named
    """
)
def pseudonyms(tables: Tables) -> DataFrame:
    """Keyed hash of a padded name, empty for blank ones."""
    value = F.when(F.col("c_acctbal") < 0, "  ").otherwise(F.concat(F.lit(" "), "c_name"))
    return tables.customer.select("c_custkey", V.keyed_hash(value, SALT).alias("id_pessoa"))


@ENTRIES.query(
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 3 THEN CAST(o_orderdate AS DATE) END AS parsed,
           CASE WHEN o_orderkey % 5 IN (0, 2) THEN CAST(o_orderdate AS DATE) END AS cast_date
    FROM orders
    """
)
def registry_dates(tables: Tables) -> DataFrame:
    """P7 and P8 on ISO, compact and invalid dates."""
    day, form = F.col("o_orderdate"), F.col("o_orderkey") % 5
    text = (
        F.when(form.isin(0, 2), F.date_format(day, "yyyy-MM-dd"))
        .when(form == 1, F.date_format(day, "yyyyMMdd"))
        .when(form == 3, F.lit("00000000"))
        .otherwise(F.date_format(day, "dd/MM/yyyy"))
    )
    written = tables.orders.select("o_orderkey", text.alias("written"))
    compact = F.col("written").rlike("^[0-9]{8}$")
    return written.select(
        "o_orderkey",
        V.parse_registry_date(F.col("written")).alias("parsed"),
        V.safe_date(F.when(compact, F.concat(F.lit("x"), "written")).otherwise(F.col("written"))).alias("cast_date"),
    )


@ENTRIES.query(
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 4 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders
    """
)
def roster_dates(tables: Tables) -> DataFrame:
    """Day-first dates in four spellings, impossible and blank ones."""
    day, form = F.col("o_orderdate"), F.col("o_orderkey") % 6
    text = (
        F.when(form == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(form == 1, F.date_format(day, "dd-MM-yyyy"))
        .when(form == 2, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(form == 3, F.date_format(day, "yyyy-MM-dd"))
        .when(form == 4, F.lit("31/02/1990"))
        .otherwise(F.lit(" "))
    )
    return tables.orders.select("o_orderkey", V.parse_roster_date(text).alias("parsed"))


@ENTRIES.query(
    f"""
    WITH dated AS (
      SELECT o_orderkey, CASE WHEN o_custkey % 50 = 0 THEN NULL
               ELSE CAST(o_orderdate AS DATE) - CAST(o_custkey * 97 % 40000 AS INT) END AS born,
             CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS event
      FROM orders),
    aged AS (
      SELECT o_orderkey, date_sub('year', born, DATE '{AS_OF}') AS idade,
             date_sub('year', born, coalesce(event, DATE '{AS_OF}')) AS idade_evento
      FROM dated)
    SELECT o_orderkey, CAST(idade AS INT) AS idade, CAST(idade_evento AS INT) AS idade_evento,
      CASE WHEN idade IS NULL THEN NULL WHEN idade < 0 THEN 'IGNORADO' WHEN idade < 18 THEN '<18'
           WHEN idade < 25 THEN '18-24' WHEN idade < 35 THEN '25-34' WHEN idade < 45 THEN '35-44'
           WHEN idade < 55 THEN '45-54' WHEN idade < 65 THEN '55-64' WHEN idade < 200 THEN '65+'
           ELSE 'IGNORADO' END AS faixa_etaria
    FROM aged
    """
)
def ages(tables: Tables) -> DataFrame:
    """Ages at a fixed day and at an event, buckets."""
    day, today = F.col("o_orderdate").cast("date"), F.lit(AS_OF)
    born = F.when(F.col("o_custkey") % 50 != 0, F.date_sub(day, (F.col("o_custkey") * 97 % 40000).cast("int")))
    event = F.when(F.col("o_orderstatus") != "P", day)
    age = V.age_years(born, today)
    return tables.orders.select(
        "o_orderkey",
        age.alias("idade"),
        V.age_years(born, F.coalesce(event, today)).alias("idade_evento"),
        V.age_bucket(age).alias("faixa_etaria"),
    )


@ENTRIES.query(
    """
    SELECT o_orderkey, CAST(CASE WHEN o_orderstatus <> 'P' THEN
             (year(o_orderdate - to_days(CAST(o_custkey * 13 % 30000 AS INT))) // 10) * 10 END AS INT) AS decada
    FROM orders
    """
)
def decades(tables: Tables) -> DataFrame:
    """P12, null for a missing date."""
    day = F.date_sub(F.col("o_orderdate").cast("date"), (F.col("o_custkey") * 13 % 30000).cast("int"))
    return tables.orders.select(
        "o_orderkey", V.decade(F.when(F.col("o_orderstatus") != "P", day)).alias("decada")
    )


@ENTRIES.query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           lpad(CAST(l_orderkey AS VARCHAR), 8, '0') || lpad(CAST(l_linenumber AS VARCHAR), 4, '0')
             || CASE WHEN l_suppkey % 3 <> 0 THEN lpad(CAST(l_suppkey % 100 AS VARCHAR), 2, '0') END AS cnpj
    FROM lineitem
    """
)
def company_numbers(tables: Tables) -> DataFrame:
    """Null as soon as one part is null."""
    check = F.when(F.col("l_suppkey") % 3 != 0, F.lpad((F.col("l_suppkey") % 100).cast("string"), 2, "0"))
    root, order = F.lpad(F.col("l_orderkey").cast("string"), 8, "0"), F.lpad(F.col("l_linenumber").cast("string"), 4, "0")
    return tables.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", V.full_company_number(root, order, check).alias("cnpj")
    )


@ENTRIES.query(
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS ultimo_curso,
           false AS socio, 0 AS n_companies, 0 AS n_dates, CAST(NULL AS DATE) AS first_date
    FROM orders
    """
)
def typed_defaults(tables: Tables) -> DataFrame:
    """Blanks for nulls, typed empty lists and their sizes, padded columns."""
    course = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    padded = add_missing(
        tables.orders, {"companies": TEXT_LIST, "dates": DATE_LIST, "first_date": "date", "flag": "boolean"}
    )
    return padded.select(
        "o_orderkey",
        V.filled(course).alias("ultimo_curso"),
        F.coalesce("flag", F.lit(False)).alias("socio"),
        F.size(F.coalesce("companies", F.array().cast(TEXT_LIST))).alias("n_companies"),
        F.size(F.coalesce("dates", F.array().cast(DATE_LIST))).alias("n_dates"),
        "first_date",
    )


@ENTRIES.query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, c_nationkey FROM customer")
def projected_columns(tables: Tables) -> DataFrame:
    """An ordered list of columns, those which exist; keys as text."""
    keyed = tables.customer.withColumn("c_custkey", F.col("c_custkey").cast("string"))
    return keep_present(keyed, ["c_custkey", "c_cpf", "c_mktsegment", "c_nationkey", "c_parent"])


@ENTRIES.query(
    f"""
    SELECT '{hashlib.sha256(SALT.encode()).hexdigest()}' AS cpf_salt_sha256, '2024-09' AS source_month,
           -1 AS max_files, count(*) AS rows
    FROM orders
    """
)
def lineage_row(tables: Tables) -> DataFrame:
    """The lineage row of a table, with its row count."""
    return lineage(tables.orders, SALT, "2024-09", -1)
