"""Queries over name similarity, partner links and founders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculo.catalogue.derived import LINE_KEY, PARTNERS_SQL, PEOPLE_SQL, people, raw_partners
from vinculo.catalogue.entries import Entries, Tables
from vinculo.functions import parse_registry_date, with_token_set_ratio
from vinculo.operators import match_names, nest, within_days
from vinculo.operators.nesting import attach_lists
from vinculo.session import spread

ENTRIES = Entries()


def parts_sql(left: str, right: str, source: str, keep: str) -> str:
    """CTEs ``words`` and ``parts``: shared length and remainders of two names of ``source``."""
    return f"""
words AS (
  SELECT {keep}, list_sort(list_distinct(string_split({left}, ' '))) AS tx,
         list_sort(list_distinct(string_split({right}, ' '))) AS ty
  FROM {source}
),
parts AS (
  SELECT {keep}, a, b, length(a) AS la, length(b) AS lb, s, CASE WHEN s > 0 THEN 1 ELSE 0 END AS g
  FROM (
    SELECT {keep}, array_to_string(list_filter(tx, lambda w: NOT list_contains(ty, w)), ' ') AS a,
           array_to_string(list_filter(ty, lambda w: NOT list_contains(tx, w)), ' ') AS b,
           length(array_to_string(list_filter(tx, lambda w: list_contains(ty, w)), ' ')) AS s
    FROM words)
)"""


def lcs_sql(source: str, keep: str) -> str:
    """CTE ``measured``: adds the common subsequence length of ``a`` and ``b`` (up to 62 characters)."""
    return f"""
masked AS (
  SELECT {keep}, a, la, lb, s, g, (1::BIGINT << la) - 1 AS full_mask,
         list_transform(string_split(b, ''), lambda c: CAST(list_sum(list_transform(string_split(a, ''),
           lambda d, i: CASE WHEN d = c AND d <> '' THEN 1::BIGINT << (i - 1) ELSE 0::BIGINT END)) AS BIGINT)) AS masks
  FROM {source}
),
measured AS (
  SELECT {keep}, la, lb, s, g,
         CASE WHEN la = 0 OR lb = 0 THEN 0 ELSE la - bit_count(list_reduce(masks,
           lambda v, m: ((v + (v & m)) | (v - (v & m))) & full_mask, full_mask)) END AS lcs
  FROM masked
)"""


NAMES_SQL = """
roster_names AS (
  SELECT DISTINCT fragment, upper(p_name) || ' ' || p_type || ' DE ' || c_mktsegment AS nome_norm FROM people
),
partner_names AS (
  SELECT DISTINCT doc_digits AS fragment, nome AS nome_socio FROM raw_partners
  WHERE identificador = '2' AND length(doc_digits) >= 6
)"""


def similar_sql(threshold: int = 90) -> str:
    """CTE ``alike``: name pairs of a fragment reaching the threshold, out of CTE ``named_pairs``."""
    slack = 100 - threshold
    keep = "fragment, nome_norm, nome_socio"
    close = f"100 * (la + lb - 2 * lcs) <= {slack} * (2 * s + 2 * g + la + lb)"
    undecided = f"""
undecided AS (
  SELECT * FROM parts
  WHERE NOT (s > 0 AND (la = 0 OR lb = 0)) AND levenshtein(a, b) * 100 <= {slack} * (2 * s + 2 * g + la + lb)
    AND NOT (s > 0 AND (100 * (1 + la) <= {slack} * (2 * s + 1 + la) OR 100 * (1 + lb) <= {slack} * (2 * s + 1 + lb)))
)"""
    return f"""
named_pairs AS (SELECT fragment, nome_norm, nome_socio FROM roster_names JOIN partner_names USING (fragment)),
{parts_sql("nome_norm", "nome_socio", "named_pairs", keep)},
{undecided},
{lcs_sql("undecided", keep)},
alike AS (
  SELECT {keep} FROM parts
  WHERE s > 0 AND (la = 0 OR lb = 0 OR 100 * (1 + la) <= {slack} * (2 * s + 1 + la)
                   OR 100 * (1 + lb) <= {slack} * (2 * s + 1 + lb))
  UNION ALL
  SELECT {keep} FROM measured WHERE {close}
)"""


def _named_people(tables: Tables) -> DataFrame:
    name = F.concat(F.upper("p_name"), F.lit(" "), "p_type", F.lit(" DE "), "c_mktsegment")
    return people(tables).select("c_custkey", "fragment", name.alias("nome_norm"))


def _partner_names(tables: Tables) -> DataFrame:
    digits = F.regexp_replace("cpf_cnpj_socio", "[^0-9]", "")
    natural = raw_partners(tables).where((F.col("identificador_socio") == "2") & (F.length(digits) >= 6))
    return natural.select(digits.alias("fragment"), F.col("nome_socio"))


_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@ENTRIES.query(
    f"""
    WITH {PEOPLE_SQL},
    compared AS (
      SELECT {_KEYS}, upper(p.p_name) || ' ' || p.p_type || ' DE ' || c_mktsegment AS x,
             upper(other.p_name) || ' ' || c_mktsegment || ' FILHO' AS y
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN people p ON o_custkey = c_custkey
      JOIN part other ON other.p_partkey = l_partkey),
    {parts_sql("x", "y", "compared", _KEYS)},
    {lcs_sql("parts", _KEYS)}
    SELECT {_KEYS}, round(CASE WHEN s > 0 AND (la = 0 OR lb = 0) THEN 100.0
      ELSE greatest(100 - 100.0 * (la + lb - 2 * lcs) / (2 * s + 2 * g + la + lb),
                    CASE WHEN s > 0 THEN 100 - 100.0 * (1 + la) / (2 * s + 1 + la) ELSE 0 END,
                    CASE WHEN s > 0 THEN 100 - 100.0 * (1 + lb) / (2 * s + 1 + lb) ELSE 0 END) END, 6) AS score
    FROM measured
    """
)
def name_scores(tables: Tables) -> DataFrame:
    """Token-set ratio of two names per line item, LCS included."""
    others = tables.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("other_name"))
    owners = tables.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    owned = tables.lineitem.join(owners.hint("merge"), "l_orderkey").join(_named_people(tables).hint("merge"), "c_custkey")
    rows = owned.join(others.hint("merge"), "l_partkey")
    rows = spread(rows, tables.lineitem, *LINE_KEY)
    segment = F.regexp_extract("nome_norm", r"(\S+)$", 1)
    other = F.concat(F.upper("other_name"), F.lit(" "), segment, F.lit(" FILHO"))
    scored = with_token_set_ratio(rows, F.col("nome_norm"), other, "score")
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("score", 6).alias("score"))


def _similar_query(threshold: int) -> str:
    return f"WITH {PEOPLE_SQL}, {PARTNERS_SQL}, {NAMES_SQL}, {similar_sql(threshold)} SELECT * FROM alike"


@ENTRIES.query(_similar_query(90))
def similar_names(tables: Tables) -> DataFrame:
    """Names of one fragment whose ratio reaches 90."""
    return match_names(_named_people(tables), _partner_names(tables), "fragment", "nome_norm", "nome_socio")


@ENTRIES.query(_similar_query(70))
def similar_names_at_70(tables: Tables) -> DataFrame:
    """The same at a lower threshold, where far more pairs are left to their common subsequences."""
    return match_names(_named_people(tables), _partner_names(tables), "fragment", "nome_norm", "nome_socio", threshold=70)


@ENTRIES.query(_similar_query(90))
def similar_names_by_signature(tables: Tables) -> DataFrame:
    """J2 with every block treated as crowded: names meet over shared signatures only."""
    return match_names(
        _named_people(tables), _partner_names(tables), "fragment", "nome_norm", "nome_socio", max_block_pairs=0
    )


_ASSOCIATIONS_SQL = """
associations AS (
  SELECT o_custkey, l_partkey % 40 AS company, CAST(l_shipdate AS DATE) AS day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def _associations(tables: Tables) -> DataFrame:
    owners = tables.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return tables.lineitem.join(owners.hint("merge"), "l_orderkey").select(
        "o_custkey", (F.col("l_partkey") % 40).alias("company"), F.col("l_shipdate").cast("date").alias("day")
    )


@ENTRIES.query(
    f"""
    WITH {_ASSOCIATIONS_SQL},
    dated AS (SELECT o_custkey, company, string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) AS days
              FROM associations GROUP BY ALL),
    listed AS (SELECT o_custkey, string_agg(company || ':' || days, ';' ORDER BY company) AS companies
               FROM dated GROUP BY o_custkey)
    SELECT c_custkey, coalesce(companies, '') AS companies
    FROM customer LEFT JOIN listed ON c_custkey = o_custkey
    """
)
def association_lists(tables: Tables) -> DataFrame:
    """Sorted dates per person and company, nested once more per person."""
    dates = nest(_associations(tables), ["o_custkey", "company"], F.col("day"), "days")
    listed = nest(dates.table, ["o_custkey"], F.struct("company", "days"), "companies")
    rows = attach_lists(tables.customer.select(F.col("c_custkey").alias("o_custkey")), [listed])
    text = F.transform(
        "companies", lambda item: F.concat(item["company"], F.lit(":"), F.array_join(item["days"].cast("array<string>"), ","))
    )
    return rows.select(F.col("o_custkey").alias("c_custkey"), F.coalesce(F.array_join(text, ";"), F.lit("")).alias("companies"))


@ENTRIES.query(
    """
    SELECT o_custkey, min(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END) AS first_day, count(*) AS n
    FROM orders GROUP BY o_custkey
    """
)
def first_associations(tables: Tables) -> DataFrame:
    """Dates parsed inside a list, their minimum without nulls, the list length."""
    text = F.when(F.col("o_orderstatus") == "P", "00000000").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    lists = nest(tables.orders, ["o_custkey"], text, "days", total_into="n").table
    first = F.array_min(F.transform("days", parse_registry_date))
    return lists.groupBy("o_custkey").agg(F.min(first).alias("first_day"), F.first("n").alias("n"))


@ENTRIES.query(
    """
    SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS company, CAST(o_orderdate AS DATE) AS day
    FROM orders WHERE o_orderstatus <> 'P'
    """
)
def parallel_lists_unpacked(tables: Tables) -> DataFrame:
    """Two parallel lists turned back into rows, incomplete pairs left out."""
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date").cast("string"))
    pair = F.struct(F.col("o_orderkey").cast("string").alias("company"), day.alias("day"))
    lists = nest(tables.orders, ["o_custkey"], pair, "pairs").table
    parallel = lists.select(
        "o_custkey",
        F.transform("pairs", lambda item: item["company"]).alias("companies"),
        F.transform("pairs", lambda item: item["day"]).alias("days"),
    )
    rows = parallel.select("o_custkey", F.inline(F.arrays_zip("companies", "days")).alias("company", "day"))
    return rows.where(F.col("day").isNotNull()).withColumn("day", F.col("day").cast("date"))


def _founders_sql(days: int) -> str:
    return f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(abs(date_diff('day', o_orderdate, l_shipdate)) AS INT) AS gap
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE abs(date_diff('day', o_orderdate, l_shipdate)) <= {days}
    """


def _founder_rows(tables: Tables, days: int) -> DataFrame:
    joined = tables.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("joined")
    )
    starts = tables.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("started")
    )
    return within_days(joined, starts, "l_orderkey", "joined", "started", days, gap="gap").drop("joined", "started")


@ENTRIES.query(_founders_sql(31))
def founders_within_31_days(tables: Tables) -> DataFrame:
    """Associations at most 31 days from the start."""
    return _founder_rows(tables, 31)


@ENTRIES.query(_founders_sql(7))
def founders_within_7_days(tables: Tables) -> DataFrame:
    """Associations at most 7 days from the start."""
    return _founder_rows(tables, 7)


@ENTRIES.query(
    """
    WITH relations AS (
      SELECT o_custkey, o_orderkey, abs(date_diff('day', o_orderdate, l_shipdate)) AS gap, CAST(l_shipdate AS DATE) AS day
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE abs(date_diff('day', o_orderdate, l_shipdate)) <= 7),
    listed AS (
      SELECT o_custkey, string_agg(o_orderkey || ':' || CAST(day AS VARCHAR) || ':' || gap, ';' ORDER BY o_orderkey, day, gap) AS r
      FROM relations GROUP BY o_custkey)
    SELECT c_custkey, coalesce(r, '') AS relations, r IS NOT NULL AS socio_fundador
    FROM customer LEFT JOIN listed ON c_custkey = o_custkey
    """
)
def founder_window(tables: Tables) -> DataFrame:
    """Founder relations of each person, defaults for the others."""
    joined = tables.lineitem.select(
        F.col("l_orderkey").alias("company"), F.col("l_shipdate").cast("date").alias("joined")
    )
    starts = tables.orders.select(
        F.col("o_orderkey").alias("company"),
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderdate").cast("date").alias("started"),
    )
    relations = within_days(joined, starts, "company", "joined", "started", 7, gap="gap")
    lists = nest(relations, ["c_custkey"], F.struct("company", "joined", "gap"), "relations")
    rows = attach_lists(tables.customer.select("c_custkey"), [lists])
    text = F.transform(
        "relations",
        lambda item: F.concat_ws(":", *[item[part].cast("string") for part in ("company", "joined", "gap")]),
    )
    return rows.select(
        "c_custkey",
        F.coalesce(F.array_join(text, ";"), F.lit("")).alias("relations"),
        F.col("relations").isNotNull().alias("socio_fundador"),
    )
