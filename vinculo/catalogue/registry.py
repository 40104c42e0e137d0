"""Queries over roster and registry sources, manifests, silver tables and company profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculo.catalogue.derived import (
    PARTNERS_SQL,
    PEOPLE_SQL,
    REGISTRY_SQL,
    ROSTER_SQL,
    SALT,
    raw_companies,
    raw_establishments,
    raw_partners,
    raw_roster,
    raw_tax_regime,
)
from vinculo.catalogue.entries import Entries, Tables
from vinculo.catalogue.scalars import _hmac_sql
from vinculo.operators import keep_keys, nest, one_per_key, target_keys
from vinculo.plans.companies import build_companies, establishment_rows, head_offices, nest_establishments
from vinculo.plans.increments import add_layer, current_rows, merge_layers, refreshed_names
from vinculo.plans.partners import build_partner_tables, companies_of_names, kept_by_fragment, partner_rows, resolved_names
from vinculo.session import scratch_path, staged
from vinculo.sinks import write_gold, write_registry_files, write_silver, write_table
from vinculo.sources import (
    FAMILIES,
    choose_snapshot,
    conform_roster,
    family_of,
    first_files,
    list_files,
    month_links,
    pending_files,
    read_registry,
    read_roster,
    read_selected,
    read_table,
    select_prefixes,
    zip_links,
)
from vinculo.sources.links import links
from vinculo.streaming import take_new_files

ENTRIES = Entries()

# --- roster and registry files ------------------------------------------------------------------------

_CONFORMED_SQL = f"""
    WITH {ROSTER_SQL}
    SELECT matricula, nome, cpf, nome_pai, CAST(NULL AS VARCHAR) AS nome_mae, data_nascimento, data_ingresso,
           data_formacao, curso, codigo_curso, nivel, situacao_curso
    FROM roster
"""


@ENTRIES.query(_CONFORMED_SQL)
def conformed_roster(tables: Tables) -> DataFrame:
    """Mangled headers, aliases, lenient dates, missing columns."""
    return conform_roster(raw_roster(tables))


@ENTRIES.query(_CONFORMED_SQL)
def roster_from_csv(tables: Tables) -> DataFrame:
    """The same roster written as CSV files and read back as text."""
    path = scratch_path(tables.spark, "roster")
    raw_roster(tables).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return read_roster(tables.spark, path)


@ENTRIES.query(
    f"""
    WITH {PEOPLE_SQL}, {PARTNERS_SQL}
    SELECT nullif(cnpj_basico, '') AS cnpj_basico, identificador, nome || ' "É;" ção' AS nome,
           data_entrada_sociedade
    FROM raw_partners
    """
)
def registry_from_csv(tables: Tables) -> DataFrame:
    """Headerless Latin-1 files with quotes and separators inside values, read by layout."""
    path = scratch_path(tables.spark, "registry")
    tricky = raw_partners(tables).withColumn("nome_socio", F.concat("nome_socio", F.lit(' "É;" ção')))
    (
        tricky.write.option("sep", ";")
        .option("encoding", "ISO-8859-1")
        .option("quoteAll", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )
    rows = read_registry(tables.spark, "partners", path, by_prefix=False)
    return rows.select(
        "cnpj_basico",
        F.col("identificador_socio").alias("identificador"),
        F.col("nome_socio").alias("nome"),
        "data_entrada_sociedade",
    )


@ENTRIES.query(
    f"""
    WITH {REGISTRY_SQL}
    SELECT cnpj_basico, cnpj_ordem, coalesce(cnpj_dv, '-') AS cnpj_dv, data_inicio_atividade, uf, '-' AS email
    FROM raw_establishments
    WHERE cnpj_basico IN (SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') FROM orders WHERE o_orderstatus = 'F')
    """
)
def targeted_registry_scan(tables: Tables) -> DataFrame:
    """A file scan cut to target companies, missing values padded."""
    path = scratch_path(tables.spark, "registry")
    raw_establishments(tables).write.option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    finished = raw_companies(tables).where(F.col("natureza_juridica") == "F")
    rows = read_registry(
        tables.spark, "establishments", path, targets=target_keys(finished, "cnpj_basico"), pad_with="-", by_prefix=False
    )
    return rows.select("cnpj_basico", "cnpj_ordem", "cnpj_dv", "data_inicio_atividade", "uf", "email")


_BROKEN_NAME = " \"É;\"\n\nção\nfim"  # what is put behind a name: quotes, a separator, several line breaks
_BROKEN_NAME_SQL = "nome || ' \"É;\"' || chr(10) || chr(10) || 'ção' || chr(10) || 'fim'"


def _broken_partners(tables: Tables) -> str:
    """A folder with partner files whose names hold line breaks, under names in mixed case."""
    folder = scratch_path(tables.spark, "registry")
    rows = raw_partners(tables).withColumn("nome_socio", F.concat("nome_socio", F.lit(_BROKEN_NAME)))
    write_registry_files(rows, folder, "sOCIOS")
    return folder


@ENTRIES.query(
    f"""
    WITH {PEOPLE_SQL}, {PARTNERS_SQL}
    SELECT nullif(cnpj_basico, '') AS cnpj_basico, identificador, {_BROKEN_NAME_SQL} AS nome, data_entrada_sociedade
    FROM raw_partners
    """
)
def registry_with_line_breaks(tables: Tables) -> DataFrame:
    """Quoted values with several line breaks, records put together over byte ranges."""
    rows = read_registry(tables.spark, "partners", _broken_partners(tables), whole_records=True)
    return rows.select("cnpj_basico", F.col("identificador_socio").alias("identificador"), F.col("nome_socio").alias("nome"), "data_entrada_sociedade")


@ENTRIES.query(
    f"""
    WITH {PEOPLE_SQL}, {PARTNERS_SQL}
    SELECT cnpj_basico, identificador, {_BROKEN_NAME_SQL} AS nome, '' AS pais
    FROM raw_partners
    WHERE cnpj_basico = '' OR cnpj_basico IN (SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') FROM orders WHERE o_orderstatus = 'F')
    """
)
def targeted_scan_with_blank_keys(tables: Tables) -> DataFrame:
    """Records of target companies and records without a company, missing values as empty text."""
    finished = target_keys(raw_companies(tables).where(F.col("natureza_juridica") == "F"), "cnpj_basico")
    rows = read_registry(tables.spark, "partners", _broken_partners(tables), finished, pad_with="", whole_records=True, blank_keys=True)
    return rows.select("cnpj_basico", F.col("identificador_socio").alias("identificador"), F.col("nome_socio").alias("nome"), "pais")


@ENTRIES.query(
    f"""
    WITH {REGISTRY_SQL}
    SELECT cnpj_basico, razao_social, capital_social, optante_simples, data_opcao_simples
    FROM raw_companies LEFT JOIN raw_tax USING (cnpj_basico) WHERE natureza_juridica <> 'O'
    """
)
def company_and_regime_files(tables: Tables) -> DataFrame:
    """Two families in one folder, told apart by prefix, cut to targets, one row per company."""
    folder = scratch_path(tables.spark, "registry")
    companies, regime = raw_companies(tables), raw_tax_regime(tables)
    write_registry_files(companies.union(companies), folder, "EMPRESAS")
    write_registry_files(regime.union(regime), folder, "simples")
    targets = target_keys(companies.where(F.col("natureza_juridica") != "O"), "cnpj_basico")
    read = [one_per_key(read_registry(tables.spark, family, folder, targets), ["cnpj_basico"]) for family in ("companies", "tax_regime")]
    joined = read[0].join(read[1], "cnpj_basico", "left")
    return joined.select("cnpj_basico", "razao_social", "capital_social", "optante_simples", "data_opcao_simples")


@ENTRIES.query(
    f"""
    WITH {PEOPLE_SQL}, {PARTNERS_SQL}
    SELECT CAST(NULL AS VARCHAR) AS cnpj_basico, identificador, nome, doc_digits, CAST(NULL AS VARCHAR) AS data_entrada_sociedade
    FROM raw_partners
    """
)
def aliased_partner_files(tables: Tables) -> DataFrame:
    """A partner file with headers of its own, other spellings of the names, optional columns missing."""
    path = scratch_path(tables.spark, "aliased")
    spelt = {"identificador_socio": "Identificador do Socio", "nome_socio": "NOME_DO_SOCIO", "cpf_cnpj_socio": "documento_socio"}
    raw_partners(tables).select(*[F.col(name).alias(other) for name, other in spelt.items()]).write.option("header", True).csv(path)
    rows = partner_rows(tables.spark.read.option("header", True).csv(path).na.fill(""))
    return rows.select("cnpj_basico", "identificador", "nome", "doc_digits", "data_entrada_sociedade")


@ENTRIES.query(
    f"""
    WITH {PEOPLE_SQL}, {PARTNERS_SQL}
    SELECT DISTINCT right(doc_digits, 6) AS cpf_fragment, nome, nullif(cnpj_basico, '') AS cnpj_basico,
           {_hmac_sql('doc_digits')} AS hash_documento_socio, data_entrada_sociedade
    FROM raw_partners WHERE identificador = '2' AND length(doc_digits) >= 6 AND data_entrada_sociedade <> '00000000'
    """
)
def silver_from_manifest(tables: Tables) -> DataFrame:
    """The latest month's partner files out of a listing of all files, read and made silver."""
    folder = scratch_path(tables.spark, "landing")
    rows = staged(raw_partners(tables), "partners")
    for month, part in (("2024-08", rows), ("2024-09", rows.where(F.col("data_entrada_sociedade") != "00000000"))):
        write_registry_files(part, f"{folder}/{month}", "Socios", packed=True)
    write_registry_files(raw_companies(tables), f"{folder}/2024-09", "Empresas", packed=True)
    manifest = list_files(tables.spark, folder)
    selected, _ = read_selected(tables.spark, manifest, folder, "partners", prefixes="soc;emp")
    return build_partner_tables(selected, SALT)[0]


@ENTRIES.query("SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def targeted_rows(tables: Tables) -> DataFrame:
    """Semi-join to a key set."""
    building = tables.customer.where(F.col("c_mktsegment") == "BUILDING")
    return keep_keys(tables.orders, building.select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


@ENTRIES.query(
    f"""
    WITH {REGISTRY_SQL}
    SELECT cnpj_basico, razao_social AS label FROM raw_companies
    UNION ALL SELECT cnpj_basico, 'SIMPLES' FROM raw_tax
    UNION ALL SELECT cnpj_basico, uf FROM raw_establishments
    """
)
def united_rows(tables: Tables) -> DataFrame:
    """Rows of same-layout tables, copies kept."""
    companies = raw_companies(tables).select("cnpj_basico", F.col("razao_social").alias("label"))
    regimes = raw_tax_regime(tables).select("cnpj_basico", F.lit("SIMPLES").alias("label"))
    offices = raw_establishments(tables).select("cnpj_basico", F.col("uf").alias("label"))
    return companies.unionByName(regimes).unionByName(offices)


# --- manifests and index pages ------------------------------------------------------------------------

_MANIFEST_SQL = """
manifest AS (
  SELECT CASE WHEN event_id % 7 = 0 THEN 'tmp' ELSE strftime(ts, '%Y-%m') END AS month,
         CASE user_id % 4 WHEN 0 THEN 'Socios' WHEN 1 THEN 'Empresas' WHEN 2 THEN 'estabelecimentos' ELSE 'Simples' END
           || CAST(event_id AS VARCHAR) || '.zip' AS name,
         CAST(floor(abs(value)) AS BIGINT) AS size
  FROM events
)"""


def _manifest(tables: Tables) -> DataFrame:
    number = F.col("user_id") % 4
    family = (
        F.when(number == 0, "Socios").when(number == 1, "Empresas").when(number == 2, "estabelecimentos").otherwise("Simples")
    )
    return tables.events.select(
        F.when(F.col("event_id") % 7 == 0, "tmp").otherwise(F.date_format("ts", "yyyy-MM")).alias("month"),
        F.concat(family, F.col("event_id").cast("string"), F.lit(".zip")).alias("name"),
        F.floor(F.abs("value")).alias("size"),
    )


@ENTRIES.query(
    f"""
    WITH {_MANIFEST_SQL}
    SELECT *, CASE WHEN name LIKE 'Socios%' THEN 'partners' WHEN name LIKE 'Empresas%' THEN 'companies'
                   WHEN name LIKE 'est%' THEN 'establishments' ELSE 'tax_regime' END AS family
    FROM manifest
    """
)
def file_families(tables: Tables) -> DataFrame:
    """Files routed by their prefix."""
    prefixes = {family: layout.prefix for family, layout in FAMILIES.items()}
    return _manifest(tables).withColumn("family", family_of(F.col("name"), prefixes))


@ENTRIES.query(f"WITH {_MANIFEST_SQL} SELECT * FROM manifest WHERE name LIKE 'Socios%' OR name LIKE 'est%'")
def files_by_prefix(tables: Tables) -> DataFrame:
    """Several prefixes in one text, any case."""
    return select_prefixes(_manifest(tables), " socios; ESTABELECIMENTOS ,")


@ENTRIES.query(
    f"""
    WITH {_MANIFEST_SQL}, valid AS (SELECT * FROM manifest WHERE month <> 'tmp')
    SELECT * FROM valid WHERE month = (SELECT max(month) FROM valid)
    """
)
def latest_snapshot(tables: Tables) -> DataFrame:
    """Files of the latest month."""
    return choose_snapshot(_manifest(tables))


@ENTRIES.query(
    f"""
    WITH {_MANIFEST_SQL}
    SELECT * FROM manifest
    ORDER BY lower(regexp_extract(name, '^\\D*')), CAST(regexp_extract(name, '\\d+') AS BIGINT), name LIMIT 500
    """
)
def first_files_in_natural_order(tables: Tables) -> DataFrame:
    """The first files, 2 before 10."""
    return first_files(_manifest(tables), 500)


@ENTRIES.query(
    f"""
    WITH {_MANIFEST_SQL}
    SELECT * FROM manifest m WHERE NOT EXISTS (
      SELECT 1 FROM manifest d WHERE d.month = m.month AND d.name = m.name AND d.size > 0 AND d.size % 2 = 0)
    """
)
def files_still_pending(tables: Tables) -> DataFrame:
    """Files without a complete counterpart among the processed ones."""
    manifest = _manifest(tables)
    return pending_files(manifest, manifest.where(F.col("size") % 2 == 0))


@ENTRIES.query(
    """
    SELECT DISTINCT unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages
    """
)
def page_links(tables: Tables) -> DataFrame:
    """S23 on raw pages: every distinct link target."""
    return links(tables.pages, 'href="([^"]+)"')


@ENTRIES.query(
    """
    SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS link FROM orders
    UNION ALL
    SELECT DISTINCT 'Socios' || CAST(o_custkey AS VARCHAR) || '.zip' FROM orders
    """
)
def index_links(tables: Tables) -> DataFrame:
    """S23 on index pages made of the orders: month folders and archives."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    html = F.concat(
        F.lit("<a href='"), month, F.lit("/'>m</a> <a href=\"Socios"), F.col("o_custkey"), F.lit('.zip">z</a> <a href="x/">x</a>')
    )
    pages = tables.orders.select(html.alias("html"))
    return month_links(pages).unionByName(zip_links(pages))


@ENTRIES.query("SELECT * FROM orders UNION ALL SELECT * FROM orders")
def streamed_intake(tables: Tables) -> DataFrame:
    """S24 as a stream: two landings, three runs, every landed row taken in once."""
    landing, bronze, checkpoint = (scratch_path(tables.spark, name) for name in ("landing", "bronze", "intake"))
    taken = tables.orders
    for landings in (1, 1, 0):
        if landings:
            tables.orders.write.mode("append").parquet(landing)
        taken = take_new_files(tables.spark, landing, tables.orders.schema, bronze, checkpoint)
    return taken


# --- partner silver tables ----------------------------------------------------------------------------

_BY_FRAGMENT_SQL = f"""
    WITH {PEOPLE_SQL}, {PARTNERS_SQL}
    SELECT DISTINCT right(doc_digits, 6) AS cpf_fragment, nome, cnpj_basico,
           {_hmac_sql('doc_digits')} AS hash_documento_socio, data_entrada_sociedade
    FROM raw_partners WHERE identificador = '2' AND length(doc_digits) >= 6
"""

_BY_NAME_SQL = f"""
    WITH {PEOPLE_SQL}, {PARTNERS_SQL},
    named AS (SELECT DISTINCT nome, cnpj_basico FROM raw_partners WHERE nome <> '')
    SELECT nome, string_agg(cnpj_basico, ',' ORDER BY cnpj_basico) AS cnpj_basicos,
           CASE WHEN count(*) = 1 THEN min(cnpj_basico) END AS cnpj_basico
    FROM named GROUP BY nome
"""


@ENTRIES.query(f"WITH {PEOPLE_SQL}, {PARTNERS_SQL} SELECT DISTINCT nome, cnpj_basico FROM raw_partners WHERE nome <> ''")
def companies_of_partner_names(tables: Tables) -> DataFrame:
    """A2, K3: the child table of the by-name lists, one row per name and company."""
    return companies_of_names(partner_rows(raw_partners(tables)))


def _joined_names(by_name: DataFrame) -> DataFrame:
    return by_name.withColumn("cnpj_basicos", F.array_join("cnpj_basicos", ","))


@ENTRIES.query(_BY_FRAGMENT_SQL)
def partners_by_fragment(tables: Tables) -> DataFrame:
    """Distinct natural-person partners."""
    return build_partner_tables(raw_partners(tables), SALT)[0]


@ENTRIES.query(_BY_NAME_SQL)
def partners_by_name(tables: Tables) -> DataFrame:
    """Companies of each name, resolved if there is just one."""
    return _joined_names(build_partner_tables(raw_partners(tables), SALT)[1])


@ENTRIES.query(
    f"""
    WITH {PEOPLE_SQL}, {PARTNERS_SQL},
    named AS (SELECT DISTINCT nome, cnpj_basico FROM raw_partners WHERE nome <> '')
    SELECT nome, count(*) AS n_empresas, CASE WHEN count(*) = 1 THEN min(cnpj_basico) END AS cnpj_basico
    FROM named GROUP BY nome
    """
)
def resolved_partner_names(tables: Tables) -> DataFrame:
    """A2, A3: how many companies a name has, and the company if there is just one, without gathering any name."""
    return resolved_names(companies_of_names(partner_rows(raw_partners(tables))))


def _months(tables: Tables) -> list[tuple[str, DataFrame, DataFrame | None]]:
    """Three changes (label, rows added, rows removed) after which just the rows with a date stand.

    The second month brings other files, among them copies of what the first had, and takes away some of the first; the
    third takes away the copies without a date.
    """
    raw = staged(raw_partners(tables), "partners")  # each change reads it again
    kind, undated = F.col("identificador_socio"), F.col("data_entrada_sociedade") == "00000000"
    return [
        ("2024-08", raw.where(kind != "1"), None),
        ("2024-09", raw.where(kind != "3"), raw.where((kind != "1") & undated)),
        ("2024-10", None, raw.where((kind != "3") & undated)),
    ]


@ENTRIES.query(_BY_FRAGMENT_SQL + " AND data_entrada_sociedade <> '00000000'")
def fragments_after_three_months(tables: Tables) -> DataFrame:
    """The by-fragment table out of layers of signed counts, as after one full build."""
    folder, merged = scratch_path(tables.spark, "layers"), scratch_path(tables.spark, "merged")
    months = _months(tables)
    for label, added, removed in months[:2]:
        add_layer(folder, label, added, removed, SALT)
    merge_layers(tables.spark, folder, merged, months[1][0])
    for _ in range(2):  # a job that runs again changes nothing
        add_layer(merged, *months[2], SALT)
    return kept_by_fragment(current_rows(tables.spark, merged))


@ENTRIES.query(
    f"""
    WITH {PEOPLE_SQL}, {PARTNERS_SQL},
    named AS (SELECT DISTINCT nome, cnpj_basico FROM raw_partners WHERE nome <> '' AND data_entrada_sociedade <> '00000000')
    SELECT nome, count(*) AS n_empresas, CASE WHEN count(*) = 1 THEN min(cnpj_basico) END AS cnpj_basico
    FROM named GROUP BY nome
    """
)
def names_after_three_months(tables: Tables) -> DataFrame:
    """Facts per name, derived again for the names that each month touches."""
    folder, facts = scratch_path(tables.spark, "layers"), None
    for label, added, removed in _months(tables):
        layer = add_layer(folder, label, added, removed, SALT)
        rows = current_rows(tables.spark, folder)
        facts = resolved_names(companies_of_names(rows)) if facts is None else refreshed_names(facts, rows, layer)
        facts = staged(facts, "names")
    return facts


@ENTRIES.query(
    """
    SELECT l_orderkey, string_agg(supplier, ',' ORDER BY supplier) AS suppliers, count(*) AS n,
           CASE WHEN count(*) = 1 THEN min(supplier) END AS only_supplier
    FROM (SELECT DISTINCT l_orderkey, lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS supplier FROM lineitem)
    GROUP BY l_orderkey
    """
)
def unambiguous_lookup(tables: Tables) -> DataFrame:
    """Distinct values per key, resolved only when single."""
    supplier = F.lpad(F.col("l_suppkey").cast("string"), 9, "0").alias("supplier")
    pairs = tables.lineitem.select("l_orderkey", supplier).distinct()
    lists = nest(pairs, ["l_orderkey"], F.col("supplier"), "suppliers", total_into="n").table
    return lists.select(
        "l_orderkey",
        F.array_join("suppliers", ",").alias("suppliers"),
        "n",
        F.when(F.col("n") == 1, F.get("suppliers", F.lit(0))).alias("only_supplier"),
    )


@ENTRIES.query(_BY_FRAGMENT_SQL)
def silver_roundtrip(tables: Tables) -> DataFrame:
    """Both silver tables written sorted, one read back by columns."""
    folder = scratch_path(tables.spark, "silver")
    write_silver(*build_partner_tables(raw_partners(tables), SALT), folder)
    columns = ("cpf_fragment", "nome", "cnpj_basico", "hash_documento_socio")
    return read_table(tables.spark, f"{folder}/socios", columns, optional=("data_entrada_sociedade", "not_there"))


@ENTRIES.query(
    f"""
    WITH {ROSTER_SQL}
    SELECT matricula, nome_pai, CASE WHEN codigo_curso = '5' THEN NULL WHEN codigo_curso = '1' THEN '<18'
             ELSE 'faixa/' || codigo_curso END AS faixa_etaria
    FROM roster
    """
)
def bucketed_roundtrip(tables: Tables) -> DataFrame:
    """Consolidated and bucketed output, the buckets read back (with a null bucket)."""
    bucket = (
        F.when(F.col("codigo_curso") == "1", "<18")
        .when(F.col("codigo_curso") != "5", F.concat(F.lit("faixa/"), "codigo_curso"))
        .alias("faixa_etaria")
    )
    rows = conform_roster(raw_roster(tables)).select("matricula", "nome_pai", bucket)
    folder = scratch_path(tables.spark, "gold")
    write_gold(rows, folder)
    return tables.spark.read.schema(rows.schema).parquet(f"{folder}/egressos_por_faixa_etaria")


# --- company profiles ---------------------------------------------------------------------------------


@ENTRIES.query("SELECT DISTINCT lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS cnpj_basico FROM lineitem WHERE l_quantity <> 1")
def target_companies(tables: Tables) -> DataFrame:
    """Distinct present keys out of lists."""
    lists = raw_partners(tables).select(F.array(F.col("cnpj_basico"), F.lit(None).cast("string")).alias("cnpj_basico"))
    return target_keys(lists, "cnpj_basico")


@ENTRIES.query(
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_linenumber) AS r
      FROM lineitem) WHERE r = 1
    """
)
def one_row_per_company(tables: Tables) -> DataFrame:
    """One deterministic row per key."""
    rows = tables.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    return one_per_key(rows, ["l_orderkey"], [-F.unix_date(F.col("l_shipdate").cast("date"))])


@ENTRIES.query(
    f"""
    WITH {REGISTRY_SQL}
    SELECT cnpj_basico, count(*) AS n, string_agg(cnpj_ordem || coalesce(cnpj_dv, '??') || ':' ||
             data_inicio_atividade || ':' || coalesce(cnpj, 'sem'), ';' ORDER BY place) AS estabelecimentos
    FROM establishments GROUP BY cnpj_basico
    """
)
def nested_establishments(tables: Tables) -> DataFrame:
    """A5, P20: all establishments of a company in one sorted list of structs."""
    nested = nest_establishments(raw_establishments(tables)).table
    return nested.select(
        "cnpj_basico",
        F.size("estabelecimentos").cast("bigint").alias("n"),
        _establishment_text("estabelecimentos").alias("estabelecimentos"),
    )


@ENTRIES.query(
    f"WITH {REGISTRY_SQL} SELECT cnpj_basico, cnpj_ordem, cnpj_dv, data_inicio_atividade, cnpj FROM establishments"
)
def flat_establishments(tables: Tables) -> DataFrame:
    """A5, P20: the child table of the establishment lists."""
    flat = establishment_rows(raw_establishments(tables))
    return flat.select("cnpj_basico", "cnpj_ordem", "cnpj_dv", "data_inicio_atividade", "cnpj")


def _establishment_text(column: str):
    return F.array_join(
        F.transform(
            column,
            lambda item: F.concat(
                item["cnpj_ordem"],
                F.coalesce(item["cnpj_dv"], F.lit("??")),
                F.lit(":"),
                item["data_inicio_atividade"],
                F.lit(":"),
                F.coalesce(item["cnpj"], F.lit("sem")),
            ),
        ),
        ";",
    )


@ENTRIES.query(
    f"""
    WITH {REGISTRY_SQL},
    heads AS (SELECT *, row_number() OVER (PARTITION BY cnpj_basico ORDER BY place) AS r
              FROM establishments WHERE identificador = '1')
    SELECT cnpj_basico, cnpj, data_inicio_atividade, cnae_fiscal_principal, uf FROM heads WHERE r = 1
    """
)
def first_head_office(tables: Tables) -> DataFrame:
    """One head office per company, fields taken out of the struct."""
    main = F.col("estabelecimento_matriz")
    return head_offices(raw_establishments(tables)).select(
        "cnpj_basico", main["cnpj"], main["data_inicio_atividade"], main["cnae_fiscal_principal"], main["uf"]
    ).toDF("cnpj_basico", "cnpj", "data_inicio_atividade", "cnae_fiscal_principal", "uf")


PROFILES_SQL = """
heads AS (
  SELECT *, row_number() OVER (PARTITION BY cnpj_basico ORDER BY place) AS r
  FROM establishments WHERE identificador = '1'
),
nested AS (
  SELECT cnpj_basico, string_agg(cnpj_ordem || coalesce(cnpj_dv, '??') || ':' || data_inicio_atividade || ':' ||
           coalesce(cnpj, 'sem'), ';' ORDER BY place) AS estabelecimentos
  FROM establishments GROUP BY cnpj_basico
),
profiles AS (
  SELECT t.cnpj_basico, c.razao_social, c.natureza_juridica, c.capital_social, c.porte_empresa,
         x.optante_simples, x.data_opcao_simples, n.estabelecimentos, h.cnpj AS cnpj_matriz, h.situacao_cadastral,
         h.data_inicio_atividade, h.uf, h.cnae_fiscal_principal,
         CAST((CAST(substr(h.data_inicio_atividade, 1, 4) AS INT) // 10) * 10 AS INT) AS decada_inicio_atividade
  FROM targets t LEFT JOIN raw_companies c USING (cnpj_basico) LEFT JOIN raw_tax x USING (cnpj_basico)
  LEFT JOIN nested n USING (cnpj_basico) LEFT JOIN (SELECT * FROM heads WHERE r = 1) h USING (cnpj_basico)
)"""


def flat_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles with the nested parts written out as text."""
    return profiles.select(
        "cnpj_basico",
        "razao_social",
        "natureza_juridica",
        "capital_social",
        "porte_empresa",
        "optante_simples",
        "data_opcao_simples",
        _establishment_text("estabelecimentos").alias("estabelecimentos"),
        F.col("estabelecimento_matriz")["cnpj"].alias("cnpj_matriz"),
        "situacao_cadastral",
        "data_inicio_atividade",
        "uf",
        "cnae_fiscal_principal",
        "decada_inicio_atividade",
    )


@ENTRIES.query(
    f"""
    WITH {REGISTRY_SQL},
    targets AS (SELECT DISTINCT lpad(CAST(l_orderkey + 3 AS VARCHAR), 8, '0') AS cnpj_basico FROM lineitem),
    {PROFILES_SQL}
    SELECT * FROM profiles
    """
)
def company_profiles(tables: Tables) -> DataFrame:
    """The star of targets, companies, tax regime, establishments and head office."""
    targets = tables.lineitem.select(F.lpad((F.col("l_orderkey") + 3).cast("string"), 8, "0").alias("cnpj_basico"))
    return flat_profiles(
        build_companies(targets, raw_companies(tables), raw_tax_regime(tables), raw_establishments(tables))
    )


@ENTRIES.query(
    f"""
    WITH {REGISTRY_SQL},
    targets AS (SELECT DISTINCT lpad(CAST(l_orderkey + 3 AS VARCHAR), 8, '0') AS cnpj_basico FROM lineitem),
    {PROFILES_SQL}
    SELECT cnpj_basico, razao_social, optante_simples, cnpj_matriz, data_inicio_atividade, uf, decada_inicio_atividade
    FROM profiles
    """
)
def flat_company_profiles(tables: Tables) -> DataFrame:
    """The star without lists; no company's rows are gathered."""
    targets = tables.lineitem.select(F.lpad((F.col("l_orderkey") + 3).cast("string"), 8, "0").alias("cnpj_basico"))
    profiles = build_companies(targets, raw_companies(tables), raw_tax_regime(tables), raw_establishments(tables), lists=False)
    return profiles.select(
        "cnpj_basico",
        "razao_social",
        "optante_simples",
        F.col("estabelecimento_matriz")["cnpj"].alias("cnpj_matriz"),
        "data_inicio_atividade",
        "uf",
        "decada_inicio_atividade",
    )


@ENTRIES.query(
    f"""
    WITH {REGISTRY_SQL}
    SELECT cnpj_basico, razao_social, CAST(NULL AS VARCHAR) AS uf, CAST(NULL AS VARCHAR) AS optante_simples,
           CAST(NULL AS INT) AS decada_inicio_atividade FROM raw_companies
    """
)
def profiles_without_offices(tables: Tables) -> DataFrame:
    """Families without files give typed empty frames, and null profile columns."""
    empty = {family: read_registry(tables.spark, family, []) for family in ("tax_regime", "establishments")}
    companies = raw_companies(tables)
    profiles = build_companies(
        companies.select("cnpj_basico"), companies, empty["tax_regime"], empty["establishments"]
    )
    return profiles.select("cnpj_basico", "razao_social", "uf", "optante_simples", "decada_inicio_atividade")


@ENTRIES.query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def counted_write(tables: Tables) -> DataFrame:
    """K5, K7: a table written with its rows counted on the way, then checked against the count."""
    path = scratch_path(tables.spark, "counted")
    rows = write_table(tables.orders.select("o_orderkey", "o_custkey", "o_totalprice"), path)
    back = tables.spark.read.parquet(path)
    if back.count() != rows:
        raise RuntimeError(f"{rows} rows counted while writing, {back.count()} found")
    return back
