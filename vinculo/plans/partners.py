"""Silver tables of registered partners, by document fragment and by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinculo.functions import digits_only, has_name, keyed_hash, normalize_name, registry_fragment
from vinculo.operators.conform import pick_columns
from vinculo.operators.nesting import nest
from vinculo.schemas import PARTNER_ALIASES, PARTNER_OPTIONAL

NATURAL_PERSON = "2"
SHORTEST_DOCUMENT = 6


def partner_rows(raw: DataFrame) -> DataFrame:
    """Partner rows with resolved columns, normalised name and document digits.

    ``tem_nome`` lets a filter on the name be pushed to the scan without normalising names twice.
    """
    picked = pick_columns(raw, PARTNER_ALIASES, optional=PARTNER_OPTIONAL)
    return picked.select(
        "cnpj_basico",
        "identificador",
        normalize_name(F.col("nome")).alias("nome"),
        has_name(F.col("nome")).alias("tem_nome"),
        digits_only(F.col("doc")).alias("doc_digits"),
        "data_entrada_sociedade",
    )


def partners_by_fragment(rows: DataFrame, salt: str) -> DataFrame:
    """Distinct natural-person partners keyed by document fragment.

    Rows are made distinct on the bare digits; the longer keyed hash is computed for the survivors only.
    """
    people = rows.where(
        (F.col("identificador") == NATURAL_PERSON) & (F.length("doc_digits") >= SHORTEST_DOCUMENT)
    )
    return (
        people.select("nome", "cnpj_basico", "doc_digits", "data_entrada_sociedade")
        .distinct()
        .select(
            registry_fragment(F.col("doc_digits")).alias("cpf_fragment"),
            "nome",
            "cnpj_basico",
            keyed_hash(F.col("doc_digits"), salt).alias("hash_documento_socio"),
            "data_entrada_sociedade",
        )
    )


def companies_of_names(rows: DataFrame) -> DataFrame:
    """The flat table behind the by-name lists: distinct (``nome``, ``cnpj_basico``), all kinds of partner."""
    return rows.where("tem_nome").select("nome", "cnpj_basico").distinct()


def resolved_names(pairs: DataFrame) -> DataFrame:
    """(``nome``, ``n_empresas``, ``cnpj_basico``) per name of :func:`companies_of_names`: the company if there is just one.

    Counts and least values add up in each task, so a name of very many companies is gathered nowhere.
    """
    counted = pairs.groupBy("nome").agg(F.count("cnpj_basico").alias("n_empresas"), F.min("cnpj_basico").alias("_least"))
    return counted.select("nome", "n_empresas", F.when(F.col("n_empresas") == 1, F.col("_least")).alias("cnpj_basico"))


def names_with_lists(pairs: DataFrame) -> DataFrame:
    """(``nome``, ``cnpj_basicos``, ``cnpj_basico``) per name of :func:`companies_of_names`, for an export with lists."""
    nested = nest(pairs, ["nome"], F.col("cnpj_basico"), "_companies").table
    companies = F.filter("_companies", lambda company: company.isNotNull())
    only_one = F.size("cnpj_basicos") == 1
    return (
        nested.withColumn("cnpj_basicos", companies)
        .withColumn("cnpj_basico", F.when(only_one, F.get("cnpj_basicos", F.lit(0))))
        .select("nome", "cnpj_basicos", "cnpj_basico")
    )


def partners_by_name(rows: DataFrame, lists: bool = True) -> DataFrame:
    """Companies of each partner name, one row per name; the single company if there is just one.

    Without ``lists``, the facts of :func:`resolved_names` alone.
    """
    pairs = companies_of_names(rows)
    return names_with_lists(pairs) if lists else resolved_names(pairs)


def without_documents(rows: DataFrame, salt: str) -> DataFrame:
    """Partner rows to be kept in a folder: of a document only the published fragment and the keyed hash, of persons alone."""
    person = (F.col("identificador") == NATURAL_PERSON) & (F.length("doc_digits") >= SHORTEST_DOCUMENT)
    return rows.select(
        "nome",
        "tem_nome",
        "cnpj_basico",
        "data_entrada_sociedade",
        F.when(person, registry_fragment(F.col("doc_digits"))).alias("cpf_fragment"),
        F.when(person, keyed_hash(F.col("doc_digits"), salt)).alias("hash_documento_socio"),
    )


def kept_by_fragment(kept: DataFrame) -> DataFrame:
    """What :func:`partners_by_fragment` gives, out of rows of :func:`without_documents`."""
    people = kept.where(F.col("cpf_fragment").isNotNull())
    return people.select("cpf_fragment", "nome", "cnpj_basico", "hash_documento_socio", "data_entrada_sociedade").distinct()


def build_partner_tables(raw: DataFrame, salt: str) -> tuple[DataFrame, DataFrame]:
    """The by-fragment and by-name tables of a raw partner file or table."""
    rows = partner_rows(raw)
    return partners_by_fragment(rows, salt), partners_by_name(rows)
