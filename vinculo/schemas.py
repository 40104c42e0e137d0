"""Layouts of the files and tables the plans read and write."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Column layouts of the headerless registry files, by position (fixed values).
PARTNER_COLUMNS = (
    "cnpj_basico", "identificador_socio", "nome_socio", "cpf_cnpj_socio", "qualificacao_socio",
    "data_entrada_sociedade", "pais", "representante_legal", "nome_representante",
    "qualificacao_representante", "faixa_etaria",
)
COMPANY_COLUMNS = (
    "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social",
    "porte_empresa", "ente_federativo",
)
ESTABLISHMENT_COLUMNS = (
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia",
    "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral", "nome_cidade_exterior",
    "pais", "data_inicio_atividade", "cnae_fiscal_principal", "cnae_fiscal_secundaria", "tipo_logradouro",
    "logradouro", "numero", "complemento", "bairro", "cep", "uf", "municipio", "ddd1", "telefone1", "ddd2",
    "telefone2", "ddd_fax", "fax", "email", "situacao_especial", "data_situacao_especial",
)
TAX_REGIME_COLUMNS = (
    "cnpj_basico", "optante_simples", "data_opcao_simples", "data_exclusao_simples", "optante_mei",
    "data_opcao_mei", "data_exclusao_mei",
)
HEAD_OFFICE_COLUMNS = (
    "situacao_cadastral", "data_inicio_atividade", "uf", "cnae_fiscal_principal", "cnae_fiscal_secundaria",
)

# Names a partner table may use for its columns (fixed values).
PARTNER_ALIASES = {
    "cnpj_basico": ("cnpj_basico", "cnpj"),
    "nome": ("nome_socio", "nome_socio_razao_social", "nome_do_socio", "nome"),
    "identificador": ("identificador_de_socio", "identificador_socio", "identificador do socio"),
    "doc": ("cpf_cnpj_socio", "cnpj_cpf_do_socio", "documento_socio"),
    "data_entrada_sociedade": ("data_entrada_sociedade",),
}
PARTNER_OPTIONAL = ("cnpj_basico", "data_entrada_sociedade")

# Roster columns and the header spellings accepted for them (fixed values).
ROSTER_TEXT_COLUMNS = (
    "matricula", "nome", "cpf", "nome_pai", "nome_mae", "curso", "codigo_curso", "nivel", "situacao_curso",
)
ROSTER_DATE_COLUMNS = ("data_nascimento", "data_ingresso", "data_formacao")
ROSTER_ALIASES = {
    "matriculadre": "matricula",
    "datanascimento": "data_nascimento",
    "dataingresso": "data_ingresso",
    "dataconclusao": "data_formacao",
    "pai": "nome_pai",
    "mae": "nome_mae",
    "codigo": "codigo_curso",
    "situacaocurso": "situacao_curso",
}

# Columns of the exported roster, in order (fixed values).
GOLD_COLUMNS = (
    "id_pessoa", "matricula", "nome", "nome_norm", "idade", "idade_ingresso", "idade_conclusao",
    "faixa_etaria", "data_nascimento", "data_ingresso", "data_formacao", "ultimo_curso", "nivel",
    "codigo_curso", "socio_cpf", "socio_nome", "socio", "fundador", "cnpj_basico", "data_associacao",
    "datas_associacao", "data_associacao_primeira", "datas_associacao_por_empresa", "decada_inicio_curso",
    "decada_conclusao_curso", "fundador_relacoes", "cnpj_fundador", "socio_fundador",
)
# Columns which tell who a person is; left out of a pseudonymised export.
IDENTIFYING_COLUMNS = ("matricula", "nome", "nome_norm", "data_nascimento")


def text_layout(names: tuple[str, ...]) -> StructType:
    """A layout in which every column is text."""
    return StructType([StructField(name, StringType()) for name in names])


PARTNER_LAYOUT = text_layout(PARTNER_COLUMNS)
COMPANY_LAYOUT = text_layout(COMPANY_COLUMNS)
ESTABLISHMENT_LAYOUT = text_layout(ESTABLISHMENT_COLUMNS)
TAX_REGIME_LAYOUT = text_layout(TAX_REGIME_COLUMNS)

ROSTER_TYPES = {
    **{name: StringType() for name in ROSTER_TEXT_COLUMNS},
    **{name: DateType() for name in ROSTER_DATE_COLUMNS},
}

FEATURE_TYPES = {
    "nome_norm": StringType(),
    "idade": IntegerType(),
    "faixa_etaria": StringType(),
    "ultimo_curso": StringType(),
}

TEXT_LIST = ArrayType(StringType())
DATE_LIST = ArrayType(DateType())
COMPANY_DATES_LIST = ArrayType(
    StructType([StructField("cnpj_basico", StringType()), StructField("datas", DATE_LIST)])
)
FOUNDER_RELATIONS_LIST = ArrayType(
    StructType(
        [
            StructField("cnpj_basico", StringType()),
            StructField("data_associacao", DateType()),
            StructField("data_inicio_atividade", DateType()),
            StructField("diferenca_dias", IntegerType()),
        ]
    )
)
