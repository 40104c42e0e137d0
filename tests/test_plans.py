"""The dataflows on a small hand-made roster and registry; all persons and numbers are invented."""

import datetime as dt

import pytest

from vinculo.plans import (
    GoldConfig,
    Registry,
    add_layer,
    build_companies,
    build_gold,
    build_partner_tables,
    current_rows,
    export_columns,
    label_founders,
    link_partners,
    merge_layers,
    refreshed_names,
    run,
    transform_roster,
)
from vinculo.plans.companies import head_offices, with_establishments
from vinculo.plans.gold import find_facts, gold_rows, person_companies
from vinculo.plans.partners import companies_of_names, kept_by_fragment, partner_rows, resolved_names, without_documents
from vinculo.schemas import (
    COMPANY_COLUMNS,
    COMPANY_LAYOUT,
    ESTABLISHMENT_COLUMNS,
    ESTABLISHMENT_LAYOUT,
    GOLD_COLUMNS,
    PARTNER_COLUMNS,
    PARTNER_LAYOUT,
    TAX_REGIME_COLUMNS,
    TAX_REGIME_LAYOUT,
)

SALT, AS_OF = "pepper", dt.date(2024, 1, 1)
JOAO, ANA, BIA = "529.982.247-25", "111.444.777-35", "123.456.789-09"
ROSTER = [
    ("m1", "  João  d'Ávila Núñez ", JOAO, dt.date(1990, 3, 5), dt.date(2010, 3, 1), dt.date(2014, 12, 1), "Letras"),
    ("m2", "João d'Ávila Núñez", JOAO, dt.date(1990, 3, 5), None, None, None),
    ("m3", "Ana Lima", ANA, dt.date(2000, 2, 29), dt.date(2018, 3, 1), None, "Direito"),
    ("m4", "Bia Souza", BIA, None, None, None, "Física"),
    ("m5", "Sem Documento", "111.111.111-11", dt.date(2024, 7, 1), None, None, "X"),
    ("m6", "Nulo", None, dt.date(1959, 1, 1), None, None, "X"),
]
ROSTER_COLUMNS = ["matricula", "nome", "cpf", "data_nascimento", "data_ingresso", "data_formacao", "curso"]
PARTNERS = [
    # root, kind, name, document, joined
    ("11111111", "2", "JOAO D'AVILA NUNEZ", "***982247**", "20200110"),
    ("11111111", "2", "JOAO D'AVILA NUNEZ", "***982247**", "20200110"),
    ("22222222", "2", "NÚÑEZ JOAO D'AVILA FILHO", "***982247**", "2020-02-05"),
    ("33333333", "2", "JOAO D'AVILA NUNES", "***982247**", "00000000"),
    ("", "2", "JOAO D'AVILA NUNEZ", "***982247**", "20200110"),
    ("44444444", "2", "CARLOS COSTA", "***444777**", "20200110"),
    ("55555555", "1", "BIA SOUZA", "12345678000199", "20200110"),
    ("66666666", "2", "BIA SOUZA", "12345", "20200110"),
]
ESTABLISHMENTS = [
    # root, order, check, head office, start, state
    ("11111111", "0001", "10", "1", "20200103", "SP"),
    ("11111111", "0002", "11", "2", "20210101", "RJ"),
    ("22222222", "0001", None, "1", "20200105", "MG"),
    ("33333333", "0002", "31", "2", "20200105", "MG"),
    ("99999999", "0001", "90", "1", "20200105", "MG"),
]


def widen(spark, rows, names, columns, layout):
    made = [tuple(dict(zip(names, row, strict=True)).get(column) for column in columns) for row in rows]
    return spark.createDataFrame(made, layout)


@pytest.fixture(scope="module")
def roster(spark):
    kinds = "matricula string, nome string, cpf string, data_nascimento date, data_ingresso date, data_formacao date, curso string"
    return spark.createDataFrame(ROSTER, kinds)


@pytest.fixture(scope="module")
def registry(spark):
    partner_names = ["cnpj_basico", "identificador_socio", "nome_socio", "cpf_cnpj_socio", "data_entrada_sociedade"]
    office_names = ["cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "data_inicio_atividade", "uf"]
    companies = [("11111111", "B LTDA"), ("11111111", "A LTDA"), ("33333333", "C LTDA"), ("99999999", "Z")]
    return Registry(
        partners=widen(spark, PARTNERS, partner_names, PARTNER_COLUMNS, PARTNER_LAYOUT),
        companies=widen(spark, companies, ["cnpj_basico", "razao_social"], COMPANY_COLUMNS, COMPANY_LAYOUT),
        tax_regime=widen(spark, [("22222222", "S")], ["cnpj_basico", "optante_simples"], TAX_REGIME_COLUMNS, TAX_REGIME_LAYOUT),
        establishments=widen(spark, ESTABLISHMENTS, office_names, ESTABLISHMENT_COLUMNS, ESTABLISHMENT_LAYOUT),
    )


def by_key(frame, key):
    return {row[key]: row for row in frame.collect()}


def test_partner_tables(registry):
    by_fragment, by_name = build_partner_tables(registry.partners, SALT)
    rows = by_fragment.collect()
    assert len(rows) == 5
    assert {row["cpf_fragment"] for row in rows} == {"982247", "444777"}
    assert all(len(row["hash_documento_socio"]) == 64 for row in rows)
    names = by_key(by_name, "nome")
    assert names["BIA SOUZA"]["cnpj_basicos"] == ["55555555", "66666666"] and names["BIA SOUZA"]["cnpj_basico"] is None
    assert names["CARLOS COSTA"]["cnpj_basico"] == "44444444"


def test_one_row_per_name(spark):
    rows = [("ANA", "2", "1", str(i % 40)) for i in range(80)] + [("BIA", "2", "1", "7"), ("EVA", "2", "1", None)]
    raw = spark.createDataFrame(rows, "nome string, identificador_socio string, documento_socio string, cnpj string")
    lists = {row["nome"]: (row["cnpj_basicos"], row["cnpj_basico"]) for row in build_partner_tables(raw, SALT)[1].collect()}
    assert lists == {"ANA": (sorted(str(i) for i in range(40)), None), "BIA": (["7"], "7"), "EVA": ([], None)}
    flat = companies_of_names(partner_rows(raw)).collect()
    assert sorted(c for n, c in flat if n == "ANA") == lists["ANA"][0]


def test_roster_transform(roster):
    rows = by_key(transform_roster(roster, SALT, AS_OF), "matricula")
    assert rows["m1"]["nome_norm"] == "JOAO D'AVILA NUNEZ"
    assert rows["m1"]["id_pessoa"] == rows["m2"]["id_pessoa"] and len(rows["m1"]["id_pessoa"]) == 64
    assert [rows["m1"][c] for c in ("cpf_fragment", "idade", "idade_ingresso", "idade_conclusao", "faixa_etaria")] == ["982247", 33, 19, 24, "25-34"]
    assert [rows["m2"][c] for c in ("idade_ingresso", "ultimo_curso", "decada_inicio_curso")] == [33, "", None]
    assert (rows["m1"]["decada_inicio_curso"], rows["m1"]["decada_conclusao_curso"]) == (2010, 2010)
    assert (rows["m4"]["idade"], rows["m4"]["faixa_etaria"]) == (None, None)
    assert [rows["m5"][c] for c in ("cpf_limpo", "id_pessoa", "cpf_fragment", "idade", "faixa_etaria")] == ["", "", "", 0, "<18"]
    assert [rows["m6"][c] for c in ("cpf_limpo", "id_pessoa", "cpf_fragment", "faixa_etaria")] == [None, None, None, "65+"]
    with pytest.raises(ValueError, match="cpf"):
        transform_roster(roster.drop("cpf"), SALT, AS_OF)


@pytest.fixture(scope="module")
def gold(roster, registry):
    silver = build_partner_tables(registry.partners, SALT)[0]
    return build_gold(roster, silver, registry, GoldConfig(SALT, AS_OF))


def test_gold(gold):
    frame, _ = gold
    assert frame.columns == list(GOLD_COLUMNS)
    rows = by_key(frame, "matricula")
    assert len(rows) == 6 and frame.count() == 6
    joao = rows["m1"]
    assert joao["cnpj_basico"] == ["11111111", "22222222", "33333333"]
    assert joao["data_associacao"] == ["20200110", "2020-02-05", "00000000"]
    assert joao["datas_associacao"] == [dt.date(2020, 1, 10), dt.date(2020, 2, 5), None]
    assert joao["data_associacao_primeira"] == dt.date(2020, 1, 10)
    assert [joao[c] for c in ("socio_cpf", "socio_nome", "socio", "fundador", "socio_fundador")] == [True] * 5
    # Both degrees of a person count: dates and relations are listed once per roster row.
    assert [(c["cnpj_basico"], c["datas"]) for c in joao["datas_associacao_por_empresa"]] == [
        ("11111111", [dt.date(2020, 1, 10)] * 2),
        ("22222222", [dt.date(2020, 2, 5)] * 2),
    ]
    assert [(r["cnpj_basico"], r["diferenca_dias"]) for r in joao["fundador_relacoes"]] == [("11111111", 7)] * 2
    assert joao["cnpj_fundador"] == ["11111111"] * 2
    assert rows["m2"]["cnpj_basico"] == joao["cnpj_basico"]
    ana = rows["m3"]
    assert [ana[c] for c in ("socio_cpf", "socio_nome", "socio", "fundador", "socio_fundador")] == [True] + [False] * 4
    for name in ("m3", "m4", "m5", "m6"):
        assert rows[name]["cnpj_basico"] == [] and rows[name]["fundador_relacoes"] == []
    assert not any(rows[name]["socio_cpf"] for name in ("m4", "m5", "m6"))


def test_companies(gold):
    rows = by_key(gold[1], "cnpj_basico")
    assert set(rows) == {"11111111", "22222222", "33333333"}
    first = rows["11111111"]
    assert first["razao_social"] == "A LTDA" and first["optante_simples"] is None
    assert [e["cnpj"] for e in first["estabelecimentos"]] == ["11111111000110", "11111111000211"]
    assert (first["uf"], first["decada_inicio_atividade"]) == ("SP", 2020)
    assert rows["22222222"]["estabelecimento_matriz"]["cnpj"] is None
    assert rows["22222222"]["optante_simples"] == "S" and rows["22222222"]["razao_social"] is None
    assert rows["33333333"]["estabelecimento_matriz"] is None and rows["33333333"]["data_inicio_atividade"] is None


@pytest.mark.parametrize(("gap", "fundador", "label"), [(0, 1, 1), (7, 1, 1), (-7, 1, 1), (8, 1, 0), (31, 1, 0), (-31, 1, 0), (32, 0, 0), (None, 0, 0)])
def test_founder_windows(spark, roster, registry, gap, fundador, label):
    start = dt.date(2020, 1, 10) - dt.timedelta(gap) if gap is not None else None
    companies = spark.createDataFrame([("11111111", start and start.isoformat())], "cnpj_basico string, data_inicio_atividade string")
    people = transform_roster(roster, SALT, AS_OF)
    linked = link_partners(people, build_partner_tables(registry.partners, SALT)[0], companies)
    row = by_key(label_founders(linked, companies), "matricula")["m1"]
    assert (row["fundador"], row["socio_fundador"]) == (bool(fundador), bool(label))
    assert len(row["fundador_relacoes"]) == 2 * label


def test_missing_tables_give_defaults(roster):
    people = transform_roster(roster, SALT, AS_OF)
    rows = link_partners(people, None).collect()
    assert len(rows) == 6
    for row in rows:
        assert not (row["socio_cpf"] or row["socio_nome"] or row["socio"] or row["fundador"])
        assert row["cnpj_basico"] == [] and row["datas_associacao_por_empresa"] == []


def test_strict_companies(spark, registry):
    nothing = spark.createDataFrame([], "cnpj_basico string")
    parts = (registry.companies, registry.tax_regime, registry.establishments)
    with pytest.raises(ValueError):
        build_companies(nothing, *parts, strict=True)
    assert build_companies(nothing, *parts).count() == 0


def test_labelling_again_changes_nothing(gold):
    frame, companies = gold
    once = label_founders(frame, companies)
    again = label_founders(once, companies)
    assert frame.count() == once.count() == again.count() == 6
    lists = ("cnpj_basico", "data_associacao", "fundador_relacoes", "cnpj_fundador", "socio_fundador")
    first, second = by_key(once, "matricula"), by_key(again, "matricula")
    for key in first:
        assert [first[key][name] for name in lists] == [second[key][name] for name in lists]
    assert [x["diferenca_dias"] for x in first["m1"]["fundador_relacoes"]] == [7, 7]


def test_any_fragment_links(spark):
    """Fragments need not be six digits."""
    roster = spark.createDataFrame([("p1", "x", "ab-1", "ANA LIMA"), ("p2", "x", " ", "EVA")], "id_pessoa string, cpf_limpo string, cpf_fragment string, nome_norm string")
    partners = spark.createDataFrame([("ab-1", "ANA LIMA", "7", "20200101")], "cpf_fragment string, nome string, cnpj_basico string, data_entrada_sociedade string")
    rows = by_key(link_partners(roster, partners), "id_pessoa")
    assert rows["p1"]["socio"] and rows["p1"]["cnpj_basico"] == ["7"]
    assert not rows["p2"]["socio_cpf"]


def test_label_guards(gold):
    frame, companies = gold
    with pytest.raises(ValueError):
        label_founders(frame, companies, max_gap_days=-1)
    with pytest.raises(ValueError, match="socio"):
        label_founders(frame.drop("socio"), companies)


def test_pseudonymised_export(gold):
    hidden = export_columns(gold[0], pseudonymised=True)
    assert not {"nome", "nome_norm", "matricula", "data_nascimento"} & set(hidden.columns)


def test_run_writes_everything(spark, roster, registry, tmp_path):
    counts = run(roster, registry, GoldConfig(SALT, AS_OF), str(tmp_path), source_month="2024-09")
    assert {k: counts[k] for k in ("socios", "socios_nomes", "egressos", "empresas")} == {"socios": 5, "socios_nomes": 5, "egressos": 6, "empresas": 3}
    for table, rows in (("silver/socios", 5), ("gold/egressos", 6), ("gold/egressos_por_faixa_etaria", 6), ("gold/socios_empresas", 3)):
        assert spark.read.parquet(f"{tmp_path}/{table}").count() == rows
    assert spark.read.json(f"{tmp_path}/silver/socios_meta").first()["rows"] == 5
    for table, lists, name in (
        ("silver/socios_nomes_empresas", "silver/socios_nomes", "cnpj_basicos"),
        ("gold/empresas_estabelecimentos", "gold/socios_empresas", "estabelecimentos"),
    ):
        flat = spark.read.parquet(f"{tmp_path}/{table}").where("cnpj_basico is not null").count()
        assert flat == sum(len(row[name] or []) for row in spark.read.parquet(f"{tmp_path}/{lists}").collect())
    assert counts["egressos_empresas"] == spark.read.parquet(f"{tmp_path}/gold/egressos_empresas").count() > 0


def test_run_needs_partners(spark, roster, registry, tmp_path):
    nobody = Registry(registry.partners.limit(0), registry.companies, registry.tax_regime, registry.establishments)
    with pytest.raises(ValueError, match="no readable partner"):
        run(roster, nobody, GoldConfig(SALT, AS_OF), str(tmp_path))


def test_links_pad_missing_columns(spark, registry):
    bare = spark.createDataFrame([("p1", "52998224725", "JOAO D'AVILA NUNEZ")], "id_pessoa string, cpf_limpo string, nome_norm string")
    row = link_partners(bare, build_partner_tables(registry.partners, SALT)[0]).first()
    assert row["cnpj_basico"] == ["11111111", "22222222", "33333333"] and row["nivel"] is None and row["idade"] is None
    with pytest.raises(ValueError, match="cpf_limpo"):
        link_partners(bare.drop("cpf_limpo"), None)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_in_the_jvm(roster, registry, gold):
    frames = [*build_partner_tables(registry.partners, SALT), transform_roster(roster, SALT, AS_OF), *gold]
    for frame in frames:
        plan = plan_of(frame)
        assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    targets = registry.companies.select("cnpj_basico")
    companies = build_companies(targets, registry.companies, registry.tax_regime, registry.establishments)
    assert "LeftSemi" in plan_of(companies)


def text_frame(spark, rows, columns):
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in columns))


def test_a_hot_company_and_a_hot_name_are_gathered_nowhere(spark):
    """A third of all rows under one company and one name: facts and child tables without a list in their plans."""
    hot, others = 20_000, 40_000
    rows = [("00000001", f"{i:06d}") for i in range(hot)] + [(f"{i % 977 + 2:08d}", f"{i:06d}") for i in range(others)]
    blank = [None] * (len(ESTABLISHMENT_COLUMNS) - 4)
    offices = text_frame(spark, [(c, o, "00", "1" if int(o) % 2 else "2", *blank) for c, o in rows], ESTABLISHMENT_COLUMNS)
    heads = head_offices(offices)
    first = {}
    for company, place in rows:
        if int(place) % 2:
            first[company] = min(first.get(company, place), place)
    assert {r["cnpj_basico"]: r["estabelecimento_matriz"]["cnpj_ordem"] for r in heads.collect()} == first
    names = spark.createDataFrame([("HOT" if c == "00000001" else c, o) for c, o in rows] + [("ONE", "7"), ("ONE", None)], "nome string, cnpj_basico string")
    resolved = resolved_names(names.distinct())
    got = {r["nome"]: (r["n_empresas"], r["cnpj_basico"]) for r in resolved.collect()}
    assert got["HOT"] == (hot, None) and got["ONE"] == (1, "7")
    assert "collect_list" not in plan_of(resolved)
    assert not [x for x in ("collect_list", "SortAggregate") if x in plan_of(heads)] and "WindowGroupLimit" in plan_of(heads)


def test_facts_are_found_without_lists(spark, roster, registry, gold):
    config = GoldConfig(SALT, AS_OF, lists=False)
    facts = find_facts(roster, build_partner_tables(registry.partners, SALT)[0], registry, config)
    plain = gold_rows(facts, config)
    for frame in (facts.companies, facts.relations, person_companies(facts), plain):
        assert "collect_list" not in plan_of(frame)
    listed, companies = gold
    assert not [name for name, kind in plain.dtypes if kind.startswith("array")]
    assert sorted(map(str, plain.collect())) == sorted(map(str, listed.select(plain.columns).collect()))
    wanted = {(r["id_pessoa"], c, d) for r in listed.collect() for c, d in zip(r["cnpj_basico"], r["data_associacao"], strict=True)}
    assert sorted(map(tuple, person_companies(facts).collect())) == sorted(wanted)
    again = with_establishments(facts.companies, registry.establishments)
    assert again.columns == companies.columns and sorted(map(str, again.collect())) == sorted(map(str, companies.collect()))


def test_kept_rows_hold_no_document(registry):
    rows = partner_rows(registry.partners)
    kept = without_documents(rows, SALT)
    assert "doc_digits" not in kept.columns
    by_fragment = build_partner_tables(registry.partners, SALT)[0]
    assert sorted(map(str, kept_by_fragment(kept).select(by_fragment.columns).collect())) == sorted(map(str, by_fragment.collect()))


def test_run_without_lists(spark, roster, registry, tmp_path):
    counts = run(roster, registry, GoldConfig(SALT, AS_OF, lists=False), str(tmp_path))
    assert {k: counts[k] for k in ("socios", "socios_nomes", "egressos", "empresas")} == {"socios": 5, "socios_nomes": 5, "egressos": 6, "empresas": 3}
    for table in ("silver/socios_nomes", "gold/egressos", "gold/socios_empresas"):
        assert not [name for name, kind in spark.read.parquet(f"{tmp_path}/{table}").dtypes if kind.startswith("array")]
    for name in ("egressos_empresas", "egressos_fundacoes", "empresas_estabelecimentos"):
        assert counts[name] == spark.read.parquet(f"{tmp_path}/gold/{name}").count() > 0


def test_layers_of_signed_counts(spark, tmp_path):
    """A row stands while one file holds it; a month written again, merged layers, names that vanish and names resolved anew."""

    def raw(*rows):
        columns = ["cnpj_basico", "identificador_socio", "nome_socio", "cpf_cnpj_socio", "data_entrada_sociedade"]
        return spark.createDataFrame([(c, "2", n, "***123456**", "20200101") for c, n in rows], ", ".join(f"{x} string" for x in columns))

    folder = str(tmp_path / "layers")
    first = add_layer(folder, "m1", raw(("1", "ANA"), ("1", "ANA"), ("2", "ANA"), ("3", "EVA")), None, "s")
    assert "123456" not in {str(v) for r in first.drop("cpf_fragment").collect() for v in r}
    facts = resolved_names(companies_of_names(current_rows(spark, folder)))
    facts = spark.createDataFrame(facts.collect(), facts.schema)
    assert {tuple(r) for r in facts.collect()} == {("ANA", 2, None), ("EVA", 1, "3")}
    for _ in range(2):
        layer = add_layer(folder, "m2", raw(("4", "IVO")), raw(("1", "ANA"), ("2", "ANA"), ("3", "EVA")), "s")
    rows = current_rows(spark, folder)
    assert {(r["cnpj_basico"], r["nome"]) for r in rows.collect()} == {("1", "ANA"), ("4", "IVO")}
    assert {tuple(r) for r in refreshed_names(facts, rows, layer).collect()} == {("ANA", 1, "1"), ("IVO", 1, "4")}
    merged = str(tmp_path / "merged")
    merge_layers(spark, folder, merged, "m2")
    assert {tuple(r) for r in current_rows(spark, merged).collect()} == {tuple(r) for r in rows.collect()}
    assert add_layer(folder, "m3", raw(("9", "X")), raw(("9", "X")), "s").count() == 0
    with pytest.raises(ValueError, match="adds or removes"):
        add_layer(folder, "m4", None, None, "s")
