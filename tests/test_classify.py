import random

import pytest
from pyspark.sql import functions as F

from textmart import rules as R
from textmart.functions import classify as C

TITLES = [
    ("Engenheiro(a) de Dados", "Data Engineer"),
    ("Estagiário de Ciência de Dados", "Data Scientist"),
    ("Estágio - Dados", "Data Intern"),
    ("Tech Lead Backend", "Data Leadership"),
    ("Coordenador de Dados de Mercado", "Data Leadership"),
    ("Analista de Governança de Dados", "Data Governance"),
    ("Analista de Gestão de Dados", "Not Data Role"),
    ("Analista de BI", "BI Analyst"),
    ("BI Analyst", "BI Analyst"),
    ("BI Developer", "Not Data Role"),
    ("Senior BI Developer", "BI Analyst"),
    ("Data & Analytics Specialist", "BI Analyst"),
    ("Data Analytics Engineer", "Analytics Engineer"),
    ("Banco de Talentos - Data Engineer", "Data Talent Pool"),
    ("International Sales", "Data Intern"),
    ("", "Not Data Role"),
    (None, "Not Data Role"),
]
LEVELS = [
    ("ANALISTA DE DADOS PL", ["pleno"]),
    ("Engenheiro de Dados Jr.", ["junior"]),
    ("Engenheiro de Dados Pleno/Sênior", ["pleno", "senior"]),
    ("Estágio - Dados", ["estagio"]),
    ("Midlevel Analytics Engineer", ["pleno"]),
    ("Analista de Dados", ["nao_especificado"]),
    ("Engenharia de Dados & Analytics Senior", ["senior"]),
    ("Staff Engineer|Jr", ["junior", "senior"]),
    ("International Data Analyst", ["nao_especificado"]),
    ("Data Science Internship", ["estagio"]),
    (None, ["nao_especificado"]),
]
NAMES = [
    ("SQL", "Sql"),
    ("GCP", "Google Cloud Platform"),
    ("Spark", "Apache Spark"),
    ("Databricks SQL", "Databricks"),
    (" Big Query ", "Google BigQuery"),
    ("PL/SQL", "Pl/Sql"),
    ("MongoDB", "Mongodb"),
    ("Azure Cosmos", "Azure Cosmos DB"),
    ("Comunicação Escrita", "Comunicação"),
    ("Excel Avançado", "Microsoft Excel"),
    ("análise  estatística ", "Análise  Estatística"),
]
MODES = [
    (("Vaga remoto", None, None), "remoto"),
    (("Home office", None, None), "remoto"),
    (("work from anywhere", "", None), "remoto"),
    (("100% remoto", None, None), "remoto"),
    (("Vaga remota", None, None), None),
    (("Vaga híbrida", None, None), None),
    (("Home-office", None, None), None),
    ((None, "", None), None),
    (("Híbrido", None, None), "hibrido"),
    (("Remoto", "São Paulo", "reuniões no local"), "hibrido"),
    (("On-site", None, None), "presencial"),
    (("Function site owner", None, None), "presencial"),
    (("no", None, "local"), "presencial"),
]


def test_positions(rows):
    assert rows([t for t, _ in TITLES], C.position_group) == [g for _, g in TITLES]


def test_positions_are_idempotent(rows):
    groups = list(dict.fromkeys([g for g, _ in R.POSITION_RULES] + [R.POSITION_DEFAULT]))
    assert len(groups) == 12
    assert rows(groups, C.position_group) == groups


def test_levels(rows):
    assert rows([t for t, _ in LEVELS], C.levels) == [v for _, v in LEVELS]


def test_names(rows):
    assert rows([t for t, _ in NAMES], C.standardize_name) == [v for _, v in NAMES]


def test_modes(rows):
    schema = "a STRING, b STRING, c STRING"
    assert rows([p for p, _ in MODES], C.work_mode, schema) == [m for _, m in MODES]


def test_skill_type(rows):
    values = ["Comunicação", "TRABALHO EM EQUIPE", "Python", None]
    assert rows(values, C.skill_type) == ["soft", "soft", "tecnica", "tecnica"]


def test_labels(rows):
    assert rows(["pleno", "x"], lambda c: C.lookup_or_self(c, R.LEVEL_LABELS)) == ["Pleno", "x"]


@pytest.fixture
def rule_table(spark):
    rows = [(i, k, label) for i, (label, ks) in enumerate(R.POSITION_RULES) for k in ks]
    return spark.createDataFrame(rows, "priority INT, keyword STRING, label STRING")


def test_rule_join_equals_cascade(spark, rule_table):
    rng = random.Random(5)
    words = sorted({w for _, ks in R.POSITION_RULES for k in ks for w in k.split()}) + ["x"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 7))) for _ in range(400)]
    texts += [k for _, ks in R.POSITION_RULES for k in ks] + ["a", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    rules = C.cascade_from_table(rule_table)
    assert rules == [(label, list(ks)) for label, ks in R.POSITION_RULES]
    chain = df.select("i", C.rule_cascade(F.col("t"), rules, "none").alias("o"))
    join = C.rule_join_first_match(df, "t", rule_table, "o", "none").select("i", "o")
    assert sorted(map(tuple, chain.collect())) == sorted(map(tuple, join.collect()))


def test_rule_join_without_rules(spark, rule_table):
    df = spark.createDataFrame([("x",)], "t STRING")
    out = C.rule_join_first_match(df, "t", rule_table.where("false"), "o", "none")
    assert [tuple(r) for r in out.collect()] == [("x", "none")]


def test_map_join(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k STRING, n INT")
    table = spark.createDataFrame([("a", "A")], "key STRING, value STRING")
    out = C.map_join(df, "k", table, "v", F.col("k"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("a", 1, "A"), ("b", 2, "b"), (None, 3, None)], key=str
    )
