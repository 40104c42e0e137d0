"""Column functions against plain-Python statements of the same rules."""

import datetime as dt
import hashlib
import hmac
import random

import pyarrow as pa
import pytest
from dateutil.relativedelta import relativedelta
from pyspark.sql import functions as F

from vinculo import functions as V
from vinculo.functions.similarity import lcs_length, where_alike
from vinculo.functions.subsequence import lcs_lengths


def column_of(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = frame.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [row["r"] for row in rows]


def test_normalize_name(spark):
    cases = {
        "  João  d'Ávila\tNúñez ": "JOAO D'AVILA NUNEZ",
        "straße øre Æsir łódź": "STRASSE ORE AESIR LODZ",
        "é n o p": "E N O P",
        "Nguyễn Đức": "NGUYEN DUC",
        "plain name": "PLAIN NAME",
        "": "",
        None: None,
        "\n\x1c": "",
    }
    assert column_of(spark, list(cases), V.normalize_name) == list(cases.values())
    assert column_of(spark, list(cases), V.has_name) == [bool(value) for value in cases.values()]


def test_digits_and_fragments(spark):
    texts = ["529.982.247-25", "***982247**", "12345", "", None, "٣12"]
    assert column_of(spark, texts, V.digits_only) == ["52998224725", "982247", "12345", "", None, "12"]
    assert column_of(spark, texts, V.roster_fragment) == ["982247", "", "", "", None, ""]
    documents = ["52998224725", "982247", "1234567", "12345", "", None, "12345678000199"]
    assert column_of(spark, documents, V.registry_fragment) == ["982247", "982247", "234567", "", "", None, "456780"]


def python_cpf(text):
    digits = "".join(c for c in text if c in "0123456789")
    if len(digits) != 11 or len(set(digits)) == 1:
        return ""
    for n in (9, 10):
        check = sum(int(digits[i]) * (n + 1 - i) for i in range(n)) * 10 % 11
        if int(digits[n]) != (0 if check == 10 else check):
            return ""
    return digits


def test_clean_cpf(spark):
    rng = random.Random(7)
    values = ["529.982.247-25", "111.111.111-11", "123", "529.982.247-26", "", "52998224725 "]
    for _ in range(3000):
        base = [rng.randrange(10) for _ in range(9)]
        for n in (9, 10):
            check = sum(base[i] * (n + 1 - i) for i in range(n)) * 10 % 11
            base.append(0 if check == 10 else check)
        if rng.random() < 0.5:
            base[rng.randrange(11)] = rng.randrange(10)
        values.append("".join(map(str, base)))
    assert column_of(spark, values, V.clean_cpf) == [python_cpf(v) for v in values]
    assert column_of(spark, [None], V.clean_cpf) == [None]


@pytest.mark.parametrize("salt", ["pepper", "s" * 64, "long " * 30, "çãé"])
def test_keyed_hash(spark, salt):
    values = ["52998224725", "  x ", "ação", "", "   ", None]
    expected = [
        None if v is None else hmac.new(salt.encode(), v.strip().encode(), hashlib.sha256).hexdigest() if v.strip() else ""
        for v in values
    ]
    assert column_of(spark, values, lambda c: V.keyed_hash(c, salt)) == expected


def test_keyed_hash_needs_a_salt():
    with pytest.raises(ValueError):
        V.keyed_hash(None, "")


def test_dates(spark):
    day = dt.date(1990, 3, 5)
    roster = ["05/03/1990", "05-03-1990", "1990-03-05", "1990-03-05 00:00:00", "31/02/1990", "", None, " 05/03/1990 "]
    assert column_of(spark, roster, V.parse_roster_date) == [day, day, day, day, None, None, None, day]
    registry = ["1990-03-05", "19900305", "00000000", "0", "", None, "20200230", "05/03/1990"]
    assert column_of(spark, registry, V.parse_registry_date) == [day, day, None, None, None, None, None, None]
    assert column_of(spark, ["2020-01-05 10:00:00", "x"], V.safe_date) == [dt.date(2020, 1, 5), None]
    assert column_of(spark, [dt.date(1999, 12, 31), dt.date(2000, 1, 1), None], V.decade, "date") == [1990, 2000, None]


def test_age_years(spark):
    rng = random.Random(3)
    start = dt.date(1930, 1, 1)
    pairs = [(dt.date(2000, 2, 29), dt.date(2021, 2, 28)), (dt.date(2021, 6, 1), dt.date(2021, 1, 1))]
    for _ in range(4000):
        pairs.append((start + dt.timedelta(rng.randrange(36000)), start + dt.timedelta(rng.randrange(36000))))
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, born date, at date")
    rows = frame.select("i", V.age_years(F.col("born"), F.col("at")).alias("r")).orderBy("i").collect()
    assert [row["r"] for row in rows] == [relativedelta(at, born).years for born, at in pairs]


def test_age_bucket(spark):
    ages = [17, 18, 24, 25, 34, 35, 64, 65, 199, 200, -1, 0, None]
    expected = ["<18", "18-24", "18-24", "25-34", "25-34", "35-44", "55-64", "65+", "65+", "IGNORADO", "IGNORADO", "<18", None]
    assert column_of(spark, ages, V.age_bucket, "int") == expected


def python_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], previous + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def python_ratio(x, y):
    a, b = set(x.split()), set(y.split())
    if not a or not b:
        return 0.0
    both = " ".join(sorted(a & b))
    left, right = " ".join(sorted(a - b)), " ".join(sorted(b - a))
    if both and (not left or not right):
        return 100.0
    joint = 1 if both else 0
    distance = len(left) + len(right) - 2 * python_lcs(left, right)
    best = 100 - 100 * distance / (2 * len(both) + 2 * joint + len(left) + len(right))
    if both:
        for rest in (left, right):
            best = max(best, 100 - 100 * (1 + len(rest)) / (2 * len(both) + 1 + len(rest)))
    return best


WORDS = "ANA MARIA JOSE JOAO SILVA SOUZA SOUSA LIMA LIMAS DA DE E CAVALCANTI CAVALCANTE PEREIRA PEREIRAS OLIVEIRA".split()


def random_name(rng):
    words = [rng.choice(WORDS) for _ in range(rng.randrange(1, 6))]
    if rng.random() < 0.5:
        at = rng.randrange(len(words))
        word = words[at]
        place = rng.randrange(len(word))
        words[at] = word[:place] + rng.choice(["", "A", "X", "E"]) + word[place + rng.randrange(2):] or "A"
    return " ".join(words)


def test_lcs_of_any_length(spark):
    rng = random.Random(5)
    pairs = [("", ""), ("", "AB"), ("A", "A")]
    for longest in (5, 61, 62, 63, 64, 130, 200):
        for _ in range(20):
            pairs.append(tuple("".join(rng.choice("ABC ") for _ in range(rng.randrange(longest + 1))) for _ in "xy"))
        pairs.append(("A" * longest, "A" * (longest + 3)))
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, x string, y string")
    rows = frame.select("i", lcs_length(F.col("x"), F.col("y")).alias("r")).orderBy("i").collect()
    assert [row["r"] for row in rows] == [python_lcs(x, y) for x, y in pairs]


def test_token_set_ratio(spark):
    rng = random.Random(11)
    pairs = [("JOAO SILVA", "JOAO SILVA SOUZA"), ("ANA LIMA", "CARLOS COSTA"), ("", "ANA"), ("ANA", ""), ("A A", "A")]
    pairs += [(random_name(rng), random_name(rng)) for _ in range(3000)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, x string, y string")
    x, y = V.name_tokens(F.col("x")), V.name_tokens(F.col("y"))
    rows = frame.select(
        "i",
        V.token_set_ratio(x, y).alias("r"),
        V.token_set_match(x, y, 90).alias("m90"),
        V.token_set_match(x, y, 80).alias("m80"),
    ).orderBy("i").collect()
    scores = [python_ratio(x, y) for x, y in pairs]
    assert [round(row["r"], 9) for row in rows] == [round(score, 9) for score in scores]
    assert [row["m90"] for row in rows] == [score >= 90 for score in scores]
    assert [row["m80"] for row in rows] == [score >= 80 for score in scores]
    assert sum(score >= 90 for score in scores) > 100


def test_batched_lcs():
    rng = random.Random(6)

    def text(longest):
        return "".join(rng.choice("ABCÉ中\U0001f600 ") for _ in range(rng.randrange(longest + 1)))

    pairs = [(text(n), text(m)) for n in (4, 63, 64, 65, 129, 300) for m in (4, 64, 128, 300) for _ in range(8)]
    pairs += [("A" * n, "A" * (n + 1)) for n in (63, 64, 65, 128, 129)] + [("", ""), ("", "A"), (None, "A"), ("A", None)]
    columns = [pa.array(side, pa.string()) for side in zip(*pairs, strict=True)]
    expected = [python_lcs(x, y) if x is not None and y is not None else 0 for x, y in pairs]
    assert lcs_lengths(*columns).tolist() == expected
    assert lcs_lengths(*[c.slice(3, 40) for c in columns]).tolist() == expected[3:43]
    assert lcs_lengths(pa.array([], pa.string()), pa.array([], pa.string())).tolist() == []


def test_token_set_ratio_in_batches(spark):
    rng = random.Random(12)
    pairs = [("JOAO SILVA", "JOAO SILVA SOUZA"), ("", "ANA"), ("ANA", ""), ("A A", "A"), ("A" * 80 + " B", "B " + "A" * 70 + "C")]
    pairs += [(random_name(rng), random_name(rng)) for _ in range(1500)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, x string, y string")
    rows = V.with_token_set_ratio(frame, F.col("x"), F.col("y"), "r").orderBy("i").collect()
    assert [round(row["r"], 9) for row in rows] == [round(python_ratio(x, y), 9) for x, y in pairs]
    for threshold in (70, 90):
        kept = where_alike(frame, V.name_tokens(F.col("x")), V.name_tokens(F.col("y")), threshold)
        assert sorted(r["i"] for r in kept.collect()) == [i for i, (x, y) in enumerate(pairs) if python_ratio(x, y) >= threshold]


def test_plans_do_not_show_the_salt(spark):
    from vinculo.functions.privacy import _padded_keys, keyed_hash

    frame = spark.createDataFrame([("123",), ("",), (None,)], "v string").select(keyed_hash(F.col("v"), "SECRET").alias("h"))
    assert frame.where("length(h) = 64").count() == 1
    plan = frame._jdf.queryExecution().toString().lower()
    for pad in _padded_keys("SECRET"):
        assert pad.hex()[:24] not in plan
        assert pad[:12].decode("latin-1").lower() not in plan
