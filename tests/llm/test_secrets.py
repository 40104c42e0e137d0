"""Secrets against a plain version: base patterns by the words of the contract, weak parts by comparing all pairs."""

from __future__ import annotations

import random

import pytest

from tests.llm import brute
from vinculo.llm import secrets

HEX = "0123456789abcdef" * 2
KEY = "AKIA" + "ABCDEFGH12345678"
MIXED = "wJalrXUtnFEMIK7MDENGbPxRfiCYzz99"


def texts():
    rng = random.Random(5)
    parts = [" ", "\n", ": ", " = ", '"', "'", "token", "PassWord", "api_key", "apikey", "secret", "AKIA", KEY, HEX, "face", MIXED, "hunter2x", "é", "\U0001f600"]
    parts += ["user: root", "login=x", "username = 'adm'", "https://a.example.org/x?y=1", "host: db.example.org", "passwd:", "=", "ASIA1234567890", "x" * 60, "\x0b"]
    fixed = [None, "", f"token={HEX}", f"password: secret: {MIXED}", KEY + KEY, "AKIA" + "B" * 13, "AKIA" + "B" * 14, "a" + HEX + "g" + HEX[:15], f"é{HEX}é{KEY}"]
    fixed += ["user: root and then pass: hunter2x", "user: root" + " " * 500 + "pass: hunter2x", f"{MIXED} alone", f"{MIXED} https://h.example/x login=bob", HEX * 300]
    return fixed + ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(1500)]


@pytest.mark.parametrize("reach", [0, 15, 200])
def test_spans(spark, reach):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    got = {r["doc_id"]: [(s["start"], s["kind"], s["stop"]) for s in r["spans"]] for r in secrets.find_secrets(docs, reach).collect()}
    for doc_id, text in rows:
        assert got[doc_id] == brute.secret_spans(text, reach), text


def test_weak_parts_need_their_complements(spark):
    rows = [(1, "login: bob, pass: hunter2x"), (2, "pass: hunter2x"), (3, "login: bob"), (4, "see https://a.example.org/x"), (5, "login: bob, pass: hunter2x at https://a.example.org/x")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    kinds = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secrets.find_secrets(docs).collect()}
    assert kinds == {1: ["identifier", "secret"], 2: [], 3: [], 4: [], 5: ["identifier", "secret", "endpoint"]}


def test_odd_rows(spark):
    rows = brute.odd_rows() + [(None, KEY, 1, None, None, None, None), (9, KEY, 1, None, None, None, None), (9, KEY, 1, None, None, None, None), (9, HEX, 1, None, None, None, None)]
    docs = spark.createDataFrame(rows, brute.ODD_SCHEMA).repartition(3)
    got = [(r["doc_id"], str([(s["start"], s["kind"], s["stop"]) for s in r["spans"]])) for r in secrets.find_secrets(docs).collect()]
    assert brute.same(got, [(r[0], str(brute.secret_spans(r[1], secrets.REACH))) for r in rows])


def test_nothing(spark):
    assert secrets.find_secrets(spark.createDataFrame([], brute.ODD_SCHEMA)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id int, text string")
    plan = secrets.find_secrets(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
