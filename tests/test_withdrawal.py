"""Withdrawal scope after scope against the plain fixpoint, and the gate of bank plans."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quillbank.operators import linking, withdrawal


def plain(easy: dict, scopes: list[tuple], times: int) -> dict:
    """Passes over all scopes until one changes nothing."""
    gone, kept = set(easy), {}
    changed = True
    while changed:
        changed = False
        for name, ids, need in scopes:
            left = len(ids - gone)
            if left < times * need:
                for i in sorted((i for i in ids if i in gone), key=lambda i: (easy[i], i))[: times * need - left]:
                    gone.discard(i)
                    kept[i] = name
                    changed = True
    return kept


@pytest.mark.parametrize("seed", range(4))
def test_withdrawal_by_the_plain_fixpoint(spark, seed):
    rng = random.Random(seed)
    easy = {i: rng.randrange(20, 26) for i in range(300) if rng.random() < 0.7}
    scopes = [(f"s{k}", set(rng.sample(range(300), rng.randrange(0, 120))), rng.randrange(0, 14)) for k in range(12)]
    rows = [(n, i) for n, ids, _ in scopes for i in ids]
    needs = [(n, (k, 0, 0), need) for k, (n, _, need) in enumerate(scopes)]
    got = withdrawal.ordered_withdrawal(
        spark.createDataFrame(list(easy.items()), "item_id long, score long"), spark.createDataFrame(rows, "scope string, item_id long").repartition(5),
        spark.createDataFrame(needs, "scope string, place struct<part: long, block: long, norm: long>, need long"), 8,
    ).collect()
    want = plain(easy, scopes, 8)
    assert {r["item_id"]: r["kept_by"] for r in got} == {i: want.get(i) for i in easy} and want


def test_nothing_is_short(spark):
    easy = spark.createDataFrame([(1, 30)], "item_id long, score long")
    none = spark.createDataFrame([], "scope string, place struct<part: long, block: long, norm: long>, need long")
    assert [tuple(r) for r in withdrawal.ordered_withdrawal(easy, spark.createDataFrame([("a", 1)], "scope string, item_id long"), none, 8).collect()] == [(1, 30, None)]


def test_gate_by_call_and_together(spark):
    calls = spark.createDataFrame([(1,), (2,), (3,)], "call_id long")
    plan = spark.createDataFrame([(1, "ADD"), (1, "RETIRE"), (2, "ADD")], "call_id long, action string")
    bad = spark.createDataFrame([(2, "PART", 4), (2, "TYPE", 1)], "call_id long, incident string, n long")
    rows = {r["call_id"]: r for r in linking.gate(calls, plan, bad).collect()}
    assert {k: (r["add"], r["retire"], r["incidents"], r["vetoed"]) for k, r in rows.items()} == {1: (1, 1, 0, False), 2: (1, 0, 5, True), 3: (0, 0, 0, False)}
    assert all(r["vetoed"] for r in linking.gate(calls, plan, bad, together=True).collect())
    assert not any(r["vetoed"] for r in linking.gate(calls, plan, bad.filter("false"), together=True).collect())


def test_every_incident_of_stored_links(spark):
    items = spark.createDataFrame([(1, "JURIDICA", "TEORICA"), (2, "INFORMATICA", None), (3, "JURIDICA", " practica")], "item_id long, kind string, theory_practice string")
    topics = spark.createDataFrame([(10, 1), (20, 2)], "topic_id long, call_id long")
    rules = spark.createDataFrame([(2, "PRACTICA"), (1, "TEORICA")], "call_id long, theory_practice string")
    links = spark.createDataFrame([(1, 1, 5, "JURIDICA", 10), (1, 2, None, "JURIDICA", 10), (1, 3, 5, "JURIDICA", 20), (2, 3, 5, "NO_JURIDICA", None), (2, 1, 5, "JURIDICA", 20), (2, 1, 5, "JURIDICA", 20)], "call_id long, item_id long, part_id long, link_type string, topic_id long")
    got = {(r["call_id"], r["incident"], r["n"]) for r in linking.bank_incidents(links, items, topics, rules).collect()}
    assert got == {(1, "PART", 1), (1, "TYPE", 1), (1, "OTHER_CALL", 1), (1, "PRACTICE", 1), (2, "TYPE", 1), (2, "TOPIC", 1), (2, "REPEATED", 1)}


def test_article_forms_are_those_of_each_row(spark):
    rows = spark.createDataFrame([(1, "Art. 5.1"), (2, None), (3, "5"), (4, "Art. 5.1"), (5, "anexo")], "id long, a string")
    got = {r["id"]: (r["base"], r["full"]) for r in linking.article_forms(rows, "a").collect()}
    want = {r["id"]: (r["base"], r["full"]) for r in rows.select("id", linking.article_base(F.col("a")).alias("base"), linking.article_full(F.col("a")).alias("full")).collect()}
    assert got == want and got[1] == got[4]
