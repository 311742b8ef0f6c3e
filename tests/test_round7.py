"""Steps that grew faster than their input: results against brute force, and how much work they make."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from quillbank.operators import duplicates as dd
from quillbank.operators import linking


def _made(rng: random.Random, words: list[str]) -> str:
    return " ".join(rng.choice(words) for _ in range(rng.choice([1, 1, 2, 3, 8, 20])))


def _rows(n: int, seed: int) -> list[tuple]:
    """Texts of few words in few blocks, a half of them with an edit or two of an earlier one."""
    rng = random.Random(seed)
    words = ["ab", "c", "tion", "ing", "other", "the", "and", "ñu"]
    out = [(None, "", "the and other"), (1, "", ""), (2, "", None), (3, None, "the and other")]
    for k in range(n):
        t = _made(rng, words)
        if k % 2 and len(out) > 4:
            t = rng.choice(out[4:])[2]
            for _ in range(rng.choice([0, 1, 1, 2])):
                i = rng.randrange(len(t) + 1)
                t = t[:i] + rng.choice("xy ") + t[i + rng.randrange(2) :]
        out.append((10 + k, rng.choice(["", "", "", "b", "c"]), t.strip() or "x"))
    # the same ids stand in other blocks too
    return out + [(i, "d", f"{t} {t}") for i, _, t in out[4::3]] + [(i + 1, "d", f"{t} {t} y") for i, _, t in out[4::3]]


def _brute(rows: list[tuple], least: float) -> list[tuple]:
    least_id: dict[tuple, int] = {}
    for i, b, t in rows:
        if i is not None and b is not None and t:
            least_id[b, t] = min(i, least_id.get((b, t), i))
    every = [(b, i, t, {f" {t} "} if len(t) < 4 else {f" {t} "[k : k + 5] for k in range(len(t) - 2)}) for (b, t), i in least_id.items()]
    out = []
    for b, i, t, x in every:
        for c, j, u, y in every:
            if b == c and i < j and min(len(t), len(u)) >= 0.72 * max(len(t), len(u)) and round(2 * len(x & y) / (len(x) + len(y)), 6) >= least:
                out.append((i, j, round(2 * len(x & y) / (len(x) + len(y)), 6)))
    return sorted(out)


def test_near_duplicates_by_grams_are_all_pairs(spark):
    rows = _rows(500, 7)
    frame = spark.createDataFrame(rows, "item_id long, b string, x string").repartition(3)
    for least in (0.94, 0.8):
        want = _brute(rows, least)
        got = dd.near_duplicates_ngram(frame, ["b"], F.col("x"), least)
        assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 40


def test_near_duplicates_of_frequent_grams_meet_few_others(spark):
    rng = random.Random(3)
    words = [a + b + c for a in "aei" for b in "nst" for c in "aeo"]
    texts = {i: " ".join(rng.choice(words) for _ in range(28)) for i in range(3000)}
    rows = [(i, "", t) for i, t in texts.items()] + [(5000 + i, "", texts[i] + " x") for i in range(0, 3000, 10)]
    frame = spark.createDataFrame(rows, "item_id long, b string, t string")
    # 5.4 million pairs of a block, 300 of them alike
    found = dd._may_be_alike(frame, ["b"], 0.94 - 1e-6, 5)
    assert found.count() < 400
    assert dd.near_duplicates_ngram(frame, ["b"], F.col("t")).count() == 300


def test_near_duplicates_normalise_each_text_once(spark):
    frame = spark.createDataFrame([(1, "", "Uno  dos"), (2, "", "uno dos tres")], "item_id long, b string, x string")
    plan = dd.near_duplicates_ngram(frame, ["b"], F.regexp_replace(F.lower("x"), " +", " "))._jdf.queryExecution().optimizedPlan().toString()
    # no line holds it in a lambda of each gram
    assert all(line.count("regexp_replace") <= 1 for line in plan.splitlines()) and "lambdafunction" not in plan


def test_topics_are_resolved_by_as_many_tasks_as_items_need(spark, monkeypatch):
    monkeypatch.setattr(linking, "_ITEMS", 50, raising=False)
    # every tenth item stands twice, with another article
    items = spark.range(1000).selectExpr("id AS item_id", "id % 7 AS norm_id", "CAST(id % 5 + 1 AS STRING) AS article_n")
    items = items.union(items.filter("item_id % 10 = 0").selectExpr("item_id", "norm_id", "CAST(item_id % 5 + 2 AS STRING)"))
    refs = spark.range(7 * 6 * 3).selectExpr("id AS ref_id", "id % 3 AS call_id", "id % 3 * 100 + id % 4 AS topic_id", "id % 7 AS norm_id", "CAST(id % 6 + 1 AS STRING) || IF(id % 4 = 1, '.1', '') AS article_asked")
    topics = spark.range(400).selectExpr("id AS topic_id", "'P' AS part", "id AS number", "'t' AS title", "'J' AS content_type")
    out = linking.resolve_topic(items, linking.located_refs(refs, topics))
    got = {(r.call_id, r.item_id): (r.topic_id, r.reason) for r in out.collect()}
    asked = [tuple(r) for r in items.collect()]
    there = [tuple(r) for r in refs.select("call_id", "topic_id", "norm_id", "article_asked").collect()]
    every: dict = {}
    for i, n, x in asked:
        for c, t, m, y in there:
            if n == m and x == y.split(".")[0]:
                every.setdefault((c, i), []).append((t, x == y))
    one = lambda s: next(iter(s)) if len(s) == 1 else None
    topic = {k: one({t for t, _ in v}) or one({t for t, e in v if e}) for k, v in every.items()}
    assert got == {k: (t, None if t else "AMBIGUOUS") for k, t in topic.items()} and None in topic.values()
    tasks = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 16 and max(r["count"] for r in tasks) < 300
