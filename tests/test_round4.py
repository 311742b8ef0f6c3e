"""What the third review found: jobs that grew faster than their input."""

from __future__ import annotations

import duckdb
import numpy as np
from pyspark.sql import functions as F
from quillbank.operators import audits as au
from quillbank.operators import duplicates as dd
from quillbank.operators import extract as ex
from quillbank.operators import withdrawal as wd
from quillbank.plans.catalogue import ORACLE_SQL, QUERIES

from tests.oracle import same


def test_ranks_in_small_blocks_are_whole(spark):
    """Blocks of four articles give the best of all, ties by id."""
    rng = np.random.default_rng(3)
    words = lambda n: [f"w{k}" for k in sorted(set(rng.integers(0, 30, n).tolist()))]
    articles = [(int(k), int(k % 2), words(12)) for k in range(40)]
    items = [(int(k), int(k % 3), words(6)) for k in range(20)]
    held = spark.createDataFrame(articles, "article_id long, norm_id long, t array<string>").select("article_id", "norm_id", F.transform("t", lambda x: F.xxhash64(x)).alias("h"))
    asked = spark.createDataFrame(items, "item_id long, norm_id long, t array<string>").select("item_id", "norm_id", F.transform("t", lambda x: F.xxhash64(x)).alias("h"), F.transform("t", lambda x: F.lit(1.0)).alias("w"), F.lit(1.0).alias("whole"))
    rows = dd._best_of_blocks(asked, held, 3, lambda s, whole: s, 4).collect()
    for item, norm, t in items:
        want = sorted((-len(set(t) & set(u)), a) for a, n, u in articles if n == norm and set(t) & set(u))[:3]
        assert sorted((-r.s, r.article_id) for r in rows if r.item_id == item)[:3] == want
    assert len(rows) > 3 * len({i for i, n, _ in items if n < 2})


def test_textuality_meets_in_tasks(spark):
    """Keys of all lengths as by hand; items and texts of an article are never joined."""
    texts = ["", "a", "Uno  dos TRES", "x" * 20 + " final " + "y" * 20, "el plazo de diez días hábiles cuenta", None]
    keys = ["", "a", "u", "uno dos", "tres cuatro", "xx final yy", "x" * 21, "plazo de  DIEZ días hábiles", None, "zzz"]
    items = [(k, 1 + k % 3, 1, *[key] * 4, "ABCDX"[k % 5]) for k, key in enumerate(keys * 6)]
    articles = [(n, 1, t) for n in (1, 2) for t in texts[3 * n - 3 : 3 * n]]
    low = lambda x: " ".join((x or "").lower().split())
    want = {}
    for _, n, _, key, *_ in items:
        mine = [low(t) for m, _, t in articles if m == n]
        state = "NO_TEXT" if not mine else "LITERAL" if any(low(key) in t for t in mine) else "NOT_LITERAL"
        want[state] = want.get(state, 0) + 1
    got = au.textuality(spark.createDataFrame(items, "item_id long, norm_id long, article_no int, opt_a string, opt_b string, opt_c string, opt_d string, answer_key string"), spark.createDataFrame(articles, "norm_id long, article_no int, text string"))
    assert {r.state: r.n for r in got.collect()} == want
    assert "contains" not in got._jdf.queryExecution().toString().lower()


def test_chunks_stream(spark):
    """A key's rows aren't collected to one array."""
    rows = spark.range(20000).select(F.lit("k").alias("key"), F.col("id").alias("row_id"), (F.col("id") * 7 % 11).alias("chars"))
    out = ex.pack_chunks(rows, 3, 12)
    assert "collect_list" not in out._jdf.queryExecution().toString()
    chunk = n = c = 0
    for r in sorted(out.collect(), key=lambda r: r.row_id):
        x = r.row_id * 7 % 11
        chunk, n, c = (chunk + 1, 1, x) if n and (n >= 3 or c + x > 12) else (chunk, n + 1, c + x)
        assert r.chunk == chunk


def test_matching_blocks_of_long_texts(monkeypatch):
    """Lists of runs and halving give difflib's sums."""
    rng = np.random.default_rng(5)
    for size in (0, 6, 1 << 21):
        monkeypatch.setattr(dd, "_LISTED", size)
        for _ in range(60):
            a, b = ("".join(rng.choice(list("abc "), int(rng.integers(0, 80)))) for _ in range(2))
            b = a[:30] + b[:9] + a[33:] if rng.random() < 0.5 else b
            assert dd._in_blocks(*dd._codes(list(a), list(b))) == dd._small(a, b)


def test_near_copies_match_quickly():
    """The longest blocks by pieces, and rejection by grams, agree with difflib; hashes of windows tell long texts apart."""
    rng = np.random.default_rng(7)
    a = "".join(rng.choice(list("abcdefgh "), 1500))
    for edits in (1, 5, 20, 80):
        b = a
        for k in rng.integers(0, 1400, edits):
            b = b[:k] + "xy"[: k % 3] + b[k + 1 :]
        for x, y in ((a, b), (b, a), (a[:300] * 4, b)):
            m = dd._small(x, y)
            assert dd.matched(x, y) == m
            assert dd.may_match(x, y, 0.94) or 2 * m < 0.94 * (len(x) + len(y))
    x, y = (rng.integers(0, 9, 3000) for _ in range(2))
    y[1000:1060] = x[500:560]
    assert dd._common(x, y)[0] >= 60
    assert not dd.may_match(a, "".join(sorted(a)), 0.94)


def test_exam_blocks_of_null_texts(spark, tmp_path):
    """A document without a text has its second block still."""
    rows = [(k, None if k == 3 else f"{'stem ' * 8}{'first xyz'} {'secondxyz'} the rest {k}") for k in range(1, 6)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    name = "tg21_split_exam_blocks"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    same(spark, con, QUERIES[name], ORACLE_SQL[name], str(tmp_path))


def test_withdrawal_step_holds_numbers_only(spark):
    """The sequential step gets sorted rows without places; a scope sees what earlier ones gave back."""
    easy = spark.createDataFrame([(k, k % 5) for k in range(12)], "item_id long, score long")
    scopes = spark.createDataFrame([(s, k) for s, m in (("b", 1), ("a", 2), ("c", 3)) for k in range(12) if k % m == 0], "scope string, item_id long")
    needs = spark.createDataFrame([("b", (1, 0, 0), 2), ("a", (2, 0, 0), 2), ("c", (3, 0, 0), 1)], "scope string, place struct<part:long,block:long,norm:long>, need long")
    out = wd.ordered_withdrawal(easy, scopes, needs, 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan
    kept: dict[int, str] = {}
    for s, m, need in (("b", 1, 2), ("a", 2, 2), ("c", 3, 1)):
        inside = sorted((k % 5, k) for k in range(12) if k % m == 0)
        short = 2 * need - sum(k in kept for _, k in inside)
        for _, k in [x for x in inside if x[1] not in kept][: max(0, short)]:
            kept[k] = s
    assert {r.item_id: r.kept_by for r in out.collect() if r.kept_by} == kept
