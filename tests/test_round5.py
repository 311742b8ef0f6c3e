"""What the review of round 3 found: jobs that outgrow their disk, time or memory."""

from __future__ import annotations

import difflib
import random

from quillbank.operators import duplicates as dd
from quillbank.operators import linking as lk
from quillbank.plans.fixtures import tables


def _ratio(a: str, b: str) -> float:
    return round(difflib.SequenceMatcher(None, a, b, False).ratio(), 6)


def _sentences(rng: random.Random, n: int) -> list[str]:
    words = ["el", "plazo", "de", "diez", "días", "norma", "art", "según", "ley", "recurso"]
    some = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 6, 15, 40]))) for _ in range(n)]
    return [t if rng.random() < 0.5 else "".join(x for x in t if rng.random() < 0.95) or "a" for t in some + some]


def test_texts_of_one_id_match_on_their_own(spark):
    """A document's sentences share its id; each of them is compared, in chunks and in blocks."""
    rng = random.Random(4)
    texts = _sentences(rng, 60)
    new = [(k, k % 2, t) for k, t in enumerate(texts[:60])]
    pool = [(k // 8, k % 2, t) for k, t in enumerate(texts[60:])] + [(3, None, texts[0]), (3, 0, None), (3, 0, "")]
    x, y = spark.createDataFrame(new, "item_id long, b long, t string"), spark.createDataFrame(pool, "item_id long, b long, t string")
    for block in ([], ["b"]):
        want = {}
        for k, b, t in new:
            best = max(((_ratio(t, u), -m) for m, c, u in pool if u and (not block or b == c)), default=(0.0, 0))
            want[k] = (-best[1], best[0]) if best[0] >= 0.8 else (None, None)
        assert {r[0]: tuple(r)[1:3] for r in dd.originality_check(x, y, block, 0.9, 0.8).collect()} == want
        assert sum(m is not None for m, _ in want.values()) > 30


def test_many_chunks_give_all_pairs(spark, monkeypatch):
    rng = random.Random(5)
    texts = _sentences(rng, 40)
    left, right = [(k, t) for k, t in enumerate(texts[:40])], [(k, t) for k, t in enumerate(texts[40:])]
    monkeypatch.setattr(dd, "_HELD", 300)
    x, y = spark.createDataFrame(left, "id long, t string"), spark.createDataFrame(right, "id long, t string")
    out = dd.matches_between(x, y, [], 0.85, True)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    want = sorted((k, m, _ratio(t, u)) for k, t in left for m, u in right if _ratio(t, u) >= 0.85)
    assert sorted(map(tuple, out.collect())) == want
    monkeypatch.setattr(dd, "_HITS", 50)
    for least in (0.5, 0.7, 0.85, 0.97):
        got = dd._Held([k for k, _ in left], [t for _, t in left], least).matches([t for _, t in right], True)
        assert sorted((h, u, round(s, 6)) for u, h, s in got if s >= least) == sorted((k, m, _ratio(t, u)) for k, t in left for m, u in right if _ratio(t, u) >= least)


def test_common_subsequences_of_many():
    rng = random.Random(6)
    pairs = [tuple("".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 9, 63, 64, 65, 200]))) for _ in "ab") for letters in ("abc ñ", "ab😀\x00\x01") for _ in range(200)]
    assert dd.common_subsequences(pairs).tolist() == [dd.common_subsequence(*p) for p in pairs]
    for a, b in pairs[:40]:
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0] + [max(row[j + 1], 0, row[j] + 1 if x == b[j] else 0) for j in range(len(b))]
            for j in range(len(b)):
                row[j + 1] = max(row[j + 1], row[j])
        assert row[-1] == dd.common_subsequence(a, b)


def test_plans_make_their_rows_once(spark):
    """Parts are resolved for the attributes of topics and items, so the rows of a plan aren't matched a second time for theirs."""
    frames = tables(spark, "/root/testdata/sf0.001", "f_items", "f_exclusions", "f_refs", "f_topics", "f_part_rules", "f_bank_links", "f_category_topics")
    plan = lk.bank_plan(*frames)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftAnti") == 3
    assert plan.filter("action = 'ADD'").count() > 0
