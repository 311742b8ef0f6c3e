"""Steps that grew faster than their input: results against brute force, and how much work they make."""

from __future__ import annotations

import difflib
import math
import random
import time
from pathlib import Path

import __spark_entry__ as entry
from quillbank.operators import duplicates as dd
from quillbank.operators import withdrawal as wd


def _shuffled(spark, job) -> tuple[list, int]:
    """Rows of a job, and how many records its stages shuffled."""
    store, jvm = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jvm
    none = jvm.java.util.ArrayList()

    def stages() -> dict[int, int]:
        every = store.stageList(none, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), none)
        return {x.stageId(): x.shuffleWriteRecords() for x in (every.apply(k) for k in range(every.size()))}

    before = stages()
    rows = job().collect()
    return rows, sum(n for k, n in stages().items() if k not in before)


def test_idf_rank_is_brute_force_and_shuffles_no_pairs(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(40)]
    articles = [(k, 1 + k % 2, rng.sample(words, rng.randrange(0, 20)), k % 9) for k in range(700)]
    items = [(k, 1 + k % 3, rng.sample([*words, "none"], rng.randrange(0, 8)), k % 11) for k in range(600)]
    want = []
    for i, norm, tokens, article in items:
        of = [a for a in articles if a[1] == norm]
        idf = {t: math.log((len(of) + 1) / (sum(t in a[2] for a in of) + 1)) for t in tokens}
        whole = sum(idf.values()) or 1
        order = sorted((-round(sum(idf[t] for t in tokens if t in a[2]) / whole, 6), a[0]) for a in of)
        want += [(i, a, n + 1, -s) for n, (s, a) in enumerate(order[:3])]
        own = [a[0] for a in of if a[3] == article][:1]
        want += [(i, a, 4, None) for a in own if a not in [x for _, x in order[:3]]]
    frame = lambda rows, key: spark.createDataFrame(rows, f"{key} long, norm_id long, tokens array<string>, article int").repartition(3)
    blocks = dd._best_of_blocks
    monkeypatch.setattr(dd, "_best_of_blocks", lambda *x: blocks(*x[:4], 100))
    got, n = _shuffled(spark, lambda: dd.idf_rank(frame(items, "item_id"), frame(articles, "article_id"), 3))
    assert sorted((r["item_id"], r["rank"], r["article_id"], r["score"]) for r in got) == sorted((i, r, a, s) for i, a, r, s in want)
    # 140,000 pairs of an item and an article of its norm, nearly all of which have a word in common
    assert n < 60_000


def _edited(rng: random.Random, t: str, n: int) -> str:
    for _ in range(n):
        i = rng.randrange(len(t) + 1)
        t = t[:i] + rng.choice(["x", " other", t[:4]]) + t[i + rng.randrange(3) :]
    return t


def test_same_ids_in_several_blocks_are_rows_of_their_own(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("aeinst", k=rng.randrange(2, 8)))
    rows = []
    for k in range(24):
        t = " ".join(word() for _ in range(rng.randrange(3, 20)))
        rows += [(k, f"s{k % 7}", "one", t), (k + 1, f"s{k % 7}", "one", _edited(rng, t, 1)), (k, "again", "one", f"{t} {t}"), (k + 1, "again", "one", _edited(rng, f"{t} {t}", 1))]
    rows += rows[:5] + [(None, "s1", "one", "x"), (3, None, "one", "x"), (500, "s1", "", ""), (501, "s1", "", "y")]
    got = dd.near_duplicates_same_block(spark.createDataFrame(rows, "item_id long, stem string, a string, b string").repartition(3), ["stem"], ["a", "b"], 0.97)
    least: dict[tuple, int] = {}
    for i, *r in rows:
        if i is not None and None not in r:
            least[tuple(r)] = min(i, least.get(tuple(r), i))
    want = []
    for x, i in least.items():
        for y, j in least.items():
            if x[0] == y[0] and i < j:
                r = sum(difflib.SequenceMatcher(None, p, q, False).ratio() if p or q else 1.0 for p, q in zip(x[1:], y[1:], strict=True)) / 2
                want += [(i, j, round(r, 6))] if round(r, 6) >= 0.97 else []
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and len(want) > 20


def test_unlike_texts_are_left_early_and_alike_ones_matched_exactly():
    rng = random.Random(9)
    for _ in range(400):
        a = "".join(rng.choices(rng.choice(["ab", "abc ", "aeinst "]), k=rng.choice([0, 2, 40, 200])))
        b = _edited(rng, a, rng.choice([0, 1, 4, 20]))
        n = sum(m.size for m in difflib.SequenceMatcher(None, a, b, False).get_matching_blocks())
        assert dd.matched(a, b) == dd.matched(a, b, n) == n and dd.matched(a, b, n + 1) < n + 1
        r = 2 * n / (len(a) + len(b)) if a or b else 1.0
        assert dd.ratio_or_less(a, b, 0.9) == r if r >= 0.9 else dd.ratio_or_less(a, b, 0.9) < 0.9
    words = [f"{x}{y}" for x in ("an", "er", "in", "th") for y in ("al", "e", "ing", "s")]
    a, b = (" ".join(rng.choices(words, k=6000)) for _ in range(2))
    start = time.process_time()
    assert dd.matched(a, b, 0.94 * len(a)) < 0.94 * len(a)
    assert time.process_time() - start < 1


def test_bank_plan_keeps_and_shuffles_little(spark):
    from quillbank.functions.session import use_checkpoints

    use_checkpoints(spark)
    folder = Path(spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:"))
    size = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    before = size()
    rows, n = _shuffled(spark, lambda: entry.queries()["ch06_bank_plan"](spark, "/root/testdata/sf0.01").groupBy("action").count())
    # 60,000 items and 70,000 links; each item would take a hundred bytes and more as a checkpoint
    assert {r["action"] for r in rows} >= {"ADD", "REASSIGN", "RETIRE"}
    assert size() - before < 2_500_000 and n < 700_000, (size() - before, n)


def test_withdrawal_of_large_needs_goes_scope_by_scope(spark, monkeypatch):
    rng = random.Random(4)
    easy = [(i, rng.randrange(4)) for i in range(900)]
    scopes = [(f"s{k}", i) for k in range(7) for i in rng.sample(range(1000), 60 * (k + 1))]
    needs = [(f"s{k}", ((k * 3) % 7, 0, 0), 10 + 25 * ((k * 5) % 7)) for k in range(7)]
    schemas = "item_id long, score long", "scope string, item_id long", "scope string, place struct<part: long, block: long, norm: long>, need long"
    frames = [spark.createDataFrame(x, s).repartition(3) for x, s in zip((easy, scopes, needs), schemas, strict=True)]
    score, kept = dict(easy), {}
    for name, _, need in sorted(needs, key=lambda x: x[1]):
        inside = [i for s, i in scopes if s == name]
        out = sorted((score[i], i) for i in inside if i in score)
        short = 2 * need - len(inside) + len(out) - sum(i in kept for _, i in out)
        kept.update({i: name for _, i in [x for x in out if x[1] not in kept][: max(0, short)]})
    want = sorted((i, s, kept.get(i)) for i, s in easy)
    walked = []
    given_back = wd._given_back
    monkeypatch.setattr(wd, "_given_back", lambda *x: walked.append(1) or given_back(*x))
    for most in (1 << 20, 50):
        monkeypatch.setattr(wd, "_ROWS", most)
        assert sorted((r["item_id"], r["score"], r["kept_by"]) for r in wd.ordered_withdrawal(*frames, 2).collect()) == want
    assert walked == [1] and 50 < len(kept) < 900 and len(set(kept.values())) > 4


def test_short_texts_meet_by_bags_and_are_all_pairs():
    rng = random.Random(6)
    words = ["".join(rng.choices("aeinorst", k=rng.randrange(2, 7))) for _ in range(300)]
    held = [" ".join(rng.choices(words, k=rng.randrange(1, 15))) for _ in range(80)] + ["x" * 700, "aa", "é" * 40]
    others = [_edited(rng, t, rng.randrange(1, 6)) or "x" for t in held] + [" ".join(rng.choices(words, k=rng.randrange(1, 15))) for _ in range(60)]
    ratio = lambda a, b: 2 * sum(m.size for m in difflib.SequenceMatcher(None, a, b, False).get_matching_blocks()) / (len(a) + len(b))
    index = dd._Held(list(range(len(held))), held, 0.85)
    grams = dd._Held.candidates
    got = {(others[u], v): s for u, v, s in index.matches(others, True) if s >= 0.85}
    want = {(t, v): s for t in set(others) for v, h in enumerate(held) if (s := ratio(h, t)) >= 0.85}
    assert got == want and len(want) > 30
    # places of grams are listed for long texts only
    asked = []
    dd._Held.candidates = lambda self, texts, size: asked.extend(texts) or grams(self, texts, size)
    try:
        assert len(list(index.matches(others, True))) >= len(got)
    finally:
        dd._Held.candidates = grams
    assert asked and min(map(len, asked)) > 600


def test_words_of_a_reference_are_coded_once():
    rng = random.Random(12)
    words = [f"w{k}" for k in range(150)]
    ref = " ".join(rng.choices(words, k=3000))
    texts = [ref, "", "none of them", *(_edited(rng, ref[: rng.randrange(50, 4000)], 5) for _ in range(10)), *(" ".join(rng.choices(words, k=rng.randrange(1, 300))) for _ in range(10))]
    coded: dict = {}
    for t in texts:
        assert dd._word_ratio(t, ref, coded) == difflib.SequenceMatcher(None, t.split(), ref.split(), False).ratio()
    assert dd._word_ratio("", " ") == 1.0 and dd._word_ratio("", "") == 1.0 and dd._word_ratio("a", "") == 0.0
    assert list(coded) == [ref]
