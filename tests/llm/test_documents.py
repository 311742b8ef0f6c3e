"""Operators over documents against brute force on a small corpus with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from quillbank.llm import decontaminate, lines, mixing, privacy, quality, simhash, suffixes


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_lines(docs, corpus):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for i, t, *_ in corpus:
        if i is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= 20:
                    holders[key(x)].add(i)
    want = []
    for i, t, *_ in corpus:
        parts = (t or "").split("\n")
        kept = [x for x in parts if not (i is not None and len(holders[key(x)]) >= 3 and i < max(holders[key(x)]))]
        want.append((i, "\n".join(kept), len(parts), len(parts) - len(kept)))
    got = lines.dedup_lines(docs)
    assert rows_of(got, "id", "kept", "n_lines", "n_dropped") == sorted(want, key=repr)
    assert got.first()["row"]["kept"] == "clash"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def naive_simhash(t, size):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
    s = [b" ".join(w[k : k + size]) for k in range(len(w) - size + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def naive_components(points, linked):
    up = list(range(len(points)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(points)):
        for b in range(a):
            if linked(points[a], points[b]):
                up[root(a)] = root(b)
    return [root(k) for k in range(len(points))]


@pytest.mark.parametrize("chunk", [2048, 4])
def test_simhash(docs, corpus, chunk, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    fps = [naive_simhash(t, 3) for _, t, *_ in corpus]
    group = naive_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for g, (i, *_) in zip(group, corpus, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    want = [(i, signed(f), least.get(g)) for (i, *_), f, g in zip(corpus, fps, group, strict=True)]
    assert rows_of(simhash.near_duplicates(docs, shingle=3), "id", "fp", "component") == sorted(want, key=repr)


def test_anchors_cover(spark):
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(300):
        a, b = int(rng.integers(0, 1 << 62)), 0
        b = a
        for bit in rng.choice(64, 3, replace=False):
            b ^= 1 << int(bit)
        rows.append((signed(a), signed(b)))
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "a long, b long")
    assert df.filter(~F.arrays_overlap(simhash.anchors(F.col("a")), simhash.anchors(F.col("b")))).isEmpty()


def test_similar_documents(docs, corpus):
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in ((t or "").lower().split() for _, t, *_ in corpus)]
    found = {}
    for r in simhash.similar_documents(docs).collect():
        found.setdefault(r["id"], r["component"])
    by_id = {i: s for (i, *_), s in zip(corpus, sets, strict=True) if i is not None and i not in (5, 6)}
    for a, x in by_id.items():
        for b, y in by_id.items():
            j = len(x & y) / len(x | y)
            if a < b and j == 1:
                assert found[a] == found[b]
            if j < 0.3 and found[a] == found[b] == min(a, b):
                raise AssertionError((a, b, j))


@pytest.mark.parametrize("chunk", [2048, 3])
@pytest.mark.parametrize("edit", ["scattered", "appended", "truncated"])
def test_similar_documents_like_brute_force(spark, edit, chunk, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for k in range(80):
        base = [word() for _ in range(rng.randrange(80, 400))]
        j = 0.75 + 0.2 * k / 79
        if edit == "scattered":
            copy = [word() if rng.random() < (1 - j) / (1 + j) / 5 else w for w in base]
        else:
            copy = base + [word() for _ in range(round(len(base) * (1 / j - 1)))] if edit == "appended" else base[: round(len(base) * j)]
        texts += [" ".join(base), " ".join(copy)]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    found = dict(map(tuple, simhash.similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()))
    linked = [found[a] == found[a + 1] for a in range(0, 160, 2)]
    assert linked == [len(sets[a] & sets[a + 1]) >= 0.8 * len(sets[a] | sets[a + 1]) for a in range(0, 160, 2)]
    assert 20 < sum(linked) < 80 and len(set(found.values())) == 160 - sum(linked)


def test_suffixes(docs, corpus):
    order = sorted(range(len(corpus)), key=lambda k: (corpus[k][0] is None, corpus[k][0] or 0, xxhash.xxh64_intdigest((corpus[k][1] or "").encode(), 42) ^ (1 << 63)))
    first, want = {}, []
    for k in order:
        i, t = corpus[k][:2]
        d = (t or "").encode()
        m = np.zeros(len(d), bool)
        for s in range(len(d) - 99):
            if first.setdefault(d[s : s + 100], (i, t, s)) != (i, t, s):
                m[s : s + 100] = True
        want.append((i, len(d), int(m.sum()), int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum()), np.frombuffer(d, np.uint8)[~m].tobytes()))
    got = suffixes.remove_repeats(docs)
    assert sorted(((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("crowd", [0, 20_000])
def test_suffixes_of_crowded_anchors(spark, crowd, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    passage = "a passage of sixty bytes that stands in very many documents "
    texts = [(k, f"{k * 7919 % 101:05d}" * 10 + passage * (1 + k % 3) + f"{k % 5}" * 70) for k in range(40)] + [(50, "x" * 400), (51, "x" * 150)]
    seen, want = set(), []
    for i, t in texts:
        d = t.encode()
        m = np.zeros(len(d), bool)
        for s in range(len(d) - 99):
            if d[s : s + 100] in seen:
                m[s : s + 100] = True
            seen.add(d[s : s + 100])
        want.append((i, int(m.sum())))
    assert rows_of(suffixes.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)), "id", "n_removed") == sorted(want, key=repr)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(3)
    for _ in range(30):
        t = np.append(rng.integers(1, rng.integers(2, 6), rng.integers(1, 200)), 0)
        assert list(suffixes.suffix_array(t, 400)) == sorted(range(len(t)), key=lambda k: t[k:].tolist())


def test_decontamination(spark, docs, corpus):
    bench = [(1, " ".join((corpus[2][1] or "").split()[:20])), (2, "word"), (3, None), (4, "nowhere to be found"), (10, " ".join(corpus[78 - 0][1].split()[100:113])), (10, "word")]
    word = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    words = lambda t: word.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = {(i, tuple(w[k : k + 13])) for i, t in bench for w in [words(t)] if w for k in range(max(1, len(w) - 12))}
    want = []
    for i, t, *_ in corpus:
        w, hit, items = words(t), set(), set()
        for item, g in windows:
            for s in range(len(w) - len(g) + 1):
                if tuple(w[s : s + len(g)]) == g:
                    hit |= set(range(s, s + len(g)))
                    items.add(str(item))
        want.append((i, len(w), len(hit), sorted(items)))
    found = decontaminate.decontaminate(docs, spark.createDataFrame(bench, "item_id long, text string"))
    assert rows_of(found, "id", "n_words", "n_hit", "items") == sorted(want, key=repr)
    assert any(x[2] for x in want)


def test_proximity_matches(spark):
    """Against every position of every rare word; words are rare as they are in all documents."""
    import math
    from collections import Counter

    rng = random.Random(9)
    words = [f"w{k}" for k in range(60)]
    pick = lambda n: [words[min(59, int(rng.expovariate(0.06)))] for _ in range(n)]
    items = [(k, pick(rng.randrange(3, 20))) for k in range(25)]
    texts = [pick(rng.randrange(1, 80)) for _ in range(40)]
    for _, w in items:
        near = [x for x in w if rng.random() > 0.1]
        rng.shuffle(near)
        texts.append(pick(5) + near + pick(5))
    seen = Counter(x for t in texts for x in t)
    want = []
    for i, t in enumerate(texts):
        phrase, near = set(), set()
        for item, w in items:
            for g in (w[k : k + 13] for k in range(max(1, len(w) - 12))):
                phrase |= {str(item) for k in range(len(t)) if t[k : k + len(g)] == g}
                need = math.ceil(0.8 * len(set(g)) - 1e-9)
                known = sorted(seen[x] for x in set(g) if x in seen)
                rare = {x for x in g if x in seen and seen[x] <= known[len(known) - need]} if len(known) >= need else set()
                near |= {str(item) for p, x in enumerate(t) if x in rare and len(set(t[max(0, p - 12) : p + 13]) & set(g)) >= need}
        want.append((i, sorted(phrase), sorted(near - phrase)))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = decontaminate.decontaminate(docs, spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string"), overlap=0.8)
    assert rows_of(found, "id", "items", "near") == sorted(want, key=repr)
    assert sum(bool(n) for *_, n in want) > 10


def test_mixing(docs, corpus):
    got = mixing.mix_sources(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix_sources(docs).collect()), key=repr)
    assert len(got) == len(corpus)
    sizes = {}
    for _, t, _, s, _ in corpus:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, full, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in names if s not in full)
        over = [s for s in names if s not in full and weight[s] * level > 2 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            full.add(s)
            left -= target[s]
    target |= {s: weight[s] * level for s in names if s not in full}
    by = defaultdict(int)
    for r in got:
        by[r["source_size"], round(r["target"], 3)] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert set(by) == {(sizes[s], round(target[s], 3)) for s in names}
    assert all(abs(n - t) <= 1 for (_, t), n in by.items())


def test_mixing_chances(spark):
    """Pivotal rounding keeps each document's expectation."""
    docs = spark.createDataFrame([(k, "w " * (1 + k % 5), "a") for k in range(40)] + [(100 + k, "w " * 40, "b") for k in range(40)], "doc_id long, text string, source string")
    taken, n = defaultdict(int), 12
    for seed in range(n):
        for r in mixing.mix_sources(docs, seed=seed * 17).filter("id >= 100").collect():
            taken[r["id"]] += r["taken"]
            share = r["target"] / r["source_size"]
    assert abs(sum(taken.values()) / n / (40 * 40) - share) < 0.01
    assert np.std(list(taken.values())) < 40 * n


def test_mixing_rows_that_repeat_an_id(spark):
    rows = [(7, "a b c", "s", "clash")] * 900 + [(None, "a b", "s", "clash")] * 300 + [(k, "w " * (k % 9), "t", "clash") for k in range(300)] + [(1, None, None, None)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target string").repartition(6)
    got = mixing.mix_sources(df)
    assert got.count() == len(rows) and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, mixing.mix_sources(df).collect()), key=repr)
    from pyspark.sql import functions as F

    sums = got.groupBy("source_size", "target").agg(F.sum("taken").alias("n"), F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect()
    assert len(sums) == 3 and all(abs(r["n"] - r["target"]) <= 1 and r["over"] <= 0 for r in sums)


def test_privacy(spark):
    hot = [(k, f"line {k}\nwrite to Amy Ruxworth at amy{0}@mail.example.com for item {k} today") for k in range(6)]
    texts = [(100, "a@b.c%d@e.f and x@y"), (101, "1.2.3.4.5.6.7.8 300.1.1.1 0255.0.0.1"), (102, "4111 1111 1111 1111 1"), (103, "4111-1111-1111-1111"), (104, "+1 (499) 555-6503 +12"), (105, None), (106, ""), (107, "é@x.y ñandú 10.0.0.1")]
    others = [(200 + k, f"nothing here for item number {k} to write at today") for k in range(200)]
    got = {r["id"]: r for r in privacy.find_personal_data(spark.createDataFrame(hot + texts + others, "doc_id long, text string")).collect()}
    base = {i: [(s["kind"], s["start"], s["end"]) for s in r["base"]] for i, r in got.items()}
    assert base[100] == [(0, 0, 5), (0, 5, 11)]
    assert base[101] == [(1, 0, 7), (1, 8, 15), (1, 26, 36)]
    assert base[102] == [] and base[103] == [(2, 0, 19)] and base[104] == [(3, 0, 17)] and base[105] == base[106] == []
    assert base[107] == [(1, 12, 20)]
    text = dict(hot)[3]
    assert {text[s["start"] : s["end"]] for s in got[3]["spans"] if s["kind"] == 4} == {"Amy", "Ruxworth"}
    from pyspark.sql import functions as F

    found = privacy.find_personal_data(spark.createDataFrame(hot + others, "doc_id long, text string")).filter("id = 3")
    clean = found.join(spark.createDataFrame(hot, "id long, text string"), "id").select(privacy.sanitise(F.col("text"), F.col("spans")).alias("t")).first()["t"]
    assert clean == "line 3\nwrite to [term] [term] at [email] for item 3 today"


def test_privacy_needs_support(spark):
    """Names beside addresses that recur in different texts are found, words seen once or twice beside an entity aren't, nor are copies support."""
    filler = lambda k: " ".join(f"common{chr(97 + (k * j) % 9)}" for j in range(1, 8))
    rows = [(k, f"{filler(k)} ask Quimby Zoe at zq@mail.example.com about {filler(k + 1)} quimby", "zq") for k in range(5)]
    rows += [(10 + k, f"{filler(k)} hapax{chr(97 + k)} writes to u{k}@box{k}.example.org with once{chr(97 + k)} here", "one") for k in range(12)]
    rows += [(30 + k, f"{filler(3)} copied words beside copy@here.example.org stay", "copy") for k in range(9)]
    # the addresses differ, their domain and the name of the firm recur
    rows += [(50 + k, f"{filler(k)} for Quillco mail p{k}@quillco.example.net {filler(k + 2)}", "firm") for k in range(6)]
    rows += [(70, f"{filler(2)} met Quimby at noon", "bare"), (None, f"{filler(4)} call Quillco", "null")]
    rows += [(200 + k, f"{filler(k)} ask about mail writes to with here for words stay", "none") for k in range(300)]
    found = privacy.find_personal_data(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)).collect()
    text = {i: t for i, t, _ in rows}
    marked = {r["id"]: [text[r["id"]][s["start"] : s["end"]] for s in r["spans"] if s["kind"] == 4] for r in found}
    want = {"zq": ["Quimby", "Zoe", "quimby"], "firm": ["Quillco"], "bare": ["Quimby"], "null": ["Quillco"]}
    assert {i: marked[i] for i, _, _ in rows} == {i: want.get(kind, []) for i, _, kind in rows}


def test_entities_like_the_plain_patterns():
    def plain(text):
        found = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        found += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            d = [int(c) for c in m[0] if c.isdigit()]
            if 14 <= len(d) <= 19 and sum(sum(divmod(x * (1 + k % 2), 10)) for k, x in enumerate(reversed(d))) % 10 == 0:
                found.append((2, m.start(), m.end()))
        found += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
        return sorted(found, key=lambda x: (x[1], x[0]))

    rng = random.Random(8)
    pieces = ["a", "x.y", "@", "@@", ".", "-", " ", "\n", "+", "(", ")", "4111", "1111", "10.0.0.1", "255", "256.", "+44 20 7946 0018", "me@b.co", "é", "4539 1488 0343 6467", "%", "_", "0"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        assert privacy.entities(text) == plain(text), text


def test_privacy_by_brute_force(spark):
    """Weigh every pair of an entity and a term near it in plain Python."""
    import math

    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("kal", "lom", "Mir", "nér", "rux", "Sät") for b in ("bad", "der", "fin", "gól", "xen", "")] + ["w" * 198]
    mails = [f"{n}{k}@mail.example.com" for n in ("zq", "amy", "pat.k") for k in range(8)]
    texts = []
    for k in range(120):
        rare = [f"name{chr(97 + k % 26)}{chr(97 + k // 26)}"]
        t = [rng.choice(words[: 6 + k % 30]) for _ in range(rng.randrange(1, 40))] + (rare + [rng.choice(mails)] if k % 9 == 0 else [rng.choice(mails)] if k % 5 == 0 else rare if k % 7 == 0 else [])
        rng.shuffle(t)
        texts.append("".join(w + rng.choice([" ", " ", " ", "\n"]) for w in t))
    texts += [f"{words[k]} tellhim him@only.example.com {words[k + 1]}" for k in range(7)] + [f"{words[k % 9]} filler" for k in range(200)] + [f"{words[k]} {mails[k][0]}9@firm.example.org tellfirm" for k in range(5)] + ["tellhim alone"] + [f"twice {words[k]} 10.0.{k}.1" for k in range(2)]
    texts += [f"{words[0]} {mails[0]} " * 3, None, "", texts[0], texts[0], texts[0], f"{'w' * 198} {mails[1]}", f"abc{mails[2]}def"]
    word = re.compile(r"[^\W\d_]{3,}")
    bases = [privacy.entities(t or "") for t in texts]
    free = [[m for m in word.finditer(t or "") if not any(m.start() < e and s < m.end() for _, s, e in b)] for t, b in zip(texts, bases, strict=True)]
    digits = lambda v: re.sub("[^0-9]", "", v)
    general = lambda k, v: (v.split("@")[-1], ".".join(v.split(".")[:2]), digits(v)[:6], digits(v)[:5])[k]
    name = lambda t, x: {(x[0], 0, t[x[1] : x[2]].lower()), (x[0], 1, general(x[0], t[x[1] : x[2]]).lower())}
    near = {}
    for t, b, ms in zip(texts, bases, free, strict=True):
        for x in b:
            left = [m for m in ms if m.end() <= x[1]][-5:]
            for m in left + [m for m in ms if m.start() >= x[2]][:5]:
                if "\n" not in t[min(m.start(), x[1]) : max(m.end(), x[2])]:
                    for c in name(t, x):
                        near.setdefault((c, m[0].lower()), set()).add(t)
    holds = [{n for x in b for n in name(t, x)} for t, b in zip(texts, bases, strict=True)]
    knows = [{w.lower() for w in word.findall(t or "")} for t in texts]
    telling = set()
    for (c, w), together in near.items():
        df, of = sum(w in k for k in knows), sum(c in h for h in holds)
        share, p, z = of / len(texts), min(1, len(together) / df), 2.33
        given = (p + z * z / (2 * df) - z * math.sqrt(p * (1 - p) / df + z * z / (4 * df * df))) / (1 + z * z / df)
        if share < 1 and given >= 1 / 3 and math.log(given / share) >= -0.75 * math.log(share):
            telling.add(w)
    assert {"tellhim", "tellfirm"} <= telling and "twice" not in telling and len(telling) < 20
    want = []
    for i, (t, b, ms) in enumerate(zip(texts, bases, free, strict=True)):
        every = [(s, k, e) for k, s, e in b] + [(m.start(), 4, m.end()) for m in ms if m[0].lower() in telling]
        want.append((i, [(k, s, e) for s, k, e in sorted(every)]))
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, base string, tid int").repartition(7)
    got = privacy.find_personal_data(df).collect()
    assert sorted((r["id"], [(x["kind"], x["start"], x["end"]) for x in r["spans"]]) for r in got) == want


def test_privacy_of_odd_rows(spark):
    import time

    # 20,000 entities beside as many words of their own: what a row sends is linear
    own = lambda k: "".join(chr(97 + k // 26**j % 26) for j in range(4))
    many = " ".join(f"u{k}@mail{k}.example.com {own(k)}" for k in range(20_000))
    rows = [(1, many), (1, "write a@b.cd"), (1, "write a@b.cd"), (None, "a@b.cd"), (None, None), (2, "x" * 500_000 + "@y.zz")]
    began = time.perf_counter()
    got = privacy.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["id"], len(r["base"])) for r in got), key=repr) == sorted([(1, 20_000), (1, 1), (1, 1), (None, 1), (None, 0), (2, 1)], key=repr)
    assert time.perf_counter() - began < 60


def test_quality(spark):
    rows = [(k, "good words stand in order here. " * (2 + k % 5) if k % 2 else "%%% $$$ junk | junk | junk " * (2 + k % 7)) for k in range(400)] + [(1000, ""), (1001, None), (None, "some text")]
    labels = [(k, k % 2, 0) for k in range(400)] + [(5, None, 0), (None, 1, 0), (7000, 1, 0)]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classify(docs, known).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    held = [k for k in range(400) if got[k]["held_out"]]
    assert 80 < len(held) < 200
    assert np.mean([got[k]["predicted"] == k % 2 for k in held]) > 0.95
    assert {r["score"] for r in quality.classify(docs, known.limit(0)).collect()} == {0.5}
    assert {r["predicted"] for r in quality.classify(docs, known.filter("quality = 0")).collect()} == {0}


def test_quality_like_plain_densities(spark):
    """Scores against log densities of two normal distributions, worked out from their formula."""
    rng = np.random.default_rng(2)
    d = len(quality.STATISTICS)
    x = np.concatenate([rng.standard_normal((60, d)), rng.standard_normal((90, d)) * 1.5 + 0.4])
    y = np.repeat([0, 1], [60, 90])
    model = quality.fit(spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y, strict=True)], "x array<double>, y int"))
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    groups = [z[y == c] for c in (0, 1)]
    pooled = sum(np.cov(g.T, bias=True) * len(g) for g in groups) / len(z)
    logs = []
    for g in groups:
        cov = 0.8 * np.cov(g.T, bias=True) + 0.2 * pooled
        cov = 0.95 * cov + 0.05 * np.trace(cov) / d * np.eye(d)
        away = z - g.mean(axis=0)
        logs.append(np.log(len(g) / len(z)) - 0.5 * np.einsum("ij,ij->i", away @ np.linalg.inv(cov), away) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)


def test_quality_of_odd_rows(spark):
    rows = [(k, "good words stand in order here. " * (2 + k % 5) if k % 2 else "%%% junk | junk | " * (2 + k % 7), "clash", k) for k in range(90)]
    rows += [(1, rows[2][1], "clash", 0), (1, rows[2][1], "clash", 0), (None, None, None, None), (500, "word " * 400_000, "clash", 0), (501, "x" * 2_000_000, "clash", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, y long")
    labels = spark.createDataFrame([(k, k % 2) for k in range(90)] * 3 + [(7, 1)] * 50, "doc_id long, quality int")
    got = quality.classify(docs, labels)
    assert got.columns == ["doc_id", "text", "score", "y", "held_out", "predicted"] and got.count() == len(rows)
    assert all(0 <= r["score"] <= 1 for r in got.select("score").collect())
    kept = quality.learn(docs, labels, fit_rows=30)
    assert len(kept.prior) == 2 and 0 < np.exp(kept.prior).min()
    once = quality.learn(docs, labels.distinct())
    assert np.array_equal(once.mean, quality.learn(docs, labels).mean)


def test_empty_tables(spark, empty):
    assert lines.dedup_lines(empty).isEmpty() and simhash.near_duplicates(empty).isEmpty() and simhash.similar_documents(empty).isEmpty()
    assert suffixes.remove_repeats(empty).isEmpty() and mixing.mix_sources(empty).isEmpty() and privacy.find_personal_data(empty).isEmpty()
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(empty, none).isEmpty()
    assert quality.classify(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).isEmpty()


def test_empty_benchmark(spark, docs, corpus):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs, none).filter("n_hit = 0").count() == len(corpus)


def test_digest():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
