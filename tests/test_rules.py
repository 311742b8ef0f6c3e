"""Rules and operators that SQL can't express, against examples and plain Python."""

from __future__ import annotations

import difflib
import random
import unicodedata
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quillbank.functions import textnorm as tx
from quillbank.operators import allocation, changes, duplicates, extract, linking
from quillbank.operators.components import connected_components


def value(spark, fn, *args):
    return spark.createDataFrame([args], ", ".join(f"c{k} string" for k in range(len(args)))).select(fn(*[F.col(f"c{k}") for k in range(len(args))]).alias("v")).first()["v"]


@pytest.mark.parametrize(("text", "want"), [("24", "24"), ("Art. 24", "24"), ("24.1", "24"), ("25.1.b", "25"), ("14 bis", "14 bis"), ("14-bis", "14 bis"), ("anexo", None), (None, None), ("", None), ("Artículo 007", "7")])
def test_article_base(spark, text, want):
    assert value(spark, tx.article_base, text) == want


@pytest.mark.parametrize(("text", "want"), [("23", "23"), ("Art. 23", "23"), ("23,2", "23.2"), ("149.1.18", "149.1.18"), ("14-bis", "14 bis"), ("23 y 24", None)])
def test_article_full(spark, text, want):
    assert value(spark, tx.article_full, text) == want


@pytest.mark.parametrize(("text", "want"), [("18", "18"), ("82.2 bis", "82.2 bis"), ("24.1.b", "24.1.b"), ("Artículo 18.2", "18.2"), ("Ley 40/2015, art. 18.2", "18.2"), ("Ley de 1978", None)])
def test_article_precise(spark, text, want):
    assert value(spark, tx.article_precise, text) == want


@pytest.mark.parametrize(("text", "want"), [("artículo 5, apartado 2", "5.2"), ("3 y 4", None), ("art. 7 letra B", "7.b"), ("12 de la Ley", "12"), ("nada", None)])
def test_article_unambiguous(spark, text, want):
    assert value(spark, tx.article_unambiguous, text) == want


def test_nfkc(spark):
    text = "ﬁn  ＡＢＣ\tStraße"
    assert value(spark, tx.norm_nfkc_casefold, text) == " ".join(unicodedata.normalize("NFKC", text).casefold().split())


def test_citation_parts(spark):
    got = value(spark, tx.citation_parts, "Ley 6/2025, de 30 de mayo, de la Generalitat Valenciana")
    assert tuple(got) == ("ley", "6", "2025", "2025-05-30", "valenciana")


def test_number_words(spark):
    assert value(spark, tx.number_from_words, "Ciento treinta y dos") == 132
    assert len(tx.number_words()) == 200  # cien and ciento


def test_norm_is_made_explicit(spark):
    assert value(spark, lambda s: tx.make_norm_explicit(s, F.lit("Ley 1/2000")), "Según el artículo 5, ¿cuál?") == "Según el artículo 5 de la Ley 1/2000, ¿cuál?"


def test_stems_are_rephrased(spark):
    cases = {
        "Las normas dictadas por el Estado:": "Respecto de las normas dictadas por el Estado, señale la opción correcta.",
        "¿CUÁL de los siguientes principios no está recogido en la Ley 1/2000?": "Indique el principio que no figura en la Ley 1/2000.",
        "¿Cuál es la especialidad en relación con X según Y?": "Según Y, ¿qué particularidad presenta X?",
        "Señale la respuesta incorrecta, de conformidad con la Ley:": "De conformidad con la Ley, identifique la afirmación incorrecta:",
        "Por lo que respecta a A y tal y como dispone B, C indique cuál será éste:": "De acuerdo con B, C ¿Cuál es el límite aplicable?",
        "El plazo, conforme a la ley, es": "El plazo, Según la ley, es", "Otra cosa": "Otra cosa",
    }
    assert {k: value(spark, tx.rephrase_stem, k) for k in cases} == cases


def test_practical_questions(spark):
    kind = lambda t: value(spark, lambda x: tx.classify_theory_practice(x, x), t)
    assert {kind(t) for t in ("El sr. Pérez acude", "Un empleado público pide", "La conselleria X decide", "Ante la siguiente situación, ¿qué?")} == {"PRACTICA"}
    assert {kind(t) for t in ("El plazo de la ley", "La conselleria decide", "Una empresarial cosa")} == {"TEORICA"}


def test_citations_are_composed(spark):
    assert value(spark, tx.norm_citation, "Ａrt. ５ ﬁn") == "art 5 fin"


def test_absolute_words(spark):
    texts = {"Sólo él": True, "con independencia de": True, "todo los": True, "NUNCA": True, "SÓLO ÉL": True, "ÚNICAMENTE": True, "EN NINGÚN CASO": True, "jamás.": True, "the les": False, "insólito": False, "solapa": False}
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r["t"]: r["v"] for r in rows.select("t", F.col("t").rlike(tx.ABSOLUTE).alias("v")).collect()} == texts


def test_accented_capitals(spark):
    # laws are looked for before decrees, so the end of "Decreto-ley" is one
    rows = spark.createDataFrame([("ARTÍCULO 18 de la LEY ORGÁNICA 2/2012",), ("Real Decreto-ley 5/2010, DECRETO LEGISLATIVO 1/2010, artículos 7",), ("artículo 3 de la Constitución española y Ley 1/2000",)], "t string")
    found = tx.detect_norm_article(F.col("t"))
    got = [tuple(r) for r in rows.select(found["state"], found["kind"], found["norm"], found["article"], tx.article_precise(F.col("t")), tx.article_unambiguous(F.col("t"))).collect()]
    assert got == [("JURIDICA", "LEY_ORGANICA", "LEY ORGÁNICA 2/2012", "18", "18", "18"), ("JURIDICA", "LEY", "ley 5/2010", "7", None, None), ("JURIDICA", "LEY", "Ley 1/2000", "3", "3", "3")]


def test_candidate_articles(spark):
    items = spark.createDataFrame([(1, 7, ["aa", "bb", "zz"], 9), (2, 7, ["none"], 3), (3, 7, [], 1)], "item_id long, norm_id long, tokens array<string>, article int")
    articles = spark.createDataFrame([(10, 7, ["aa"], 1), (11, 7, ["aa", "bb"], 2), (12, 7, ["cc"], 9), (13, 7, ["cc"], 9), (14, 8, ["aa"], 9)], "article_id long, norm_id long, tokens array<string>, article int")
    got = sorted((r["item_id"], r["rank"], r["article_id"]) for r in duplicates.idf_rank(items, articles, 2).collect())
    assert got == [(1, 1, 11), (1, 2, 10), (1, 3, 12), (2, 1, 10), (2, 2, 11), (3, 1, 10), (3, 2, 11)]


def test_norm_names(spark):
    schema = "{} string, tokens array<string>, identity string"
    names = spark.createDataFrame([("one", ["ley", "39"], "ley 39"), ("two", ["ley", "40"], "ley 40"), ("part", ["ley", "agua", "costa", "mar"], None), ("free", ["plan", "agua"], None), ("far", ["ley", "41"], "ley 41")], schema.format("id"))
    cands = spark.createDataFrame([("A", ["ley", "39", "2015"], "ley 39"), ("B", ["ley", "40"], "ley 40"), ("C", ["ley", "40", "x"], "ley 40"), ("D", ["ley", "agua", "costa"], "ley 5"), ("E", ["plan", "agua"], None)], schema.format("cand"))
    assert {tuple(r) for r in duplicates.best_name_match(names, cands, 0.72, 0.12).collect()} == {("one", "A", 1.0), ("part", "D", 0.75), ("free", "E", 1.0)}


def test_components_against_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5), (None, 3)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["component"] for r in got} == {x: root(x) for x in up}
    assert len(got) == len(up)
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").isEmpty()


def test_ratio_pairs_against_all_pairs(spark):
    rng = random.Random(2)
    rows = [(k, k % 3, "".join(rng.choice("ab ") for _ in range(rng.randrange(4, 14)))) for k in range(60)] + [(100, None, "x"), (101, 1, None)]
    df = spark.createDataFrame(rows, "item_id long, block long, t string")
    got = {(r[0], r[1]) for r in duplicates.near_duplicates_same_block(df, ["block"], ["t"], 0.8).collect()}
    least = defaultdict(lambda: 10**9)
    for k, b, t in rows:
        if b is not None and t is not None:
            least[b, t] = min(least[b, t], k)
    reps = [(k, b, t) for (b, t), k in least.items()]
    want = {(x[0], y[0]) for x in reps for y in reps if x[1] == y[1] and x[0] < y[0] and round(difflib.SequenceMatcher(None, x[2], y[2], False).ratio(), 6) >= 0.8}
    assert got == want


def _edited(rng, text, edits):
    t = list(text)
    for _ in range(edits):
        k = rng.randrange(len(t) + 1)
        t[k : k + rng.randrange(2)] = rng.choice("abcdef gh")
    return "".join(t)


def test_matched_characters_against_difflib():
    rng = random.Random(4)
    for k in range(4000):
        a = "".join(rng.choice("ab" if k % 2 else "abcdef gh") for _ in range(rng.randrange(30)))
        b = _edited(rng, a, rng.randrange(5))
        assert duplicates.matched(a, b) == sum(m.size for m in difflib.SequenceMatcher(None, a, b, False).get_matching_blocks())


def test_options_alike_on_average_against_all_pairs(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdef gh") for _ in range(60)) for _ in range(3)]
    rows = [(k, k % 2, "" if k % 4 == 0 else _edited(rng, base[k % 3], 1), _edited(rng, base[k % 3], rng.randrange(5))) for k in range(48)] + [(90, None, "x", "y"), (91, 1, None, "y"), (92, 1, "", ""), (93, 1, "", "")]
    df = spark.createDataFrame(rows, "item_id long, block long, x string, y string")
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b, False).ratio()
    first = {}
    for k, *r in rows:
        if None not in r:
            first.setdefault(tuple(r), k)
    reps = [(k, *r) for r, k in first.items()]
    want = {(a[0], b[0]) for a in reps for b in reps if a[0] < b[0] and a[1] == b[1] and round((ratio(a[2], b[2]) + ratio(a[3], b[3])) / 2, 6) >= 0.93}
    assert {(r[0], r[1]) for r in duplicates.near_duplicates_same_block(df, ["block"], ["x", "y"], 0.93).collect()} == want
    assert want


def test_matches_between_against_all_pairs(spark):
    rng = random.Random(8)
    pool = [(k, "".join(rng.choice("abcdef gh") for _ in range(rng.choice([1, 2, 5, 30, 90])))) for k in range(60)] + [(70, None), (71, "")]
    new = [(k, _edited(rng, pool[rng.randrange(60)][1], rng.randrange(9))) for k in range(40)] + [(50, None), (51, "")]
    ratio = lambda a, b: round(difflib.SequenceMatcher(None, a, b, False).ratio(), 6)
    x, y = spark.createDataFrame(new, "item_id long, t string"), spark.createDataFrame(pool, "item_id long, t string")
    want = {}
    for k, a in new:
        best = max(((ratio(a, b), -m) for m, b in pool if a and b), default=(0.0, 0))
        want[k] = (-best[1], best[0], best[0] < 0.9) if best[0] >= 0.8 else (None, None, True)
    assert {r[0]: tuple(r)[1:] for r in duplicates.originality_check(x, y, [], 0.9, 0.8).collect()} == want
    marks = spark.createDataFrame([(0, 0)], "item_id long, exam_id long")
    got = {(r["item_id"], r["exam_id"], r["similarity"]) for r in duplicates.match_official(x, y.withColumnRenamed("item_id", "exam_id"), marks, [], 0.8).collect()}
    assert got == {(k, m, ratio(a, b)) for k, a in new for m, b in pool if a and b and ratio(a, b) >= 0.8 and (k, m) != (0, 0)}


def test_one_field_edited_against_all_pairs(spark):
    rng = random.Random(9)
    rows = [(k, *[_edited(rng, f"{f} field of it", int(rng.random() < 0.15) * rng.randrange(9)) for f in "pqrst"]) for k in range(60)]
    df = spark.createDataFrame(rows, "item_id long, stem string, opt_a string, opt_b string, opt_c string, opt_d string")

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    norm = [(k, *[" ".join(f.lower().split()) for f in r]) for k, *r in rows]
    least = {}
    for k, *r in norm:
        least.setdefault(tuple(r), k)
    reps = [(k, r) for r, k in least.items()]
    want = set()
    for k, a in reps:
        for m, b in reps:
            off = [i for i in range(5) if a[i] != b[i]]
            if k < m and len(off) == 1 and edits(a[off[0]], b[off[0]]) <= 5:
                want.add((k, m, duplicates.FIELDS[off[0]], edits(a[off[0]], b[off[0]])))
    assert {tuple(r) for r in duplicates.near_duplicates_one_field(df).collect()} == want
    assert want


def test_whole_article_texts_are_compared(spark):
    a = " ".join(f"w{k}" for k in range(400))
    rows = [(1, "S", 1, a), (2, "S", 1, a + " end"), (3, "S", 2, a), (4, "S", 1, a)]
    got = duplicates.article_duplicates(spark.createDataFrame(rows, "article_id long, source_id string, article_no long, text string")).collect()
    assert {(r["article_id"], r["similarity"]) for r in got} == {(1, round(800 / 801, 6)), (2, 1.0)}


def test_plan_applied_twice_is_applied_once(spark):
    from quillbank.plans.fixtures import tables

    items, exclusions, refs, topics, rules, links, categories = tables(spark, "/root/testdata/sf0.001", "f_items", "f_exclusions", "f_refs", "f_topics", "f_part_rules", "f_bank_links", "f_category_topics")
    items = items.dropDuplicates(["item_id"])  # the test data repeat some order lines
    plan = linking.bank_plan(items, exclusions, refs, topics, rules, links, categories).cache()
    once = linking.apply_bank_plan(links, plan).cache()
    assert once.exceptAll(linking.apply_bank_plan(once, plan)).isEmpty()
    assert once.filter("state = 'INCLUIDA'").count() == links.filter("state = 'INCLUIDA'").count() + plan.filter("action = 'ADD'").count() - plan.filter("action = 'RETIRE'").count()


def test_blocked_calls_keep_their_links(spark):
    links = spark.createDataFrame([(1, 5, 10, "JURIDICA", "INCLUIDA", 100), (2, 5, 20, "JURIDICA", "INCLUIDA", 200)], "call_id long, item_id long, part_id long, link_type string, state string, topic_id long")
    plan = spark.createDataFrame([(1, 5, "RETIRE", None, None, "X", "JURIDICA"), (2, 5, "RETIRE", None, None, "X", "JURIDICA"), (1, 9, "ADD", 101, 11, None, "NO_JURIDICA")], "call_id long, item_id long, action string, topic_id long, part_id long, reason string, link_type string")
    got = {tuple(r) for r in linking.apply_bank_plan(links, plan, spark.createDataFrame([(2, 3)], "call_id long, incidents long")).collect()}
    assert got == {(2, 5, 20, "JURIDICA", "INCLUIDA", 200), (1, 9, 11, "NO_JURIDICA", "INCLUIDA", 101)}


def test_withdrawal_keeps_coverage(spark):
    scopes = [(s, i) for s in range(4) for i in range(100) if i % (s + 2) == 0]
    easy = [(i, i) for i in range(0, 100, 2)]
    needs = [(s, 2) for s in range(4)]
    out = {r[0] for r in allocation.protected_withdrawal(spark.createDataFrame(easy, "item_id long, score long"), spark.createDataFrame(scopes, "scope long, item_id long"), spark.createDataFrame(needs, "scope long, need long"), 8).collect()}
    for s in range(4):
        held = [i for t, i in scopes if t == s]
        assert len([i for i in held if i not in out]) >= min(16, len(held))


def test_headings_in_order_against_loop(spark):
    rng = random.Random(3)
    rows = [(d, rng.randrange(1, 9), rng.randrange(500)) for d in range(20) for _ in range(25)]
    got = {(r["doc"], r["number"]): r["pos"] for r in extract.choose_headings_in_order(spark.createDataFrame(rows, "doc long, number int, pos int")).collect()}
    want = {}
    for d in range(20):
        last = -1
        for n in range(1, 9):
            later = sorted(p for e, m, p in rows if e == d and m == n and p > last)
            if later:
                want[d, n] = last = later[0]
    assert got == want


def test_split_oversized_loses_nothing(spark):
    texts = [(1, "a. b, c\n" * 50), (2, ""), (3, "x" * 100), (4, None)]
    got = extract.split_oversized(spark.createDataFrame(texts, "doc long, text string"), "doc", "text", 30).orderBy("doc", "piece").collect()
    joined = defaultdict(str)
    for r in got:
        assert len(r["text"]) <= 30
        joined[r["doc"]] += r["text"]
    assert joined[1].replace(" ", "") == texts[0][1].replace(" ", "") and joined[3] == "x" * 100 and joined[2] == ""


def test_ingest_replay_changes_nothing(spark):
    batch = spark.createDataFrame([(1, "f", "a"), (2, "f", "a"), (3, "g", "b")], "row_id long, file_hash string, content_key string")
    pool, log = spark.createDataFrame([(9, "h", "b")], batch.schema), spark.createDataFrame([], "file_hash string, state string")
    new, counts = changes.ingest(batch, pool, log)
    assert [r["row_id"] for r in new.collect()] == [1]
    assert {(r["file_hash"], r["inserted"], r["duplicates"]) for r in counts.collect()} == {("f", 1, 1), ("g", 0, 1)}
    assert changes.ingest(batch, pool.union(new), counts.select("file_hash", "state"))[0].isEmpty()
