"""Gazette headers, exam blocks, syllabus topics and merge reviews by example."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quillbank.operators import papers


def test_headers_go_and_weak_lines_only_beside_them(spark):
    inline = "Núm. 7 Martes 4 de junio de 2024 Sec. III. cve: BOE-B-2024-9 Verificable en http://www.boe.es"
    text = f"uno\nES\n32/239\nES L 123/4 3.4.2019\n3.4.2019\ndos {inline}\ntres\n12/3\ncuatro\nDO L de 1.2.2003\nELI: http://data.europa.eu/x ES\nNUM. 3 / 01.02.2003\nNum. 3 / 01.02.2003\nC123/45 es"
    (row,) = papers.clean_gazette(spark.createDataFrame([(1, text)], "id long, t string"), "id", "t").collect()
    # the header within a line takes the line end after it along
    assert row["kept"] == "uno\ndos tres\n12/3\ncuatro\nNUM. 3 / 01.02.2003\nC123/45 es"


def test_weak_lines_like_the_fixpoint(spark):
    import random

    rng = random.Random(3)
    kinds = ["texto", "ES", "1/2", "3.4.2019", "L 45/12", "DO L de 1.1.2001", "más"]
    texts = [(k, "\n".join(rng.choices(kinds, k=rng.randrange(1, 25)))) for k in range(80)]
    strong, weak = re.compile(papers.STRONG), re.compile(papers.WEAK)

    def plain(text: str) -> str:
        lines = text.split("\n")
        gone = [bool(strong.match(x)) for x in lines]
        while True:
            more = [k for k, x in enumerate(lines) if not gone[k] and weak.match(x) and (k > 0 and gone[k - 1] or k + 1 < len(lines) and gone[k + 1])]
            if not more:
                return "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
            for k in more:
                gone[k] = True

    got = {r["doc"]: r["kept"] for r in papers.clean_gazette(spark.createDataFrame(texts, "id long, t string"), "id", "t").collect()}
    assert got == {k: plain(t) for k, t in texts}


def test_exam_blocks(spark):
    text = "Portada\n1. ¿Qué?\nA) a\nB) b\nC) c\nD) d\nSeguridad en la respuesta: baja\n9\n\n  2.  otra\nA) a B) b\nC) c\nD) d\n 33. tercera 4. no\n A) a\n\tB) b\nC) c\nD)\td"
    rows = papers.split_exam_blocks(spark.createDataFrame([(1, text), (2, None), (3, "")], "id long, t string"), "id", "t").collect()
    assert sorted((r["doc"], r["number"], r["text"]) for r in rows) == [(1, 1, "1. ¿Qué?\nA) a\nB) b\nC) c\nD) d"), (1, 33, "33. tercera 4. no\n A) a\n\tB) b\nC) c\nD)\td")]


def test_syllabus(spark):
    text = "Tema 1. fuera\nTemario parte general Núm 3 1. Uno\nsigue 16. Dieciséis 2. Dos 1. Otra vez\nTEMARIO PARTE ESPECIAL 0. cero 60. Sesenta 61. no 123. tampoco 5. 6. Seis"
    rows = papers.split_syllabus(spark.createDataFrame([(1, text), (2, "1. nada"), (3, None)], "id long, t string"), "id", "t").collect()
    assert sorted((r["doc"], r["part"], r["number"], r["text"]) for r in rows) == [(1, "ESPECIAL", 6, "Seis"), (1, "ESPECIAL", 60, "Sesenta"), (1, "GENERAL", 1, "Uno sigue"), (1, "GENERAL", 2, "Dos")]


def test_merge_review(spark):
    groups = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (2, 21), (3, 30), (3, 31), (4, 40), (4, 41), (5, 50), (5, 51), (5, 52), (6, 60), (6, 61)], "component long, item_id long")
    links = spark.createDataFrame([(1, 1, 11, 5, "J", "I"), (2, 1, 20, 5, "J", "I"), (3, 1, 21, 6, "J", "I"), (4, 1, 30, 5, "J", "I"), (5, 1, 31, 5, "J", "I"), (6, 2, 31, 5, "J", "I"), (7, 1, 40, 5, "J", "I"), (8, 1, 41, 5, "J", "I"), (9, 1, 60, None, "J", "I"), (10, 1, 61, None, "J", "I")], "link_id long, call_id long, item_id long, part_id long, link_type string, state string")
    topics = spark.createDataFrame([(k, 100) for k in range(1, 11)] + [(5, 101)], "link_id long, topic_id long")
    got = {r["component"]: tuple(r)[1:] for r in papers.merge_review(groups, links, topics, spark.createDataFrame([(41,)], "item_id long")).collect()}
    assert got == {1: (11, 10, "OK", 0, 0), 2: (20, 21, "LINKS", 1, 0), 3: (30, 31, "TOPICS", 1, 1), 4: (40, 41, "SIMULATION", 1, 0), 5: (None, None, "NOT_A_PAIR", 0, 0), 6: (60, 61, "OK", 1, 0)}
    assert papers.merge_review(groups.filter("false"), links, topics, links.select(F.col("item_id"))).count() == 0


def test_titles_like_lengthening_them_round_by_round(spark):
    import random
    from collections import defaultdict

    from quillbank.operators import extract

    rng = random.Random(5)
    sentences = ["La ley", "El acto", "—", "Los plazos.", "Fin", "el ACTO", "..", "Título"]
    topics = [(k, f"p{k % 3}", ". ".join(rng.choices(sentences, k=rng.randrange(0, 7))) + rng.choice(["", ".", " ..."])) for k in range(120)] + [(200, "p0", None), (201, "p9", "Solo. Dos")]
    bare = lambda x: x.lower().translate(str.maketrans("áéíóú", "aeiou"))
    parts = {k: [x.strip(" .") for x in re.split(r"\.\s+", " ".join((t or "").split())) if x.strip(" .")] for k, _, t in topics}
    of, depth = {k: p for k, p, _ in topics}, dict.fromkeys(parts, 1)
    while True:
        title = {k: ". ".join(s[: depth[k]]).rstrip(".") for k, s in parts.items()}
        same = defaultdict(list)
        for k, t in title.items():
            same[of[k], bare(t)].append(k)
        longer = [k for g in same.values() if len(g) > 1 for k in g if depth[k] < len(parts[k])]
        if not longer:
            break
        for k in longer:
            depth[k] += 1
    got = {r["topic_id"]: r["title"] for r in extract.unique_titles(spark.createDataFrame(topics, "topic_id long, part string, text string").repartition(4)).collect()}
    assert {k: v or "" for k, v in got.items()} == title


def test_numbered_items_like_the_plain_rule(spark):
    import random

    rng = random.Random(9)
    texts = []
    for k in range(150):
        out, number = [], rng.randrange(1, 4)
        for _ in range(rng.randrange(0, 5)):
            number += rng.choice([1, 1, 1, 2])
            marks = [rng.choice([m, m.upper()]) for m in ("a)", "b)", "c)", "d)")]
            if rng.random() < 0.3:
                marks[rng.randrange(4)] = rng.choice(["", "e)", "ba)"])
            words = ["¿Qué", "Uno", "dos\n3 tres", "", "1. no", "7Siete" if rng.random() < 0.1 else "más"]
            out.append(f"{rng.choice(['', ' ', chr(10)])}{number}{rng.choice(['', ' ', chr(10), '. '])}{rng.choice(['¿Qué', 'El', 'Ámbito', 'no'])} {' '.join(f'{m} {rng.choice(words)}' for m in marks)}")
        texts.append((k, "\n".join(out)))

    def plain(text: str) -> list[tuple]:
        found = list(re.finditer(r"(?m)^\s*(\d{1,4})\s*(?=(?:¿|[A-ZÁÉÍÓÚÜÑ]))", text))
        rows = []
        for m, end in zip(found, [*(x.start() for x in found[1:]), len(text)], strict=False):
            b = re.match(r"(?is)^(.*?)\ba\)\s*(.*?)\bb\)\s*(.*?)\bc\)\s*(.*?)\bd\)\s*(.*)$", text[m.end() : end].strip())
            parts = [" ".join(b[k].split()) for k in range(1, 6)] if b else []
            rows.append((int(m[1]), *(parts if parts and all(parts) else [None] * 5), None if parts and all(parts) else "OPTIONS"))
        seen = {r[0] for r in rows}
        return rows + [(n, *[None] * 5, "MISSING") for n in range(min(seen, default=0), max(seen, default=0)) if n not in seen]

    got: dict = {k: [] for k, _ in texts}
    for r in papers.split_numbered_items(spark.createDataFrame([*texts, (900, None)], "id long, t string").repartition(4), "id", "t").collect():
        got[r["doc"]].append(tuple(r)[1:])
    want = {k: plain(t) for k, t in texts}
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    assert {r[-1] for v in want.values() for r in v} == {None, "OPTIONS", "MISSING"}
