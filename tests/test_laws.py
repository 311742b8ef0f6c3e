"""Headings, scopes, fragments and literal evidence against plain versions of their rules, on random and odd inputs."""

from __future__ import annotations

import random
import re
import unicodedata

import pytest

from quillbank.operators import evidence, fragments, headings, scopes

HEADING = re.compile(r"(?im)^[ \t]*(?:art[ií]culo|article)[ \t]+(\d+)(?![ \t]*\.\s*\d)(?:[ \t]*\.)?(?=[ \t]+|$)")


def bare(x: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).lower()


def tidy(x: str | None) -> str:
    return " ".join((x or "").split())


# --- headings


def plain_headings(text: str) -> tuple[bool, dict, dict, dict]:
    """Mode, places, errors and bodies of one text, step by step."""
    seen: dict[int, list] = {}
    for m in HEADING.finditer(text):
        end = text.find("\n", m.start())
        line = tidy(text[m.start() : end if end >= 0 else len(text)])
        r = re.match(rf"(?i)^(?:art[ií]culo|article)\s+{int(m[1])}(?:\s*\.)?\s*(.*)$", line)
        seen.setdefault(int(m[1]), []).append((m.start(), line, tidy(bare(r[1])).strip(" .;:-") if r else ""))
    if not seen:
        return False, {}, {}, {}
    if 1 in seen:
        nums = [1]
        while nums[-1] + 1 in seen:
            nums.append(nums[-1] + 1)
    else:
        runs: list[list[int]] = []
        for n in sorted(seen):
            runs = [*runs[:-1], [*runs[-1], n]] if runs and runs[-1][-1] == n - 1 else [*runs, [n]]
        nums = max(runs, key=len)
    alike = lambda a, b: bool(a and b and (a.startswith(b) or b.startswith(a)))
    twice = sum(len(seen[n]) > 1 for n in nums)
    agree = sum(any(alike(seen[n][0][2], x[2]) for x in seen[n][1:]) for n in nums)
    toc = twice >= max(2, int(len(nums) * 0.6)) and agree >= max(2, int(len(nums) * 0.5))
    place, error = {}, {}
    for n in nums:
        if toc:
            found = [x for x in seen[n][1:] if alike(seen[n][0][2], x[2])] or (seen[n][1:] if len(seen[n]) == 2 else [])
        elif n == nums[0]:
            found = seen[n]
        elif n - 1 not in place:
            error[n] = "PREVIOUS_MISSING"
            continue
        else:
            found = [x for x in seen[n] if x[0] > place[n - 1][0]]
        if found:
            place[n] = found[0]
        else:
            error[n] = "NO_MATCH" if toc else "NONE_AFTER"
    last = None
    for n in nums:
        if n in place:
            if last is not None and place[n][0] <= last:
                error[n] = "OUT_OF_ORDER"
            last = place[n][0]
    bodies = {}
    for n in nums:
        if n in place:
            if n != nums[-1] and n + 1 not in place:
                bodies[n] = (place[n][1], None, "NEXT_MISSING")
                continue
            block = text[place[n][0] : len(text) if n == nums[-1] else place[n + 1][0]].strip()
            rest = block.split("\n", 1)[1].strip() if "\n" in block else ""
            short = len(tidy(rest)) < 20
            bodies[n] = (place[n][1], None if short else block, "SHORT" if short else None)
    return toc, {n: (p[0], p[1]) for n, p in place.items()}, error, bodies


def random_law(rng: random.Random) -> str:
    word = lambda: rng.choice(["Artículo", "ARTÍCULO", "artículo", "article", "Articulo", "  Artículo", "Art."])
    names = ["Objeto", "Ámbito.", "Ámbito de aplicación", "Fin: límites", "", "Órganos"]
    title = {n: rng.choice(names) for n in range(0, 12)}
    lines = []
    start = rng.choice([0, 1, 1, 1, 2, 4])
    for part in range(rng.choice([1, 2, 2, 3])):
        for n in range(start, start + rng.randrange(1, 7)):
            if rng.random() < 0.15:
                continue
            kind = rng.random()
            dot = rng.choice([".", " .", "", ".-"])
            lines.append(f"{word()} {n}{dot} {title[n] if kind < 0.7 else rng.choice(names)}" if kind < 0.9 else f"{word()} {n}{rng.choice(['.', '.1', '. 2 cosas', '.\n', 'x'])}")
            lines += [rng.choice(["", "1. Uno", "Un texto que sigue con palabras suficientes.", "corto"]) for _ in range(rng.randrange(0, 3))]
    if rng.random() < 0.2:
        rng.shuffle(lines)
    return "\n".join(lines)


def test_headings_and_bodies_by_the_plain_rule(spark):
    rng = random.Random(1)
    texts = [(k, random_law(rng)) for k in range(400)] + [(900, ""), (901, None), (902, "Artículo 3"), (903, "Artículo 1. A\nArtículo 1. A")]
    frame = spark.createDataFrame(texts, "doc long, text string").repartition(6)
    chosen = headings.choose_headings(headings.find_headings(frame))
    got: dict = {}
    for r in chosen.collect():
        got.setdefault(r["doc"], []).append((r["number"], r["toc"], r["pos"], r["line"], r["error"]))
    bodies: dict = {}
    for r in headings.article_bodies(frame, chosen).collect():
        bodies.setdefault(r["doc"], {})[r["number"]] = (r["title"], r["text"], r["error"])
    errors = set()
    for k, t in texts:
        toc, place, error, body = plain_headings(t or "")
        errors |= set(error.values()) | {b[2] for b in body.values()} | {toc}
        want = [(n, toc, *place.get(n, (None, None)), error.get(n)) for n in sorted({*place, *error})]
        assert sorted(got.get(k, [])) == want, (k, t)
        assert bodies.get(k, {}) == body, (k, t)
    assert errors >= {"PREVIOUS_MISSING", "NONE_AFTER", "NO_MATCH", "OUT_OF_ORDER", "NEXT_MISSING", "SHORT", None, True, False}


# --- scopes


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("CAPÍTULO II. De los órganos", ("capitulo", "2")), ("título preliminar", ("titulo", "preliminar")), ("Sección 1.ª Otras", ("seccion", "1")), ("LIBRO Décimo", ("libro", "10")),
        ("Título Único", ("titulo", "unico")), ("Subsección  3ª", ("subseccion", "3")), ("Capítulo séptima", ("capitulo", "7")), ("título XLIV", ("titulo", "44")), ("Títulos I", None), ("del Título I", None), ("TÍTULO de", None), ("Título 007 x", ("titulo", "7")),
    ],
)
def test_units(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(scopes.unit(__import__("pyspark").sql.functions.col("t")).alias("u")).first()["u"]
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize(
    ("text", "listed", "excluded", "path"),
    [
        ("Artículos 1 a 5", ["1", "2", "3", "4", "5"], [], {}), ("ARTÍCULOS 3 Y 7 BIS", ["3", "7 bis"], [], {}), ("artículos 9-11 y artículo 2", ["9", "10", "11", "2"], [], {}),
        ("artículos 5 a 3", ["5", "3"], [], {}), ("artículo 4, artículo 4", ["4"], [], {}), ("Título III, excepto los artículos 12 y 13; Capítulo I", [], ["12", "13"], {"titulo": "3", "capitulo": "1"}),
        ("todo salvo artículo 3,5. Fin", [], ["3.5"], {}), ("excepto lo que dicen los otros artículos 8", ["8"], [], {}), ("Título I, Título II", [], [], {"titulo": "2"}), (None, [], [], {}), ("", [], [], {}),
        ("salvo los artículos 1 a 3", [], ["1", "2", "3"], {}), ("artículo 1.2 quater y 30 al 31", ["1.2 quater", "30", "31"], [], {}),
    ],
)
def test_parts_of_scopes(spark, text, listed, excluded, path):
    F = __import__("pyspark").sql.functions
    row = spark.createDataFrame([(text,)], "t string").select(*[v.alias(k) for k, v in scopes.scope_parts(F.coalesce("t", F.lit(""))).items()]).first()
    assert (list(row["listed"]), list(row["excluded"] or []), dict(row["path"])) == (listed, excluded, path)


def test_an_index_keeps_the_richest_line_and_the_order_of_articles(spark):
    lines = ["Artículo 2. Antes", "TÍTULO I", "Artículo 10", "Artículo 2 bis. x", "Capítulo I", "Artículo 2. Dentro", "x" * 301, "LIBRO II", "Artículo 3", "Artículo único. y", "Título I " + "x" * 300, "art. 4.1"]
    index = scopes.parse_index(spark.createDataFrame([(1, k, x) for k, x in enumerate(lines)], "norm_id long, pos int, line string"))
    got = {r["article"]: dict(r["path"]) for r in index.collect()}
    assert got == {"2": {"titulo": "1", "capitulo": "1"}, "10": {"titulo": "1"}, "2 bis": {"titulo": "1"}, "3": {"libro": "2"}, "unico": {"libro": "2"}, "4.1": {"libro": "2"}}
    asked = spark.createDataFrame([(1, 1, None), (2, 1, "título I"), (3, 1, "Título I, Capítulo II"), (4, 1, "artículos 3, 99 y 10"), (5, 7, "todo"), (6, 1, "artículo 3, salvo el artículo 3")], "scope_id long, norm_id long, scope string")
    rows = sorted((r["scope_id"], r["nth"], r["article"], r["error"]) for r in scopes.resolve_scopes(index, asked).collect() if r["scope_id"] != 6)
    assert rows == [(1, 1, "2", None), (1, 2, "2 bis", None), (1, 3, "3", None), (1, 4, "4.1", None), (1, 5, "10", None), (1, 6, "unico", None), (2, 1, "2", None), (2, 2, "2 bis", None), (2, 3, "10", None), (3, 1, None, "EMPTY"), (4, 2, "99", "MISSING")]


# --- fragments


def plain_merge(rows: list[dict]) -> list[tuple]:
    out, now = [], None
    for r in rows:
        f = {c: tidy(r[c]) for c in ("number", *fragments.TEXTS, *fragments.SCALARS)}
        f["answer"], f["kind"] = f["answer"].upper(), f["kind"].upper()
        reason = "BAD_ANSWER" if f["answer"] not in ("", "A", "B", "C", "D") else "BAD_KIND" if f["kind"] not in ("", "JURIDICA", "INFORMATICA", "OTRA") else "EMPTY" if not any(f[c] for c in ("number", *fragments.TEXTS, "answer")) else None
        if reason is None and not f["number"]:
            reason = "UNMARKED" if not r["continues"] else "ORPHAN" if now is None else None
        if reason:
            out.append({**f, "page": r["page"], "last": r["page"], "errors": [(r["frag"], reason)], "item": None})
        elif f["number"]:
            now = {**f, "page": r["page"], "last": r["page"], "errors": [], "item": sum(x["item"] is not None for x in out) + 1}
            out.append(now)
        else:
            for c in fragments.TEXTS:
                a, b = now[c], f[c]
                now[c] = a if not b or b in a else b if a in b else f"{a} {b}"
            for c in fragments.SCALARS:
                if f[c] and now[c] and f[c] != now[c]:
                    now["errors"].append((r["frag"], f"CONFLICT:{c}"))
                    break
                now[c] = f[c] or now[c]
            else:
                now["last"] = max(now["last"], r["page"])
    return out


def test_fragments_by_the_plain_rule(spark):
    rng = random.Random(2)
    rows = []
    for doc in range(60):
        for frag in range(rng.randrange(0, 14)):
            piece = lambda: rng.choice([None, "", "ab", "abc  d", "bc", "x\ny", "ab cd"])
            rows.append({"doc": doc, "frag": frag, "page": rng.randrange(1, 9), "number": rng.choice([None, "", str(frag), " 7 "] if frag or rng.random() < 0.7 else [None]), "continues": rng.choice([True, True, False, None]),
                         **{c: piece() for c in fragments.TEXTS}, **{c: rng.choice([None, "", "v", "w"]) for c in fragments.SCALARS}, "answer": rng.choice([None, "a", " A ", "B", "E" if rng.random() < 0.2 else ""]), "kind": rng.choice([None, "otra", "JURIDICA" if rng.random() < 0.3 else "", "?" if rng.random() < 0.2 else ""])})
    schema = f"doc long, frag long, page int, number string, continues boolean, {', '.join(f'{c} string' for c in (*fragments.TEXTS, *fragments.SCALARS))}"
    got = fragments.merge_fragments(spark.createDataFrame([tuple(r.values()) for r in rows], schema).repartition(5)).collect()
    key = lambda x: repr(x)
    want = []
    for doc in range(60):
        want += [(doc, m["item"], m["number"], m["page"], m["last"], *[m[c] for c in (*fragments.TEXTS, *fragments.SCALARS)], m["errors"]) for m in plain_merge([r for r in rows if r["doc"] == doc])]
    assert sorted([(*r[:-1], [tuple(e) for e in r["errors"]]) for r in got], key=key) == sorted(want, key=key)


# --- literal evidence


def plain_evidence(items: list[tuple], texts: list[tuple]) -> dict:
    out = {}
    for item, norm, _, _ in items:
        out.setdefault(item, {"norm": norm, "hits": {}})
    for item, norm, origin, words in items:
        for n in range(9, 16):
            for k in range(len(words) - n + 1):
                p = " ".join(words[k : k + n])
                for text, of, body in texts:
                    if of == norm and p in " ".join(body):
                        hit = out[item]["hits"].setdefault(text, (set(), set()))
                        hit[0].add(origin)
                        hit[1].add(p)
    return out


def test_evidence_by_the_plain_rule(spark):
    rng = random.Random(4)
    words = ["a", "la", "al", "b", "ba", "que", "quea"]
    items, texts = [], []
    for k in range(30):
        items += [(k, k % 4, o, [rng.choice(words) for _ in range(rng.randrange(0, 24))]) for o in ("stem", "opt_a")]
    for t in range(24):
        body = [rng.choice(words) for _ in range(rng.randrange(0, 30))]
        for _ in range(3):  # pieces of items, with the ends of words cut or prolonged
            w = list(rng.choice(items)[3])
            if len(w) > 9:
                a = rng.randrange(0, len(w) - 8)
                w = w[a : a + rng.randrange(9, 20)]
                w[0], w[-1] = rng.choice(["", "x"]) + w[0], w[-1] + rng.choice(["", "x"])
                body += w + [rng.choice(words)]
        texts.append((t, t % 3, body * rng.choice([1, 1, 3])))
    got: dict = {}
    found = evidence.literal_evidence(spark.createDataFrame(items, "item_id long, norm_id long, origin string, words array<string>").repartition(4), spark.createDataFrame(texts, "text_id long, norm_id long, words array<string>"))
    for r in found.collect():
        got.setdefault(r["item_id"], []).append((r["text_id"], r["state"], r["origins"], r["fragments"]))
    for item, x in plain_evidence(items, texts).items():
        state = "NO_SOURCE" if x["norm"] == 3 else ("NONE", "UNIQUE", "SEVERAL")[min(2, len(x["hits"]))]
        want = [(t, state, sorted(o), sorted(f, key=lambda p: (-len(p.split()), p))[:5]) for t, (o, f) in sorted(x["hits"].items())] or [(None, state, None, None)]
        assert sorted(got[item], key=str) == sorted(want, key=str), item
