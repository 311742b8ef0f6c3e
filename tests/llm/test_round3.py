"""Language profiles, the Merkle manifest and fill-in-middle, by brute force and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from oracle import connect, same
from pyspark.sql import functions as F

from quillbank.llm import infill, languages, merkle
from quillbank.llm.queries import ORACLE_SQL, QUERIES


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_fill_in_middle"])
def test_same_as_sql(spark, name):
    same(spark, connect(), QUERIES[name], ORACLE_SQL[name])


# --- languages


def plain_vector(text: str) -> np.ndarray:
    out = np.zeros(languages.SIZE)
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    for w in words:
        points = [0, *map(ord, w), 0]
        for a, b, c in zip(points, points[1:], points[2:], strict=False):
            out += np.roll(languages.letter(a).astype(float), 2) * np.roll(languages.letter(b), 1) * languages.letter(c)
    return out


def test_bundles_by_brute_force():
    rng = random.Random(5)
    texts = ["", "a", "Élan vital, 3rd!", "ÀÀ àà _x_ ½ Ⅷ", "!?", "日本 語", " ".join("".join(rng.choices("abcdeéß", k=rng.randrange(1, 9))) for _ in range(3000))]
    got = np.concatenate([languages.bundles(c) for c in languages.chunks([t.encode() for t in texts])])
    for t, v in zip(texts, got, strict=True):
        assert np.allclose(v, plain_vector(t)), t[:20]


def test_many_trigrams_are_made_in_blocks():
    text = "".join(chr(0x4E00 + (k * k) % 9000) for k in range(3 * languages.BLOCK))
    assert np.allclose(languages.bundles([text.encode()])[0], plain_vector(text))


def test_chunks_keep_order_and_whole_texts():
    texts = [b"x" * n for n in (1, languages.CHARS * 2, 3, *[5] * 200)] + [None]
    parts = list(languages.chunks(texts))
    assert [t for p in parts for t in p] == texts
    assert all(len(p) <= languages.TEXTS for p in parts)


def test_learns_only_from_rows_that_are_not_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = QUERIES["op11_language_id"](spark, sf).join(docs.select("doc_id", "lang", "text"), "doc_id").toPandas()
    assert len(found) == docs.count()
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found["doc_id"]]).all()
    tested = found[found["held_out"]]
    assert (tested["lang"] == tested["lang_pred"]).mean() > 0.98
    # what held-out rows say of their language changes nothing
    other = docs.withColumn("lang", F.when(languages.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    again = languages.identify(other).select("doc_id", F.col("lang_pred").alias("p"), F.col("score").alias("s")).toPandas().set_index("doc_id")
    assert (found.set_index("doc_id")["lang_pred"] == again["p"].reindex(found["doc_id"])).all()
    assert np.allclose(found.set_index("doc_id")["score"], again["s"].reindex(found["doc_id"]))


def test_odd_rows_of_languages(spark, docs, empty):
    odd = docs.select("doc_id", "text", "lang", F.lit(7).alias("score"), F.lit("x").alias("lang_pred"), F.lit("y").alias("odd name.")).unionByName(
        spark.createDataFrame([(900, "12 !?", "en", 7, "x", "y"), (901, None, None, 7, "x", "y"), (902, "ka lo ka", None, 7, "x", "y"), (903, "word " * 60000, "en", 7, "x", "y")], "doc_id long, text string, lang string, score int, lang_pred string, `odd name.` string")
    )
    rows = languages.identify(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert (by[900]["lang_pred"], by[900]["score"]) == ("und", 0.0) == (by[901]["lang_pred"], by[901]["score"]) == (by[76]["lang_pred"], by[76]["score"])
    assert by[902]["lang_pred"] == "en" and 0 <= by[902]["score"] <= 1
    assert languages.identify(empty).count() == 0
    # nothing to learn from
    none = languages.identify(odd.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in none] == [("und", 0.0)]


# --- manifest


def tree(nodes: list[str]) -> tuple[str, list[list[str]]]:
    """Root and each leaf's siblings with sides, by the plain rule."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            o = p ^ 1
            paths[i].append(("" if o >= len(nodes) else "<" if p & 1 else ">") + (nodes[o] if o < len(nodes) else ""))
        nodes = [sha("".join(nodes[k : k + 2])) for k in range(0, len(nodes), 2)]
        at = [p // 2 for p in at]
    return nodes[0], paths


def written(*values) -> str:
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


@pytest.mark.parametrize("levels", [1, 3, 8])
def test_manifest_by_brute_force(spark, docs, corpus, levels):
    rows = [(i, t, f"l{(i or 0) % 3}" if (i or 0) % 5 else None, s, n) for i, t, _, s, n in corpus] + [(7, "in a group of its own", "zz", None, 1)] * 2 + [(8, "", "é", "", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("g", F.lit(1)).withColumn("root", F.lit("clash")).repartition(4)
    got = merkle.manifest(frame, levels=levels, keep={"n": F.col("n_chars")})
    got = got.withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).withColumn("proof", merkle.siblings(F.col("path"))).collect()
    groups = {}
    for i, t, lang, s, n in rows:
        groups.setdefault(lang, []).append((-1 if i is None else i, sha(written(i, s, lang, n, t))))
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: tree([x[1] for x in sorted(groups[k])]) for k in names}
    root, over = tree([trees[k][0] for k in names])
    want = []
    for at, k in enumerate(names):
        for (i, leaf), path in zip(sorted(groups[k]), trees[k][1], strict=True):
            want.append((i, leaf, trees[k][0], root, "".join(x[1:] for x in path + over[at]), root))
    assert sorted((-1 if r["id"] is None else r["id"], r["leaf"], r["subroot"], r["root"], r["proof"], r["folded"]) for r in got) == sorted(want)


def test_fields_are_written_apart(spark):
    rows = spark.createDataFrame([("1", None), ("1", ""), (None, "1"), ("é", "-")], "a string, b string")
    got = [r[0] for r in rows.select(merkle.leaf(F.col("a"), F.col("b"))).collect()]
    assert got == [sha("1:1-"), sha("1:10:"), sha("-1:1"), sha("2:é1:-")]


def test_small_manifests(spark, empty):
    assert merkle.manifest(empty).count() == 0
    (one,) = merkle.manifest(spark.createDataFrame([(None, None, None, None, None)], empty.schema)).collect()
    assert one["leaf"] == one["subroot"] == one["root"] == sha("-----") and one["path"] == ""


# --- fill in middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_infill(doc_id, text: str) -> tuple:
    units = UNIT.findall(text)
    n = len(units)
    h = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("frame", [1, 40, 1 << 16])
def test_infill_by_brute_force(spark, docs, frame):
    rng = random.Random(3)
    odd = [(2000 + k, "".join(rng.choices([" ", "\n", "\x0b", " ", "ab", "é", "<", "<S", "P>", "日"], k=rng.randrange(0, 400)))) for k in range(120)]
    odd += [(3000 + k, x) for k, x in enumerate(("   ", " a", "a ", "x<P>y", "a <S>", "<M>", "w" * 5000, "\t" * 3000 + "z" + " " * 3000) * 6)]
    rows = docs.select("doc_id", "text", F.lit("c").alias("frames"), F.lit("d").alias("n")).unionByName(spark.createDataFrame([(*r, "c", "d") for r in odd], "doc_id long, text string, frames string, n string"))
    got = infill.fill_in_middle(infill.store(rows, frame=frame), with_output=True).withColumn("back", infill.restore(F.col("output"), F.col("form"))).collect()
    texts = rows.collect()
    want = [(r["doc_id"], *plain_infill(r["doc_id"], r["text"] or ""), r["text"] or "") for r in texts]
    key = lambda x: tuple(map(str, x))
    assert sorted(((r["id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in got), key=key) == sorted(want, key=key)
    assert all(r["output_sha256"] == sha(r["output"]) and r["restored_sha256"] == sha(r["back"]) for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_a_cut_opens_one_frame():
    text = b" ".join(b"word%d" % k for k in range(5000))
    held = infill.Frames(infill.pack(text, 1000, 3)["frames"])
    opened = []
    inner = held.open
    held.open = type("Counting", (), {"decompress": staticmethod(lambda d: opened.append(1) or inner.decompress(d))})
    k, at = held.cut(2500)
    assert len(held.data) > 20 and len(opened) == 1
    assert b"".join(held.read((0, 0), (k, at))) == b" ".join(b"word%d" % k for k in range(2500))


def test_stored_texts_can_be_written_and_read_again(spark, docs, empty, tmp_path):
    infill.store(docs).write.parquet(str(tmp_path / "stored"))
    again = infill.fill_in_middle(spark.read.parquet(str(tmp_path / "stored")))
    assert sorted(r["output_sha256"] for r in again.collect()) == sorted(sha(plain_infill(r["doc_id"], r["text"] or "")[4]) for r in docs.collect())
    assert infill.fill_in_middle(infill.store(empty)).count() == 0
