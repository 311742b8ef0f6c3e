from __future__ import annotations

import random

import pytest


@pytest.fixture(scope="session")
def corpus():
    """Documents with copies, near copies, shared lines, empty, null, short and long texts, repeated rows and a null id."""
    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("ka", "lo", "Mi", "né", "ru", "Sä", "ti") for b in ("ba", "der", "fin", "gól", "x", "")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for k in range(60):
        t = "\n".join([text(rng.randrange(3, 30)) for _ in range(rng.randrange(1, 6))] + (["A shared line that many hold. "] if k % 4 == 0 else []))
        rows.append((k, t, "en", f"s{k % 3}" if k % 7 else None, len(t)))
    for k in range(60, 75):
        base = rows[k - 60][1]
        rows.append((k, base if k % 2 else base.replace("ka", "KO", 1), "en", "s0", len(base)))
    rows += [(75, "", "en", "s1", 0), (76, None, "en", None, None), (77, "word", "en", "s1", 4), (78, text(3000), "en", "s2", 0), (5, "another text of the same id " * 6, "en", "s0", 0), (6, rows[6][1], "en", "s0", 0), (None, rows[3][1], "en", "s0", 0)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string, n_chars long").withColumn("kept", __import__("pyspark").sql.functions.lit("clash")).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
