"""Near copies among rows that repeat an id or have none."""

from __future__ import annotations

import corpus_pipeline
from quillbank.llm import simhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def _text(name: str, n: int = 60) -> str:
    return " ".join(f"{name}{k}" for k in range(n))


def test_near_copies_stage_judges_rows_without_or_with_repeated_ids(spark):
    texts = [
        (1, _text("a")), (1, _text("b")), (2, _text("a") + " end"), (3, _text("c")), (3, _text("d")), (4, _text("d") + " more"),
        (None, _text("a") + " tail"), (None, _text("e")), (None, _text("e") + " more"), (None, _text("f")), (None, _text("f")), (0, _text("b") + " x"), (7, None), (6, ""), (None, None), (9, _text("g")), (9, _text("g")),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], COLUMNS).repartition(3)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_copies_stage(spark, docs, "").collect()]
    e = {_text("e"), _text("e") + " more"}
    assert len(kept) == 8
    assert {x for x in kept if x[1] not in e} == {(1, _text("a")), (0, _text("b") + " x"), (3, _text("c")), (3, _text("d")), (6, ""), (None, _text("f")), (9, _text("g"))}
    assert len([x for x in kept if x[1] in e and x[0] is None]) == 1


def test_similar_rows_without_an_id_link_like_others(spark):
    rows = [(None, _text("a")), (None, _text("a") + " end"), (5, _text("a") + " tail"), (None, _text("b")), (None, _text("b") + " end")]
    found = simhash.similar_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["id"] or 0, r["component"] or 0) for r in found) == [(0, 0), (0, 0), (0, 5), (0, 5), (5, 5)]
    assert len({r["at"] for r in found}) == 2
