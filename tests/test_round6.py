"""Steps that grew faster than their input: what a plan reads or evaluates how often, and small checks of the results."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import functions as F

from quillbank.functions import textnorm as tx
from quillbank.operators import linking, scopes
from quillbank.plans.fixtures import tables


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_scopes_meet_the_index_once(spark):
    lines = spark.range(1, 4).select(F.lit(1).cast("long").alias("norm_id"), F.col("id").alias("pos"), F.concat(F.lit("Artículo "), F.col("id").cast("string")).alias("line"))
    asked = spark.createDataFrame([(1, 1, "artículos 1 y 3, salvo artículo 3"), (2, 1, "artículos 2 y 9"), (3, 1, "Título I"), (4, 1, None), (5, 2, None)], "scope_id long, norm_id long, scope string")
    out = scopes.resolve_scopes(scopes.parse_index(lines), asked)
    assert _plan(out).count("Range (") == 1
    got = sorted(tuple(r) for r in out.select("scope_id", "nth", F.coalesce("article", F.lit("")), F.coalesce("error", F.lit(""))).collect())
    assert got == [(1, 1, "1", ""), (2, 2, "9", "MISSING"), (3, 1, "", "EMPTY"), (4, 1, "1", ""), (4, 2, "2", ""), (4, 3, "3", "")]


def test_rules_of_texts_are_evaluated_once(spark):
    texts = ["Según la LEY ORGÁNICA 3/2012, ARTÍCULO 3.1", "el Decreto 7/2001 y la Ley 7/2015 (artículos 5 y 6)", "CONSTITUCIÓN  ESPAÑOLA", "Ley 1 / 2020", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    out = rows.select(tx.detect_norm_article(F.col("x")).alias("v"))
    assert _plan(out).count("regexp_extract") <= 6
    assert [tuple(r.v) for r in out.collect()] == [
        ("JURIDICA", "LEY_ORGANICA", "LEY ORGÁNICA 3/2012", "3.1"), ("JURIDICA", "LEY", "Ley 7/2015", "5"), ("PENDIENTE", "CONSTITUCION", "CONSTITUCIÓN ESPAÑOLA", None), *[("PENDIENTE", None, None, None)] * 3,
    ]
    out = rows.select(tx.make_norm_explicit(F.col("x"), F.lit("Ley 39/2015")).alias("v"))
    assert _plan(out).count("(?:citado|") == 1
    out = rows.select(tx.citation_parts(F.col("x")).alias("v"))
    assert _plan(out).count("regexp_replace(lower") + _plan(out).count("real decreto legislativo ([0-9]+)") <= 4
    assert [r.v and tuple(r.v) for r in out.collect()][:4] == [("ley organica", "3", "2012", "", ""), ("ley", "7", "2015", "", ""), None, ("ley", "1", "2020", "", "")]


def test_composition_leaves_out_what_is_composed(spark):
    kept = [c for c in map(chr, range(0x3000)) if re.match(tx.COMPOSED, c)]
    # none changes, alone or behind another
    assert len(kept) > 240 and all(unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c) for c in kept)
    assert unicodedata.normalize("NFKC", "".join(a + b for a in kept for b in kept)) == "".join(a + b for a in kept for b in kept)
    texts = ["Ley «3»", "é ñ", "ﬁn ½ ª …", "Привет й", "가", "", None]
    out = spark.createDataFrame([(t,) for t in texts], "x string").select(tx.nfkc(F.col("x")).alias("v"))
    assert [r.v for r in out.collect()] == [t and unicodedata.normalize("NFKC", t) for t in texts]
    # texts that need nothing aren't sent to Python
    assert "RLIKE" in _plan(out) and "_composed" in _plan(out)


def test_catalogue_makes_identities_once(spark):
    rows = [("Ley 3/2007",), ("Ley 3/2007, de 2 de mayo",), ("Real Decreto 4/2001",), ("",), (None,), ("Otra",)]
    names = spark.createDataFrame(rows, "name string").repartition(2)
    out = linking.norm_catalogue(names, spark.createDataFrame([("otra",)], "key string"))
    assert _plan(out).count("LogicalRDD") + _plan(out).count("LocalRelation") <= 2
    assert sorted(tuple(r) for r in out.collect()) == [("ley 3/2007 de 2 de mayo", "Ley 3/2007, de 2 de mayo"), ("real decreto 4/2001", "Real Decreto 4/2001")]


def test_references_are_made_in_many_tasks(spark):
    (refs,) = tables(spark, "/root/testdata/sf0.001", "f_refs")
    assert refs.groupBy(F.spark_partition_id()).count().count() > 1
