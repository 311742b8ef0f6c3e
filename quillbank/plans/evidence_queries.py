"""Queries of merged fragments (TG-05) and literal evidence (DD-20)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank.functions.textnorm import norm_ascii_alnum
from quillbank.operators import evidence as ev
from quillbank.operators import fragments as fr
from quillbank.plans.fixtures import tables, with_views
from quillbank.plans.text_queries import _ua

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def tg05_merge_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    (rows,) = tables(spark, sf_dir, "f_page_fragments")
    found = fr.merge_fragments(rows)
    errors = F.array_join(F.transform("errors", lambda e: F.concat(e["frag"].cast("string"), F.lit(":"), e["error"])), ",")
    return found.withColumn("errors", errors)


def _tidy(c: str) -> str:
    x = f"trim(regexp_replace(coalesce(CAST({c} AS VARCHAR), ''), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'))"
    return f"upper({x})" if c in ("answer", "kind") else x


def _joined(c: str) -> str:
    return f"CASE WHEN x.{c} = '' OR contains(a.{c}, x.{c}) THEN a.{c} WHEN contains(x.{c}, a.{c}) THEN x.{c} ELSE a.{c} || ' ' || x.{c} END AS {c}"


_ALL = ", ".join((*fr.TEXTS, *fr.SCALARS))
_CLASH = "CASE " + " ".join(f"WHEN x.{c} <> '' AND a.{c} <> '' AND x.{c} <> a.{c} THEN {k}" for k, c in enumerate(fr.SCALARS)) + " END"
_NAMED = "CASE clash " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(fr.SCALARS)) + " END"
QUERIES["tg05_merge_fragments"] = tg05_merge_fragments
ORACLE_SQL["tg05_merge_fragments"] = with_views(f"""WITH RECURSIVE t AS (SELECT doc, frag, page, {_tidy("number")} AS number, coalesce(continues, false) AS continues, {", ".join(f"{_tidy(c)} AS {c}" for c in (*fr.TEXTS, *fr.SCALARS))} FROM f_page_fragments),
b AS (SELECT *, CASE WHEN answer NOT IN ('', 'A', 'B', 'C', 'D') THEN 'BAD_ANSWER' WHEN kind NOT IN ('', 'JURIDICA', 'INFORMATICA', 'OTRA') THEN 'BAD_KIND' WHEN number || {" || ".join(fr.TEXTS)} || answer = '' THEN 'EMPTY' END AS bad FROM t),
i AS (SELECT *, CAST(count(*) FILTER (WHERE bad IS NULL AND number <> '') OVER (PARTITION BY doc ORDER BY frag ROWS UNBOUNDED PRECEDING) AS BIGINT) AS item FROM b),
e AS (SELECT *, CASE WHEN bad IS NOT NULL THEN bad WHEN number = '' AND NOT continues THEN 'UNMARKED' WHEN number = '' AND item = 0 THEN 'ORPHAN' END AS error FROM i),
p AS (SELECT *, row_number() OVER (PARTITION BY doc, item ORDER BY frag) AS k FROM e WHERE error IS NULL),
m AS (
  SELECT doc, item, k, number, page AS first_page, page AS last_page, {_ALL}, '' AS errors FROM p WHERE k = 1
  UNION ALL SELECT doc, item, k, number, first_page, CASE WHEN clash IS NULL THEN greatest(last_page, page) ELSE last_page END, {_ALL}, errors || CASE WHEN clash IS NULL THEN '' ELSE CASE WHEN errors = '' THEN '' ELSE ',' END || frag || ':CONFLICT:' || {_NAMED} END
  FROM (SELECT *, {", ".join(f"CASE WHEN new_{c} <> '' AND coalesce(clash > {k}, true) THEN new_{c} ELSE old_{c} END AS {c}" for k, c in enumerate(fr.SCALARS))}
    FROM (SELECT a.doc, a.item, x.k, a.number, first_page, last_page, x.page, x.frag, errors, {_CLASH} AS clash, {", ".join(map(_joined, fr.TEXTS))}, {", ".join(f"x.{c} AS new_{c}, a.{c} AS old_{c}" for c in fr.SCALARS)} FROM m a JOIN p x ON x.doc = a.doc AND x.item = a.item AND x.k = a.k + 1)))
SELECT doc, item, number, CAST(first_page AS BIGINT) AS first_page, CAST(last_page AS BIGINT) AS last_page, {_ALL}, errors FROM m QUALIFY row_number() OVER (PARTITION BY doc, item ORDER BY k DESC) = 1
UNION ALL SELECT doc, NULL, number, page, page, {_ALL}, frag || ':' || error FROM e WHERE error IS NOT NULL""")


def _halves(benchmark: DataFrame) -> DataFrame:
    """Items of the benchmark's texts: the first two thirds of the words are the stem, the rest an option."""
    w = benchmark.select("item_id", (F.col("item_id") % 4).alias("norm_id"), F.split(norm_ascii_alnum(F.col("text")), " ").alias("w"))
    cut = F.floor(F.size("w") * 2 / 3).cast("int")
    parts = F.array(F.struct(F.lit("stem").alias("origin"), F.slice("w", F.lit(1), cut).alias("words")), F.struct(F.lit("opt_a").alias("origin"), F.slice("w", cut + 1, F.size("w")).alias("words")))
    return w.select("item_id", "norm_id", F.inline(parts))


def dd20_literal_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark, docs = tables(spark, sf_dir, "benchmark", "documents")
    texts = docs.select(F.col("doc_id").alias("text_id"), (F.col("doc_id") % 3).alias("norm_id"), F.split(norm_ascii_alnum(F.col("text")), " ").alias("words"))
    found = ev.literal_evidence(_halves(benchmark), texts)
    return found.select("item_id", "state", "text_id", F.array_join("origins", ",").alias("origins"), F.array_join("fragments", "|").alias("fragments"))


def _alnum(x: str) -> str:
    return f"trim(regexp_replace(lower({_ua(x)}), '[^a-z0-9]+', ' ', 'g'))"


QUERIES["dd20_literal_evidence"] = dd20_literal_evidence
# texts that hold none of an item's shortest phrases hold no longer one
ORACLE_SQL["dd20_literal_evidence"] = f"""
WITH w AS (SELECT item_id, item_id % 4 AS norm_id, string_split({_alnum("text")}, ' ') AS w FROM benchmark),
parts AS (SELECT item_id, norm_id, 'stem' AS origin, w[1:CAST(floor(len(w) * 2 / 3) AS INT)] AS w FROM w UNION ALL SELECT item_id, norm_id, 'opt_a', w[CAST(floor(len(w) * 2 / 3) AS INT) + 1:] FROM w),
sizes AS (SELECT item_id, norm_id, origin, w, unnest(range(9, 16)) AS n FROM parts),
ph AS (SELECT DISTINCT item_id, norm_id, origin, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sizes WHERE len(w) >= n)),
d AS (SELECT doc_id, doc_id % 3 AS norm_id, {_alnum("text")} AS t FROM documents),
pairs AS (SELECT DISTINCT item_id, doc_id, t FROM ph JOIN d ON d.norm_id = ph.norm_id WHERE n = 9 AND contains(t, p)),
hits AS (SELECT DISTINCT pairs.item_id, doc_id, origin, n, p FROM pairs JOIN ph ON ph.item_id = pairs.item_id WHERE contains(t, p)),
best AS (SELECT item_id, doc_id, string_agg(p, '|' ORDER BY n DESC, p) AS fragments FROM (SELECT *, row_number() OVER (PARTITION BY item_id, doc_id ORDER BY n DESC, p) AS r FROM (SELECT DISTINCT item_id, doc_id, n, p FROM hits)) WHERE r <= 5 GROUP BY item_id, doc_id),
origins AS (SELECT item_id, doc_id, string_agg(DISTINCT origin, ',' ORDER BY origin) AS origins FROM hits GROUP BY item_id, doc_id),
f AS (SELECT b.item_id, b.doc_id, origins, fragments, count(*) OVER (PARTITION BY b.item_id) AS n FROM best b JOIN origins o ON o.item_id = b.item_id AND o.doc_id = b.doc_id)
SELECT w.item_id, CASE WHEN norm_id NOT IN (SELECT norm_id FROM d) THEN 'NO_SOURCE' WHEN n IS NULL THEN 'NONE' WHEN n = 1 THEN 'UNIQUE' ELSE 'SEVERAL' END AS state, doc_id AS text_id, origins, fragments
FROM w LEFT JOIN f ON f.item_id = w.item_id"""
