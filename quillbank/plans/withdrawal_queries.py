"""Queries of the withdrawal of easy items (WN-13), both rules, with an oracle that walks the scopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank.operators import withdrawal as wd
from quillbank.plans.fixtures import tables, with_views

QUERIES: dict = {}
ORACLE_SQL: dict = {}
_VIEWS = ("f_parts", "f_blueprint", "f_gate_items", "f_exclusions", "f_bank_links")


def _levelled(items: DataFrame) -> DataFrame:
    return items.withColumn("level", F.when(F.col("item_id") % 6 > 0, F.col("item_id") % 6 - 1))


def wn13_withdrawal_by_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, blueprint, items, exclusions, links = tables(spark, sf_dir, *_VIEWS)
    scopes, needs = wd.protected_scopes(parts, blueprint, links, items, exclusions)
    return wd.ordered_withdrawal(wd.easy_by_score(items, exclusions), scopes, needs, wd.TIMES_BY_SCORE)


def wn13_withdrawal_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, blueprint, items, exclusions, links = tables(spark, sf_dir, *_VIEWS)
    excluded = exclusions.filter("state in ('CUARENTENA', 'RETIRADA')")
    scopes, needs = wd.protected_scopes(parts, blueprint, links, items, excluded)
    easy = wd.easy_by_level(_levelled(items), exclusions, items.filter("item_id % 43 = 0"))
    return wd.ordered_withdrawal(easy, scopes, needs, wd.TIMES_BY_LEVEL)


def wn13_protected_withdrawal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Withdrawn items where each call is one scope and needs a sixteenth of its links."""
    items, links = tables(spark, sf_dir, "f_items", "f_bank_links")
    easy = items.groupBy("item_id").agg(F.min("score").cast("long").alias("score")).filter(F.col("score") >= wd.SCORE)
    call = F.col("call_id").cast("long")
    place = F.struct(call.alias("part"), F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("norm"))
    needs = links.groupBy("call_id").agg(F.floor(F.count("*") / 16).cast("long").alias("need")).select(call.cast("string").alias("scope"), place.alias("place"), "need")
    out = wd.ordered_withdrawal(easy, links.select(call.cast("string").alias("scope"), "item_id"), needs, wd.TIMES_BY_SCORE)
    return out.filter("kept_by is null").select("item_id", "score")


def _walk(tables_sql: str, order: str, times: int, result: str) -> str:
    """Scope after scope, of ``easy``, ``member`` and ``needs``; the state is the list of items given back and, beside it, of the scopes that did."""
    return with_views(f"""WITH RECURSIVE {tables_sql},
sc AS (
  SELECT row_number() OVER (ORDER BY {order}) AS k, n.scope, {times} * any_value(need) - count(*) + count(e.item_id) AS short, list(e.item_id ORDER BY score, e.item_id) FILTER (WHERE e.item_id IS NOT NULL) AS inside
  FROM needs n JOIN member m ON m.scope = n.scope LEFT JOIN easy e ON e.item_id = m.item_id GROUP BY n.scope, {order}),
st AS (
  SELECT CAST(0 AS BIGINT) AS k, []::BIGINT[] AS kept, []::VARCHAR[] AS who
  UNION ALL
  SELECT x.k + 1, list_concat(kept, took), list_concat(who, list_transform(took, lambda y: CAST(scope AS VARCHAR)))
  FROM (SELECT st.k, kept, who, scope, list_filter(coalesce(inside, []), lambda y: NOT list_contains(kept, y))[1:CAST(greatest(0, short - len(list_intersect(coalesce(inside, []), kept))) AS BIGINT)] AS took FROM st JOIN sc ON sc.k = st.k + 1) x),
fin AS (SELECT unnest(kept) AS item_id, unnest(who) AS kept_by FROM st WHERE k = (SELECT max(k) FROM st))
{result}""")


def _oracle(easy: str, excluded: str, times: int) -> str:
    return _walk(f"""easy AS ({easy}),
live AS (SELECT DISTINCT part_id, item_id FROM f_bank_links WHERE state = 'INCLUIDA' AND part_id IN (SELECT part_id FROM f_parts) AND item_id NOT IN (SELECT item_id FROM f_exclusions WHERE {excluded})),
named AS (SELECT part_id, norm_id, sum(amount) AS need, min(block_order) AS block FROM f_blueprint WHERE block_type = 'NORMA' AND norm_id IS NOT NULL GROUP BY part_id, norm_id),
needs AS (SELECT CAST(part_id AS VARCHAR) AS scope, part_id, -1 AS block, 0 AS norm, n_items AS need FROM f_parts UNION ALL SELECT part_id || '/' || norm_id, part_id, block, norm_id, need FROM named),
member AS (SELECT DISTINCT CAST(part_id AS VARCHAR) AS scope, item_id FROM live UNION ALL SELECT DISTINCT l.part_id || '/' || n.norm_id, l.item_id FROM live l JOIN f_gate_items i ON i.item_id = l.item_id AND i.theory_practice = 'TEORICA' JOIN named n ON n.part_id = l.part_id AND n.norm_id = i.norm_id)""",
        "part_id, block, norm", times, "SELECT easy.item_id, CAST(score AS BIGINT) AS score, kept_by FROM easy LEFT JOIN fin ON fin.item_id = easy.item_id")


QUERIES["wn13_protected_withdrawal"] = wn13_protected_withdrawal
ORACLE_SQL["wn13_protected_withdrawal"] = _walk("""easy AS (SELECT item_id, min(score) AS score FROM f_items GROUP BY item_id HAVING min(score) >= 20),
member AS (SELECT DISTINCT call_id AS scope, item_id FROM f_bank_links),
needs AS (SELECT call_id AS scope, call_id AS place, floor(count(*) / 16) AS need FROM f_bank_links GROUP BY call_id)""", "place", wd.TIMES_BY_SCORE, "SELECT item_id, CAST(score AS BIGINT) AS score FROM easy WHERE item_id NOT IN (SELECT item_id FROM fin)")  # fmt: skip
QUERIES["wn13_withdrawal_by_score"] = wn13_withdrawal_by_score
ORACLE_SQL["wn13_withdrawal_by_score"] = _oracle("SELECT item_id, score FROM f_gate_items WHERE kind = 'JURIDICA' AND source_type = 'ia_generada' AND answer_key IN ('A', 'B', 'C', 'D') AND score >= 20 AND item_id NOT IN (SELECT item_id FROM f_exclusions)", "true", wd.TIMES_BY_SCORE)
QUERIES["wn13_withdrawal_by_level"] = wn13_withdrawal_by_level
ORACLE_SQL["wn13_withdrawal_by_level"] = _oracle("SELECT item_id, CASE WHEN item_id % 6 > 0 THEN item_id % 6 - 1 END AS score FROM f_gate_items WHERE kind = 'JURIDICA' AND theory_practice <> 'PRACTICA' AND source_type NOT IN ('apoyo', 'modelo') AND item_id % 6 >= 3 AND item_id % 43 <> 0 AND item_id NOT IN (SELECT item_id FROM f_exclusions WHERE state IN ('CUARENTENA', 'RETIRADA'))", "state IN ('CUARENTENA', 'RETIRADA')", wd.TIMES_BY_LEVEL)
