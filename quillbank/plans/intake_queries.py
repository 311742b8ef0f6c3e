"""Queries of the intake (CH-05): files that are new, known, changed, moved, broken or used by banks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank.operators import intake
from quillbank.plans.fixtures import tables, with_views

QUERIES: dict = {}
ORACLE_SQL: dict = {}
_VIEWS = ("f_intake_batch", "f_intake_failed", "f_intake_pool", "f_intake_log", "f_intake_links")


def ch05_intake_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.plan_intake(*tables(spark, sf_dir, *_VIEWS), "b1", 2)[1].drop("version")


def ch05_intake_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that count after the batch."""
    batch, failed, pool, log, links = tables(spark, sf_dir, *_VIEWS)
    rows, entries = intake.plan_intake(batch, failed, pool, log, links, "b1", 2)
    columns = ["import_id", "batch", "row_id", "content_key"]
    return intake.live_rows(pool.select(*columns).unionByName(rows.select(*columns)), log.unionByName(entries)).select(*columns)


# imports are numbered k: what happens to each follows from its number and what it holds
_STEPS = """
fl AS (SELECT DISTINCT file, file_hash, CAST(NULL AS VARCHAR) AS broken FROM f_intake_batch UNION ALL SELECT file, file_hash, error FROM f_intake_failed),
m AS (SELECT f.*, h.import_id AS by_hash, h.state AS hash_state, n.import_id AS by_name, coalesce(h.data, n.data) AS kept FROM fl f LEFT JOIN f_intake_log h ON h.file_hash = f.file_hash LEFT JOIN f_intake_log n ON n.file = f.file AND h.import_id IS NULL),
t AS (SELECT *, coalesce(by_hash, by_name, 'b1/' || file) AS import_id FROM m WHERE broken IS NOT NULL OR by_hash IS NULL OR hash_state <> 'COMPLETED'),
lv AS (SELECT p.* FROM f_intake_pool p JOIN f_intake_log l ON l.import_id = p.import_id AND l.data = p.batch),
us AS (SELECT import_id, count(*) AS n FROM lv WHERE row_id IN (SELECT row_id FROM f_intake_links) GROUP BY import_id),
x AS (SELECT t.*, coalesce(broken, 'LINKED:' || us.n) AS error FROM t LEFT JOIN us ON us.import_id = t.import_id),
r AS (SELECT b.*, x.import_id FROM f_intake_batch b JOIN x ON x.file = b.file AND x.file_hash = b.file_hash AND x.error IS NULL),
fresh AS (SELECT content_key, min(row_id) AS row_id FROM r WHERE content_key NOT IN (SELECT content_key FROM lv WHERE import_id NOT IN (SELECT import_id FROM x WHERE error IS NULL)) GROUP BY content_key)"""
QUERIES["ch05_intake_log"] = ch05_intake_log
ORACLE_SQL["ch05_intake_log"] = with_views(f"""WITH {_STEPS}
SELECT x.import_id, x.file, x.file_hash, CASE WHEN x.error IS NULL THEN 'COMPLETED' ELSE 'ERROR' END AS state, count(f.row_id) AS inserted, count(r.row_id) - count(f.row_id) AS duplicates, x.error, CASE WHEN x.error IS NULL THEN 'b1' ELSE x.kept END AS data
FROM x LEFT JOIN r ON r.import_id = x.import_id LEFT JOIN fresh f ON f.row_id = r.row_id AND f.content_key = r.content_key GROUP BY x.import_id, x.file, x.file_hash, x.error, x.kept""")
QUERIES["ch05_intake_pool"] = ch05_intake_pool
ORACLE_SQL["ch05_intake_pool"] = with_views(f"""WITH {_STEPS}
SELECT import_id, batch, row_id, content_key FROM lv WHERE import_id NOT IN (SELECT import_id FROM x WHERE error IS NULL)
UNION ALL SELECT r.import_id, 'b1', r.row_id, r.content_key FROM r JOIN fresh f ON f.row_id = r.row_id AND f.content_key = r.content_key""")
