"""Queries of audits (AU), each with its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillbank.functions import textnorm as tx
from quillbank.operators import audits as au
from quillbank.operators import linking as lk
from quillbank.plans.bank_queries import EXPECTED, LOCATED, _base, _more_refs, _shared
from quillbank.plans.fixtures import tables, with_views
from quillbank.plans.text_queries import _nsl, _ua

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def register(name: str, views: str, build, sql: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(*tables(spark, sf_dir, *views.split()))
    if sql is not None:
        ORACLE_SQL[name] = with_views(sql)


_lt = lambda b: b.select("link_id", "topic_id", F.lit(True).alias("is_main")).filter("link_id % 31 <> 0").union(b.filter("link_id % 17 = 0").select("link_id", F.col("topic_id") + 1000, F.col("link_id") % 2 == 0))
_lt_sql = "lt AS (SELECT link_id, topic_id, true AS is_main FROM f_bank_links WHERE link_id % 31 <> 0 UNION ALL SELECT link_id, topic_id + 1000, link_id % 2 = 0 FROM f_bank_links WHERE link_id % 17 = 0)"
register("au01_constraint_check", "f_exclusions", lambda x: au.violations(x, "item_id", {"CLASS": ~F.col("class").isin("ERROR_DEMOSTRADO", "NO_DETERMINABLE"), "PROVEN": (F.col("class") == "ERROR_DEMOSTRADO") & (F.col("item_id") % 3 == 0), "STATE": ~F.col("state").isin("CUARENTENA")}), "SELECT item_id, 'PROVEN' AS \"check\" FROM f_exclusions WHERE class = 'ERROR_DEMOSTRADO' AND item_id % 3 = 0 UNION ALL SELECT item_id, 'STATE' FROM f_exclusions WHERE state <> 'CUARENTENA'")
register("au02_included_but_excluded", "f_bank_links f_exclusions", lambda b, x: au.included_but_excluded(b, x).select("link_id"), "SELECT link_id FROM f_bank_links WHERE state = 'INCLUIDA' AND item_id IN (SELECT item_id FROM f_exclusions)")
register("au03_orphans", "orders customer", lambda o, c: au.orphans(o, "o_custkey", c.filter("c_custkey % 11 <> 0"), "c_custkey").select("o_orderkey", "o_custkey"), "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 11 <> 0)")
register("au04_unreferenced", "part lineitem f_norms", lambda p, li, n: au.unreferenced(p.select(F.col("p_partkey").alias("k")), "k", li.filter("l_quantity > 45").select(F.col("l_partkey").alias("k")), n.select(F.col("norm_id").alias("k"))), "SELECT p_partkey AS k FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45) AND p_partkey NOT IN (SELECT norm_id FROM f_norms)")
register("au05_duplicate_keys", "f_refs", lambda r: au.duplicate_keys(r.filter("norm_id is not null"), ["call_id", "topic_id", "norm_id"], "ref_id"), "SELECT call_id, topic_id, norm_id, count(*) AS n, array_to_string(list_sort(list(ref_id)), ',') AS ids FROM f_refs WHERE norm_id IS NOT NULL GROUP BY call_id, topic_id, norm_id HAVING count(*) > 1")
register("au06_topic_defects", "f_bank_links f_topics", lambda b, t: au.topic_defects(b, _lt(b), t), f"""WITH {_lt_sql}, c AS (SELECT b.link_id, count(DISTINCT lt.topic_id) AS n, count(*) FILTER (WHERE is_main) AS mains, coalesce(bool_or(t.call_id <> b.call_id), false) AS alien FROM f_bank_links b LEFT JOIN lt ON lt.link_id = b.link_id LEFT JOIN f_topics t ON t.topic_id = lt.topic_id GROUP BY b.link_id)
 SELECT link_id, 'NO_TOPIC' AS defect FROM c WHERE n = 0 UNION ALL SELECT link_id, 'SEVERAL' FROM c WHERE n > 1 UNION ALL SELECT link_id, 'NOT_ONE_MAIN' FROM c WHERE mains <> 1 UNION ALL SELECT link_id, 'FOREIGN' FROM c WHERE alien""")
register("au07_type_mismatch", "f_bank_links f_items", lambda b, i: au.type_mismatch(b, i.withColumn("kind", F.when(F.col("item_id") % 41 != 0, F.col("kind")))), "SELECT link_id, CASE WHEN b.item_id % 41 <> 0 THEN kind END AS kind, link_type FROM f_bank_links b JOIN f_items i ON i.item_id = b.item_id WHERE b.item_id % 41 <> 0 AND (kind = 'JURIDICA') <> (link_type = 'JURIDICA')")
register("au08_null_part_links", "f_bank_links f_items f_part_rules", lambda b, i, r: b.filter("part_id is null").select("link_id", F.lit("NO_PART").alias("defect")).union(b.join(i.filter("theory_practice = 'PRACTICA'").select("item_id"), "item_id", "left_semi").join(lk.calls_with_practice(r.filter("call_id % 2 = 0")), "call_id", "left_anti").select("link_id", F.lit("PRACTICE"))), "SELECT link_id, 'NO_PART' AS defect FROM f_bank_links WHERE part_id IS NULL UNION ALL SELECT link_id, 'PRACTICE' FROM f_bank_links b WHERE item_id IN (SELECT item_id FROM f_items WHERE theory_practice = 'PRACTICA') AND call_id NOT IN (SELECT call_id FROM f_part_rules WHERE theory_practice = 'PRACTICA' AND call_id % 2 = 0)")
_o = ", ".join(_nsl(f"opt_{c}") for c in "abcd")
register("au09_item_quality", "f_text_items", lambda t: au.item_quality(t.withColumn("answer_key", F.when(F.col("item_id") % 13 == 0, "X").otherwise(F.col("answer_key")))), f"""WITH q AS (SELECT item_id, [{_o}] AS o, CASE WHEN item_id % 13 = 0 THEN 0 ELSE list_position(['A', 'B', 'C', 'D'], answer_key) END AS k FROM f_text_items)
 SELECT item_id, 'BAD_KEY' AS "check" FROM q WHERE k = 0 UNION ALL SELECT item_id, 'KEY_REPEATED' FROM q WHERE k > 0 AND len(list_filter(o, lambda x: x = o[k])) > 1 UNION ALL SELECT item_id, 'DISTRACTORS' FROM q WHERE k > 0 AND len(list_distinct(list_filter(o, lambda x: x <> o[k]))) < len(list_filter(o, lambda x: x <> o[k]))""")
register("au10_field_defects", "f_items", au.field_defects, "SELECT 'key' AS field, count(*) FILTER (WHERE answer_key NOT IN ('A', 'B', 'C', 'D')) AS n FROM f_items UNION ALL SELECT 'norm_name', count(*) FILTER (WHERE trim(norm_name_n) = '') FROM f_items UNION ALL SELECT 'kind', 0 UNION ALL SELECT 'import', 0 UNION ALL SELECT 'page', count(*) FILTER (WHERE page <= 1) FROM f_items")
for _c in ("norm_name_n", "validity", "source_type"):
    register(f"au11_distribution_{_c}", "f_items", lambda i, c=_c: au.distribution(i, c), f"SELECT coalesce(nullif(trim({_c}), ''), '(blank)') AS value, count(*) AS n FROM f_items GROUP BY 1")
register("au12_generated_summary", "f_items", lambda i: au.conditional_counts(i, {"generated": F.col("source_type") == "ia_generada", "legal": (F.col("source_type") == "ia_generada") & (F.col("kind") == "JURIDICA"), "practice": (F.col("source_type") == "ia_generada") & (F.col("theory_practice") == "PRACTICA"), "obsolete": (F.col("source_type") == "ia_generada") & F.col("validity").startswith("OBSOLETA"), "total": F.lit(True)}), "SELECT count(*) FILTER (WHERE source_type = 'ia_generada') AS generated, count(*) FILTER (WHERE source_type = 'ia_generada' AND kind = 'JURIDICA') AS legal, count(*) FILTER (WHERE source_type = 'ia_generada' AND theory_practice = 'PRACTICA') AS practice, count(*) FILTER (WHERE source_type = 'ia_generada' AND validity LIKE 'OBSOLETA%') AS obsolete, count(*) AS total FROM f_items")
register("au13_topic_distribution", "f_topics f_bank_links", au.topic_distribution, "SELECT t.call_id, t.topic_id, count(DISTINCT b.item_id) AS items, count(DISTINCT b.item_id) FILTER (WHERE link_type = 'JURIDICA') AS legal FROM f_topics t LEFT JOIN f_bank_links b ON b.topic_id = t.topic_id AND b.state = 'INCLUIDA' GROUP BY t.call_id, t.topic_id")
register("au14_origin_distribution", "f_bank_links f_items", lambda b, i: b.join(i.select("item_id", "source_type", "theory_practice"), "item_id").groupBy("call_id", "source_type").agg(F.count("*").alias("n"), F.count_if(F.col("theory_practice") == "PRACTICA").alias("practice")), "SELECT call_id, source_type, count(*) AS n, count(*) FILTER (WHERE theory_practice = 'PRACTICA') AS practice FROM f_bank_links b JOIN f_items i ON i.item_id = b.item_id GROUP BY call_id, source_type")
register("au15_bank_totals", "f_bank_links", au.bank_totals, "SELECT call_id, count(*) AS total, count(*) FILTER (WHERE link_type = 'JURIDICA') AS legal, count(*) FILTER (WHERE link_type <> 'JURIDICA') AS other, count(*) FILTER (WHERE state = 'REVISION') AS review FROM f_bank_links GROUP BY ROLLUP (call_id)")
register("au16_ref_state_counts", "f_refs", au.ref_states, "SELECT state, count(*) AS n, count(*) FILTER (WHERE norm_id IS NULL) AS no_norm, count(*) FILTER (WHERE state = 'COMPLETADO' AND norm_id IS NULL) AS done_without_norm FROM f_refs GROUP BY state")
register("au17_norms_never_completed", "f_refs", lambda r: au.norms_never_completed(r.filter("norm_id % 3 <> 0 or state = 'PENDIENTE'")), "SELECT norm_id, count(*) AS n FROM f_refs WHERE norm_id IS NOT NULL AND (norm_id % 3 <> 0 OR state = 'PENDIENTE') GROUP BY norm_id HAVING count(*) FILTER (WHERE state = 'COMPLETADO') = 0")
register("au18_short_or_empty_articles", "f_articles", lambda a: a.select("article_id", F.length(tx.collapsed(F.coalesce("text", F.lit("")))).alias("n")).filter("n < 80"), f"SELECT * FROM (SELECT article_id, length(trim(regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'))) AS n FROM f_articles) WHERE n < 80")
_ra = lambda a: a.select((F.col("article_id") * 3).alias("ref_id"), "norm_id", "article_no", F.when(F.col("article_id") % 9 != 0, F.col("article_id")).alias("article_id"))
_rs = lambda a: a.groupBy("norm_id", "article_no").agg(F.min("article_id").alias("article_id"))
register("au19_resolution_disagreements", "f_articles", lambda a: au.resolution_disagreements(_ra(a), _rs(a), a), "WITH r AS (SELECT article_id * 3 AS ref_id, norm_id, article_no, CASE WHEN article_id % 9 <> 0 THEN article_id END AS article_id FROM f_articles), s AS (SELECT norm_id, article_no, min(article_id) AS resolved FROM f_articles GROUP BY norm_id, article_no) SELECT ref_id, r.article_id, resolved, coalesce(x.text_hash = y.text_hash, false) AS same_text FROM r JOIN s ON s.norm_id = r.norm_id AND s.article_no = r.article_no LEFT JOIN f_articles x ON x.article_id = r.article_id LEFT JOIN f_articles y ON y.article_id = resolved WHERE r.article_id IS DISTINCT FROM resolved")
register("au20_corpus_completeness", "f_refs", au.corpus_completeness, "SELECT call_id, count(*) AS total, count(*) FILTER (WHERE state = 'COMPLETADO') AS done, count(norm_id) AS linked, count(DISTINCT (norm_id, article_asked)) FILTER (WHERE state = 'COMPLETADO') AS articles FROM f_refs GROUP BY call_id")
register("au21_call_documents", "f_refs f_norms", lambda r, n: r.join(n, "norm_id").groupBy("call_id", "source_id").agg(F.min("norm_name").alias("name")), "SELECT call_id, source_id, min(norm_name) AS name FROM f_refs r JOIN f_norms n ON n.norm_id = r.norm_id GROUP BY call_id, source_id")
register("au22_topic_counts", "f_topics f_refs", lambda t, r: t.join(r.select("topic_id").distinct().withColumn("has", F.lit(True)), "topic_id", "left").rollup("call_id", "part").agg(F.count("*").alias("topics"), F.count("has").alias("with_refs")), "SELECT call_id, part, count(*) AS topics, count(h.topic_id) AS with_refs FROM f_topics t LEFT JOIN (SELECT DISTINCT topic_id FROM f_refs) h ON h.topic_id = t.topic_id GROUP BY ROLLUP (call_id, part)")
register("au23_name_variants", "f_citations", lambda c: au.name_variants(c, tx.norm_punct(F.regexp_replace("name", "[«»]", ""))), f"SELECT trim(regexp_replace(regexp_replace(lower({_ua(chr(114) + 'egexp_replace(name, ' + chr(39) + '[«»]' + chr(39) + ', ' + chr(39) * 2 + ', ' + chr(39) + 'g' + chr(39) + ')')}), '[_/\\\\.,;:()\\[\\]{{}}\\-]+', ' ', 'g'), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) AS key, string_agg(DISTINCT name, ' | ' ORDER BY name) AS variants, count(DISTINCT name) AS n, min(item_id) AS first_id, max(item_id) AS last_id FROM f_citations GROUP BY key HAVING count(DISTINCT name) > 1")
register("au24_blueprint_check", "f_blueprint f_parts f_refs f_topics", lambda b, p, r, t: au.blueprint_check(b, p, r.join(t.select("topic_id", "part"), "topic_id").join(p.select("part_id", F.col("call_id"), F.col("name").alias("part")), ["call_id", "part"]).filter("norm_id % 4 <> 0")), """WITH al AS (SELECT DISTINCT p.part_id, r.norm_id FROM f_refs r JOIN f_topics t ON t.topic_id = r.topic_id JOIN f_parts p ON p.call_id = r.call_id AND p.name = t.part WHERE r.norm_id % 4 <> 0)
 SELECT b.part_id, 'SUM' AS "check" FROM f_blueprint b JOIN f_parts p ON p.part_id = b.part_id GROUP BY b.part_id HAVING sum(amount) <> any_value(n_items) UNION ALL SELECT DISTINCT b.part_id, 'NORM' FROM f_blueprint b WHERE block_type = 'NORMA' AND NOT EXISTS (SELECT 1 FROM al WHERE al.part_id = b.part_id AND al.norm_id = b.norm_id)""")
register("au25_rule_coverage", "f_part_rules f_topics f_refs", au.rule_coverage, "SELECT r.part_id, r.priority, count(DISTINCT t.topic_id) AS topics, CAST(sum(coalesce(n.refs, 0)) AS BIGINT) AS refs FROM f_part_rules r LEFT JOIN f_topics t ON t.call_id = r.call_id AND (r.syllabus_part IS NULL OR upper(r.syllabus_part) = upper(t.part)) AND (r.content_type IS NULL OR upper(r.content_type) = upper(t.content_type)) LEFT JOIN (SELECT topic_id, count(*) AS refs FROM f_refs GROUP BY topic_id) n ON n.topic_id = t.topic_id GROUP BY r.part_id, r.priority")
register("au26_gap_report", "f_refs f_topics f_bank_links f_items", lambda r, t, b, i: au.gap_report(lk.located_refs(r, t), b, i), f"WITH {LOCATED}, hv AS (SELECT DISTINCT b.call_id, i.norm_id, {_base('i.article_n')} AS base FROM f_bank_links b JOIN f_items i ON i.item_id = b.item_id WHERE b.state = 'INCLUIDA') SELECT call_id, topic_id, count(*) AS open_refs FROM l WHERE norm_id IS NOT NULL AND base IS NOT NULL AND NOT EXISTS (SELECT 1 FROM hv WHERE hv.call_id = l.call_id AND hv.norm_id = l.norm_id AND hv.base = l.base) GROUP BY call_id, topic_id")
_ch = "ch AS (SELECT norm_id, sha256(string_agg(text_hash, '' ORDER BY article_no, article_id)) AS hash FROM f_articles GROUP BY norm_id)"
register("au27_freshness", "f_articles", lambda a: au.freshness(au.content_hash(a, "norm_id").filter("norm_id <> 2").select((F.when(F.col("norm_id") == 3, 99).otherwise(F.col("norm_id"))).alias("norm_id"), F.when(F.col("norm_id") == 5, None).when(F.col("norm_id") == 6, "x").otherwise(F.col("hash")).alias("stored_hash")), a), f"WITH {_ch}, c AS (SELECT CASE WHEN norm_id = 3 THEN 99 ELSE norm_id END AS norm_id, CASE WHEN norm_id = 5 THEN NULL WHEN norm_id = 6 THEN 'x' ELSE hash END AS sh FROM ch WHERE norm_id <> 2) SELECT coalesce(c.norm_id, ch.norm_id) AS norm_id, CASE WHEN c.norm_id IS NULL THEN 'NEW' WHEN hash IS NULL THEN 'SURPLUS' WHEN sh IS NULL THEN 'NO_HASH' WHEN sh <> hash THEN 'STALE' ELSE 'OK' END AS state FROM c FULL JOIN ch ON ch.norm_id = c.norm_id")
_src = lambda a: a.withColumn("source_id", F.concat("source_id", F.lit("-"), (F.col("article_id") % 3).cast("string")))
register("au28_canonical_source", "f_articles", lambda a: au.canonical_source(_src(a)), "WITH b AS (SELECT norm_id, source_id || '-' || CAST(article_id % 3 AS VARCHAR) AS s, count(*) AS n, string_agg(text_hash, '' ORDER BY text_hash) AS h FROM f_articles GROUP BY 1, 2), r AS (SELECT *, rank() OVER (PARTITION BY norm_id ORDER BY n DESC) AS r FROM b) SELECT norm_id, CASE WHEN count(DISTINCT h) = 1 THEN min(s) END AS source_id FROM r WHERE r = 1 GROUP BY norm_id")
register("au29_full_validation", "f_bank_links f_exclusions f_items f_topics f_refs", lambda b, x, i, t, r: au.full_validation([("excluded", au.included_but_excluded(b, x), 0), ("no_part", b.filter("part_id is null"), 0), ("types", au.type_mismatch(b, i), 10**6), ("surplus", lk.surplus_links(lk.expected_bank(i, r, t), b), 10**6)]), f"""WITH {LOCATED}, {EXPECTED}, m AS (SELECT 'excluded' AS "check", (SELECT count(*) FROM f_bank_links WHERE state = 'INCLUIDA' AND item_id IN (SELECT item_id FROM f_exclusions)) AS value, 0 AS most UNION ALL SELECT 'no_part', (SELECT count(*) FROM f_bank_links WHERE part_id IS NULL), 0
 UNION ALL SELECT 'types', (SELECT count(*) FROM f_bank_links b JOIN f_items i ON i.item_id = b.item_id WHERE (kind = 'JURIDICA') <> (link_type = 'JURIDICA')), 1000000 UNION ALL SELECT 'surplus', (SELECT count(*) FROM f_bank_links b WHERE link_type = 'JURIDICA' AND NOT EXISTS (SELECT 1 FROM ex WHERE ex.call_id = b.call_id AND ex.item_id = b.item_id)), 1000000)
 SELECT "check", value, most, value <= most AS ok FROM m UNION ALL SELECT 'ALL', count(*) FILTER (WHERE value > most), 0, bool_and(value <= most) FROM m""")
register("au30_cost_by_session", "f_cost_log", lambda c: au.cost_by_session(c, 12.06).select("session_id", "calls", F.col("total").cast("double").alias("total"), F.col("closing").cast("double").alias("closing")), "SELECT session_id, calls, CAST(total AS DOUBLE) AS total, CAST(12.06 - sum(total) OVER (ORDER BY session_id) AS DOUBLE) AS closing FROM (SELECT session_id, count(*) AS calls, sum(cost) AS total FROM f_cost_log GROUP BY session_id)")
register("au31_budget_stop", "f_cost_log", lambda c: au.budget_stop(c, 100), "WITH r AS (SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, sum(cost) OVER (PARTITION BY CAST(ts AS DATE), operation ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS spent FROM f_cost_log), f AS (SELECT *, row_number() OVER (PARTITION BY day, operation ORDER BY ts, event_id) AS n FROM r WHERE spent > 100) SELECT day, operation, event_id FROM f WHERE n = 1")
_ti = lambda t: t.select("*", (1 + F.col("item_id") % 10).alias("norm_id"), (1 + F.floor(F.col("item_id") / 10) % 40).cast("int").alias("article_no"))
register("au32_textuality", "f_text_items f_articles", lambda t, a: au.textuality(_ti(t).filter("item_id % 3 <> 0").union(_ti(t).filter("item_id % 3 = 0").withColumn("opt_a", F.lit("zzz")).withColumn("opt_b", F.lit("zzz")).withColumn("opt_c", F.lit("zzz")).withColumn("opt_d", F.lit("zzz"))), a), f"""WITH i AS (SELECT item_id, 1 + item_id % 10 AS norm_id, CAST(1 + floor(item_id / 10) % 40 AS INT) AS article_no, CASE WHEN item_id % 3 = 0 THEN 'zzz' ELSE ([{_o}])[list_position(['A', 'B', 'C', 'D'], answer_key)] END AS key FROM f_text_items),
 s AS (SELECT item_id, count(a.article_id) AS n, bool_or(contains({_nsl('a.text')}, key)) AS lit FROM i LEFT JOIN f_articles a ON a.norm_id = i.norm_id AND a.article_no = i.article_no GROUP BY item_id) SELECT CASE WHEN n = 0 THEN 'NO_TEXT' WHEN lit THEN 'LITERAL' ELSE 'NOT_LITERAL' END AS state, count(*) AS n FROM s GROUP BY 1""")
register("au33_articles_by_source", "f_articles f_refs", lambda a, r: a.groupBy("source_id").agg(F.count("*").alias("n")).join(r.filter("norm_id is not null").groupBy(F.concat(F.lit("DOC-"), F.col("norm_id").cast("string")).alias("source_id")).agg(F.count("*").alias("refs")), "source_id", "full"), "SELECT coalesce(a.source_id, r.source_id) AS source_id, n, refs FROM (SELECT source_id, count(*) AS n FROM f_articles GROUP BY 1) a FULL JOIN (SELECT 'DOC-' || CAST(norm_id AS VARCHAR) AS source_id, count(*) AS refs FROM f_refs WHERE norm_id IS NOT NULL GROUP BY 1) r ON r.source_id = a.source_id")
register("au35_ref_collisions", "f_refs f_topics", lambda r, t: lk.located_refs(_more_refs(r), t).filter("norm_id is not null and base is not null").groupBy("call_id", "norm_id", "base").agg(F.count("*").alias("refs"), F.count_distinct("topic_id").alias("topics")).filter("topics > 1 or refs > 1"), f"WITH r2 AS ({_shared}), {LOCATED.replace('FROM f_refs r', 'FROM r2 r')} SELECT call_id, norm_id, base, count(*) AS refs, count(DISTINCT topic_id) AS topics FROM l WHERE norm_id IS NOT NULL AND base IS NOT NULL GROUP BY ALL HAVING count(DISTINCT topic_id) > 1 OR count(*) > 1")
register("au36_part_sizes_check", "f_parts f_calls", lambda p, c: au.part_sizes_check(p.withColumn("part_order", F.when(F.col("part_id") == 13, 1).otherwise(F.col("part_order"))), c.select("call_id", (55 + 5 * (F.col("call_id") % 2)).alias("n_items"))), "SELECT call_id, 'SUM' AS \"check\" FROM (SELECT c.call_id, 55 + 5 * (c.call_id % 2) AS n, sum(n_items) AS t FROM f_calls c JOIN f_parts p ON p.call_id = c.call_id GROUP BY 1, 2) WHERE n <> t UNION ALL SELECT call_id, 'ORDER' FROM f_parts WHERE part_id = 13")
register("au37_coverage_by_source", "f_items f_bank_links", lambda i, b: i.join(b.select("item_id").distinct().withColumn("linked", F.lit(True)), "item_id", "left").groupBy("source_type").agg(F.count_distinct("import_id").alias("files"), F.count("*").alias("items"), F.count("linked").alias("used")), "SELECT source_type, count(DISTINCT import_id) AS files, count(*) AS items, count(b.item_id) AS used FROM f_items i LEFT JOIN (SELECT DISTINCT item_id FROM f_bank_links) b ON b.item_id = i.item_id GROUP BY source_type")
register("au38_pending_by_norm", "f_refs", lambda r: r.filter("state <> 'COMPLETADO'").groupBy("call_id", "norm_name", "state").agg(F.count("*").alias("n")), "SELECT call_id, norm_name, state, count(*) AS n FROM f_refs WHERE state <> 'COMPLETADO' GROUP BY ALL")
register("au39_ref_defects", "f_refs", lambda r: r.select("ref_id", F.when(F.col("state") != "COMPLETADO", "NOT_COMPLETED").when(F.col("norm_id").isNull(), "NO_NORM").when(tx.article_base(F.col("article_asked")).isNull(), "NO_ARTICLE").alias("reason")).filter("reason is not null"), f"SELECT * FROM (SELECT ref_id, CASE WHEN state <> 'COMPLETADO' THEN 'NOT_COMPLETED' WHEN norm_id IS NULL THEN 'NO_NORM' WHEN {_base('article_asked')} IS NULL THEN 'NO_ARTICLE' END AS reason FROM f_refs) WHERE reason IS NOT NULL")
register("au40_expected_refs_check", "f_refs", lambda r: au.expected_rows_check(r.filter("ref_id % 7 <> 0"), r.filter("ref_id % 5 <> 0"), ["ref_id"]), "SELECT ref_id, 'MISSING' AS diff FROM f_refs WHERE ref_id % 7 <> 0 AND ref_id % 5 = 0 UNION ALL SELECT ref_id, 'SURPLUS' FROM f_refs WHERE ref_id % 7 = 0 AND ref_id % 5 <> 0")
