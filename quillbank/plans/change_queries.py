"""Queries of verdicts (VD), allocation (WN), change sets (CH), publication (PB) and the remaining links and filters, each with its oracle."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillbank.functions import textnorm as tx
from quillbank.operators import allocation as wn
from quillbank.operators import changes as ch
from quillbank.operators import linking as lk
from quillbank.operators import verdicts as vd
from quillbank.plans.bank_queries import _base
from quillbank.plans.fixtures import tables, with_views
from quillbank.plans.text_queries import _identity_sql

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def register(name: str, views: str, build, sql: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(*tables(spark, sf_dir, *views.split()))
    if sql is not None:
        ORACLE_SQL[name] = with_views(sql)



def c(name):
    return F.col(name)


_two = lambda: vd.verdict_two_pass(c("stored"), c("p1"), c("p1_about"), c("p2"), c("p2_about"), c("quote_ok"))
_two_sql = "CASE WHEN p1 IS NULL THEN 'NOT_AUDITED' WHEN p1 = stored AND p1_about = 'S' THEN 'OK' WHEN p2 IS NULL THEN 'UNDECIDED' WHEN p2 = stored AND p2_about = 'S' THEN 'OK_P2' WHEN p2_about = 'N' THEN 'REVIEW_ARTICLE' WHEN p2 = '?' THEN 'UNDECIDED' WHEN p2 = p1 AND quote_ok THEN 'ERROR_KEY' ELSE 'REVIEW_KEY' END"
register("vd01_verdict_two_pass", "f_answers", lambda a: a.select("item_id", _two().alias("verdict")), f"SELECT item_id, {_two_sql} AS verdict FROM f_answers")
_st = lambda: F.create_map(*[x for k in range(4) for x in (F.lit("ABCD"[k]), F.substring(F.lit("TFFF?F"), ((c("item_id") + k * (1 + c("item_id") % 3)) % 6 + 1).cast("int"), F.lit(1)))])
_sts = [f"substr('TFFF?F', CAST((item_id + {k} * (1 + item_id % 3)) % 6 + 1 AS INT), 1)" for k in range(4)]
register("vd02_verdict_matrix", "f_items", lambda i: i.select("item_id", vd.verdict_matrix(_st(), c("answer_key")).alias("verdict")), f"WITH v AS (SELECT item_id, answer_key, [{', '.join(_sts)}] AS v FROM f_items) SELECT item_id, CASE WHEN list_contains(v, '?') THEN 'UNDECIDABLE:OPEN' WHEN len(list_filter(v, lambda x: x = 'T')) = 0 THEN 'UNDECIDABLE:NONE' WHEN len(list_filter(v, lambda x: x = 'T')) > 1 THEN 'UNDECIDABLE:SEVERAL' WHEN list_position(['A', 'B', 'C', 'D'], answer_key) > 0 AND v[list_position(['A', 'B', 'C', 'D'], answer_key)] = 'T' THEN 'CONFIRMED' ELSE 'PROVEN_ERROR' END AS verdict FROM v")
register("vd03_two_audits", "f_answers", lambda a: a.select("item_id", vd.two_audits(c("p1"), c("p2"), c("stored")).alias("verdict")), "SELECT item_id, CASE WHEN p1 = stored THEN 'CONFIRMED' WHEN p2 IS NULL THEN 'PENDING' WHEN p2 = stored THEN 'DISPUTED' WHEN p1 = p2 AND p1 <> '?' THEN 'ERROR' ELSE 'UNDECIDED' END AS verdict FROM f_answers")
_tot = lambda: vd.two_of_three(c("stored"), c("p1"), F.coalesce(c("p2"), F.lit("?")))
register("vd04_two_of_three", "f_answers", lambda a: a.select("item_id", _tot()["verdict"].alias("verdict"), _tot()["disputed"].alias("disputed")), "SELECT item_id, coalesce(CASE WHEN stored = p1 THEN stored WHEN stored = coalesce(p2, '?') THEN stored WHEN p1 = coalesce(p2, '?') THEN p1 END, coalesce(p2, '?')) AS verdict, stored <> p1 OR p1 <> coalesce(p2, '?') AS disputed FROM f_answers")
register("vd05_third_pass_class", "f_answers", lambda a: a.select("item_id", vd.third_pass_class(c("stored"), c("p1"), c("p2")).alias("cls")), "SELECT item_id, CASE WHEN p2 IS NULL OR p2 = '?' THEN 'UNDECIDED' WHEN p2 = p1 THEN 'CONFIRMS' WHEN p2 = stored THEN 'RECOVERS' ELSE 'THIRD' END AS cls FROM f_answers")
_vp = lambda: vd.validation_passed([c("p1_about") == "S", c("p2_about") == "S", c("quote_ok")])
register("vd06_validation_passed", "f_answers", lambda a: a.select("item_id", _vp()["passed"].alias("passed"), _vp()["contradiction"].alias("contradiction")), "WITH n AS (SELECT item_id, CAST(p1_about = 'S' AS INT) + CAST(p2_about = 'S' AS INT) + CAST(quote_ok AS INT) AS n FROM f_answers) SELECT item_id, n = 3 AS passed, n > 0 AND n < 3 AS contradiction FROM n")
_acc = lambda: vd.accept_answer(c("p1_about") == "S", c("p2"), c("quote_ok"), F.when(c("item_id") % 5 != 0, "SI"), F.when(c("item_id") % 4 == 0, c("p1")), c("stored"))
register("vd07_accept_answer", "f_answers", lambda a: a.select("item_id", _acc().alias("reason")), "SELECT item_id, CASE WHEN p1_about <> 'S' THEN 'NOT_LEGAL' WHEN p2 IS NULL THEN 'NO_ARTICLE' WHEN NOT quote_ok THEN 'QUOTE' WHEN item_id % 5 = 0 THEN 'NOT_IN_FORCE' WHEN item_id % 4 = 0 AND p1 <> stored THEN 'OTHER_KEY' ELSE 'ACCEPTED' END AS reason FROM f_answers")
register("vd08_verdict_pivot", "f_answers", lambda a: vd.verdict_pivot(a.withColumn("v", _two()), "stored", "v", ["OK", "OK_P2", "ERROR_KEY"]), f"SELECT stored, count(*) FILTER (WHERE v = 'OK') AS ok, count(*) FILTER (WHERE v = 'OK_P2') AS ok_p2, count(*) FILTER (WHERE v = 'ERROR_KEY') AS error_key, count(*) AS total FROM (SELECT stored, {_two_sql} AS v FROM f_answers) GROUP BY ROLLUP (stored)")
register("vd09_latest_checkpoint", "events", lambda e: vd.latest_checkpoint(e.select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id"), "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id, event_type")
_q10 = lambda: [(c("validity") == "VIGENTE").cast("int"), c("score"), -c("item_id")]
register("vd10_validity_group_apply", "f_items", lambda i: vd.validity_group_apply(i.groupBy("item_id").agg(F.max(F.struct("norm_id", "article_n", "validity", "score")).alias("r")).select("item_id", "r.*"), ["norm_id", "article_n"], _q10()), "WITH i AS (SELECT item_id, r.* FROM (SELECT item_id, max(struct_pack(norm_id := coalesce(norm_id, -1), article_n := article_n, validity := validity, score := score)) AS r FROM f_items GROUP BY item_id)), b AS (SELECT *, row_number() OVER (PARTITION BY norm_id, article_n ORDER BY (validity = 'VIGENTE') DESC, score DESC, item_id) AS n FROM i) SELECT i.item_id, i.validity, b.validity AS new_validity, b.item_id AS decided_by FROM i JOIN b ON b.norm_id = i.norm_id AND b.article_n = i.article_n AND b.n = 1 WHERE i.validity <> b.validity")
_na = lambda: vd.normalise_answer(F.when(c("item_id") % 3 == 0, "APPROVED").when(c("item_id") % 3 == 1, "CORRECTED").otherwise("OPEN"), [c("name"), c("article")], F.substring("stem", 5, 20), F.concat(c("stem"), c("name")))
register("vd11_normalise_answer", "f_citations", lambda i: i.select("item_id", _na().alias("state")), "SELECT item_id, CASE WHEN item_id % 3 < 2 AND trim(coalesce(name, '')) <> '' AND trim(coalesce(article, '')) <> '' AND length(substr(stem, 5, 20)) >= 12 THEN CASE item_id % 3 WHEN 0 THEN 'APPROVED' ELSE 'CORRECTED' END ELSE 'UNRESOLVED' END AS state FROM f_citations")
register("vd12_answer_batch_check", "f_answers", lambda a: vd.batch_check(a.filter("item_id % 11 <> 0").select((c("item_id") % 50).alias("batch"), "item_id"), a.filter("item_id % 13 <> 0").select((c("item_id") % 50).alias("batch"), "item_id", F.when(c("stored") != "X", c("stored")).alias("answer"))), "WITH a AS (SELECT DISTINCT item_id % 50 AS batch, item_id FROM f_answers WHERE item_id % 11 <> 0), b AS (SELECT item_id % 50 AS batch, item_id, stored FROM f_answers WHERE item_id % 13 <> 0) SELECT batch, CAST(count(*) FILTER (WHERE item_id % 13 = 0) AS INT) AS missing, CAST((SELECT count(DISTINCT b.item_id) FROM b WHERE b.batch = a.batch AND b.item_id % 11 = 0) AS INT) AS foreign_ids, (SELECT count(*) FROM b WHERE b.batch = a.batch AND stored = 'X') AS invalid FROM a GROUP BY batch")
register("vd13_latest_phase_status", "f_answers", lambda a: a.groupBy(vd.latest_phase_status(F.when(c("p1") != "?", c("p1")), c("p2")).alias("status")).agg(F.count("*").alias("n")), "SELECT coalesce(p2, CASE WHEN p1 <> '?' THEN p1 END, 'PENDING') AS status, count(*) AS n FROM f_answers GROUP BY 1")
register("vd14_guessable_filter", "f_items f_answers", lambda i, a: vd.guessable_filter(i.select("item_id", "answer_key").distinct(), a.groupBy("item_id").agg(F.min("p1").alias("guess"))), "SELECT DISTINCT i.item_id, answer_key FROM f_items i LEFT JOIN (SELECT item_id, min(p1) AS guess FROM f_answers GROUP BY item_id) a ON a.item_id = i.item_id WHERE guess IS NULL OR guess <> answer_key")

_u = "u AS (SELECT item_id, any_value(norm_id) AS norm_id FROM f_items GROUP BY item_id)"
register("wn01_examples_per_group", "f_text_items", lambda t: vd.first_per_group(t, ["source_type"], [c("item_id")], 3).select("source_type", "item_id", "rank"), "SELECT * FROM (SELECT source_type, item_id, CAST(row_number() OVER (PARTITION BY source_type ORDER BY item_id) AS INT) AS rank FROM f_text_items) WHERE rank <= 3")
register("wn02_examples_with_fallback", "f_text_items", lambda t: wn.examples_with_fallback(t.select("item_id", c("source_type").alias("category")), t.select(c("source_type").alias("category")).distinct(), 3), "WITH r AS (SELECT item_id, source_type AS category FROM f_text_items), g AS (SELECT DISTINCT source_type AS category FROM f_text_items), x AS (SELECT g.category, CASE WHEN r.category = g.category THEN 0 ELSE 1 END AS tier, r.item_id FROM g, r), k AS (SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY tier, item_id) AS INT) AS rank FROM x) SELECT * FROM k WHERE rank <= 3")
register("wn03_evenly_spaced", "f_text_items", lambda t: wn.evenly_spaced(t, "source_type", "item_id", 5).select("source_type", "item_id", "pos"), "WITH r AS (SELECT source_type, item_id, CAST(row_number() OVER (PARTITION BY source_type ORDER BY item_id) - 1 AS INT) AS pos, count(*) OVER (PARTITION BY source_type) AS n FROM f_text_items) SELECT source_type, item_id, pos FROM r WHERE n <= 5 OR list_contains(list_transform(range(0, 5), lambda i: CAST(round_even(i * (n - 1) / 4.0, 0) AS INT)), pos)")
_h = lambda x, s: f"md5(concat_ws('|', CAST({x} AS VARCHAR), '{s}'))"
register("wn04_stratified_sample", "f_text_items f_calls", lambda t, k: wn.stratified_sample(t.select("item_id", (c("item_id") % 5).alias("stratum")), "stratum", k.select(c("call_id").alias("stratum"), (3 + c("call_id")).alias("quota")), "s4").select("stratum", "item_id"), f"SELECT stratum, item_id FROM (SELECT item_id, item_id % 5 AS stratum, row_number() OVER (PARTITION BY item_id % 5 ORDER BY {_h('item_id', 's4')}, item_id) AS r FROM f_text_items) WHERE r <= 3 + stratum")
register("wn05_random_sample", "f_text_items", lambda t: wn.random_sample(t.select("item_id"), 25, "s5"), f"SELECT item_id FROM f_text_items ORDER BY {_h('item_id', 's5')}, item_id LIMIT 25")
register("wn06_percentile_profile", "f_items", lambda i: wn.percentile_profile(i, "norm_id", "score"), "SELECT norm_id, count(*) AS n, quantile_disc(score, 0.5) AS p50, quantile_disc(score, 0.75) AS p75, quantile_disc(score, 0.9) AS p90 FROM f_items GROUP BY norm_id HAVING count(*) >= 5")
register("wn06_percentile_anchors", "f_items", lambda i: wn.percentile_anchors(i, "norm_id", "score", "item_id"), """WITH p AS (SELECT norm_id, quantile_disc(score, 0.5) AS p50, quantile_disc(score, 0.75) AS p75 FROM f_items GROUP BY norm_id HAVING count(*) >= 5),
 a AS (SELECT i.norm_id, 'MEDIAN' AS anchor, item_id, score FROM f_items i JOIN p ON p.norm_id = i.norm_id WHERE score = p50 UNION ALL SELECT i.norm_id, 'HIGH', item_id, score FROM f_items i JOIN p ON p.norm_id = i.norm_id WHERE score >= p75)
 SELECT norm_id, anchor, item_id, score FROM (SELECT *, row_number() OVER (PARTITION BY norm_id, anchor ORDER BY item_id, score) AS r FROM a) WHERE r <= 3""")
_wt = lambda r: r.filter("norm_id is not null").groupBy("call_id", "norm_id").agg(F.count_distinct("article_asked", "topic_id").alias("weight"))
LARGEST = "q0 AS (SELECT call_id, norm_id, weight, round(weight * 60 / sum(weight) OVER (PARTITION BY call_id), 9) AS exact FROM w), q1 AS (SELECT *, floor(exact) AS f FROM q0), q2 AS (SELECT *, 60 - sum(f) OVER (PARTITION BY call_id) AS rest, row_number() OVER (PARTITION BY call_id ORDER BY exact - f DESC, norm_id) AS r FROM q1), quota AS (SELECT call_id, norm_id, CAST(f + CASE WHEN r <= rest THEN 1 ELSE 0 END AS BIGINT) AS quota FROM q2)"
_wsql = "w AS (SELECT call_id, norm_id, count(DISTINCT (article_asked, topic_id)) AS weight FROM f_refs WHERE norm_id IS NOT NULL GROUP BY call_id, norm_id)"
register("wn07_largest_remainder", "f_refs", lambda r: wn.largest_remainder(_wt(r), ["call_id"], "norm_id", F.lit(60)), f"WITH {_wsql}, {LARGEST} SELECT call_id, norm_id, quota FROM quota")
register("wn08_cycle_select", "f_text_items", lambda t: wn.cycle_select(t.select("item_id", "source_type"), "source_type", t.groupBy("source_type").agg((F.count("*") % 4 * 9 + 2).alias("quota")), "s8").select("source_type", "item_id", "turn"), "WITH n AS (SELECT source_type, count(*) AS n, count(*) % 4 * 9 + 2 AS quota FROM f_text_items GROUP BY source_type), r AS (SELECT t.source_type, item_id, quota, unnest(range(1, CAST(greatest(1, ceil(quota / n)) AS INT) + 1)) AS turn FROM f_text_items t JOIN n ON n.source_type = t.source_type), p AS (SELECT *, row_number() OVER (PARTITION BY source_type ORDER BY turn, md5(concat_ws('|', CAST(item_id AS VARCHAR), CAST(turn AS VARCHAR), 's8')), item_id) AS pick FROM r) SELECT source_type, item_id, CAST(turn AS INT) AS turn FROM p WHERE pick <= quota")
register("wn09_round_robin_groups", "f_text_items", lambda t: wn.round_robin_groups(t.select("item_id", "source_type"), "source_type", 40, "s9").select("item_id", "rank"), f"SELECT item_id, CAST(rank AS INT) AS rank FROM (SELECT item_id, row_number() OVER (PARTITION BY source_type ORDER BY {_h('item_id', 's9')}, item_id) AS rank FROM f_text_items) ORDER BY rank, {_h('item_id', 's9')}, item_id LIMIT 40")
_load = lambda t, b: t.join(b.groupBy("topic_id").agg(F.count("*").alias("n")), "topic_id", "left").select("topic_id", F.coalesce("n", F.lit(0)).alias("load"))
register("wn10_deficit_fill", "f_topics f_bank_links f_refs", lambda t, b, r: wn.deficit_fill(_load(t, b), r.select("ref_id", "topic_id"), 50, "s10"), f"WITH ld AS (SELECT t.topic_id, count(b.topic_id) AS load FROM f_topics t LEFT JOIN f_bank_links b ON b.topic_id = t.topic_id GROUP BY t.topic_id), cd AS (SELECT topic_id, ref_id, row_number() OVER (PARTITION BY topic_id ORDER BY {_h('ref_id', 's10')}, ref_id) AS rank FROM f_refs) SELECT cd.topic_id, ref_id, load + rank - 1 AS level FROM cd JOIN ld ON ld.topic_id = cd.topic_id WHERE rank <= 50 ORDER BY level, {_h('cd.topic_id', 's10')}, cd.topic_id LIMIT 50")
register("wn12_norm_quota_sequence", "f_refs", lambda r: wn.norm_quota_sequence(r, 60, "s12"), f"WITH {_wsql}, {LARGEST}, k AS (SELECT call_id, norm_id, ref_id, row_number() OVER (PARTITION BY call_id, norm_id ORDER BY {_h('ref_id', 's12')}, ref_id) AS rank FROM f_refs WHERE norm_id IS NOT NULL) SELECT k.call_id, k.norm_id, ref_id, quota FROM k JOIN quota q ON q.call_id = k.call_id AND q.norm_id = k.norm_id WHERE rank <= quota")
register("wn13_withdrawal_one_scope", "f_items f_bank_links", lambda i, b: wn.protected_withdrawal(i.groupBy("item_id").agg(F.min("score").alias("score")).filter("score >= 20"), b.filter("call_id = 1").select(c("call_id").alias("scope"), "item_id").distinct(), b.filter("call_id = 1").groupBy(c("call_id").alias("scope")).agg(F.floor(F.count("*") / 16).alias("need")), 8), "WITH e AS (SELECT item_id, min(score) AS score FROM f_items GROUP BY item_id HAVING min(score) >= 20), s AS (SELECT DISTINCT item_id FROM f_bank_links WHERE call_id = 1), z AS (SELECT (SELECT floor(count(*) / 16) FROM f_bank_links WHERE call_id = 1) * 8 - (SELECT count(*) FROM s WHERE item_id NOT IN (SELECT item_id FROM e)) AS d), r AS (SELECT e.item_id, row_number() OVER (ORDER BY score, e.item_id) AS r FROM e JOIN s ON s.item_id = e.item_id) SELECT item_id, score FROM e WHERE item_id NOT IN (SELECT item_id FROM r, z WHERE r <= d)")
_files = lambda e: e.select(F.concat(c("event_type"), F.lit("-"), c("user_id").cast("string"), F.lit(".csv")).alias("name"), "ts", "event_id")
register("wn14_retention", "events", lambda e: wn.retention(_files(e), 5, "2020-01-01").select("event_id", "family", "rank"), "SELECT event_id, family, CAST(rank AS INT) AS rank FROM (SELECT event_id, ts, regexp_replace(event_type || '-' || CAST(user_id AS VARCHAR) || '.csv', '[0-9]+', '#', 'g') AS family, row_number() OVER (PARTITION BY regexp_replace(event_type || '-' || CAST(user_id AS VARCHAR) || '.csv', '[0-9]+', '#', 'g') ORDER BY ts DESC, event_type || '-' || CAST(user_id AS VARCHAR) || '.csv') AS rank FROM events) WHERE rank > 5 OR ts < TIMESTAMP '2020-01-01'")
register("wn15_topic_load_sort", "f_topics f_bank_links", lambda t, b: _load(t, b).withColumn("place", F.row_number().over(Window.partitionBy(F.floor(c("topic_id") / 1000)).orderBy("load", "topic_id"))), "SELECT topic_id, load, CAST(row_number() OVER (PARTITION BY floor(topic_id / 1000) ORDER BY load, topic_id) AS INT) AS place FROM (SELECT t.topic_id, count(b.topic_id) AS load FROM f_topics t LEFT JOIN f_bank_links b ON b.topic_id = t.topic_id GROUP BY t.topic_id)")
register("wn16_top_unvisited_aspects", "f_text_items", lambda t: wn.top_unvisited_aspects(t, 15, "s16"), "SELECT aspect FROM (SELECT DISTINCT substr(regexp_replace(stem, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'), 1, 110) AS aspect FROM f_text_items) WHERE aspect <> '' ORDER BY md5(aspect || 's16'), aspect LIMIT 15")

_old = lambda r: r.filter("ref_id % 9 <> 0")
register("ch01_syllabus_delta", "f_refs", lambda r: ch.delta(_old(r), r.filter("ref_id % 8 <> 0"), ["topic_id", "norm_id", "article_asked"]), "WITH b AS (SELECT DISTINCT topic_id, norm_id, article_asked FROM f_refs WHERE ref_id % 9 <> 0), a AS (SELECT DISTINCT topic_id, norm_id, article_asked FROM f_refs WHERE ref_id % 8 <> 0) SELECT *, 'ADDED' AS change FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'REMOVED' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
_tgt = lambda r: r.select("ref_id", "topic_id", "state")
_srcs = lambda r: r.filter("ref_id % 5 = 0").select((c("ref_id") + F.when(c("ref_id") % 2 == 0, 0).otherwise(10**7)).alias("ref_id"), "topic_id", F.when(c("ref_id") % 3 != 0, "NUEVO").alias("state"))
register("ch02_upsert", "f_refs", lambda r: ch.upsert(_tgt(r), _srcs(r), ["ref_id"]), "WITH s AS (SELECT ref_id + CASE WHEN ref_id % 2 = 0 THEN 0 ELSE 10000000 END AS ref_id, topic_id, CASE WHEN ref_id % 3 <> 0 THEN 'NUEVO' END AS state FROM f_refs WHERE ref_id % 5 = 0) SELECT ref_id, topic_id, state FROM f_refs WHERE ref_id NOT IN (SELECT ref_id FROM s) UNION ALL SELECT * FROM s")
register("ch02_insert_ignore", "f_refs", lambda r: ch.insert_ignore(_tgt(r), _srcs(r), ["ref_id"]).select("ref_id"), "SELECT ref_id FROM f_refs UNION ALL SELECT ref_id + 10000000 FROM f_refs WHERE ref_id % 5 = 0 AND ref_id % 2 <> 0")
register("ch04_delete_absent", "f_refs", lambda r: ch.delete_absent(r, _srcs(r), ["ref_id"]).select("ref_id"), "SELECT ref_id FROM f_refs WHERE ref_id % 5 = 0 AND ref_id % 2 = 0")
_corr = lambda i: i.filter("item_id % 17 = 0").select("item_id", "answer_key", (c("item_id") % 2).alias("odd")).distinct().select((c("item_id") + F.when(c("item_id") % 3 == 0, 10**9).otherwise(0)).alias("item_id"), F.when(c("item_id") % 5 == 0, "Z").otherwise(c("answer_key")).alias("old_key"), F.lit("A").alias("new_key"))
_i1 = lambda i: i.groupBy("item_id").agg(F.min("answer_key").alias("answer_key"))
_corr_sql = "i1 AS (SELECT item_id, min(answer_key) AS answer_key FROM f_items GROUP BY item_id), cr AS (SELECT item_id + CASE WHEN item_id % 3 = 0 THEN 1000000000 ELSE 0 END AS item_id, CASE WHEN item_id % 5 = 0 THEN 'Z' ELSE answer_key END AS old_key, 'A' AS new_key FROM i1 WHERE item_id % 17 = 0), pv AS (SELECT cr.item_id, old_key, new_key, CASE WHEN i1.item_id IS NULL THEN 'UNKNOWN' WHEN cr.item_id IN (SELECT item_id FROM f_exclusions) THEN 'EXCLUDED' WHEN i1.answer_key <> old_key THEN 'STALE' WHEN old_key = new_key THEN 'UNCHANGED' ELSE 'READY' END AS status FROM cr LEFT JOIN i1 ON i1.item_id = cr.item_id)"
register("ch08_correction_preview", "f_items f_exclusions", lambda i, x: ch.correction_preview(_i1(i), _corr(_i1(i)), x), f"WITH {_corr_sql} SELECT * FROM pv")
register("ch08_apply_corrections", "f_items f_exclusions", lambda i, x: ch.apply_corrections(_i1(i), ch.correction_preview(_i1(i), _corr(_i1(i)), x)), f"WITH {_corr_sql} SELECT i1.item_id, CASE WHEN pv.item_id IS NULL THEN answer_key ELSE new_key END AS answer_key FROM i1 LEFT JOIN pv ON pv.item_id = i1.item_id AND status = 'READY'")
_cases = lambda i: _i1(i).filter("item_id % 21 = 0").select((c("item_id") + F.when(c("item_id") % 2 == 0, 0).otherwise(F.when(c("item_id") % 5 == 0, 10**9).otherwise(0))).alias("item_id"), F.when(c("item_id") % 4 == 0, "Q").otherwise(c("answer_key")).alias("stored_key"))
_qp = "i1 AS (SELECT item_id, min(answer_key) AS answer_key FROM f_items GROUP BY item_id), cs AS (SELECT item_id + CASE WHEN item_id % 2 <> 0 AND item_id % 5 = 0 THEN 1000000000 ELSE 0 END AS item_id, CASE WHEN item_id % 4 = 0 THEN 'Q' ELSE answer_key END AS k FROM i1 WHERE item_id % 21 = 0), qp AS (SELECT cs.item_id, CASE WHEN i1.item_id IS NULL THEN 'MISSING' WHEN i1.answer_key <> k THEN 'KEY_CHANGED' WHEN cs.item_id IN (SELECT item_id FROM f_exclusions) THEN 'ALREADY' ELSE 'READY' END AS status, (SELECT count(*) FROM f_bank_links b WHERE b.item_id = cs.item_id AND state = 'INCLUIDA') AS links FROM cs LEFT JOIN i1 ON i1.item_id = cs.item_id)"
register("ch09_quarantine_preview", "f_items f_exclusions f_bank_links", lambda i, x, b: ch.quarantine_preview(_cases(i), _i1(i), x, b), f"WITH {_qp} SELECT * FROM qp")
register("ch09_quarantine_apply", "f_items f_exclusions f_bank_links", lambda i, x, b: ch.quarantine_apply(b, ch.quarantine_preview(_cases(i), _i1(i), x, b)).groupBy("call_id", "state").agg(F.count("*").alias("n")), f"WITH {_qp} SELECT call_id, CASE WHEN item_id IN (SELECT item_id FROM qp WHERE status = 'READY') THEN 'REVISION' ELSE state END AS state, count(*) AS n FROM f_bank_links GROUP BY 1, 2")
register("ch10_undo_withdrawal", "f_exclusions f_bank_links", lambda x, b: ch.undo_withdrawal(x, b, c("state") == "RETIRADA")[1].groupBy("state").agg(F.count("*").alias("n")), "SELECT CASE WHEN item_id IN (SELECT item_id FROM f_exclusions WHERE state = 'RETIRADA') AND item_id NOT IN (SELECT item_id FROM f_exclusions WHERE state <> 'RETIRADA') THEN 'INCLUIDA' ELSE state END AS state, count(*) AS n FROM f_bank_links GROUP BY 1")
register("ch11_corpus_sync_plan", "f_articles", lambda a: ch.sync_plan(a.filter("article_id % 4 <> 0"), a.select("article_id", F.when(c("article_id") % 6 == 1, "new").otherwise(c("text_hash")).alias("text_hash")), ["article_id"]), "SELECT article_id, CASE WHEN article_id % 4 = 0 THEN 'INSERT' WHEN article_id % 6 = 1 THEN 'REPAIR' ELSE 'UNCHANGED' END AS action FROM f_articles")
register("ch12_unchanged_rows", "f_articles", lambda a: ch.changed_outside_plan(a.select("article_id", "text_hash"), a.select("article_id", F.when(c("article_id") % 10 == 3, "x").otherwise(c("text_hash")).alias("text_hash")), a.filter("article_id % 20 = 3").select("article_id"), "article_id"), "SELECT article_id FROM f_articles WHERE article_id % 10 = 3 AND article_id % 20 <> 3")
_arts = lambda r, keep: r.filter(f"norm_id is not null and {keep}").select("topic_id", "norm_id", F.when(c("ref_id") % 23 == 0, "*").otherwise(F.regexp_replace("article_asked", "-bis", " bis")).alias("article"))
register("ch13_scope_findings", "f_refs", lambda r: ch.scope_findings(_arts(r, "ref_id % 9 <> 0"), _arts(r, "ref_id % 8 <> 0")), """WITH x AS (SELECT ref_id, topic_id, norm_id, CASE WHEN ref_id % 23 = 0 THEN '*' ELSE regexp_replace(article_asked, '-bis', ' bis') END AS article FROM f_refs WHERE norm_id IS NOT NULL), e AS (SELECT DISTINCT topic_id, norm_id, article FROM x WHERE ref_id % 9 <> 0), a AS (SELECT DISTINCT topic_id, norm_id, article FROM x WHERE ref_id % 8 <> 0)
 SELECT *, CASE WHEN regexp_matches(article, ' bis$') THEN 'DOUBT' ELSE 'ADD' END AS action FROM (SELECT * FROM e EXCEPT SELECT * FROM a) UNION ALL SELECT d.*, CASE WHEN regexp_matches(d.article, ' bis$') OR EXISTS (SELECT 1 FROM a WHERE a.topic_id = d.topic_id AND a.norm_id = d.norm_id AND a.article = '*') THEN 'DOUBT' ELSE 'DELETE' END FROM (SELECT * FROM a EXCEPT SELECT * FROM e) d WHERE d.article <> '*'""")
register("ch14_enrichment_plan", "f_items", lambda i: ch.enrichment_plan(i.select("item_id", "norm_name_n", "norm_type_n").distinct(), {"norm_name_n": F.lit("Norm"), "norm_type_n": F.when(c("item_id") % 2 == 0, "LEY")}), "WITH d AS (SELECT DISTINCT item_id, norm_name_n, norm_type_n FROM f_items) SELECT item_id, 'norm_name_n' AS field, 'Norm' AS value FROM d WHERE trim(norm_name_n) = '' UNION ALL SELECT item_id, 'norm_type_n', 'LEY' FROM d WHERE norm_type_n IS NULL AND item_id % 2 = 0")
register("ch15_call_status_impact", "f_calls f_parts f_topics f_bank_links", ch.call_status_impact, "SELECT call_id, active, (SELECT count(*) FROM f_parts p WHERE p.call_id = c.call_id) AS parts, (SELECT count(*) FROM f_topics t WHERE t.call_id = c.call_id) AS topics, (SELECT count(*) FROM f_bank_links b WHERE b.call_id = c.call_id) AS links FROM f_calls c")
register("ch16_union_distinct_names", "f_items f_refs", lambda i, r: i.select(c("norm_name_n").alias("name")).distinct().unionAll(r.select(c("norm_name").alias("name")).distinct()), "SELECT DISTINCT norm_name_n AS name FROM f_items UNION ALL SELECT DISTINCT norm_name FROM f_refs")
_rl = lambda n: n.filter("norm_id % 2 = 1").select((1001 + c("norm_id") % 20).alias("topic_id"), "norm_id", F.concat_ws(",", (c("norm_id") % 5 + 1).cast("string"), F.concat((c("norm_id") % 7 + 8).cast("string"), F.lit("-"), (c("norm_id") % 7 + 11).cast("string")), F.lit("14 bis")).alias("expression"))
register("ch17_rules_to_refs", "f_norms f_refs", lambda n, r: ch.rules_to_refs(_rl(n), r.filter("norm_id is not null").select("topic_id", "norm_id", c("article_asked").alias("article"))), "WITH rl AS (SELECT 1001 + norm_id % 20 AS topic_id, norm_id FROM f_norms WHERE norm_id % 2 = 1), e AS (SELECT topic_id, norm_id, CAST(norm_id % 5 + 1 AS VARCHAR) AS article FROM rl UNION SELECT topic_id, norm_id, CAST(unnest(range(norm_id % 7 + 8, norm_id % 7 + 12)) AS VARCHAR) FROM rl UNION SELECT topic_id, norm_id, '14 bis' FROM rl), s AS (SELECT DISTINCT topic_id, norm_id, article_asked AS article FROM f_refs WHERE norm_id IS NOT NULL AND topic_id IN (SELECT topic_id FROM rl)) SELECT *, 'ADDED' AS change FROM (SELECT * FROM e EXCEPT SELECT * FROM s) UNION ALL SELECT *, 'REMOVED' FROM (SELECT * FROM s EXCEPT SELECT * FROM e)")
register("ch18_insert_plan_check", "f_refs", lambda r: ch.insert_plan_check(r.filter("ref_id % 6 = 0").select("topic_id"), r.filter("ref_id % 35 = 0").select("topic_id"), ["topic_id"]), "SELECT topic_id, 'REPEATED' AS reason FROM f_refs WHERE ref_id % 6 = 0 GROUP BY topic_id HAVING count(*) > 1 UNION ALL SELECT DISTINCT topic_id, 'EXISTS' FROM f_refs WHERE ref_id % 6 = 0 AND topic_id IN (SELECT topic_id FROM f_refs WHERE ref_id % 35 = 0)")
register("ch20_apply_recovered", "f_items", lambda i: ch.apply_recovered(i.select("item_id", "norm_id", "article_n").distinct(), i.filter("item_id % 4 = 0").select("item_id", (c("item_id") % 9 + 1).alias("norm_id"), F.lit("7").alias("article"))).groupBy("norm_id").agg(F.count("*").alias("n"), F.count_if(c("article_n") == "7").alias("sevens")), "SELECT CASE WHEN norm_id IS NULL AND item_id % 4 = 0 THEN item_id % 9 + 1 ELSE norm_id END AS norm_id, count(*) AS n, count(*) FILTER (WHERE CASE WHEN norm_id IS NULL AND item_id % 4 = 0 THEN '7' ELSE article_n END = '7') AS sevens FROM (SELECT DISTINCT item_id, norm_id, article_n FROM f_items) GROUP BY 1")
register("ch21_retract_items", "f_bank_links f_items", lambda b, i: ch.retract_items(b, i, i.filter("item_id % 3 = 0").select("item_id")).select("link_id"), "SELECT link_id FROM f_bank_links WHERE item_id NOT IN (SELECT item_id FROM f_items WHERE item_id % 3 = 0 AND source_type = 'ia_generada')")
_batch = lambda d: d.select(c("doc_id").alias("row_id"), F.concat(F.lit("f"), (c("doc_id") % 17).cast("string")).alias("file_hash"), F.sha2("text", 256).alias("content_key"))
register("ch05_ingest", "documents", lambda d: ch.ingest(_batch(d), _batch(d).filter("row_id % 10 = 0"), _batch(d).filter("file_hash in ('f3', 'f5')").select("file_hash", F.lit("DONE").alias("state")).distinct())[1], "WITH b AS (SELECT doc_id, 'f' || CAST(doc_id % 17 AS VARCHAR) AS file_hash, text FROM documents WHERE doc_id % 17 NOT IN (3, 5)), n AS (SELECT min(doc_id) AS doc_id FROM b WHERE text NOT IN (SELECT text FROM documents WHERE doc_id % 10 = 0) GROUP BY text) SELECT file_hash, count(n.doc_id) AS inserted, count(*) - count(n.doc_id) AS duplicates, 'DONE' AS state FROM b LEFT JOIN n ON n.doc_id = b.doc_id GROUP BY file_hash")

register("pb01_publish_subset", "f_bank_links f_topics", lambda b, t: ch.publish_subset(b, t)[1].select("topic_id"), "SELECT topic_id FROM f_topics WHERE topic_id IN (SELECT topic_id FROM f_bank_links WHERE state = 'INCLUIDA')")
_inv = lambda o, cu, p: ch.inventory({"orders": o, "customer": cu, "part": p})
register("pb02_inventory", "orders customer part", _inv, "SELECT 'orders' AS table_name, count(*) AS rows, 6 AS columns FROM orders UNION ALL SELECT 'customer', count(*), 5 FROM customer UNION ALL SELECT 'part', count(*), 6 FROM part")
register("pb02_call_totals", "f_calls f_parts f_topics f_refs f_bank_links", lambda c, p, t, r, b: ch.call_totals(c, {"parts": p, "topics": t, "refs": r, "links": b}), "SELECT call_id, (SELECT count(*) FROM f_parts x WHERE x.call_id = c.call_id) AS parts, (SELECT count(*) FROM f_topics x WHERE x.call_id = c.call_id) AS topics, (SELECT count(*) FROM f_refs x WHERE x.call_id = c.call_id) AS refs, (SELECT count(*) FROM f_bank_links x WHERE x.call_id = c.call_id) AS links FROM f_calls c")
register("pb03_compare_inventory", "orders customer part", lambda o, cu, p: ch.compare_inventory(_inv(o, cu, p), _inv(o, cu.filter("c_custkey > 5"), p)), "SELECT 'customer' AS table_name, count(*) AS a, count(*) FILTER (WHERE c_custkey > 5) AS b FROM customer HAVING count(*) <> count(*) FILTER (WHERE c_custkey > 5)")
register("pb04_content_fingerprint", "f_bank_links", ch.content_fingerprint, "SELECT count(*) AS links, count(DISTINCT item_id) AS items, count(DISTINCT topic_id) AS topics, CAST(sum(item_id % 1000) AS BIGINT) AS mark FROM f_bank_links WHERE state = 'INCLUIDA'")
register("pb05_study_extract", "f_articles", lambda a: a.dropDuplicates(["norm_id", "source_id", "article_no"]).groupBy("norm_id").agg(F.array_join(F.transform(F.array_sort(F.collect_set("article_no")), lambda x: x.cast("string")), ",").alias("articles"), F.array_join(F.array_sort(F.collect_set("source_id")), ",").alias("sources")), "SELECT norm_id, array_to_string(list_sort(list(DISTINCT article_no)), ',') AS articles, array_to_string(list_sort(list(DISTINCT source_id)), ',') AS sources FROM f_articles GROUP BY norm_id")
register("pb06_activity_filter", "f_calls", lambda k: ch.activity_filter(k).select("call_id", F.lit("active").alias("f")).union(ch.activity_filter(k.drop("active")).select("call_id", F.lit("all"))), "SELECT call_id, 'active' AS f FROM f_calls WHERE active UNION ALL SELECT call_id, 'all' FROM f_calls")

register("fl04_search_by_reference", "f_items", lambda i: i.filter("norm_id = 3").filter((c("article_n") == "12") | c("article_n").startswith("12 ") | c("article_n").startswith("12.")).select("item_id", "article_n", F.when(c("article_n") == "12", 0).otherwise(1).alias("tier")), "SELECT item_id, article_n, CASE WHEN article_n = '12' THEN 0 ELSE 1 END AS tier FROM f_items WHERE norm_id = 3 AND (article_n = '12' OR article_n LIKE '12 %' OR article_n LIKE '12.%')")
register("fl05_pending_items", "f_items", lambda i: i.filter("kind <> 'JURIDICA' or norm_id is null").select("item_id", "kind", "norm_id"), "SELECT item_id, kind, norm_id FROM f_items WHERE kind <> 'JURIDICA' OR norm_id IS NULL")
_imp = lambda o: o.select(c("o_orderkey").alias("import_id"), F.when(c("o_orderstatus") == "F", "COMPLETADO").otherwise("PARCIAL").alias("state"), (c("o_orderkey") % 4).alias("errors"), F.when(c("o_orderkey") % 9 == 0, "msg").alias("message"))
register("fl06_needs_review", "orders", lambda o: _imp(o).filter("state <> 'COMPLETADO' or errors > 0 or message is not null").select("import_id"), "SELECT o_orderkey AS import_id FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 4 > 0 OR o_orderkey % 9 = 0")
register("fl07_import_recommendation", "orders", lambda o: _imp(o).select("import_id", F.when(c("state") != "COMPLETADO", "REIMPORT").when(c("errors") > 2, "REVIEW_PAGES").when(c("errors") > 0, "REVIEW").when(c("message").isNotNull(), "READ_MESSAGE").otherwise("OK").alias("advice")), "SELECT o_orderkey AS import_id, CASE WHEN o_orderstatus <> 'F' THEN 'REIMPORT' WHEN o_orderkey % 4 > 2 THEN 'REVIEW_PAGES' WHEN o_orderkey % 4 > 0 THEN 'REVIEW' WHEN o_orderkey % 9 = 0 THEN 'READ_MESSAGE' ELSE 'OK' END AS advice FROM orders")
register("fl08_import_page_gaps", "f_items", lambda i: i.groupBy("import_id").agg(F.collect_set("page").alias("p")).select("import_id", F.array_join(F.array_sort(F.array_except(F.sequence(F.lit(1), F.lit(5)), "p")), ",").alias("missing"), F.size(F.filter("p", lambda x: x > 5)).alias("outside")), "SELECT import_id, array_to_string(list_filter([1, 2, 3, 4, 5], lambda x: NOT list_contains(p, x)), ',') AS missing, CAST(len(list_filter(p, lambda x: x > 5)) AS INT) AS outside FROM (SELECT import_id, list(DISTINCT page) AS p FROM f_items GROUP BY import_id)")
register("fl09_references_to_resolve", "f_refs f_articles", lambda r, a: r.filter(c("state").isin("PENDIENTE") | c("norm_id").isNull()).join(a.select("norm_id").distinct(), "norm_id", "left_semi").select("ref_id"), "SELECT ref_id FROM f_refs WHERE (state = 'PENDIENTE' OR norm_id IS NULL) AND norm_id IN (SELECT norm_id FROM f_articles)")
register("fl10_skip_unchanged", "f_articles", lambda a: a.select("article_id", "text_hash").join(a.filter("article_id % 3 = 0 and article_id % 15 <> 0").select("article_id", c("text_hash").alias("h")), "article_id", "left").filter("h is null or h <> text_hash").select("article_id"), "SELECT article_id FROM f_articles WHERE NOT (article_id % 3 = 0 AND article_id % 15 <> 0)")
register("fl11_correction_candidates", "f_items orders", lambda i, o: i.join(o.select(c("o_orderkey").alias("import_id"), "o_orderpriority"), "import_id").filter(c("o_orderpriority").ilike("1-%") & (c("source_type") == "ia_generada")).select("item_id"), "SELECT item_id FROM f_items i JOIN orders o ON o.o_orderkey = i.import_id WHERE o_orderpriority ILIKE '1-%' AND source_type = 'ia_generada'")
register("fl12_pending_work", "f_items f_answers", lambda i, a: i.filter("norm_id is null").select("item_id").distinct().join(a.filter("p1 = '?'").select("item_id", F.lit("ERROR").alias("s")).distinct(), "item_id", "left").join(a.filter("p1 <> '?' and item_id % 2 = 0").select("item_id").distinct(), "item_id", "left_anti").select("item_id"), "SELECT DISTINCT item_id FROM f_items WHERE norm_id IS NULL AND item_id NOT IN (SELECT item_id FROM f_answers WHERE p1 <> '?' AND item_id % 2 = 0)")
register("fl13_touched_documents", "f_refs f_norms", lambda r, n: r.filter("state = 'COMPLETADO'").join(r.filter("ref_id % 4 = 0").select("ref_id"), "ref_id", "left_semi").join(n, "norm_id").select("source_id").distinct(), "SELECT DISTINCT source_id FROM f_refs r JOIN f_norms n ON n.norm_id = r.norm_id WHERE state = 'COMPLETADO' AND ref_id % 4 = 0")

_names = lambda ci: ci.select("name")
_idsub = f"(SELECT x AS name, v AS key FROM ({_identity_sql('name')}))"
register("lk01_build_norm_catalogue", "f_citations", lambda ci: lk.norm_catalogue(_names(ci), ci.filter("item_id % 40 = 7").select("name").distinct().select(tx.norm_identity(c("name")).alias("key")).distinct()), f"WITH n AS {_idsub}, k AS (SELECT key, min(name) AS name FROM n WHERE key <> '' GROUP BY key), un AS (SELECT *, CASE WHEN regexp_matches(key, '\\b[0-9]+/[0-9]{{4}}\\b') THEN trim(regexp_replace(key, ' +de [0-9]{{1,2}} de {tx.MONTH}(?: de [0-9]{{4}})?$', '')) ELSE key END AS plain FROM k) SELECT key, name FROM un WHERE key NOT IN (SELECT plain FROM un WHERE plain <> key) AND key NOT IN (SELECT n.key FROM f_citations c JOIN n ON n.name = c.name WHERE c.item_id % 40 = 7)")
register("lk02_link_items_to_norms", "f_refs f_norms", lambda r, n: lk.link_to_norms(r.select("ref_id", "norm_id", "norm_name"), F.lower(F.trim("norm_name")), n.filter("norm_id % 2 = 0"), False).select("ref_id", "norm_id"), "SELECT ref_id, coalesce(r.norm_id, n.norm_id) AS norm_id FROM f_refs r LEFT JOIN f_norms n ON n.norm_key = lower(trim(norm_name)) AND n.norm_id % 2 = 0")
register("lk14_source_text_index", "f_articles", lk.longest_text, "SELECT norm_id, article_no, arg_max(article_id, (length(text), -article_id)) AS article_id, CAST(max(length(text)) AS INT) AS chars FROM f_articles GROUP BY norm_id, article_no")
register("lk15_text_coverage_state", "f_items f_articles", lk.text_coverage, f"WITH t AS (SELECT norm_id, CAST(article_no AS VARCHAR) AS base, count(DISTINCT text_hash) AS n FROM f_articles GROUP BY norm_id, article_no) SELECT item_id, CASE WHEN i.norm_id IS NULL THEN 'NO_NORM' WHEN i.base IS NULL THEN 'NO_ARTICLE' WHEN n IS NULL THEN 'NO_TEXT' WHEN n > 1 THEN 'SEVERAL' ELSE 'VERIFIABLE' END AS state FROM (SELECT item_id, norm_id, {_base('article_n')} AS base FROM f_items WHERE kind = 'JURIDICA') i LEFT JOIN t ON t.norm_id = i.norm_id AND t.base = i.base")
register("lk16_seed_norm_sources", "f_articles", lambda a: lk.seed_sources(a.select("source_id", "norm_id").union(a.filter("article_id % 30 = 4").select("source_id", c("norm_id") + 1))), "WITH r AS (SELECT source_id, norm_id FROM f_articles UNION ALL SELECT source_id, norm_id + 1 FROM f_articles WHERE article_id % 30 = 4) SELECT source_id, CASE WHEN count(DISTINCT norm_id) = 1 THEN min(norm_id) END AS norm_id, count(DISTINCT norm_id) > 1 AS conflict FROM r GROUP BY source_id")
_srcn = lambda ci: ci.select((c("item_id") % 97).alias("source_id"), "name").filter("length(name) > 12")
_cat = lambda ci: ci.filter("item_id % 10 = 1").groupBy("name").agg(F.min("item_id").alias("item_id")).groupBy(tx.norm_identity(c("name")).alias("key")).agg(F.min("item_id").alias("norm_id"))
register("lk17_resolve_source", "f_citations", lambda ci: lk.resolve_sources(_srcn(ci.filter("item_id % 3 = 0")), _cat(ci)), f"WITH n AS {_idsub}, ct AS (SELECT key, min(item_id) AS norm_id FROM f_citations c JOIN n ON n.name = c.name WHERE item_id % 10 = 1 GROUP BY key), s AS (SELECT DISTINCT item_id % 97 AS source_id, key FROM f_citations c JOIN n ON n.name = c.name WHERE item_id % 3 = 0 AND length(c.name) > 12), m AS (SELECT source_id, count(DISTINCT ct.norm_id) AS hits, min(ct.norm_id) AS norm_id, count(DISTINCT s.key) AS keys FROM s LEFT JOIN ct ON ct.key = s.key GROUP BY source_id) SELECT source_id, CASE WHEN hits > 1 THEN 'CONFLICT' WHEN hits = 1 THEN 'LINK' WHEN keys = 1 THEN 'CREATE' ELSE 'PENDING' END AS state, CASE WHEN hits = 1 THEN norm_id END AS norm_id FROM m")
register("lk18_unresolved_sources", "f_articles f_norms", lambda a, n: lk.unresolved_sources(a, n.filter("norm_id % 3 = 0")), "SELECT source_id, array_to_string(list_sort(list(DISTINCT norm_id)), ',') AS norms, count(*) AS n FROM f_articles WHERE source_id NOT IN (SELECT source_id FROM f_norms WHERE norm_id % 3 = 0) GROUP BY source_id")
_key19 = "concat('ley ', CAST(l_partkey % 40 AS STRING), '/2015', CASE WHEN l_partkey % 3 = 0 THEN concat(' de ', CAST(l_linenumber AS STRING), ' de mayo') ELSE '' END)"
register("lk19_precise_or_link_ref", "lineitem", lambda li: lk.precise_or_link(li.select((c("l_orderkey") * 10 + c("l_linenumber")).alias("ref_id"), F.expr(_key19).alias("key")).distinct(), li.filter("l_partkey % 40 < 30 and l_linenumber < 3").select(F.expr(_key19).alias("key")).distinct().withColumn("norm_id", F.length("key") * 1000 + F.regexp_extract("key", "([0-9]+)/", 1).cast("int"))), f"""WITH r AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS ref_id, {_key19} AS key FROM lineitem), pl AS (SELECT ref_id, key, trim(regexp_replace(key, ' de [0-9]+ de mayo$', '')) AS plain FROM r),
 n AS (SELECT key, trim(regexp_replace(key, ' de [0-9]+ de mayo$', '')) AS plain, length(key) * 1000 + CAST(regexp_extract(key, '([0-9]+)/', 1) AS INT) AS norm_id FROM (SELECT DISTINCT {_key19} AS key FROM lineitem WHERE l_partkey % 40 < 30 AND l_linenumber < 3)),
 m AS (SELECT ref_id, pl.key, pl.plain, count(norm_id) AS a, min(CASE WHEN n.key = pl.key THEN norm_id END) AS exact, min(norm_id) AS lone, count(*) FILTER (WHERE n.key = n.plain) AS undated FROM pl LEFT JOIN n ON n.plain = pl.plain GROUP BY ALL),
 s AS (SELECT *, CASE WHEN exact IS NOT NULL THEN 'LINK' WHEN a = 0 THEN 'CREATE' WHEN a > 1 THEN 'BLOCKED' WHEN undated = 1 AND key <> plain THEN 'UPGRADE' WHEN key = plain THEN 'LINK' ELSE 'BLOCKED' END AS action FROM m) SELECT ref_id, action, coalesce(exact, CASE WHEN action IN ('LINK', 'UPGRADE') THEN lone END) AS norm_id FROM s""")
register("lk21_filter_by_citation_rules", "f_citations", lambda ci: lk.filter_by_citations(ci.select("item_id", tx.cited_norms(c("stem")).alias("cited"), F.when(c("item_id") % 2 == 0, "39/2015").otherwise("40/2015").alias("assigned"))).select("item_id"), r"""WITH k AS (SELECT item_id, list_transform(regexp_extract_all(stem, '\b([0-9]{1,4}) */ *([0-9]{4}|[0-9]{2})\b', 0), lambda c: CAST(CAST(trim(string_split(c, '/')[1]) AS INT) AS VARCHAR) || '/' || CASE WHEN length(trim(string_split(c, '/')[2])) = 2 THEN CASE WHEN CAST(trim(string_split(c, '/')[2]) AS INT) > 30 THEN '19' ELSE '20' END ELSE '' END || trim(string_split(c, '/')[2])) AS cited FROM f_citations) SELECT item_id FROM k WHERE len(cited) = 0 OR list_contains(cited, CASE WHEN item_id % 2 = 0 THEN '39/2015' ELSE '40/2015' END)""")
_cand = lambda li: li.select("l_orderkey", "l_linenumber", (c("l_quantity") > 25).alias("same_date"), (c("l_tax") < 0.04).alias("regional"), (c("l_returnflag") == "R").alias("national"))
register("lk22_candidate_disambiguation", "lineitem", lambda li: lk.disambiguate(_cand(li), "l_orderkey", ["same_date", "regional", "national"]).select("l_orderkey", "l_linenumber"), """WITH c AS (SELECT l_orderkey, l_linenumber, l_quantity > 25 AS a, l_tax < 0.04 AS b, l_returnflag = 'R' AS d FROM lineitem), s1 AS (SELECT *, bool_or(a) OVER (PARTITION BY l_orderkey) AS any1 FROM c), f1 AS (SELECT * FROM s1 WHERE a OR NOT any1), s2 AS (SELECT *, bool_or(b) OVER (PARTITION BY l_orderkey) AS any2 FROM f1), f2 AS (SELECT * FROM s2 WHERE b OR NOT any2),
 s3 AS (SELECT *, bool_or(d) OVER (PARTITION BY l_orderkey) AS any3 FROM f2), f3 AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM s3 WHERE d OR NOT any3) SELECT l_orderkey, l_linenumber FROM f3 WHERE n = 1""")
_blk = lambda a: a.select("source_id", (c("article_no") % 20).alias("article_no"), "article_id", F.when(c("article_id") % 37 != 0, c("article_id") % 6).alias("dated"))
register("lk24_current_block", "f_articles", lambda a: lk.current_block(_blk(a)), "WITH b AS (SELECT source_id, article_no % 20 AS article_no, article_id, CASE WHEN article_id % 37 <> 0 THEN article_id % 6 END AS dated FROM f_articles), w AS (SELECT *, max(dated) OVER k AS latest, count(*) FILTER (WHERE dated IS NULL) OVER k AS undated FROM b WINDOW k AS (PARTITION BY source_id, article_no)), g AS (SELECT source_id, article_no, min(article_id) AS a, count(*) AS n, max(undated) AS u FROM w WHERE dated = latest OR latest IS NULL GROUP BY ALL) SELECT source_id, article_no, CASE WHEN u = 0 AND n = 1 THEN a END AS article_id, CASE WHEN u > 0 THEN 'NO_DATE' WHEN n > 1 THEN 'TIE' END AS incident FROM g")
register("lk25_coverage_across_sources", "f_refs f_articles", lambda r, a: lk.missing_numbers_of_norms(r.filter("norm_id is not null").select("norm_id", tx.article_base(c("article_asked")).try_cast("int").alias("article_no")).filter("article_no is not null"), a.filter("article_id % 2 = 0")), f"SELECT DISTINCT norm_id, CAST({_base('article_asked')} AS INT) AS article_no FROM f_refs WHERE norm_id IS NOT NULL AND NOT contains({_base('article_asked')}, ' ') AND (norm_id, CAST({_base('article_asked')} AS INT)) NOT IN (SELECT (norm_id, article_no) FROM f_articles WHERE article_id % 2 = 0)")
register("lk26_canonical_partial", "part", lambda p: lk.canonical_partial(p.select(c("p_brand").alias("norm"), c("p_partkey").alias("part_id"), (c("p_size") > 40).alias("complete"), (c("p_retailprice") > 1000).alias("preferred")), "norm"), "WITH t AS (SELECT p_brand AS norm, p_partkey AS part_id, CASE WHEN p_size > 40 AND p_retailprice > 1000 THEN 1 WHEN p_size > 40 THEN 2 WHEN p_retailprice > 1000 THEN 3 ELSE 4 END AS tier FROM part), b AS (SELECT norm, min(tier) AS tier FROM t GROUP BY norm) SELECT t.norm, t.tier, CASE WHEN count(*) = 1 THEN min(part_id) END AS part_id FROM t JOIN b ON b.norm = t.norm AND b.tier = t.tier GROUP BY t.norm, t.tier")
_pool = lambda i: i.groupBy("item_id").agg(F.min("norm_id").alias("norm_id"), F.min("norm_type_n").alias("norm_type_n"))
register("lk28_metadata_fallback", "f_items", lambda i: lk.metadata_fallback(_pool(i).select("item_id", "norm_id"), _pool(i).filter("item_id % 5 = 0").select("item_id", F.lit("EXAMPLE").alias("norm_type_n")), _pool(i).filter("norm_id % 2 = 0")), "WITH p AS (SELECT item_id, min(norm_id) AS norm_id, min(norm_type_n) AS t FROM f_items GROUP BY item_id) SELECT item_id, CASE WHEN item_id % 5 = 0 THEN 'EXAMPLE' WHEN norm_id IN (SELECT norm_id FROM p WHERE norm_id % 2 = 0 AND t IS NOT NULL) THEN 'LEY' ELSE 'DERIVED' END AS norm_type FROM p")
