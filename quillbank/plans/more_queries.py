"""Queries of the operators that build on several others, each with its oracle where SQL has one."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillbank.functions import textnorm as tx
from quillbank.operators import allocation as wn
from quillbank.operators import changes as ch
from quillbank.operators import duplicates as dd
from quillbank.operators import linking as lk
from quillbank.plans.bank_queries import ELIGIBLE, INDEX, LOCATED, MATCHED, _base, _parts
from quillbank.plans.fixtures import tables, with_views
from quillbank.plans.text_queries import _nsl, _ua

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def register(name: str, views: str, build, sql: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(*tables(spark, sf_dir, *views.split()))
    if sql is not None:
        ORACLE_SQL[name] = with_views(sql)


def c(name):
    return F.col(name)


_NOT_GENERAL = "(syllabus_part IS NULL OR syllabus_part <> 'GENERAL')"
_alias = {"supplier#000000001": 1, "supplier#000000003": 3, "supplier#000000007": 7}
register("lk20_alias_link_refs", "f_refs f_norms", lambda r, n: lk.alias_link(r.select("ref_id", "norm_id", F.concat(F.lit(" Supplier#00000000"), (c("ref_id") % 9).cast("string")).alias("norm_name")), _alias).select("ref_id", "norm_id"), "SELECT ref_id, coalesce(norm_id, CASE WHEN ref_id % 9 IN (1, 3, 7) THEN ref_id % 9 END) AS norm_id FROM f_refs")
register("au34_part_resolution_diagnosis", "f_items f_exclusions f_refs f_topics f_bank_links f_part_rules", lambda i, x, r, t, b, p: lk.part_errors(i, x, lk.located_refs(r, t), b, p.filter(_NOT_GENERAL)), f"WITH {ELIGIBLE}, {LOCATED}, {INDEX}, {MATCHED}, nw AS (SELECT * FROM m WHERE outcome = 'NEW'), {_parts('np', 'nw').replace('JOIN f_part_rules r ON', f'JOIN (SELECT * FROM f_part_rules WHERE {_NOT_GENERAL}) r ON')} SELECT call_id, part, content_type, theory_practice, part_reason, count(*) AS n FROM np WHERE part_reason IS NOT NULL GROUP BY ALL")
_alnum = lambda x: f"trim(regexp_replace(lower({_ua(x)}), '[^a-z0-9]+', ' ', 'g'))"
_words = lambda x: F.array_distinct(F.split(tx.norm_ascii_alnum(x), " "))
_sources = lambda p: p.groupBy(c("p_type").alias("p")).agg(F.min("p_partkey").alias("source_id"), F.min("p_brand").alias("identity"), (F.min("p_size") > 1).alias("official")).select("source_id", _words(c("p")).alias("tokens"), "identity", "official")
register("lk23_best_named_source", "part", lambda p: lk.best_named_source(p.select(c("p_partkey").alias("id"), _words(F.concat_ws(" ", "p_type", "p_brand")).alias("tokens")), _sources(p), 0.4), f"""WITH a AS (SELECT p_partkey AS id, list_distinct(string_split({_alnum("concat_ws(' ', p_type, p_brand)")}, ' ')) AS t FROM part), b AS (SELECT min(p_partkey) AS source_id, list_distinct(string_split({_alnum('p_type')}, ' ')) AS t, min(p_brand) AS identity, min(p_size) > 1 AS official FROM part GROUP BY p_type),
 s AS (SELECT id, source_id, identity, official, round(len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))), 6) AS score FROM a, b), f AS (SELECT *, rank() OVER (PARTITION BY id ORDER BY score DESC) AS r FROM s WHERE score >= 0.4) SELECT id, arg_min(source_id, (NOT official, source_id)) AS source_id, max(score) AS score FROM f WHERE r = 1 GROUP BY id HAVING count(DISTINCT identity) = 1""")
_tw = lambda d: d.select(c("doc_id").alias("topic_id"), (c("doc_id") % 2).alias("norm_id"), F.concat(F.lit(" "), tx.norm_ascii_alnum(c("text")), F.lit(" ")).alias("words"))
_hw = lambda b: b.select((c("item_id") % 2).alias("norm_id"), F.posexplode(F.concat(F.array("text"), F.split("text", r"\. "))).alias("pos", "t"), "item_id").select("norm_id", F.concat_ws("/", c("item_id").cast("string"), F.when(c("pos") > 0, c("pos").cast("string"))).alias("path"), F.concat(F.lit(" "), tx.norm_ascii_alnum(c("t")), F.lit(" ")).alias("words"))
register("lk27_material_scope", "documents benchmark", lambda d, b: lk.material_scope(_tw(d), _hw(b)), f"""WITH t AS (SELECT doc_id AS topic_id, doc_id % 2 AS norm_id, ' ' || {_alnum('text')} || ' ' AS words FROM documents), p AS (SELECT item_id, list_prepend(text, string_split(text, '. ')) AS l FROM benchmark), s AS (SELECT item_id, unnest(range(len(l))) AS pos, unnest(l) AS t FROM p),
 h0 AS (SELECT item_id % 2 AS norm_id, concat_ws('/', CAST(item_id AS VARCHAR), CASE WHEN pos > 0 THEN CAST(pos AS VARCHAR) END) AS path, ' ' || {_alnum('t')} || ' ' AS words FROM s),
 h AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY norm_id, words) AS n FROM h0) WHERE n = 1 AND len(string_split(trim(words), ' ')) >= 2), hit AS (SELECT topic_id, t.norm_id, path FROM t JOIN h ON h.norm_id = t.norm_id AND contains(t.words, h.words)) SELECT * FROM hit WHERE NOT EXISTS (SELECT 1 FROM hit o WHERE o.topic_id = hit.topic_id AND o.norm_id = hit.norm_id AND o.path LIKE hit.path || '/%')""")
_said = lambda x, key, name: x.select(c(key).alias(name), F.explode(F.split("text", r"\. |\n")).alias("t"))
register("dd21_match_official", "documents benchmark", lambda d, b: dd.match_official(_said(d, "doc_id", "item_id"), _said(b, "item_id", "exam_id"), d.filter("doc_id % 6 = 0").select(c("doc_id").alias("item_id"), (c("doc_id") % 40).alias("exam_id")), []), None)
register("dd22_article_duplicates", "f_articles", lambda a: dd.article_duplicates(a.withColumn("article_no", c("article_no") % 9)), None)
register("dd23_merge_precheck", "f_bank_links", lambda b: dd.merge_precheck(b.select("item_id").distinct().filter("item_id % 10 = 2").select("item_id", (c("item_id") - 1 - (c("item_id") % 4) * 10).alias("keep_id")), b), "WITH p AS (SELECT DISTINCT item_id, item_id - 1 - (item_id % 4) * 10 AS keep_id FROM f_bank_links WHERE item_id % 10 = 2) SELECT p.keep_id, p.item_id, l.call_id, CASE WHEN k.item_id IS NULL THEN 'MOVE' WHEN k.part_id IS NOT DISTINCT FROM l.part_id AND k.link_type = l.link_type AND k.topic_id = l.topic_id THEN 'DROP' ELSE 'BLOCK' END AS action FROM p JOIN f_bank_links l ON l.item_id = p.item_id LEFT JOIN f_bank_links k ON k.item_id = p.keep_id AND k.call_id = l.call_id")
_ti = lambda t: t.select("*", (1 + c("item_id") % 10).alias("norm_id"), (1 + F.floor(c("item_id") / 10) % 40).cast("int").alias("article_no"))
_key = "concat_ws(chr(1), " + ", ".join(_nsl(f) for f in dd.FIELDS) + ")"
register("dd25_conflicts_with_text", "f_text_items f_articles", lambda t, a: dd.conflicts_with_text(_ti(t), a.filter("article_id % 2 = 0"), dd.normalised_key()), f"WITH b AS (SELECT {_key} AS k FROM f_text_items GROUP BY 1 HAVING count(DISTINCT answer_key) > 1), n AS (SELECT norm_id, article_no, count(*) AS texts, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS sources FROM f_articles WHERE article_id % 2 = 0 GROUP BY norm_id, article_no) SELECT item_id, coalesce(texts, 0) AS texts, coalesce(sources, '') AS sources FROM f_text_items i JOIN b ON b.k = {_key} LEFT JOIN n ON n.norm_id = 1 + item_id % 10 AND n.article_no = 1 + floor(item_id / 10) % 40")
_dated = lambda r, a, b: r.filter(a).select("ref_id", "topic_id", F.concat_ws("", F.concat(F.lit("ley "), (c("ref_id") % 7).cast("string"), F.lit("/2015")), F.when(F.expr(b), " de 3 de mayo")).alias("key"), F.concat(F.lit("ley "), (c("ref_id") % 7).cast("string"), F.lit("/2015")).alias("plain"), c("article_asked").alias("article"))
register("ch03_upsert_ref", "f_refs", lambda r: ch.upsert_ref(_dated(r, "ref_id % 2 = 0", "ref_id % 3 = 0"), _dated(r, "ref_id % 3 <> 1", "ref_id % 4 = 0").withColumnRenamed("ref_id", "in_id")), """WITH s AS (SELECT ref_id, topic_id, 'ley ' || CAST(ref_id % 7 AS VARCHAR) || '/2015' AS plain, article_asked AS article, ref_id % 3 = 0 AS d FROM f_refs WHERE ref_id % 2 = 0), i AS (SELECT ref_id AS in_id, topic_id, 'ley ' || CAST(ref_id % 7 AS VARCHAR) || '/2015' AS plain, article_asked AS article, ref_id % 4 = 0 AS d FROM f_refs WHERE ref_id % 3 <> 1),
 m AS (SELECT in_id, min(CASE WHEN s.d = i.d THEN ref_id END) AS same, count(ref_id) AS n, min(ref_id) AS lik FROM i LEFT JOIN s ON s.topic_id = i.topic_id AND s.plain = i.plain AND s.article = i.article GROUP BY in_id) SELECT in_id, CASE WHEN same IS NOT NULL THEN 'SAME' WHEN n > 1 THEN 'AMBIGUOUS' WHEN n = 1 THEN 'UPDATE' ELSE 'INSERT' END AS action, coalesce(same, CASE WHEN n = 1 THEN lik END) AS ref_id FROM m""")
_cand = lambda t: t.select("*", F.when(c("item_id") % 7 == 0, "OPEN").otherwise("CONFIRMED").alias("state"), (1 + c("item_id") % 12).alias("norm_id"), F.concat(F.lit("art. "), (c("item_id") % 30).cast("string"), F.lit(".1")).alias("article"), F.concat((c("item_id") % 30 + F.when(c("item_id") % 11 == 0, 1).otherwise(0)).cast("string")).alias("asked"))
register("ch19_accept_candidates", "f_text_items f_articles", lambda t, a: ch.accept_candidates(_cand(t), t.filter("item_id % 5 = 0"), a, dd.normalised_key()), f"SELECT item_id, CASE WHEN item_id % 7 = 0 THEN 'STATE' WHEN trim(coalesce(stem, '')) = '' OR trim(coalesce(opt_a, '')) = '' OR trim(coalesce(opt_b, '')) = '' OR trim(coalesce(opt_c, '')) = '' OR trim(coalesce(opt_d, '')) = '' THEN 'STRUCTURE' WHEN 1 + item_id % 12 NOT IN (SELECT norm_id FROM f_articles) THEN 'NORM' WHEN item_id % 11 = 0 THEN 'ARTICLE' WHEN {_key} IN (SELECT {_key} FROM f_text_items WHERE item_id % 5 = 0) THEN 'DUPLICATE' END AS reason FROM f_text_items")
_ra = lambda r: r.filter("norm_id is not null").select("ref_id", "topic_id", "norm_id", c("article_asked").alias("article"), "state")
_fi = lambda r: _ra(r).filter("ref_id % 6 = 0").select("topic_id", "norm_id", "article", F.lit("DELETE").alias("action")).union(_ra(r).filter("ref_id % 5 = 0").select("topic_id", (c("norm_id") + F.when(c("ref_id") % 2 == 0, 0).otherwise(500)), F.lit("77"), F.lit("ADD"))).distinct()
register("ch22_apply_scope_findings", "f_refs", lambda r: ch.apply_scope_findings(_ra(r), _fi(r)), """WITH r AS (SELECT ref_id, topic_id, norm_id, article_asked AS article, state FROM f_refs WHERE norm_id IS NOT NULL), d AS (SELECT DISTINCT topic_id, norm_id, article FROM r WHERE ref_id % 6 = 0), a AS (SELECT DISTINCT topic_id, norm_id + CASE WHEN ref_id % 2 = 0 THEN 0 ELSE 500 END AS norm_id, '77' AS article FROM r WHERE ref_id % 5 = 0)
 SELECT topic_id, norm_id, article, state FROM r WHERE (topic_id, norm_id, article) NOT IN (SELECT (topic_id, norm_id, article) FROM d) UNION ALL SELECT a.topic_id, a.norm_id, a.article, coalesce((SELECT arg_min(state, ref_id) FROM r WHERE r.topic_id = a.topic_id AND r.norm_id = a.norm_id), (SELECT arg_min(state, ref_id) FROM r WHERE r.topic_id = a.topic_id), 'SIN_RESOLVER') FROM a""")
_pr = lambda r, t, p: r.filter("norm_id is not null").join(t.select("topic_id", "part"), "topic_id").join(p.select("part_id", "call_id", c("name").alias("part")), ["call_id", "part"]).select("ref_id", "part_id", "norm_id")
register("wn11_blueprint_sequence", "f_blueprint f_parts f_refs f_topics", lambda b, p, r, t: wn.blueprint_sequence(b, p, _pr(r, t, p), "s11").groupBy("block").agg(F.count("*").alias("n"), F.count_distinct("ref_id").alias("refs")), """WITH pr AS (SELECT ref_id, p.part_id, r.norm_id FROM f_refs r JOIN f_topics t ON t.topic_id = r.topic_id JOIN f_parts p ON p.call_id = r.call_id AND p.name = t.part WHERE r.norm_id IS NOT NULL),
 rows_ AS (SELECT b.part_id, b.block_order, b.amount, ref_id FROM f_blueprint b JOIN pr ON pr.part_id = b.part_id AND ((b.block_type = 'NORMA' AND pr.norm_id = b.norm_id) OR (b.block_type = 'LIBRE' AND pr.norm_id NOT IN (SELECT norm_id FROM f_blueprint n WHERE n.part_id = b.part_id AND n.norm_id IS NOT NULL)))),
 live AS (SELECT part_id, block_order, any_value(amount) AS weight, count(*) AS cand FROM rows_ GROUP BY part_id, block_order), q0 AS (SELECT l.*, p.n_items, round(weight * p.n_items / sum(weight) OVER (PARTITION BY l.part_id), 9) AS exact FROM live l JOIN f_parts p ON p.part_id = l.part_id), q1 AS (SELECT *, n_items - sum(floor(exact)) OVER (PARTITION BY part_id) AS rest, row_number() OVER (PARTITION BY part_id ORDER BY exact - floor(exact) DESC, block_order) AS r FROM q0), q AS (SELECT *, CAST(floor(exact) + CASE WHEN r <= rest THEN 1 ELSE 0 END AS BIGINT) AS quota FROM q1)
 SELECT CAST(part_id AS VARCHAR) || '/' || CAST(block_order AS VARCHAR) AS block, quota AS n, least(quota, cand) AS refs FROM q WHERE quota > 0""")
