"""Queries of duplicates and similarity (DD), each with its oracle where SQL has one."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillbank.functions import textnorm as tx
from quillbank.operators import duplicates as dd
from quillbank.plans.fixtures import tables, with_views
from quillbank.plans.text_queries import _nsl, _ua, flags_sql

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def register(name: str, views: str, build, sql: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(*tables(spark, sf_dir, *views.split()))
    if sql is not None:
        ORACLE_SQL[name] = with_views(sql)


_F = ["stem", "opt_a", "opt_b", "opt_c", "opt_d"]
_alnum = lambda x: f"trim(regexp_replace(lower({_ua(f'coalesce({x}, {chr(39) * 2})')}), '[^a-z0-9]+', ' ', 'g'))"
_nkey = "concat_ws(chr(1), " + ", ".join(_nsl(f) for f in _F) + ")"
_okey = f"concat_ws(chr(1), {_alnum('stem')}, array_to_string(list_sort([{', '.join(_alnum(f) for f in _F[1:])}]), chr(1)))"
_T = "f_text_items"
register("dd01_exact_duplicates", _T, dd.exact_duplicates, "SELECT item_id, keep_id FROM (SELECT *, min(item_id) OVER (PARTITION BY stem, opt_a, opt_b, opt_c, opt_d) AS keep_id FROM f_text_items WHERE stem IS NOT NULL AND opt_a IS NOT NULL AND opt_b IS NOT NULL AND opt_c IS NOT NULL AND opt_d IS NOT NULL) WHERE item_id <> keep_id")
register("dd02_exact_duplicates_normalised", _T, lambda t: dd.duplicate_groups(t, dd.normalised_key()), f"SELECT min(item_id) AS first_id, count(*) AS n FROM f_text_items GROUP BY {_nkey} HAVING count(*) > 1")
register("dd03_duplicates_option_order_free", _T, lambda t: dd.duplicate_groups(t, dd.option_free_key()), f"SELECT min(item_id) AS first_id, count(*) AS n FROM f_text_items GROUP BY {_okey} HAVING count(*) > 1")
register("dd04_stem_duplicates", _T, lambda t: t.groupBy(F.trim("stem").alias("s")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("ids")).filter("n > 1").select("n", "ids"), "SELECT count(*) AS n, array_to_string(list_sort(list(item_id)), ',') AS ids FROM f_text_items GROUP BY trim(stem) HAVING count(*) > 1")
_five = " UNION ALL ".join(f"SELECT min(item_id) AS item_id, '{f}' AS field, concat_ws(chr(1), {', '.join(_nsl(g) for g in _F if g != f)}) AS k, {_nsl(f)} AS v FROM ti GROUP BY k, v" for f in _F)
_typo = "SELECT item_id, stem, opt_a, opt_b, opt_c, opt_d FROM f_text_items UNION ALL SELECT item_id + 1000000, concat(stem, CASE WHEN item_id % 2 = 0 THEN ' x' ELSE ' wholly different' END), opt_a, opt_b, opt_c, opt_d FROM f_text_items WHERE item_id % 5 = 0"
_with_typo = lambda t: t.select("item_id", *_F).union(t.filter("item_id % 5 = 0").select(F.col("item_id") + 1000000, F.concat("stem", F.when(F.col("item_id") % 2 == 0, " x").otherwise(" wholly different")), *_F[1:]))
# the oracle counts edits in bytes, so it gives each letter beyond ASCII that the texts have a byte of its own; texts within five edits share one of six pieces
_LETTERS = "ßäçèéêíñóöü"
_bytes = lambda x: f"translate({x}, '{_LETTERS}', {' || '.join(f'chr({k})' for k in (1, 2, 3, 4, 5, 6, 14, 15, 16, 17, 18))})"
_piece = lambda k: f"contains(y, substr(x, {k} * (length(x) // 6) + 1, length(x) // 6))"
register("dd05_near_duplicates_4of5", _T, lambda t: dd.near_duplicates_one_field(_with_typo(t)), f"""WITH ti AS ({_typo}), r AS MATERIALIZED ({_five}), q AS MATERIALIZED (SELECT item_id, field, md5(k) AS k, {_bytes('v')} AS v FROM r),
 p AS (SELECT a.item_id AS id_a, b.item_id AS id_b, a.field, a.v AS x, b.v AS y FROM q a JOIN q b ON a.field = b.field AND a.k = b.k AND a.item_id < b.item_id AND abs(length(a.v) - length(b.v)) <= 5),
 s AS MATERIALIZED (SELECT * FROM p WHERE length(x) < 60 OR {' OR '.join(map(_piece, range(6)))})
 SELECT id_a, id_b, field, distance FROM (SELECT *, levenshtein(x, y) AS distance FROM s) WHERE distance BETWEEN 1 AND 5""")
_pairs = lambda c: c.select(F.col("c_custkey").alias("id_a"), F.expr("c_custkey - c_custkey % 7").alias("id_b")).union(c.filter("c_custkey % 49 = 0").selectExpr("c_custkey", "c_custkey - 7 * (c_custkey div 7 % 3)"))
_pairs_sql = "p AS (SELECT c_custkey AS a, c_custkey - c_custkey % 7 AS b FROM customer UNION ALL SELECT c_custkey, c_custkey - 7 * (c_custkey // 7 % 3) FROM customer WHERE c_custkey % 49 = 0), u AS (SELECT a, b FROM p WHERE a <> b UNION SELECT b, a FROM p WHERE a <> b)"
_comp_sql = f"WITH RECURSIVE {_pairs_sql}, w(node, reach) AS (SELECT a, a FROM u UNION SELECT w.node, u.b FROM w JOIN u ON u.a = w.reach)"
register("dd06_components", "customer", lambda c: dd.components(_pairs(c)), f"{_comp_sql} SELECT node, min(reach) AS component FROM w GROUP BY node")
_links = lambda o: o.select(F.col("o_custkey").alias("item_id"), (F.col("o_orderkey") % 5).alias("call_id")).filter("item_id % 3 = 0").distinct()
_keep_sql = f"""{_comp_sql}, g AS (SELECT node, min(reach) AS component FROM w GROUP BY node), lk AS (SELECT DISTINCT o_custkey AS item_id, o_orderkey % 5 AS call_id FROM orders WHERE o_custkey % 3 = 0),
us AS (SELECT g.*, EXISTS (SELECT 1 FROM lk WHERE lk.item_id = g.node) AS used FROM g), kp AS (SELECT component, CASE WHEN count(*) FILTER (WHERE used) = 1 THEN min(node) FILTER (WHERE used) ELSE min(node) END AS keep_id FROM us GROUP BY component),
pn AS (SELECT g.node AS item_id, kp.keep_id FROM g JOIN kp ON kp.component = g.component WHERE g.node <> kp.keep_id)"""
register("dd07_keep_plan", "customer orders", lambda c, o: dd.keep_plan(dd.components(_pairs(c)), _links(o)), f"{_keep_sql} SELECT item_id, keep_id, coalesce((SELECT string_agg(CAST(a.call_id AS VARCHAR), ',' ORDER BY a.call_id) FROM lk a JOIN lk b ON a.call_id = b.call_id WHERE a.item_id = pn.item_id AND b.item_id = pn.keep_id), '') AS collisions FROM pn")
register("dd08_reassign_links", "customer orders", lambda c, o: dd.reassign_links(_links(o), dd.keep_plan(dd.components(_pairs(c)), _links(o))), f"{_keep_sql} SELECT DISTINCT lk.call_id, coalesce(pn.keep_id, lk.item_id) AS item_id FROM lk LEFT JOIN pn ON pn.item_id = lk.item_id")
register("dd09_conflicting_duplicates", _T, lambda t: dd.conflicting_duplicates(t, dd.normalised_key(), F.col("answer_key")), f"SELECT min(item_id) AS first_id, count(*) AS n, count(DISTINCT answer_key) AS answers FROM f_text_items GROUP BY {_nkey} HAVING count(DISTINCT answer_key) > 1")
_with_typo_d = lambda t: t.select("item_id", *_F).union(t.filter("item_id % 5 = 0").select(F.col("item_id") + 1000000, *_F[:4], F.concat("opt_d", F.when(F.col("item_id") % 2 == 0, " x").otherwise(" wholly different"))))
register("dd10_near_duplicates_same_stem", _T, lambda t: dd.near_duplicates_same_block(_with_typo_d(t), ["stem"], _F[1:], 0.985), None)
_alike = f"""WITH ti AS ({_typo}), r AS (SELECT min(item_id) AS item_id, opt_a, t FROM (SELECT item_id, opt_a, {_alnum('stem')} AS t FROM ti WHERE opt_a IS NOT NULL) WHERE t <> '' GROUP BY opt_a, t),
 g AS (SELECT *, CASE WHEN length(t) + 2 <= 5 THEN [' ' || t || ' '] ELSE list_distinct(list_transform(range(1, length(t) - 1), lambda i: substr(' ' || t || ' ', i, 5))) END AS g FROM r)
 SELECT a.item_id AS id_a, b.item_id AS id_b, round(2.0 * len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g)), 6) AS similarity FROM g a JOIN g b ON a.opt_a = b.opt_a AND a.item_id < b.item_id AND least(length(a.t), length(b.t)) >= 0.72 * greatest(length(a.t), length(b.t)) WHERE round(2.0 * len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g)), 6) >= 0.94"""
register("dd11_near_duplicates_ngram", _T, lambda t: dd.near_duplicates_ngram(_with_typo(t), ["opt_a"], tx.norm_ascii_alnum(F.col("stem")), 0.94), _alike)
_sentences = lambda d, key: d.select(key, F.posexplode(F.split("text", r"\. |\n")).alias("pos", "t"))
register("dd12_originality_check", "benchmark documents", lambda b, d: dd.originality_check(_sentences(b, "item_id").select((F.col("item_id") * 1000 + F.col("pos")).alias("item_id"), "t"), _sentences(d, "doc_id").select(F.col("doc_id").alias("item_id"), "t"), [], 0.965, 0.85), None)
register("dd13_anti_join_existing", _T, lambda t: dd.anti_join_existing(_with_typo(t).select("item_id", "stem"), t.filter("item_id % 2 = 0").select("stem"), tx.norm_ascii_alnum(F.col("stem"))).select("item_id"), f"WITH ti AS ({_typo}), k AS (SELECT item_id, {_alnum('stem')} AS k FROM ti) SELECT min(item_id) AS item_id FROM k WHERE k NOT IN (SELECT {_alnum('stem')} FROM f_text_items WHERE item_id % 2 = 0) GROUP BY k")
register("dd14_internal_duplicates", _T, lambda t: dd.internal_duplicates(t, dd.normalised_key()), f"SELECT item_id, first_id FROM (SELECT item_id, min(item_id) OVER (PARTITION BY {_nkey}) AS first_id FROM f_text_items) WHERE item_id <> first_id")
register("dd15_fact_dedup", "f_articles", lambda a: a.groupBy("article_no", F.lower("text").alias("t")).agg(F.min("article_id").alias("article_id")).select("article_no", "article_id"), "SELECT article_no, min(article_id) AS article_id FROM f_articles GROUP BY article_no, lower(text)")
register("dd16_hash_groups", "f_articles", dd.hash_groups, "SELECT text_hash, count(*) AS n, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS sources FROM f_articles GROUP BY text_hash HAVING count(*) > 1")
_tok = lambda x: f"regexp_extract_all(lower({x}), '[a-z]{{5,}}', 0)"
_tokens = lambda x: F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit("[a-z]{5,}"), F.lit(0)))
_ask = lambda t: t.select("item_id", (1 + F.col("item_id") % 10).alias("norm_id"), _tokens(F.concat("stem", "opt_a")).alias("tokens"), (1 + F.col("item_id") % 40).cast("int").alias("article"))
register("dd17_idf_rank", "f_text_items f_articles", lambda t, a: dd.idf_rank(_ask(t), a.select("article_id", "norm_id", _tokens(F.col("text")).alias("tokens"), F.col("article_no").alias("article")), 4).select("item_id", "article_id", "rank"), f"""WITH tm AS (SELECT DISTINCT norm_id, article_id, unnest({_tok('text')}) AS token FROM f_articles), n AS (SELECT norm_id, count(*) AS total FROM f_articles GROUP BY norm_id),
 df AS (SELECT norm_id, token, count(*) AS df FROM tm GROUP BY norm_id, token), i AS (SELECT item_id, 1 + item_id % 10 AS norm_id, 1 + item_id % 40 AS article, list_distinct({_tok('stem || opt_a')}) AS w FROM f_text_items),
 q AS (SELECT u.item_id, u.norm_id, u.token, ln((total + 1) / (coalesce(df, 0) + 1)) AS idf FROM (SELECT item_id, norm_id, unnest(w) AS token FROM i) u JOIN n ON n.norm_id = u.norm_id LEFT JOIN df ON df.norm_id = u.norm_id AND df.token = u.token),
 wh AS (SELECT item_id, sum(idf) AS whole FROM q GROUP BY item_id), hit AS (SELECT q.item_id, tm.article_id, sum(idf) AS s FROM q JOIN tm ON tm.norm_id = q.norm_id AND tm.token = q.token GROUP BY ALL),
 s AS (SELECT i.item_id, a.article_id, a.article_no = i.article AS own, round(coalesce(hit.s, 0) / CASE WHEN coalesce(whole, 0) = 0 THEN 1 ELSE whole END, 6) AS score FROM i JOIN f_articles a ON a.norm_id = i.norm_id LEFT JOIN hit ON hit.item_id = i.item_id AND hit.article_id = a.article_id LEFT JOIN wh ON wh.item_id = i.item_id),
 k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, article_id) AS rank, count(*) OVER (PARTITION BY item_id) AS held, row_number() OVER (PARTITION BY item_id, own ORDER BY article_id) AS nth FROM s)
 SELECT item_id, article_id, CAST(CASE WHEN rank <= 4 THEN rank ELSE least(held, 4) + 1 END AS INT) AS rank FROM k WHERE rank <= 4 OR (own AND nth = 1)""")
_ask2 = lambda t: t.select("item_id", (1 + F.col("item_id") % 10).alias("norm_id"), _tokens(F.col("opt_a")).alias("answer"), _tokens(F.col("stem")).alias("context"))
register("dd18_weighted_overlap_rank", "f_text_items f_articles", lambda t, a: dd.weighted_overlap_rank(_ask2(t), a.select("article_id", "norm_id", _tokens(F.col("text")).alias("tokens")), 5), f"""WITH tm AS (SELECT norm_id, article_id, list_distinct({_tok('text')}) AS w FROM f_articles), q AS (SELECT item_id, 1 + item_id % 10 AS norm_id, list_distinct({_tok('opt_a')}) AS a, list_distinct({_tok('stem')}) AS c FROM f_text_items),
 s AS (SELECT item_id, article_id, len(list_intersect(a, w)) AS na, len(list_intersect(c, w)) AS nc, len(a) AS n FROM q JOIN tm ON tm.norm_id = q.norm_id),
 r AS (SELECT item_id, article_id, round(2.2 * na + nc + CASE WHEN n > 0 AND na / n >= 0.38 THEN 4 ELSE 0 END, 2) AS score FROM s WHERE na + nc > 0)
 SELECT item_id, article_id, CAST(score AS DOUBLE) AS score, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, article_id) AS rank FROM r) WHERE rank <= 5""")
_nt = lambda x: F.array_distinct(F.split(tx.norm_ascii_alnum(x), " "))
_named = "concat_ws(' ', p_type, CASE WHEN p_size % 3 = 0 THEN p_brand END)"
_identity, _cand_identity = "CASE WHEN p_size % 4 = 0 THEN upper(p_type) END", "CASE WHEN length(p_type) % 2 = 0 THEN upper(p_type) END"
register("dd19_best_name_match", "part", lambda p: dd.best_name_match(p.select(F.col("p_partkey").alias("id"), _nt(F.expr(_named)).alias("tokens"), F.expr(_identity).alias("identity")), p.select(F.col("p_type").alias("cand"), _nt(F.col("p_type")).alias("tokens"), F.expr(_cand_identity).alias("identity")).distinct(), 0.72, 0.12), f"""WITH a AS (SELECT p_partkey AS id, list_distinct(string_split({_alnum(_named)}, ' ')) AS t, {_identity} AS i FROM part), b AS (SELECT DISTINCT p_type AS cand, list_distinct(string_split({_alnum('p_type')}, ' ')) AS t, {_cand_identity} AS i FROM part),
 e AS (SELECT id, count(*) AS n, min(cand) AS cand FROM a JOIN b ON a.i = b.i GROUP BY id),
 s AS (SELECT id, cand, round(CASE WHEN a.i IS NOT NULL AND b.i IS NOT NULL THEN 0 WHEN a.i IS NOT NULL OR b.i IS NOT NULL THEN CASE WHEN len(list_intersect(a.t, b.t)) = least(len(a.t), len(b.t)) THEN least(len(a.t), len(b.t)) / greatest(len(a.t), len(b.t)) ELSE 0 END ELSE len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))) END, 6) AS s FROM a, b WHERE id NOT IN (SELECT id FROM e)),
 r AS (SELECT *, row_number() OVER w AS r, lead(s) OVER w AS nx FROM s WINDOW w AS (PARTITION BY id ORDER BY s DESC, cand))
 SELECT id, cand, 1.0::DOUBLE AS s FROM e WHERE n = 1 UNION ALL SELECT id, cand, CAST(s AS DOUBLE) FROM r WHERE r = 1 AND s >= 0.72 AND round(s - coalesce(nx, 0), 6) >= 0.12""")
_w = lambda x: F.filter(F.split(tx.norm_ascii_alnum(x), " "), lambda y: y != "")
_wsql = lambda x: f"list_filter(string_split({_alnum(x)}, ' '), lambda y: y <> '')"
register("dd20_phrase_evidence", "benchmark documents", lambda b, d: dd.phrase_evidence(b.select("item_id", _w(F.col("text")).alias("words")), d.select(F.col("doc_id").alias("text_id"), _w(F.col("text")).alias("words")), 9), f"""WITH b AS (SELECT DISTINCT item_id, array_to_string(w[i:i+8], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 7)) AS i FROM (SELECT item_id, {_wsql('text')} AS w FROM benchmark) WHERE len(w) >= 9)),
 d AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+8], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 7)) AS i FROM (SELECT doc_id, {_wsql('text')} AS w FROM documents) WHERE len(w) >= 9)),
 m AS (SELECT item_id, count(DISTINCT doc_id) AS n, min(doc_id) AS t FROM b JOIN d ON b.g = d.g GROUP BY item_id) SELECT x.item_id, CASE WHEN n IS NULL THEN 'NONE' WHEN n = 1 THEN 'UNIQUE' ELSE 'SEVERAL' END AS state, CASE WHEN n = 1 THEN t END AS text_id FROM benchmark x LEFT JOIN m ON m.item_id = x.item_id""")
# a ninth of the stems point to something that isn't in the item
_points = lambda t: t.select("item_id", F.concat(F.when(F.col("item_id") % 9 == 0, "Según el apartado anterior, ").otherwise(""), "stem").alias("stem"))
_points_sql = "SELECT item_id, CASE WHEN item_id % 9 = 0 THEN 'Según el apartado anterior, ' ELSE '' END || stem AS stem FROM f_text_items"
register("dd24_strict_quality_set", "f_text_items f_bank_links", lambda t, b: dd.strict_quality_set(_points(t).filter(F.size(tx.self_sufficiency_flags(F.col("stem"), F.col("stem"))) > 0).select("item_id"), dd.near_duplicates_ngram(_with_typo(t), ["opt_a"], tx.norm_ascii_alnum(F.col("stem")), 0.94), b), f"""WITH pairs AS ({_alike}), st AS ({_points_sql}),
 ids AS (SELECT item_id, 'FLAG' AS r FROM st WHERE {flags_sql('stem')} <> '' UNION ALL SELECT unnest([id_a, id_b]), 'DUPLICATE' FROM pairs)
 SELECT item_id, string_agg(DISTINCT r, ',' ORDER BY r) AS reasons, (SELECT count(*) FROM f_bank_links b WHERE b.item_id = ids.item_id) AS links FROM ids GROUP BY item_id""")
register("dd26_duplicate_usage", "customer orders", lambda c, o: dd.duplicate_usage(dd.components(_pairs(c)), _links(o)), f"{_keep_sql} SELECT component, CASE WHEN count(*) FILTER (WHERE used) >= 2 THEN 'SEVERAL' WHEN count(*) FILTER (WHERE used) = 1 THEN 'ONE' ELSE 'NONE' END AS usage FROM us GROUP BY component")
register("tx29_central_key", _T, dd.central_key, None)
