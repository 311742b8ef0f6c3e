"""Queries of text to rows (TG), each with its oracle where SQL has one."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillbank.functions import textnorm as tx
from quillbank.operators import extract as tg
from quillbank.plans.fixtures import tables, with_views
from quillbank.plans.text_queries import _ua

QUERIES: dict = {}
ORACLE_SQL: dict = {}

def c(name):
    return F.col(name)



def register(name: str, views: str, build, sql: str | None) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(*tables(spark, sf_dir, *views.split()))
    if sql is not None:
        ORACLE_SQL[name] = with_views(sql)


# exam papers made of the documents' words: numbered items with options, some broken
_exam = lambda: F.concat(F.lit("Test\n1. "), F.substring("text", 1, 40), F.lit("\nA) "), F.substring("text", 41, 9), F.lit("\nB) "), F.substring("text", 51, 9), F.lit("\nC) x\n"), F.when(c("doc_id") % 4 == 0, "C) ").otherwise("D) "), F.regexp_replace(F.substr("text", F.lit(61)), r"\s+", " "), F.lit("\n2) again\na) 1 b) 2 c) 3 d) 4"))
register("tg01_split_items", "documents", lambda d: tg.split_items(d.select("doc_id", _exam().alias("text")), "doc_id", "text"), None)
register("tg02_answer_key_table", "orders", lambda o: tg.answer_key_table(o.select("o_orderkey", F.concat_ws(" ", F.lit("1."), F.substring(F.lit("ABCD"), (c("o_orderkey") % 4 + 1).cast("int"), F.lit(1)), F.lit("2 - b 3) C"), (c("o_orderkey") % 3 + 1).cast("string"), F.lit(": d"))  .alias("text")), "o_orderkey", "text"), "WITH b AS (SELECT o_orderkey AS doc, o_orderkey % 3 + 1 AS last FROM orders), k AS (SELECT doc, last, unnest([1, 2, 3]) AS number FROM b) SELECT doc, CAST(number AS INT) AS number, CASE WHEN number = last THEN 'D' WHEN number = 1 THEN substr('ABCD', CAST(doc % 4 + 1 AS INT), 1) WHEN number = 2 THEN 'B' ELSE 'C' END AS letter FROM k")
register("tg03_label_repair", "orders", lambda o: o.select("o_orderkey", F.array_join(tg.label_repair(F.when(c("o_orderkey") % 3 == 0, F.array(*map(F.lit, ["A)", "8)", "€}", "d"]))).when(c("o_orderkey") % 3 == 1, F.array(*map(F.lit, ["A", "B", "C", "C"]))).otherwise(F.array(*map(F.lit, ["A", "C", "B", "D"])))), "").alias("labels")), "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN 'ACBD' ELSE 'ABCD' END AS labels FROM orders")
register("tg04_position_to_page", "conversations", lambda v: tg.position_to_page(v.select(c("conv_id").alias("doc"), c("turn").alias("page"), "text"), v.select(c("conv_id").alias("doc"), (c("turn") * 53 + c("conv_id") % 40).alias("pos"), (c("conv_id") * 1000 + c("turn")).alias("mark_id"))), "WITH s AS (SELECT conv_id, turn, coalesce(sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM conversations) SELECT v.conv_id AS doc, v.conv_id * 1000 + v.turn AS mark_id, (SELECT max(turn) FROM s WHERE s.conv_id = v.conv_id AND s.pos <= v.turn * 53 + v.conv_id % 40) AS page FROM conversations v")
register("tg05_stitch_fragments", "f_fragments", tg.stitch_fragments, "WITH s AS (SELECT *, nullif(sum(CASE WHEN visible_number IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY frag ROWS UNBOUNDED PRECEDING), 0) AS item FROM f_fragments) SELECT doc, CAST(item AS BIGINT) AS item, min(visible_number) AS number, count(*) AS fragments, string_agg(text, chr(10) ORDER BY frag) AS text FROM s GROUP BY doc, item")
register("tg05_merge_contained", "documents", lambda d: d.select("doc_id", tg.merge_contained(F.array(F.substring("text", 1, 30), F.substring("text", 5, 10), F.substring("text", 1, 60), F.substr("text", F.lit(100)))).alias("v")), "SELECT doc_id, CASE WHEN contains(substr(text, 1, 60), substr(text, 100)) THEN substr(text, 1, 60) WHEN contains(substr(text, 100), substr(text, 1, 60)) THEN substr(text, 100) ELSE substr(text, 1, 60) || ' ' || substr(text, 100) END AS v FROM documents")
register("tg06_missing_numbers", "f_items", lambda i: tg.missing_numbers(i, "import_id", "page"), "WITH b AS (SELECT import_id, min(page) AS lo, max(page) AS hi FROM f_items GROUP BY import_id) SELECT import_id, number FROM (SELECT import_id, CAST(unnest(range(lo, hi + 1)) AS INT) AS number FROM b) WHERE (import_id, number) NOT IN (SELECT (import_id, page) FROM f_items)")
_present = lambda i: i.select(c("import_id").alias("doc"), c("page").alias("number"), (c("page") * 10).cast("long").alias("page")).distinct()
register("tg07_candidate_pages", "f_items", lambda i: tg.candidate_pages(_present(i), tg.missing_numbers(i, "import_id", "page").select(c("import_id").alias("doc"), "number")), "WITH b AS (SELECT import_id, min(page) AS lo, max(page) AS hi FROM f_items GROUP BY import_id), m AS (SELECT import_id, number FROM (SELECT import_id, CAST(unnest(range(lo, hi + 1)) AS INT) AS number FROM b) WHERE (import_id, number) NOT IN (SELECT (import_id, page) FROM f_items)) SELECT import_id AS doc, number, CAST((SELECT max(page) FROM f_items i WHERE i.import_id = m.import_id AND page < number) * 10 AS BIGINT) AS low, CAST((SELECT min(page) FROM f_items i WHERE i.import_id = m.import_id AND page > number) * 10 AS BIGINT) AS high FROM m")
_strong, _weak = "^(The|La|Le|De|Die|Und) [^.]{0,25}\\.?$", "^.{1,25}$"
register("tg08_clean_boilerplate_lines", "documents", lambda d: tg.clean_boilerplate(d, "doc_id", "text", _strong, _weak), f"""WITH l AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents), m AS (SELECT *, regexp_matches(line, '{_strong}') AS s, regexp_matches(line, '{_strong}') OR regexp_matches(line, '{_weak}') AS mark FROM l),
 i AS (SELECT *, sum(CASE WHEN mark THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM m), h AS (SELECT *, bool_or(s) OVER (PARTITION BY doc_id, island, mark) AS hit FROM i) SELECT doc_id AS doc, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT (mark AND hit)), '') AS kept FROM h GROUP BY doc_id""")
_heads = lambda li: li.filter("l_quantity > 10").select(c("l_suppkey").alias("doc"), (c("l_partkey") % 60 + c("l_suppkey") % 3).cast("int").alias("number"), c("l_orderkey").cast("int").alias("pos"), c("l_returnflag").alias("line")).filter("number % 7 <> 5 or doc % 2 = 0")
_hsql = "hd AS (SELECT * FROM (SELECT l_suppkey AS doc, CAST(l_partkey % 60 + l_suppkey % 3 AS INT) AS number, CAST(l_orderkey AS INT) AS pos, l_returnflag AS line FROM lineitem WHERE l_quantity > 10) WHERE number % 7 <> 5 OR doc % 2 = 0)"
register("tg09_heading_inventory", "lineitem", lambda li: tg.heading_inventory(_heads(li)), f"WITH {_hsql}, n AS (SELECT doc, number, number - row_number() OVER (PARTITION BY doc ORDER BY number) AS g FROM (SELECT DISTINCT doc, number FROM hd)), r AS (SELECT doc, min(number) AS lo, max(number) AS hi FROM n GROUP BY doc, g), k AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY (lo = 1) DESC, hi - lo DESC, lo) AS p FROM r) SELECT doc, lo, hi, lo <> 1 AS partial FROM k WHERE p = 1")
_uheads = lambda li: _heads(li).groupBy("doc", "number", "pos").agg(F.min("line").alias("line"))
register("tg10_toc_mode", "lineitem", lambda li: tg.toc_mode(_uheads(li)), f"WITH {_hsql}, u AS (SELECT doc, number, pos, min(line) AS line FROM hd GROUP BY ALL), f AS (SELECT *, row_number() OVER w AS r, first_value(line) OVER w AS fl FROM u WINDOW w AS (PARTITION BY doc, number ORDER BY pos)), b AS (SELECT doc, number, count(*) AS n, bool_or(r > 1 AND line = fl) AS again FROM f GROUP BY doc, number) SELECT doc, count(*) FILTER (WHERE n >= 2) >= greatest(2, floor(count(*) * 0.6)) AND count(*) FILTER (WHERE again) >= greatest(2, floor(count(*) * 0.5)) AS toc FROM b GROUP BY doc")
register("tg11_choose_headings", "lineitem", lambda li: tg.choose_headings_in_order(_uheads(li)), None)
_marks = lambda d: d.select(c("doc_id").alias("doc"), F.explode(F.sequence(F.lit(0), F.floor(F.length("text") / 150).cast("int"))).alias("number")).withColumn("pos", c("number") * 150)
register("tg12_segment_bodies", "documents", lambda d: tg.segment_bodies(d.select(c("doc_id").alias("doc"), "text"), _marks(d)), "WITH m AS (SELECT doc_id, text, CAST(unnest(range(0, CAST(floor(length(text) / 150) AS INT) + 1)) AS INT) AS number FROM documents), e AS (SELECT *, number * 150 AS pos, lead(number * 150) OVER (PARTITION BY doc_id ORDER BY number) AS nx FROM m), b AS (SELECT doc_id, number, trim(substr(text, pos + 1, coalesce(nx, length(text)) - pos), ' ' || chr(10) || chr(9) || chr(13)) AS blk FROM e) SELECT doc_id AS doc, number, CAST(length(blk) AS INT) AS chars, CASE WHEN length(CASE WHEN instr(blk, chr(10)) > 0 THEN trim(regexp_replace(substr(blk, CAST(instr(blk, chr(10)) AS INT) + 1), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) ELSE '' END) < 20 THEN 'SHORT' END AS error FROM b")
_expr = lambda: F.when(c("l_linenumber") % 2 == 0, F.concat((c("l_partkey") % 9 + 1).cast("string"), F.lit(" a "), (c("l_partkey") % 9 + 4).cast("string"))).otherwise(F.concat((c("l_partkey") % 9).cast("string"), F.lit(", 7 bis")))
register("tg13_expand_article_ranges", "lineitem", lambda li: li.select("l_orderkey", "l_linenumber", F.explode(tg.expand_article_ranges(_expr())).alias("article")), "SELECT l_orderkey, l_linenumber, CAST(unnest(range(l_partkey % 9 + 1, l_partkey % 9 + 5)) AS VARCHAR) AS article FROM lineitem WHERE l_linenumber % 2 = 0 UNION ALL SELECT l_orderkey, l_linenumber, unnest([CAST(l_partkey % 9 AS VARCHAR), '7 bis']) FROM lineitem WHERE l_linenumber % 2 <> 0")
register("tg14_resolve_scope", "f_refs f_norms", lambda r, n: tg.resolve_scope(r.filter("norm_id is not null").select("norm_id", c("article_asked").alias("article")).distinct(), n.select(c("norm_id").alias("scope_id"), "norm_id", F.when(c("norm_id") % 2 == 0, F.array(F.lit("3"), F.lit("4"), F.lit("99"))).alias("listed"), F.array(F.lit("4"), F.lit("6")).alias("excluded"))), "WITH ix AS (SELECT DISTINCT norm_id, article_asked AS article FROM f_refs WHERE norm_id IS NOT NULL) SELECT n.norm_id AS scope_id, a.article, CASE WHEN ix.article IS NULL THEN 'MISSING' END AS error FROM f_norms n CROSS JOIN (VALUES ('3'), ('99')) AS a(article) LEFT JOIN ix ON ix.norm_id = n.norm_id AND ix.article = a.article WHERE n.norm_id % 2 = 0 UNION ALL SELECT n.norm_id, ix.article, NULL FROM f_norms n JOIN ix ON ix.norm_id = n.norm_id WHERE n.norm_id % 2 <> 0 AND ix.article NOT IN ('4', '6')")
register("tg15_pack_chunks", "f_articles", lambda a: tg.pack_chunks(a.select(c("source_id").alias("key"), c("article_id").alias("row_id"), F.length("text").alias("chars")), 4, 5000), "WITH RECURSIVE o AS (SELECT source_id, article_id, length(text) AS chars, row_number() OVER (PARTITION BY source_id ORDER BY article_id) AS r FROM f_articles), w(source_id, article_id, r, chunk, n, cc) AS (SELECT source_id, article_id, r, 0, 1, chars FROM o WHERE r = 1 UNION ALL SELECT o.source_id, o.article_id, o.r, w.chunk + CASE WHEN w.n >= 4 OR w.cc + o.chars > 5000 THEN 1 ELSE 0 END, CASE WHEN w.n >= 4 OR w.cc + o.chars > 5000 THEN 1 ELSE w.n + 1 END, CASE WHEN w.n >= 4 OR w.cc + o.chars > 5000 THEN o.chars ELSE w.cc + o.chars END FROM w JOIN o ON o.source_id = w.source_id AND o.r = w.r + 1) SELECT source_id AS key, article_id AS row_id, chunk FROM w")
register("tg16_split_oversized", "documents", lambda d: tg.split_oversized(d, "doc_id", "text", 800).select("doc", "piece", F.length("text").alias("chars")), None)
_w = lambda: F.filter(F.split(tx.norm_ascii_alnum(F.col("text")), " "), lambda y: y != "")
_wq = f"list_filter(string_split(trim(regexp_replace(lower({_ua('text')}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda y: y <> '')"
register("tg17_phrase_windows", "benchmark", lambda b: b.select("item_id", F.explode(tg.phrase_windows(_w())).alias("phrase")), f"WITH b AS (SELECT item_id, {_wq} AS w FROM benchmark), s AS (SELECT item_id, w, unnest(range(9, least(15, len(w)) + 1)) AS n FROM b), p AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM s) SELECT item_id, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM p")
_syll = lambda d: d.select(c("doc_id").alias("doc"), F.posexplode(F.concat(F.array(F.lit("preface")), F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.when(k == 0, "PART GENERAL").when(k == 5, "PART ESPECIAL").otherwise(F.concat(F.when(k % 2 == 1, F.concat(((c("doc_id") + k) % 3 + 1).cast("string"), F.lit(". "))).otherwise(""), F.substring("text", k * 10 + 1, F.lit(9))))))).alias("pos", "line"))
register("tg18_split_topics", "documents", lambda d: tg.split_topics(_syll(d).withColumn("line", F.regexp_replace("line", "\n", " "))), """WITH l AS (SELECT doc_id, text, unnest(range(0, 10)) AS k FROM documents), s AS (SELECT doc_id, k, CASE WHEN k < 5 THEN 'GENERAL' ELSE 'ESPECIAL' END AS part, CASE WHEN k % 2 = 1 AND k <> 5 THEN (doc_id + k) % 3 + 1 END AS num, replace(substr(text, k * 10 + 1, 9), chr(10), ' ') AS t FROM l WHERE k NOT IN (0, 5)),
 g AS (SELECT *, sum(CASE WHEN num IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS topic FROM s), b AS (SELECT doc_id, part, topic, max(num) AS number, string_agg(t, ' ' ORDER BY k) AS text FROM g WHERE topic > 0 GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, part, number ORDER BY topic) AS n FROM b) SELECT doc_id AS doc, part, CAST(number AS INT) AS number, text FROM r WHERE n = 1""")
_t19 = "list_filter(list_transform(string_split_regex(trim(regexp_replace(text, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')), '\\.\\s+'), lambda x: trim(x, ' .')), lambda x: x <> '')"
_n19 = f"lower({_ua("array_to_string(s[1:d], '. ')")})"
register("tg19_unique_titles", "documents", lambda d: tg.unique_titles(d.select(c("doc_id").alias("topic_id"), c("lang").alias("part"), "text")), f"""WITH b AS (SELECT doc_id, lang, {_t19} AS s FROM documents),
 p AS (SELECT doc_id, lang, d, {_n19} AS v FROM (SELECT *, unnest(range(1, len(s) + 1)) AS d FROM b)), n AS (SELECT lang, v FROM p GROUP BY lang, v HAVING count(DISTINCT doc_id) = 1),
 f AS (SELECT doc_id, min(d) AS depth FROM p JOIN n ON n.lang = p.lang AND n.v = p.v GROUP BY doc_id)
 SELECT b.doc_id AS topic_id, rtrim(array_to_string(s[1:coalesce(depth, len(s))], '. '), '.') AS title FROM b LEFT JOIN f ON f.doc_id = b.doc_id""")
register("tg20_longest_block", "f_articles", lambda a: tg.longest_block(a.select(c("norm_id").alias("doc"), c("article_no").alias("number"), c("article_id").alias("pos"), "text")).select("doc", "number", F.length("text").alias("chars")), "SELECT norm_id AS doc, article_no AS number, CAST(max(length(text)) AS INT) AS chars FROM f_articles GROUP BY norm_id, article_no HAVING max(length(text)) >= 20")
register("tg21_split_exam_blocks", "documents", lambda d: tg.split_items(d.withColumn("text", F.coalesce("text", F.lit(""))).select("doc_id", _exam().alias("text")), "doc_id", "text").filter("reason is null").groupBy("number").agg(F.count("*").alias("n")), "SELECT 1 AS number, count(*) FILTER (WHERE doc_id % 4 <> 0 AND trim(replace(substr(text, 1, 40), chr(10), ' ')) <> '' AND trim(replace(substr(text, 41, 9), chr(10), ' ')) <> '' AND trim(replace(substr(text, 51, 9), chr(10), ' ')) <> '' AND trim(replace(substr(text, 61), chr(10), ' ')) <> '') AS n FROM documents UNION ALL SELECT 2, count(*) FROM documents")
