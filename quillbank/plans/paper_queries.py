"""Queries of papers made of the documents' lines (TG-08, TG-18, TG-21) and of merge reviews (DD-23)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank.operators import papers as pp
from quillbank.plans.fixtures import tables, with_views

QUERIES: dict = {}
ORACLE_SQL: dict = {}
_LINES = "ln AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l FROM documents)"


def _of_lines(documents: DataFrame, line) -> DataFrame:
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    return documents.select("doc_id", F.array_join(F.transform(lines, lambda x, i: line(x, (i + 1).cast("long"))), "\n").alias("text"))


_INLINE = " Núm. 12 Lunes 3 de mayo de 2019 Sec. I. Pág. 45 cve: BOE-A-2019-123 Verificable en https://www.boe.es "


def tg08_clean_gazette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers before some lines, weak lines alone and beside them, and headers within lines."""
    (docs,) = tables(spark, sf_dir, "documents")

    def line(x, i):
        before = F.when(i % 5 == 1, "ES\nL 45/12 Diario Oficial de la Unión Europea\n3.4.2019\n").when(i % 5 == 2, "32/239\n").when(i % 5 == 3, "Núm. 8650 / 17.10.2019\nES\n").otherwise("")
        return F.concat(before, F.when((i % 4 == 0) & (F.trim(F.substr(x, F.lit(11))) != ""), F.concat(F.substring(x, 1, 10), F.lit(_INLINE), F.substr(x, F.lit(11)))).otherwise(x))

    return pp.clean_gazette(_of_lines(docs, line), "doc_id", "text")


QUERIES["tg08_clean_gazette"] = tg08_clean_gazette
# what stays is known from where headers were put: weak lines alone stay
ORACLE_SQL["tg08_clean_gazette"] = f"""WITH {_LINES}
SELECT doc_id AS doc, array_to_string(list_transform(l, lambda x, i: CASE WHEN i % 5 = 2 THEN '32/239' || chr(10) ELSE '' END || CASE WHEN i % 4 = 0 AND trim(substr(x, 11)) <> '' THEN rtrim(substr(x, 1, 10), ' ') || ' ' || ltrim(substr(x, 11), ' ') ELSE x END), chr(10)) AS kept FROM ln"""


def tg01_numbered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line is an item; every sixth lacks an option, every seventh skips a number, every other has its number on a line of its own."""
    (docs,) = tables(spark, sf_dir, "documents")

    def line(x, i):
        number = (i + F.floor(i / 7)).cast("string")
        return F.concat(number, F.when(i % 2 == 1, "\n").otherwise(""), F.lit("¿"), x, F.lit("?\na) uno B)  dos\n"), F.when(i % 6 == 0, "").otherwise("c) tres "), F.lit("D)\ncuatro\n"))

    return pp.split_numbered_items(_of_lines(docs, line), "doc_id", "text")


QUERIES["tg01_numbered_items"] = tg01_numbered_items
ORACLE_SQL["tg01_numbered_items"] = f"""WITH {_LINES}, r AS (SELECT doc_id, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS i FROM ln),
t AS (SELECT doc_id AS doc, CAST(i + i // 7 AS INT) AS number, i % 6 <> 0 AS ok, trim(regexp_replace('¿' || x || '?', '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) AS stem, i FROM r)
SELECT doc, number, CASE WHEN ok THEN stem END AS stem, CASE WHEN ok THEN 'uno' END AS opt_a, CASE WHEN ok THEN 'dos' END AS opt_b, CASE WHEN ok THEN 'tres' END AS opt_c, CASE WHEN ok THEN 'cuatro' END AS opt_d, CASE WHEN NOT ok THEN 'OPTIONS' END AS reason FROM t
UNION ALL SELECT doc, number - 1, NULL, NULL, NULL, NULL, NULL, 'MISSING' FROM t WHERE i % 7 = 0"""


def tg21_exam_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth block lacks an option, every third has a tail."""
    (docs,) = tables(spark, sf_dir, "documents")

    def line(x, i):
        return F.concat((i % 1000).cast("string"), F.lit(". "), x, F.lit("\nA) uno\n  B) dos\n"), F.when(i % 5 == 0, "").otherwise("C) tres\n"), F.lit("D) cuatro\n\n"), F.when(i % 3 == 0, "Seguridad en la respuesta: alta\ncola\n").otherwise(""))

    return pp.split_exam_blocks(_of_lines(docs, line), "doc_id", "text")


QUERIES["tg21_exam_blocks"] = tg21_exam_blocks
ORACLE_SQL["tg21_exam_blocks"] = f"""WITH {_LINES}, r AS (SELECT doc_id, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS i FROM ln)
SELECT doc_id AS doc, CAST(i % 1000 AS INT) AS number, (i % 1000) || '. ' || x || chr(10) || 'A) uno' || chr(10) || '  B) dos' || chr(10) || 'C) tres' || chr(10) || 'D) cuatro' AS text FROM r WHERE i % 5 <> 0"""


def tg18_split_syllabus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the lines is the general part; numbers repeat and go beyond their part's."""
    (docs,) = tables(spark, sf_dir, "documents")
    letters = lambda x: F.btrim(F.regexp_replace(x, r"[^\p{L}]+", " "), F.lit(" "))
    half = F.floor(F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")) / 2)

    def line(x, i):
        head = F.when(i == 1, "Índice 1. nada\nCVE: DOGV-2\nTemario parte general\n").when(i == half + 1, "TEMARIO PARTE ESPECIAL\n").otherwise("")
        return F.concat(head, (i % 70).cast("string"), F.lit(". "), letters(x), F.when(i % 6 == 0, "\n3 / 9").otherwise(""))

    return pp.split_syllabus(_of_lines(docs, line), "doc_id", "text")


QUERIES["tg18_split_syllabus"] = tg18_split_syllabus
ORACLE_SQL["tg18_split_syllabus"] = f"""WITH {_LINES}, r AS (SELECT doc_id, len(l) // 2 AS half, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS i FROM ln),
t AS (SELECT doc_id, i, i % 70 AS number, CASE WHEN half = 0 OR i > half THEN 'ESPECIAL' ELSE 'GENERAL' END AS part, half, trim(regexp_replace(x, '[^\\pL]+', ' ', 'g')) AS text FROM r),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, part, number ORDER BY i) AS nth FROM (SELECT doc_id, i, number, CASE WHEN half = 0 THEN 'GENERAL' ELSE part END AS part, text FROM t) WHERE text <> '' AND number >= 1 AND number <= CASE part WHEN 'GENERAL' THEN 15 ELSE 60 END)
SELECT doc_id AS doc, part, CAST(number AS INT) AS number, text FROM f WHERE nth = 1"""


def dd23_merge_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring items as pairs, some as threes; every eleventh item is in a simulation, some links have a second topic."""
    (links,) = tables(spark, sf_dir, "f_bank_links")
    items = links.select("item_id").distinct()
    groups = items.select((F.col("item_id") / F.when(F.col("item_id") % 50 < 10, 30).otherwise(20)).cast("long").alias("g"), F.when(F.col("item_id") % 50 < 10, 1).otherwise(0).alias("s"), "item_id").select((F.col("g") * 2 + F.col("s")).alias("component"), "item_id")
    some = links.select("link_id", "topic_id").union(links.filter("item_id % 7 = 0").select("link_id", F.col("topic_id") + 1))
    unused = groups.select("component", (-F.col("item_id")).alias("item_id")).filter("item_id % 3 = 0")
    return pp.merge_review(groups.union(unused).distinct(), links, some, items.filter("item_id % 11 = 0"))


QUERIES["dd23_merge_review"] = dd23_merge_review
ORACLE_SQL["dd23_merge_review"] = with_views("""WITH it AS (SELECT DISTINCT item_id FROM f_bank_links),
gr AS (SELECT CAST(floor(item_id / CASE WHEN item_id % 50 < 10 THEN 30 ELSE 20 END) AS BIGINT) * 2 + CASE WHEN item_id % 50 < 10 THEN 1 ELSE 0 END AS component, item_id FROM it),
ga AS (SELECT * FROM gr UNION SELECT component, -item_id FROM gr WHERE item_id % 3 = 0),
sz AS (SELECT component, count(*) AS n, min(item_id) AS lo, max(item_id) AS hi, min(item_id) FILTER (WHERE item_id > 0) AS first, count(*) FILTER (WHERE item_id > 0) AS k FROM ga GROUP BY component),
pr AS (SELECT component, CASE WHEN k = 1 THEN first ELSE lo END AS keep_id, CASE WHEN k = 1 THEN lo + hi - first ELSE hi END AS item_id FROM sz WHERE n = 2),
tp AS (SELECT link_id, CASE WHEN item_id % 7 = 0 THEN topic_id || ',' || (topic_id + 1) ELSE CAST(topic_id AS VARCHAR) END AS topics FROM f_bank_links),
m AS (SELECT pr.component, b.part_id AS bp, a.part_id AS ap, b.link_type AS bt, a.link_type AS at_, b.state AS bs, a.state AS as_, ta.topics AS topa, tb.topics AS topb, a.link_id
  FROM pr JOIN f_bank_links b ON b.item_id = pr.item_id JOIN tp tb ON tb.link_id = b.link_id LEFT JOIN f_bank_links a ON a.item_id = pr.keep_id AND a.call_id = b.call_id LEFT JOIN tp ta ON ta.link_id = a.link_id),
c AS (SELECT component, count(link_id) AS e, count(*) - count(link_id) AS mv, coalesce(bool_or(ap IS DISTINCT FROM bp OR at_ <> bt OR as_ <> bs) FILTER (WHERE link_id IS NOT NULL), false) AS fd, coalesce(bool_or(topa <> topb) FILTER (WHERE link_id IS NOT NULL), false) AS td FROM m GROUP BY component)
SELECT pr.component, keep_id, item_id, CASE WHEN item_id > 0 AND item_id % 11 = 0 THEN 'SIMULATION' WHEN fd THEN 'LINKS' WHEN td THEN 'TOPICS' ELSE 'OK' END AS state, coalesce(e, 0) AS equal_links, coalesce(mv, 0) AS moved_links FROM pr LEFT JOIN c ON c.component = pr.component
UNION ALL SELECT component, NULL, NULL, 'NOT_A_PAIR', 0, 0 FROM sz WHERE n <> 2""")
