"""Queries of legal texts (TG-11, TG-12, TG-14): laws made of the documents' lines, and what is found in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank.operators import headings as hd
from quillbank.operators import scopes as sc
from quillbank.plans.fixtures import tables
from quillbank.plans.text_queries import _ua

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def laws(documents: DataFrame) -> DataFrame:
    """``doc, text``: each line of a document is an article with its heading; two of three documents begin with an index.

    Indexes cut headings short and lose some; some articles begin with a line that cites the next article.
    """
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    of = lambda i: F.col("doc_id") + i
    index = F.transform(lines, lambda x, i: F.concat(F.lit("Artículo "), (i + 1).cast("string"), F.when(of(i) % 11 == 0, ".").otherwise(F.concat(F.lit(". "), F.substring(x, 1, 18)))))

    def article(x: Column, i: Column) -> Column:
        cites = F.when(of(i) % 7 == 0, F.concat(F.lit("artículo "), (i + 2).cast("string"), F.lit(" de esta ley\n"))).otherwise("")
        return F.concat(cites, F.lit("ARTÍCULO "), (i + 1).cast("string"), F.lit(". "), F.substring(x, 1, 40), F.lit("\n"), x)

    text = F.concat(F.when(F.col("doc_id") % 3 != 0, F.concat(F.array_join(index, "\n"), F.lit("\n"))).otherwise(""), F.array_join(F.transform(lines, article), "\n"))
    return documents.select(F.col("doc_id").alias("doc"), text.alias("text"))


_LAWS = """
ln AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l FROM documents),
laws AS (
  SELECT doc_id AS doc,
         CASE WHEN doc_id % 3 <> 0 THEN array_to_string(list_transform(l, lambda x, i: 'Artículo ' || i || CASE WHEN (doc_id + i - 1) % 11 = 0 THEN '.' ELSE '. ' || substr(x, 1, 18) END), chr(10)) || chr(10) ELSE '' END
         || array_to_string(list_transform(l, lambda x, i: CASE WHEN (doc_id + i - 1) % 7 = 0 THEN 'artículo ' || (i + 1) || ' de esta ley' || chr(10) ELSE '' END || 'ARTÍCULO ' || i || '. ' || substr(x, 1, 40) || chr(10) || x), chr(10)) AS text
  FROM ln)"""

#: Headings by lines; the digits' surroundings are tested apart because this dialect can't look ahead.
_HEADINGS = f"""
li AS (SELECT doc, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k FROM laws),
ofs AS (SELECT doc, text, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM li),
m AS (SELECT *, regexp_extract(line, '(?i)^[ \\t]*(art[ií]culo|article)[ \\t]+[0-9]+', 0) AS head FROM ofs),
hd AS (
  SELECT doc, CAST(regexp_extract(head, '[0-9]+$', 0) AS INT) AS number, CAST(pos AS BIGINT) AS pos, trim(regexp_replace(line, '[ \\t]+', ' ', 'g')) AS line
  FROM m WHERE head <> '' AND regexp_matches(substr(line, length(head) + 1), '^([ \\t]*\\.)?([ \\t]+|$)') AND NOT regexp_matches(substr(text, CAST(pos AS BIGINT) + length(head) + 1, 300), '^[ \\t]*\\.\\s*[0-9]')),
ru AS (SELECT *, trim({_ua("lower(regexp_extract(line, '(?i)^(art[ií]culo|article) [0-9]+ ?[.]? ?(.*)$', 2))")}, ' .;:-') AS rubric FROM hd),
isl AS (SELECT *, CASE WHEN number > 0 THEN number - dense_rank() OVER (PARTITION BY doc, number > 0 ORDER BY number) ELSE -1 END AS g FROM ru),
runs AS (SELECT doc, g, min(number) AS lo, max(number) AS hi FROM isl GROUP BY doc, g),
inv AS (SELECT doc, g, lo, hi FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY (lo = 1) DESC, hi - lo DESC, lo) AS r FROM runs) WHERE r = 1),
h AS (SELECT isl.*, row_number() OVER w AS r, first_value(rubric) OVER w AS ref, count(*) OVER (PARTITION BY isl.doc, number) AS n FROM isl JOIN inv ON inv.doc = isl.doc AND inv.g = isl.g WINDOW w AS (PARTITION BY isl.doc, number ORDER BY pos)),
c AS (SELECT *, r > 1 AND ref <> '' AND rubric <> '' AND (starts_with(ref, rubric) OR starts_with(rubric, ref)) AS fits FROM h),
per AS (SELECT doc, number, max(n) AS n, min(pos) FILTER (WHERE fits) AS fit, min(pos) AS first_pos, max(pos) AS last_pos FROM c GROUP BY doc, number),
modes AS (SELECT doc, count(*) FILTER (WHERE n >= 2) >= greatest(2, floor(count(*) * 0.6)) AND count(fit) >= greatest(2, floor(count(*) * 0.5)) AS toc, min(number) AS lo FROM per GROUP BY doc),
seq AS (
  SELECT p.doc, p.number, p.first_pos AS pos FROM per p JOIN modes ON modes.doc = p.doc AND p.number = lo AND NOT toc
  UNION ALL SELECT s.doc, p.number, (SELECT min(c.pos) FROM c WHERE c.doc = s.doc AND c.number = s.number + 1 AND c.pos > s.pos) FROM seq s JOIN per p ON p.doc = s.doc AND p.number = s.number + 1),
ch AS (
  SELECT p.doc, toc, p.number, CASE WHEN NOT toc THEN s.pos WHEN fit IS NOT NULL THEN fit WHEN n = 2 THEN last_pos END AS pos, lag(s.pos) OVER (PARTITION BY p.doc ORDER BY p.number) AS behind, p.number = lo AS opens
  FROM per p JOIN modes ON modes.doc = p.doc LEFT JOIN seq s ON s.doc = p.doc AND s.number = p.number),
fin AS (
  SELECT ch.doc, toc, ch.number, ch.pos, h.line, last_value(ch.pos IGNORE NULLS) OVER (PARTITION BY ch.doc ORDER BY ch.number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier, behind, opens
  FROM ch LEFT JOIN h ON h.doc = ch.doc AND h.number = ch.number AND h.pos = ch.pos),
chosen AS (
  SELECT doc, toc, number, pos, line, CASE WHEN pos <= earlier THEN 'OUT_OF_ORDER' WHEN pos IS NULL THEN CASE WHEN toc THEN 'NO_MATCH' WHEN behind IS NULL THEN 'PREVIOUS_MISSING' ELSE 'NONE_AFTER' END END AS error FROM fin)"""


def tg11_headings_with_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return hd.choose_headings(hd.find_headings(laws(docs)))


def tg12_article_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    texts = laws(docs)
    return hd.article_bodies(texts, hd.choose_headings(hd.find_headings(texts)))


QUERIES["tg11_headings_with_index"] = tg11_headings_with_index
ORACLE_SQL["tg11_headings_with_index"] = f"WITH RECURSIVE {_LAWS},{_HEADINGS}\nSELECT doc, toc, number, pos, line, error FROM chosen"
QUERIES["tg12_article_bodies"] = tg12_article_bodies
ORACLE_SQL["tg12_article_bodies"] = f"""WITH RECURSIVE {_LAWS},{_HEADINGS},
e AS (SELECT *, lead(pos) OVER w AS e, lead(number) OVER w IS NULL AS is_last FROM chosen WINDOW w AS (PARTITION BY doc ORDER BY number)),
b AS (SELECT e.*, trim(substr(text, pos + 1, greatest(0, CASE WHEN is_last THEN length(text) ELSE e END - pos)), ' ' || chr(10) || chr(9) || chr(13)) AS blk FROM e JOIN laws ON laws.doc = e.doc WHERE pos IS NOT NULL),
x AS (SELECT *, CASE WHEN NOT is_last AND e IS NULL THEN 'NEXT_MISSING' WHEN length(CASE WHEN instr(blk, chr(10)) > 0 THEN trim(regexp_replace(substr(blk, CAST(instr(blk, chr(10)) AS INT) + 1), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) ELSE '' END) < 20 THEN 'SHORT' END AS err FROM b)
SELECT doc, number, line AS title, CASE WHEN err IS NULL THEN blk END AS text, err AS error FROM x"""


#: Numbers of units as indexes write them; further ones are digits.
ROMAN = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X")
#: Scopes that every norm is asked for, and what they mean: articles named, articles excluded, units.
SCOPES = (
    ("Título I, Capítulo II", [], [], {"titulo": "1", "capitulo": "2"}),
    ("Artículos 1 al 5 (excepto los artículos 3 y 4)", ["1", "2", "3", "4", "5"], ["3", "4"], {}),
    ("Toda la norma, SALVO  artículo 2", [], ["2"], {}),
    ("CAPÍTULO SEGUNDO; Título Primero", [], [], {"titulo": "1", "capitulo": "2"}),
    ("artículos 2, 3 y 8 bis. Además, el Artículo 1", ["2", "3", "8 bis", "1"], [], {}),
    ("Libro primero > TÍTULO 2 > sección 1ª", [], [], {"libro": "1", "titulo": "2", "seccion": "1"}),
    ("Capítulo I; Capítulo III, salvo los artículos 7", [], ["7"], {"capitulo": "3"}),
    ("artículo 4.2", ["4.2"], [], {}),
)


def index_lines(documents: DataFrame) -> DataFrame:
    """``norm_id, pos, line``: a line of the document is an article; every ninth opens a title, every third a chapter, every sixth a section."""
    rows = documents.select("doc_id", F.posexplode(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")).alias("k", "x"))
    number = lambda n: F.when(n <= 10, F.get(F.array(*map(F.lit, ROMAN)), n - 1)).otherwise(n.cast("string"))
    k = F.col("k")
    lines = F.array(
        F.when((k == 0) & (F.col("doc_id") % 5 == 0), F.lit("LIBRO PRIMERO. De todo")),
        F.when(k % 9 == 0, F.concat(F.lit("TÍTULO "), number(F.floor(k / 9).cast("int") + 1))),
        F.when(k % 3 == 0, F.concat(F.lit("  Capítulo "), number(F.floor(k % 9 / 3).cast("int") + 1), F.lit(". Disposiciones"))),
        F.when(k % 6 == 0, F.lit("SECCIÓN 1.ª Otras")),
        F.concat(F.lit("Artículo "), (k + 1).cast("string"), F.when(k % 8 == 7, " bis").otherwise(""), F.lit(". "), F.col("x")),
    )
    return rows.select(F.col("doc_id").alias("norm_id"), "k", F.posexplode(lines).alias("j", "line")).filter("line is not null").select("norm_id", (F.col("k") * 5 + F.col("j")).alias("pos"), "line")


def scopes_of(documents: DataFrame) -> DataFrame:
    asked = F.array(*[F.lit(s[0]) for s in SCOPES])
    return documents.select(F.col("doc_id").alias("norm_id"), F.posexplode(asked).alias("k", "scope")).select((F.col("norm_id") * 10 + F.col("k")).alias("scope_id"), "norm_id", "scope")


def tg14_resolve_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return sc.resolve_scopes(sc.parse_index(index_lines(docs)), scopes_of(docs))


def _list(x: list[str]) -> str:
    return f"[{', '.join(repr(v) for v in x)}]::VARCHAR[]"


QUERIES["tg14_resolve_scopes"] = tg14_resolve_scopes
# paths by arithmetic and scopes by what they mean, so neither is parsed
ORACLE_SQL["tg14_resolve_scopes"] = f"""
WITH s(k, listed, excluded, libro, titulo, capitulo, seccion, asks) AS (VALUES {", ".join(f"({k}, {_list(a)}, {_list(x)}, {', '.join(repr(p[u]) if u in p else 'NULL' for u in ('libro', 'titulo', 'capitulo', 'seccion'))}, {bool(p)})" for k, (_, a, x, p) in enumerate(SCOPES))}),
l AS (SELECT doc_id, unnest(range(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')))) AS k FROM documents),
ix AS (
  SELECT doc_id, k, (k + 1) || CASE WHEN k % 8 = 7 THEN ' bis' ELSE '' END AS article, CASE WHEN doc_id % 5 = 0 THEN '1' END AS libro, CAST(k // 9 + 1 AS VARCHAR) AS titulo,
         CAST(k % 9 // 3 + 1 AS VARCHAR) AS capitulo, CASE WHEN k // 3 % 2 = 0 THEN '1' END AS seccion
  FROM l),
named AS (SELECT doc_id * 10 + s.k AS scope_id, doc_id, excluded, unnest(listed) AS article, unnest(range(1, len(listed) + 1)) AS nth FROM documents, s WHERE len(listed) > 0),
known AS (SELECT n.*, ix.k IS NULL AS gone, bool_or(ix.k IS NULL) OVER (PARTITION BY scope_id) AS broken FROM named n LEFT JOIN ix ON ix.doc_id = n.doc_id AND ix.article = n.article),
hit AS (
  SELECT ix.doc_id * 10 + s.k AS scope_id, article, ix.k FROM ix, s WHERE len(listed) = 0 AND NOT list_contains(excluded, article)
  AND coalesce(s.libro = ix.libro, s.libro IS NULL) AND coalesce(s.titulo = ix.titulo, s.titulo IS NULL) AND coalesce(s.capitulo = ix.capitulo, s.capitulo IS NULL) AND coalesce(s.seccion = ix.seccion, s.seccion IS NULL))
SELECT scope_id, CAST(nth AS INT) AS nth, article, CASE WHEN broken THEN 'MISSING' END AS error FROM known WHERE CASE WHEN broken THEN gone ELSE NOT list_contains(excluded, article) END
UNION ALL SELECT scope_id, CAST(row_number() OVER (PARTITION BY scope_id ORDER BY k) AS INT), article, NULL FROM hit
UNION ALL SELECT doc_id * 10 + s.k, 1, NULL, 'EMPTY' FROM documents, s WHERE asks AND doc_id * 10 + s.k NOT IN (SELECT scope_id FROM hit)"""
