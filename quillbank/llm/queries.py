"""The queries of the operators of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank.llm import decontaminate, infill, languages, lines, merkle, mixing, neighbours, pages, privacy, quality, simhash, suffixes, urls


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: The contract's rules.
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = _read(spark, sf_dir, "pages")
    # the number in a page's path is the id of the document that it was made of, which may be labelled
    number = F.regexp_extract(urls.url_parts(F.col("url"))[1], r"([0-9]{1,18})[^/0-9]*/?$", 1)
    numbered = every.select("page_id", F.when(number != "", number.cast("long")).alias("doc_id"))
    labels = numbered.join(_read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id").select("page_id", (1 - F.col("quality")).alias("bad"))
    found = urls.judge_urls(every, labels, RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "template", "bad_share")


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = _read(spark, sf_dir, "embeddings")
    return neighbours.nearest(every, every.filter("vec_id % 50 = 0"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract_articles(_read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"), shingle=3, threshold=3)
    return found.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(_read(spark, sf_dir, "documents"))
    return cut.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def _of(kind: int):
    return lambda s: s["kind"] == kind


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.find_personal_data(_read(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(privacy.KINDS[:4])]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(privacy.written(F.col("base")).cast("binary"), 256).alias("base_sha256"), privacy.written(F.col("spans")).alias("spans"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(_read(spark, sf_dir, "documents"))
    return cut.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_read(spark, sf_dir, "documents"))
    return mixed.withColumnRenamed("id", "doc_id")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = languages.identify(_read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, 1)
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars").cast("decimal(38,0)") + 1, F.col("text")]
    found = merkle.manifest(docs, keep={"claim": F.when(changed == 1, merkle.leaf(*fields))})
    folded = found.withColumn("folded_root", merkle.fold(F.coalesce("claim", "leaf"), F.col("path")))
    return folded.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.fill_in_middle(infill.store(_read(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_nearest_neighbours, op3_simhash_near_dedup, op4_line_dedup, op5_personal_data, op6_suffix_array_dedup, op7_source_mixing,
    op8_benchmark_decontamination, op9_quality_classifier, op10_html_extraction, op11_language_id, op12_merkle_manifest, op13_fill_in_middle,
)}

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def _field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


ORACLE_SQL = {
    "op4_line_dedup": f"""
WITH l AS (
  SELECT doc_id, unnest(range(len(string_split(t, chr(10))))) AS pos, unnest(string_split(t, chr(10))) AS line
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
), k AS (SELECT doc_id, pos, line, translate(trim(line, {_SPACE}), {_UPPER}, {_LOWER}) AS key FROM l),
c AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id < c.keep AS lost FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op8_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, w[s:s + least(13, len(w)) - 1] AS g FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM b WHERE len(w) > 0)),
n AS (SELECT DISTINCT len(g) AS n FROM bw),
dw AS (SELECT doc_id, s, n, w[s:s + n - 1] AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, n WHERE len(w) >= n)),
h AS (SELECT doc_id, s, n, item_id FROM dw JOIN bw ON dw.g = bw.g),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN i ON d.doc_id = i.doc_id""",
    # leaves; nodes of each tree level by level; steps of each leaf, first to its subroot, then to the root; the fold
    "op12_merkle_manifest": f"""
WITH RECURSIVE crc AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS crc
  FROM documents),
base AS (
  SELECT d.doc_id, lang, sha256(f1 || f2 || f3 || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || f5) AS leaf,
         sha256(f1 || f2 || f3 || coalesce(strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1), '-') || f5) AS claim, crc % 7 = 0 AS changed
  FROM (SELECT *, {_field("doc_id")} AS f1, {_field("source")} AS f2, {_field("lang")} AS f3, {_field("text")} AS f5 FROM documents) d LEFT JOIN crc ON crc.doc_id = d.doc_id),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM base),
t AS (
  SELECT lang, 0 AS lvl, pos, leaf AS h, n FROM leaves
  UNION ALL SELECT lang, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), n FROM t WHERE n > 1::BIGINT << lvl GROUP BY lang, lvl, pos // 2, n),
sub AS (SELECT lang, h AS subroot, lvl AS depth, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n <= 1::BIGINT << lvl),
u AS (
  SELECT 0 AS lvl, pos, subroot AS h, n FROM sub
  UNION ALL SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), n FROM u WHERE n > 1::BIGINT << lvl GROUP BY lvl, pos // 2, n),
steps AS (
  SELECT l.doc_id, l.leaf, l.pos, l.lang, t.lvl, (l.pos >> t.lvl) & 1 AS side, o.h FROM leaves l JOIN t ON t.lang IS NOT DISTINCT FROM l.lang AND t.pos = l.pos >> t.lvl AND l.n > 1::BIGINT << t.lvl
  LEFT JOIN t o ON o.lang IS NOT DISTINCT FROM t.lang AND o.lvl = t.lvl AND o.pos = xor(t.pos, 1)
  UNION ALL
  SELECT l.doc_id, l.leaf, l.pos, l.lang, s.depth + u.lvl, (s.pos >> u.lvl) & 1, o.h FROM leaves l JOIN sub s ON s.lang IS NOT DISTINCT FROM l.lang JOIN u ON u.pos = s.pos >> u.lvl AND s.n > 1::BIGINT << u.lvl
  LEFT JOIN u o ON o.lvl = u.lvl AND o.pos = xor(u.pos, 1)),
proof AS (SELECT lang, pos, sha256(coalesce(string_agg(h, '' ORDER BY lvl), '')) AS proof_sha256, count(*) AS depth FROM steps GROUP BY lang, pos),
fold AS (
  SELECT lang, pos, 0 AS lvl, CASE WHEN changed THEN claim ELSE leaf END AS h FROM leaves
  UNION ALL SELECT f.lang, f.pos, f.lvl + 1, sha256(CASE WHEN s.side = 1 THEN coalesce(s.h, '') || f.h ELSE f.h || coalesce(s.h, '') END) FROM fold f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.pos = f.pos AND s.lvl = f.lvl),
top AS (SELECT h AS root FROM u WHERE n <= 1::BIGINT << lvl)
SELECT l.doc_id, l.leaf, s.subroot, root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM leaves l JOIN sub s ON s.lang IS NOT DISTINCT FROM l.lang CROSS JOIN top LEFT JOIN proof p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos
JOIN fold f ON f.lang IS NOT DISTINCT FROM l.lang AND f.pos = l.pos AND f.lvl = coalesce(p.depth, 0)""",
    "op13_fill_in_middle": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:least(a, b)], '') AS pre, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS mid, array_to_string(u[greatest(a, b) + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(pre || mid || suf) AS restored_sha256
FROM p""",
}
