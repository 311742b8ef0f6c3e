"""Item-bank tables derived from the raw tables, in SQL that Spark and the oracle share."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: Stems and explanations with what the text rules look for; ``#`` is a number that differs by row.
STEMS = (
    "Según la LEY ORGÁNICA #/2012, ARTÍCULO #.1, ¿qué?", "El Decreto #/2001 y la Ley #/2015 (artículos 5 y 6)", "¿Qué plazo hay? (TAG GVA #)", "¿Qué plazo hay (Dificultad alta)?", "Indique el plazo (o el que lo sustituya, 2019).",
    "Explicación. La C es la correcta", "SOLUCIÓN: OPCIÓN B (CORRECTA). Respuesta: la b.", "Respuesta correcta: A. Pero la respuesta correcta es la D, según otros", "Véase el art. #.2.b del Real Decreto Legislativo 5/2015",
    "Artículos 5 y 6 de la Ley #/2010: artículo 5, y 6 de la Ley 1/2000", "Según el PÁRRAFO ANTERIOR y las letras a y b del apartado 3", "Los citados artículos del Estatuto, disposición #", "EL ARTÍCULO # DE LA CONSTITUCIÓN ESPAÑOLA", "Artículo #, 7 de la Ley  39/2015",
)

#: In order: a view may use raw tables and views before it.
VIEWS: dict[str, str] = {
    "f_calls": "SELECT CAST(r_regionkey AS BIGINT) AS call_id, r_name AS code, r_regionkey <> 4 AS active FROM region",
    "f_parts": """SELECT c.call_id * 10 + p.o AS part_id, c.call_id, p.name, p.n_items, p.o AS part_order
        FROM f_calls c CROSS JOIN (VALUES (1, 'GENERAL', 20), (2, 'ESPECIAL', 30), (3, 'TECNICA', 10)) AS p(o, name, n_items)""",
    "f_topics": """SELECT c.call_id * 1000 + t.n AS topic_id, c.call_id, t.n AS number,
        CASE WHEN t.n > 20 THEN 'TECNICA' WHEN t.n <= 8 THEN 'GENERAL' ELSE 'ESPECIAL' END AS part,
        CASE WHEN t.n > 20 THEN 'INFORMATICA' ELSE 'JURIDICO' END AS content_type, concat('Topic ', CAST(t.n AS STRING)) AS title
        FROM f_calls c CROSS JOIN (SELECT DISTINCT CAST(substr(p_brand, 7) AS INT) AS n FROM part) t""",
    "f_norms": "SELECT s_suppkey AS norm_id, s_name AS canonical_name, lower(trim(s_name)) AS norm_key, concat('DOC-', CAST(s_suppkey AS STRING)) AS source_id FROM supplier",
    "f_refs": """SELECT (n.norm_id * 100 + a.n) * 10 + c.call_id AS ref_id, c.call_id, c.call_id * 1000 + 1 + (n.norm_id + a.n) % 20 AS topic_id,
        CASE WHEN a.n % 13 = 0 THEN NULL ELSE n.norm_id END AS norm_id, n.canonical_name AS norm_name,
        CASE WHEN a.n % 5 = 0 THEN concat('Art. ', CAST(a.n AS STRING), '.1') WHEN a.n % 7 = 0 THEN concat(CAST(a.n AS STRING), '-bis')
             WHEN a.n % 17 = 0 THEN 'anexo' ELSE CAST(a.n AS STRING) END AS article_asked,
        CASE WHEN a.n % 11 = 0 THEN 'PENDIENTE' ELSE 'COMPLETADO' END AS state
        FROM f_calls c CROSS JOIN f_norms n CROSS JOIN (SELECT DISTINCT p_partkey % 40 + 1 AS n FROM part) a WHERE (n.norm_id + a.n + c.call_id) % 3 <> 0""",
    "f_category_topics": "SELECT call_id, topic_id, concat('CAT_', CAST(number AS STRING)) AS category FROM f_topics WHERE content_type = 'INFORMATICA'",
    "f_items": """SELECT l_orderkey * 10 + l_linenumber AS item_id, CASE l_returnflag WHEN 'R' THEN 'INFORMATICA' ELSE 'JURIDICA' END AS kind,
        CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE l_suppkey END AS norm_id, CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE 'LEY' END AS norm_type_n,
        CASE WHEN l_partkey % 37 = 0 THEN '' ELSE concat('Norm ', CAST(l_suppkey AS STRING)) END AS norm_name_n,
        CASE WHEN l_orderkey % 7 = 0 THEN concat('Articulo ', CAST(l_partkey % 40 + 1 AS STRING), '.2')
             WHEN l_orderkey % 11 = 0 THEN concat(CAST(l_partkey % 40 + 1 AS STRING), ' bis') ELSE CAST(l_partkey % 40 + 1 AS STRING) END AS article_n,
        CASE l_returnflag WHEN 'R' THEN concat('CAT_', CAST(l_partkey % 30 AS STRING)) END AS category,
        CASE WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN 'PRACTICA' ELSE 'TEORICA' END AS theory_practice,
        CASE WHEN l_tax >= 0.08 THEN 'OBSOLETA_NORMA' WHEN l_tax >= 0.06 THEN 'NO_VERIFICABLE' ELSE 'VIGENTE' END AS validity,
        CASE l_linenumber WHEN 1 THEN 'apoyo' WHEN 2 THEN 'modelo' WHEN 3 THEN 'ia_generada' ELSE 'tests' END AS source_type,
        substr('ABCDX', 1 + CAST(l_quantity AS INT) % 5, 1) AS answer_key, CAST(l_orderkey AS BIGINT) AS import_id, l_linenumber AS page, CAST(l_quantity * 2 AS INT) AS score
        FROM lineitem""",
    "f_exclusions": """SELECT item_id, CASE WHEN item_id % 2 = 0 THEN 'ERROR_DEMOSTRADO' ELSE 'NO_DETERMINABLE' END AS class,
        CASE WHEN item_id % 4 = 0 THEN 'RETIRADA' ELSE 'CUARENTENA' END AS state FROM f_items WHERE item_id % 19 = 0""",
    "f_part_rules": """SELECT c.call_id, c.call_id * 10 + r.o AS part_id, r.priority, r.syllabus_part, r.content_type, r.theory_practice
        FROM f_calls c CROSS JOIN (VALUES (1, 10, 'GENERAL', 'JURIDICO', NULL), (2, 10, 'ESPECIAL', 'JURIDICO', 'TEORICA'), (2, 20, 'ESPECIAL', NULL, NULL),
        (3, 20, 'ESPECIAL', NULL, 'PRACTICA'), (3, 10, NULL, 'INFORMATICA', NULL)) AS r(o, priority, syllabus_part, content_type, theory_practice)""",
    "f_bank_links": """SELECT i.item_id * 10 + r.call_id AS link_id, r.call_id, i.item_id,
        CASE WHEN i.item_id % 23 = 0 THEN NULL ELSE r.call_id * 10 + 1 + i.item_id % 2 END AS part_id,
        CASE WHEN i.item_id % 29 = 0 THEN 'NO_JURIDICA' ELSE 'JURIDICA' END AS link_type,
        CASE WHEN i.item_id % 19 = 0 AND i.item_id % 3 <> 0 THEN 'REVISION' ELSE 'INCLUIDA' END AS state,
        min(r.topic_id) + CASE WHEN i.item_id % 13 = 0 THEN 1 ELSE 0 END AS topic_id
        FROM f_items i JOIN f_refs r ON r.norm_id = i.norm_id AND r.article_asked = i.article_n
        WHERE i.item_id % 3 <> 1 AND i.kind = 'JURIDICA' GROUP BY i.item_id, r.call_id""",
    # calls 0 and 3 are clean, 3 admits no practical questions; 1 has invalid references, 2 and 4 incidents among their links
    "f_gate_items": "SELECT * FROM f_items WHERE item_id IN (SELECT item_id FROM f_items GROUP BY item_id HAVING count(*) = 1)",
    "f_gate_refs": "SELECT * FROM f_refs WHERE call_id = 1 OR norm_id IS NOT NULL AND article_asked <> 'anexo'",
    "f_gate_rules": "SELECT * FROM f_part_rules WHERE NOT (call_id = 3 AND coalesce(theory_practice, '') = 'PRACTICA')",
    "f_gate_links": """SELECT b.link_id, b.call_id, b.item_id, b.part_id, b.link_type, b.state, b.topic_id FROM f_bank_links b JOIN f_gate_items i ON i.item_id = b.item_id
        WHERE b.call_id IN (1, 2) OR b.part_id IS NOT NULL AND b.link_type = 'JURIDICA' AND NOT (b.call_id = 3 AND i.theory_practice = 'PRACTICA')
        UNION ALL SELECT link_id + 5, call_id, item_id, part_id, link_type, state, topic_id FROM f_bank_links WHERE call_id = 4 AND part_id IS NOT NULL AND link_type = 'JURIDICA' AND item_id % 101 = 0""",
    "f_blueprint": """SELECT p.part_id, b.o AS block_order, b.block_type, CASE WHEN b.block_type = 'NORMA' THEN 1 + (p.part_id + b.o) % 10 END AS norm_id, b.amount
        FROM f_parts p CROSS JOIN (VALUES (1, 'NORMA', 8), (2, 'NORMA', 7), (3, 'LIBRE', 5)) AS b(o, block_type, amount) WHERE p.name <> 'TECNICA'""",
    "f_articles": """SELECT doc_id AS article_id, concat('DOC-', CAST(1 + doc_id % 10 AS STRING)) AS source_id, 1 + doc_id % 10 AS norm_id,
        CAST(1 + floor(doc_id / 10) % 40 AS INT) AS article_no, lang, text, SHA256(text) AS text_hash FROM documents""",
    "f_text_items": """SELECT doc_id AS item_id, substr(text, 1, 120) AS stem, substr(text, 121, 40) AS opt_a, substr(text, 161, 40) AS opt_b,
        substr(text, 201, 40) AS opt_c, substr(text, 241) AS opt_d, substr('ABCD', CAST(1 + doc_id % 4 AS INT), 1) AS answer_key, source AS source_type, lang FROM documents""",
    "f_fragments": "SELECT conv_id AS doc, turn AS frag, CASE WHEN role = 'user' THEN turn END AS visible_number, role <> 'user' AS is_continuation, text FROM conversations",
    # every third turn opens an item; what follows repeats, extends or contradicts it
    "f_page_fragments": """SELECT conv_id AS doc, CAST(turn AS BIGINT) AS frag, CAST(floor(turn / 2) AS INT) AS page, CASE WHEN turn % 3 = 0 AND NOT (conv_id % 10 = 9 AND turn = 0) THEN CAST(1 + CAST(floor(turn / 3) AS INT) AS STRING) END AS number,
        turn % 3 <> 0 AND (conv_id + turn) % 11 <> 0 OR conv_id % 10 = 9 AS continues,
        CASE WHEN turn % 3 = 0 THEN substr(m, 1, 50 + conv_id % 30) WHEN (conv_id + turn) % 3 = 0 THEN substr(m, 5, 20) WHEN (conv_id + turn) % 3 = 1 THEN substr(m, 1, 100) ELSE text END AS stem,
        CASE WHEN turn % 3 = 2 THEN substr(m, 10, 40) ELSE substr(m, 10, 15) END AS opt_a, CASE WHEN turn % 3 = 1 THEN substr(text, 20) ELSE substr(m, 30, 15) END AS opt_b,
        CASE WHEN turn % 3 = 0 THEN '' ELSE substr(m, 50 + turn, 12) END AS opt_c, CASE WHEN turn % 2 = 0 THEN substr(m, 80, 9) END AS opt_d, CASE WHEN turn % 5 = 4 THEN concat(' Hoja  ', CAST(turn AS STRING)) END AS footer,
        CASE WHEN (conv_id * 7 + turn) % 13 = 0 THEN 'E' WHEN (conv_id + turn) % 4 = 1 THEN substr('abcd', 1 + CAST(conv_id % 4 AS INT), 1) WHEN (conv_id + turn) % 9 = 4 THEN ' B ' END AS answer,
        CASE WHEN (conv_id + turn) % 17 = 3 THEN 'VARIA' WHEN turn % 2 = 0 THEN 'juridica' END AS kind, CASE WHEN turn % 3 <> 1 THEN 'LEY' WHEN conv_id % 6 = 5 THEN 'DECRETO' END AS norm_type,
        CASE WHEN turn % 3 = 2 THEN concat('Ley ', CAST(conv_id % 7 AS STRING)) END AS norm_name, CAST(turn - turn % 3 + CASE WHEN conv_id % 8 = 7 AND turn % 3 = 2 THEN 1 ELSE 0 END AS STRING) AS article, CAST(NULL AS STRING) AS topic
        FROM (SELECT *, max(text) OVER (PARTITION BY conv_id) AS m FROM conversations) v""",
    # files of items: 17 known imports (some failed, some without rows) and a batch that brings some again, moved, changed or new
    "f_intake_log": """SELECT concat('i', CAST(k AS STRING)) AS import_id, concat('file-', CAST(k AS STRING)) AS file, concat('old-', CAST(k AS STRING)) AS file_hash, CASE WHEN k % 5 = 0 THEN 'ERROR' ELSE 'COMPLETED' END AS state,
        CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS duplicates, CAST(NULL AS STRING) AS error, CASE WHEN k % 10 <> 0 THEN 'b0' END AS data, CAST(1 AS BIGINT) AS version FROM (SELECT DISTINCT doc_id % 17 AS k FROM documents) x""",
    "f_intake_pool": "SELECT concat('i', CAST(doc_id % 17 AS STRING)) AS import_id, CASE WHEN doc_id % 4 = 3 THEN 'b-1' ELSE 'b0' END AS batch, concat('file-', CAST(doc_id % 17 AS STRING)) AS file, concat('old-', CAST(doc_id % 17 AS STRING)) AS file_hash, doc_id AS row_id, SHA256(text) AS content_key FROM documents WHERE doc_id % 3 = 0",
    "f_intake_links": "SELECT row_id FROM f_intake_pool WHERE import_id IN ('i1', 'i7', 'i12') AND row_id % 2 = 0",
    "f_intake_batch": """SELECT concat(CASE WHEN k % 7 = 6 THEN 'moved-' ELSE 'file-' END, CAST(k AS STRING)) AS file, concat(CASE WHEN k % 3 = 0 AND k < 17 THEN 'old-' ELSE 'new-' END, CAST(k AS STRING)) AS file_hash, doc_id + 1000000 AS row_id, SHA256(text) AS content_key
        FROM (SELECT doc_id, text, doc_id % 23 AS k FROM documents) d WHERE k NOT IN (14, 15)""",
    "f_intake_failed": "SELECT concat('file-', CAST(k AS STRING)) AS file, concat('bad-', CAST(k AS STRING)) AS file_hash, 'page 3 unreadable' AS error FROM (SELECT DISTINCT doc_id % 17 + 14 AS k FROM documents) x WHERE k IN (14, 15, 30)",
    "f_stems": f"""SELECT l_orderkey * 10 + l_linenumber AS item_id, l_partkey % {len(STEMS)} AS kind, l_suppkey AS number, CASE l_partkey % {len(STEMS)} {" ".join(f"WHEN {k} THEN replace('{x}', '#', CAST(l_suppkey AS STRING))" for k, x in enumerate(STEMS))} END AS stem FROM lineitem""",
    "f_cost_log": "SELECT event_id, user_id AS session_id, ts, event_type AS operation, CAST(round(value, 2) AS DECIMAL(18,2)) AS cost FROM events",
    "f_answers": """SELECT item_id, answer_key AS stored, substr('ABCD?', CAST(1 + item_id % 5 AS INT), 1) AS p1, CASE WHEN item_id % 7 = 0 THEN 'N' ELSE 'S' END AS p1_about,
        CASE WHEN item_id % 3 = 0 THEN NULL ELSE substr('ABCD?', CAST(1 + item_id % 4 AS INT), 1) END AS p2,
        CASE WHEN item_id % 9 = 0 THEN 'N' ELSE 'S' END AS p2_about, item_id % 2 = 0 AS quote_ok FROM f_items WHERE kind = 'JURIDICA'""",
    # citations, references and stems spelt in many ways, one for each line of an order
    "f_citations": """SELECT l_orderkey * 10 + l_linenumber AS item_id,
        CASE l_linenumber WHEN 1 THEN concat('Ley  Orgánica ', CAST(l_partkey % 60 + 1 AS STRING), '/', CAST(1980 + l_suppkey % 40 AS STRING), ', de ', CAST(1 + l_partkey % 28 AS STRING), ' de mayo')
            WHEN 2 THEN concat('Real Decreto Legislativo ', CAST(l_partkey % 9 + 1 AS STRING), '/', CAST(2010 + l_suppkey % 10 AS STRING))
            WHEN 3 THEN concat('Decreto-Ley ', CAST(l_partkey % 30 + 1 AS STRING), ' / ', CAST(1990 + l_suppkey % 30 AS STRING), ', de 03 de setiembre de 2001, que cita la Ley 2/2012')
            WHEN 4 THEN concat('Directiva (UE) ', CAST(1995 + l_suppkey % 25 AS STRING), '/', CAST(l_partkey AS STRING)) WHEN 5 THEN 'Constitución_Española de 1978'
            WHEN 6 THEN 'TFUE' ELSE concat('«Estatuto de los  Trabajadores»', CASE WHEN l_partkey % 2 = 0 THEN ' ' ELSE '' END) END AS name,
        CASE l_partkey % 8 WHEN 0 THEN concat('Artículo ', CAST(l_suppkey AS STRING), '.2') WHEN 1 THEN concat('Art. ', CAST(l_suppkey AS STRING), '-bis') WHEN 2 THEN concat('00', CAST(l_suppkey AS STRING))
            WHEN 3 THEN 'anexo' WHEN 4 THEN concat(CAST(l_suppkey AS STRING), ',1.18') WHEN 5 THEN concat('art ', CAST(l_suppkey AS STRING), ' ter') WHEN 6 THEN NULL ELSE concat('ley 4/2015, art. ', CAST(l_suppkey AS STRING), '.1.b') END AS article,
        CASE l_suppkey % 9 WHEN 0 THEN concat('¿Cuál es el plazo, conforme a la Ley ', CAST(l_partkey % 60 + 1 AS STRING), '/', CAST(l_partkey % 100 AS STRING), '? (Ayuntamiento de Alba, OPE 2019)')
            WHEN 1 THEN concat('Un ciudadano solicita una licencia el 3 de mayo de 2020 y paga ', CAST(l_partkey % 90 AS STRING), ' euros.') WHEN 2 THEN 'Señale la respuesta INCORRECTA según el artículo anterior del apartado 2:'
            WHEN 3 THEN concat('Respuesta correcta: ', substr('ABCD', CAST(1 + l_partkey % 4 AS INT), 1), '. El artículo ', CAST(l_partkey % 50 AS STRING), ' de la Ley 39/2015 lo dice; solución ', substr('ABCD', CAST(1 + l_orderkey % 4 AS INT), 1))
            WHEN 4 THEN 'En el supuesto de que la persona interesada no comparezca, deberá  archivarse (señale la falsa).' WHEN 5 THEN concat('El artículo ', CAST(l_partkey % 50 AS STRING), '.1 de la Ley 40/2015 y el Real Decreto 203/2021')
            WHEN 6 THEN concat('Derogado. Publicado en: BOE núm. ', CAST(l_partkey AS STRING)) WHEN 7 THEN 'La Consti' || chr(173) || 'tución es nor-' || chr(10) || ' ma suprema [examen tipo 2018] excepto' ELSE 'Conforme  a la ley, indique la respuesta correcta' END AS stem
        FROM lineitem""",
}

#: Views of one small file that others multiply by a few hundred rows, and the key by which they are dealt before: else one task makes all of those rows.
SPREAD = {"f_norms": "norm_id"}

_NAMES = re.compile(r"\bf_[a-z_]+\b")


def _needed(names: set[str]) -> list[str]:
    todo, found = list(names), set()
    while todo:
        n = todo.pop()
        if n not in found:
            found.add(n)
            todo += [x for x in _NAMES.findall(VIEWS[n]) if x in VIEWS]
    return [n for n in VIEWS if n in found]


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Frames of raw tables and derived views, without registering anything.

    Each frame is planned on its own from the parquet files, so Catalyst prunes and pushes down through it.
    """
    order = _needed({n for n in names if n in VIEWS})
    raw = {n for n in names if n in RAW} | {t for n in order for t in RAW if re.search(rf"\b{t}\b", VIEWS[n])}
    got = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in raw}
    for n in order:
        body = re.sub(r"\bSHA256\((\w+)\)", r"sha2(\1, 256)", VIEWS[n])
        used = {u: got[u] for u in got if re.search(rf"(FROM|JOIN)\s+{u}\b", body)}
        body = re.sub(r"(FROM|JOIN)\s+(\w+)\b", lambda m, used=used: f"{m[1]} {{{m[2]}}}" if m[2] in used else m[0], body)
        got[n] = spark.sql(body, **used)
        if n in SPREAD:
            got[n] = got[n].repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), SPREAD[n])
    return [got[n] for n in names]


def with_views(sql: str) -> str:
    """The oracle's SQL with the views that it names as common table expressions."""
    order = _needed({n for n in _NAMES.findall(sql) if n in VIEWS})
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order)
    if not ctes:
        return sql
    body = sql.lstrip()
    deep = "RECURSIVE " if body[:15].upper() == "WITH RECURSIVE " else ""
    if deep:
        body = f"WITH {body[15:]}"
    return f"WITH {deep}{ctes},\n{body[5:]}" if body[:5].upper() == "WITH " else f"WITH {ctes}\n{body}"
