"""Queries of filters (FL), links (LK) and the bank plan (CH-06, CH-07), each with its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillbank.operators import linking as lk
from quillbank.plans.fixtures import tables, with_views
from quillbank.plans.text_queries import _article_base_sql, _full

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def register(name: str, views: str, build, sql: str | None) -> None:
    """A query over the named tables and views, and its oracle's SQL."""
    QUERIES[name] = lambda spark, sf_dir: build(*tables(spark, sf_dir, *views.split()))
    if sql is not None:
        ORACLE_SQL[name] = with_views(sql)


def _base(x: str) -> str:
    return _article_base_sql.replace("coalesce(article,", f"coalesce({x},")


def _fullsql(x: str) -> str:
    f = _full.replace("coalesce(article,", f"coalesce({x},")
    return f"CASE WHEN regexp_matches({f}, '^[0-9]+( (bis|ter|quater|quinquies))?(\\.[0-9a-z]+)*$') THEN {f} END"


_missing = """concat_ws(',', CASE WHEN trim(coalesce(norm_type_n, '')) = '' THEN 'norm_type' END, CASE WHEN trim(coalesce(norm_name_n, '')) = '' THEN 'norm_name' END,
 CASE WHEN norm_id IS NULL THEN 'norm_id' END, CASE WHEN trim(coalesce(article_n, '')) = '' THEN 'article' END)"""
#: Shared steps of the oracles.
ELIGIBLE = f"""e AS (SELECT i.*, {_base('article_n')} AS base, CASE WHEN EXISTS (SELECT 1 FROM f_exclusions x WHERE x.item_id = i.item_id AND x.state IN ('CUARENTENA', 'RETIRADA')) THEN 'EXCLUDED' WHEN validity LIKE 'OBSOLETA%' THEN 'OBSOLETE'
 WHEN {_missing} <> '' THEN 'INCOMPLETE:' || {_missing} WHEN {_base('article_n')} IS NULL THEN 'ARTICLE' END AS reason FROM f_items i WHERE kind = 'JURIDICA')"""
LOCATED = f"l AS (SELECT r.*, t.part, t.number, t.title, t.content_type, {_base('r.article_asked')} AS base, {_fullsql('r.article_asked')} AS fullref FROM f_refs r JOIN f_topics t ON t.topic_id = r.topic_id)"
INDEX = "ix AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY call_id, norm_id, base ORDER BY article_asked, part, number, ref_id) AS rn FROM l WHERE norm_id IS NOT NULL AND base IS NOT NULL) WHERE rn = 1)"
MATCHED = """m AS (SELECT ix.call_id, e.item_id, ix.topic_id, ix.part, ix.content_type, e.theory_practice,
 CASE WHEN e.theory_practice = 'PRACTICA' AND NOT EXISTS (SELECT 1 FROM f_part_rules p WHERE p.call_id = ix.call_id AND upper(p.theory_practice) = 'PRACTICA') THEN 'PRACTICE_NOT_ADMITTED'
 WHEN b.item_id IS NOT NULL THEN 'EXISTING' ELSE 'NEW' END AS outcome
 FROM e JOIN ix ON ix.norm_id = e.norm_id AND ix.base = e.base LEFT JOIN (SELECT DISTINCT call_id, item_id FROM f_bank_links) b ON b.call_id = ix.call_id AND b.item_id = e.item_id WHERE e.reason IS NULL)"""
TOPIC = f"""ti AS (SELECT item_id, norm_id, {_base('article_n')} AS base, {_fullsql('article_n')} AS fullref FROM f_items WHERE norm_id IS NOT NULL),
tc AS (SELECT l.call_id, ti.item_id, min(l.topic_id) AS lo, max(l.topic_id) AS hi, min(CASE WHEN l.fullref = ti.fullref THEN l.topic_id END) AS elo, max(CASE WHEN l.fullref = ti.fullref THEN l.topic_id END) AS ehi
 FROM ti JOIN l ON l.norm_id = ti.norm_id AND l.base = ti.base GROUP BY l.call_id, ti.item_id),
rt AS (SELECT call_id, item_id, CASE WHEN lo = hi THEN lo WHEN elo = ehi THEN elo END AS topic_id FROM tc)"""


def _parts(name: str, rows: str) -> str:
    """Part of each row of ``rows`` by the wildcard rules."""
    return f"""{name}_c AS (SELECT q.*, r.part_id AS rule_part, r.priority, min(r.priority) OVER (PARTITION BY q.call_id, q.part, q.content_type, q.theory_practice) AS least FROM (SELECT DISTINCT call_id, part, content_type, theory_practice FROM {rows}) q
 JOIN f_part_rules r ON r.call_id = q.call_id AND (r.syllabus_part IS NULL OR upper(r.syllabus_part) = upper(q.part)) AND (r.content_type IS NULL OR upper(r.content_type) = upper(q.content_type)) AND (r.theory_practice IS NULL OR upper(r.theory_practice) = upper(coalesce(q.theory_practice, '')))),
{name}_d AS (SELECT call_id, part, content_type, theory_practice, min(rule_part) AS lo, max(rule_part) AS hi FROM {name}_c WHERE priority = least GROUP BY ALL),
{name} AS (SELECT x.*, CASE WHEN d.lo = d.hi THEN d.lo END AS new_part, CASE WHEN d.lo IS NULL THEN 'NO_RULE' WHEN d.lo <> d.hi THEN 'AMBIGUOUS' END AS part_reason
 FROM {rows} x LEFT JOIN {name}_d d ON d.call_id = x.call_id AND d.part IS NOT DISTINCT FROM x.part AND d.content_type IS NOT DISTINCT FROM x.content_type AND d.theory_practice IS NOT DISTINCT FROM x.theory_practice)"""


MOVED = """mv0 AS (SELECT b.link_id, b.call_id, b.item_id, b.topic_id AS old_topic, rt.topic_id, t.part, t.content_type, i.theory_practice FROM f_bank_links b JOIN rt ON rt.call_id = b.call_id AND rt.item_id = b.item_id
 JOIN f_topics t ON t.topic_id = rt.topic_id JOIN f_items i ON i.item_id = b.item_id WHERE b.link_type = 'JURIDICA' AND b.topic_id <> rt.topic_id)"""
RETIRED = """re AS (SELECT * FROM (SELECT b.link_id, b.call_id, b.item_id, coalesce(e.reason, CASE WHEN NOT EXISTS (SELECT 1 FROM l WHERE l.call_id = b.call_id AND l.norm_id = e.norm_id AND l.base = e.base) THEN 'OUT_OF_SYLLABUS' END) AS reason
 FROM f_bank_links b LEFT JOIN e ON e.item_id = b.item_id WHERE b.link_type = 'JURIDICA' AND b.state = 'INCLUIDA') WHERE reason IS NOT NULL)"""
OTHER = """nc AS (SELECT c.call_id, i.item_id, c.topic_id, t.part, t.content_type, i.theory_practice,
 CASE WHEN trim(coalesce(i.category, '')) = '' THEN 'INCOMPLETE' WHEN c.topic_id IS NULL THEN 'OUTSIDE' WHEN EXISTS (SELECT 1 FROM f_bank_links b WHERE b.call_id = c.call_id AND b.item_id = i.item_id) THEN 'EXISTING' ELSE 'NEW' END AS outcome
 FROM f_items i LEFT JOIN (SELECT call_id, upper(trim(category)) AS category, min(topic_id) AS topic_id FROM f_category_topics GROUP BY ALL HAVING count(DISTINCT topic_id) = 1) c ON c.category = upper(trim(i.category))
 LEFT JOIN f_topics t ON t.topic_id = c.topic_id WHERE i.kind = 'INFORMATICA' AND i.item_id NOT IN (SELECT item_id FROM f_exclusions WHERE state IN ('CUARENTENA', 'RETIRADA')))"""
PLAN = f"""WITH {ELIGIBLE}, {LOCATED}, {INDEX}, {MATCHED}, {TOPIC}, {OTHER}, nw AS (SELECT call_id, item_id, topic_id, part, content_type, theory_practice, 'JURIDICA' AS link_type FROM m WHERE outcome = 'NEW'
 UNION ALL SELECT call_id, item_id, topic_id, part, content_type, theory_practice, 'NO_JURIDICA' FROM nc WHERE outcome = 'NEW'), {_parts('np', 'nw')}, {MOVED}, {_parts('mv', 'mv0')}, {RETIRED},
pl AS (SELECT call_id, item_id, CASE WHEN new_part IS NULL THEN 'BLOCKED' ELSE 'ADD' END AS action, topic_id, new_part AS part_id, part_reason AS reason, link_type FROM np
 UNION ALL SELECT call_id, item_id, 'REASSIGN', topic_id, new_part, NULL, 'JURIDICA' FROM mv WHERE part_reason IS NULL AND link_id NOT IN (SELECT link_id FROM re)
 UNION ALL SELECT call_id, item_id, 'RETIRE', NULL, NULL, reason, 'JURIDICA' FROM re)"""
_plan_views = "f_items f_exclusions f_refs f_topics f_part_rules f_bank_links"
_bank_views = f"{_plan_views} f_category_topics"

register("fl01_eligible_items", "f_items f_exclusions", lambda i, x: lk.eligible_items(i, x).select("item_id", "reason"), f"WITH {ELIGIBLE} SELECT item_id, reason FROM e")
register("fl02_completeness_reason", "f_items", lambda i: i.select("item_id", lk.completeness_reason(F.col("norm_type_n"), F.col("norm_name_n"), F.col("norm_id"), F.col("article_n")).alias("missing")).filter("missing <> ''"), f"SELECT item_id, {_missing} AS missing FROM f_items WHERE {_missing} <> ''")
register("fl03_call_allows_practice", "f_part_rules", lk.calls_with_practice, "SELECT DISTINCT call_id FROM f_part_rules WHERE upper(theory_practice) = 'PRACTICA'")
register("lk03_ref_index_first", "f_refs f_topics", lambda r, t: lk.ref_index(lk.located_refs(r, t)).select("call_id", "norm_id", "base", "topic_id"), f"WITH {LOCATED}, {INDEX} SELECT call_id, norm_id, base, topic_id FROM ix")
register("lk03_ref_index_unambiguous", "f_refs f_topics", lambda r, t: lk.ref_index(lk.located_refs(r, t), "unambiguous"), f"WITH {LOCATED} SELECT call_id, norm_id, base, min(topic_id) AS topic_id FROM l WHERE norm_id IS NOT NULL AND base IS NOT NULL GROUP BY ALL HAVING count(DISTINCT topic_id) = 1")
register("lk03_invalid_refs", "f_refs f_topics", lambda r, t: lk.invalid_refs(lk.located_refs(r, t)), f"WITH {LOCATED} SELECT ref_id, call_id, CASE WHEN norm_id IS NULL THEN 'NORM_NULL' ELSE 'ARTICLE' END AS reason FROM l WHERE norm_id IS NULL OR base IS NULL")
_shared = "SELECT ref_id, call_id, topic_id, norm_id, norm_name, article_asked FROM f_refs UNION ALL SELECT ref_id + 1000000, call_id, call_id * 1000 + 1 + (topic_id + 3) % 20, norm_id, norm_name, article_asked FROM f_refs WHERE ref_id % 5 = 0"
_more_refs = lambda r: r.select("ref_id", "call_id", "topic_id", "norm_id", "norm_name", "article_asked").union(r.filter("ref_id % 5 = 0").selectExpr("ref_id + 1000000", "call_id", "call_id * 1000 + 1 + (topic_id + 3) % 20", "norm_id", "norm_name", "article_asked"))
register("lk03_repeated_refs", "f_refs f_topics", lambda r, t: lk.repeated_refs(lk.located_refs(_more_refs(r), t)), f"WITH r2 AS ({_shared}), {LOCATED.replace('FROM f_refs r', 'FROM r2 r')} SELECT call_id, norm_id, fullref AS \"full\", array_to_string(list_sort(list(DISTINCT topic_id)), ',') AS topics FROM l WHERE norm_id IS NOT NULL AND base IS NOT NULL AND fullref IS NOT NULL GROUP BY ALL HAVING count(DISTINCT topic_id) > 1")
register("lk04_category_index", "f_category_topics", lambda c: lk.category_index(c.union(c.filter("topic_id % 3 = 0").selectExpr("call_id", "topic_id - 1", "category"))), "WITH c AS (SELECT * FROM f_category_topics UNION ALL SELECT call_id, topic_id - 1, category FROM f_category_topics WHERE topic_id % 3 = 0) SELECT call_id, upper(category) AS category, CASE WHEN count(DISTINCT topic_id) = 1 THEN min(topic_id) END AS topic_id, CASE WHEN count(DISTINCT topic_id) > 1 THEN 'SEVERAL' END AS reason FROM c GROUP BY call_id, category")
register("lk05_match_items", _plan_views, lambda i, x, r, t, p, b: lk.match_items(i, x, lk.ref_index(lk.located_refs(r, t)), b, p).select("call_id", "item_id", "topic_id", "outcome"), f"WITH {ELIGIBLE}, {LOCATED}, {INDEX}, {MATCHED} SELECT call_id, item_id, topic_id, outcome FROM m")
register("lk06_resolve_topic", "f_items f_refs f_topics", lambda i, r, t: lk.resolve_topic(i, lk.located_refs(_more_refs(r), t)), f"WITH r2 AS ({_shared}), {LOCATED.replace('FROM f_refs r', 'FROM r2 r')}, {TOPIC} SELECT call_id, item_id, topic_id, CASE WHEN topic_id IS NULL THEN 'AMBIGUOUS' END AS reason FROM rt")
_t_rows = "SELECT t.call_id, t.topic_id, t.part, t.content_type, p.tp AS theory_practice FROM f_topics t CROSS JOIN (VALUES ('TEORICA'), ('PRACTICA'), (NULL)) AS p(tp)"
register("lk07_resolve_part", "f_topics f_part_rules", lambda t, p: lk.resolve_part(t.select("call_id", "topic_id", "part", "content_type", F.explode(F.array(F.lit("TEORICA"), F.lit("PRACTICA"), F.lit(None))).alias("theory_practice")), p, ["topic_id", "theory_practice"]), f"WITH tr AS ({_t_rows}), {_parts('w', 'tr')} SELECT topic_id, theory_practice, new_part AS part_id, part_reason FROM w")
register("lk08_reassignable_links", _plan_views, lambda i, x, r, t, p, b: lk.reassignable_links(b, i, lk.located_refs(r, t), t, p), f"WITH {LOCATED}, {TOPIC}, {MOVED}, {_parts('mv', 'mv0')} SELECT link_id, call_id, item_id, old_topic, topic_id, new_part AS part_id FROM mv WHERE part_reason IS NULL")
register("lk09_retirable_links", _plan_views, lambda i, x, r, t, p, b: lk.retirable_links(b, i, x, lk.located_refs(r, t)), f"WITH {ELIGIBLE}, {LOCATED}, {RETIRED} SELECT link_id, call_id, item_id, reason FROM re")
register("lk05_match_categories", "f_items f_exclusions f_category_topics f_topics f_bank_links", lambda i, x, c, t, b: lk.match_categories(i, x, c, t, b).select("call_id", "item_id", "topic_id", "outcome"), f"WITH {OTHER} SELECT call_id, item_id, topic_id, outcome FROM nc")
register("lk05_unmatched_items", "f_items f_exclusions f_refs f_topics", lambda i, x, r, t: lk.unmatched_items(i, x, lk.ref_index(lk.located_refs(r, t))), f"WITH {ELIGIBLE}, {LOCATED} SELECT item_id, CASE WHEN reason IS NULL THEN 'OUTSIDE' ELSE 'INCOMPLETE' END AS outcome FROM e WHERE reason LIKE 'INCOMPLETE%' OR (reason IS NULL AND NOT EXISTS (SELECT 1 FROM l WHERE l.norm_id = e.norm_id AND l.base = e.base))")
register("ch06_blocked_calls", "f_refs f_topics f_category_topics", lambda r, t, c: lk.blocked_calls(_more_refs(r), t, c), f"""WITH r2 AS ({_shared}), {LOCATED.replace('FROM f_refs r', 'FROM r2 r')}, x AS (SELECT call_id FROM l WHERE norm_id IS NULL OR base IS NULL UNION ALL SELECT call_id FROM (SELECT call_id FROM l WHERE norm_id IS NOT NULL AND base IS NOT NULL AND fullref IS NOT NULL GROUP BY call_id, norm_id, fullref HAVING count(DISTINCT topic_id) > 1)
 UNION ALL SELECT call_id FROM (SELECT call_id FROM f_category_topics GROUP BY call_id, upper(trim(category)) HAVING count(DISTINCT topic_id) > 1)) SELECT call_id, count(*) AS incidents FROM x GROUP BY call_id""")
register("ch06_bank_plan", _bank_views, lk.bank_plan, f"{PLAN} SELECT call_id, item_id, action, topic_id, part_id, reason, link_type FROM pl")
register("ch06_plan_totals", _bank_views, lambda *v: lk.plan_totals(lk.bank_plan(*v)), f'{PLAN} SELECT call_id, count(*) FILTER (WHERE action = \'ADD\') AS "add", count(*) FILTER (WHERE action = \'REASSIGN\') AS reassign, count(*) FILTER (WHERE action = \'RETIRE\') AS retire, count(*) FILTER (WHERE action = \'BLOCKED\') AS blocked, count(*) FILTER (WHERE action = \'BLOCKED\') > 0 AS blocks FROM pl GROUP BY call_id')
register("ch07_apply_bank_plan", _bank_views, lambda *v: lk.apply_bank_plan(v[5], lk.bank_plan(*v)), f"""{PLAN} SELECT b.call_id, b.item_id, coalesce(q.part_id, b.part_id) AS part_id, b.link_type, b.state, coalesce(q.topic_id, b.topic_id) AS topic_id FROM f_bank_links b LEFT JOIN (SELECT * FROM pl WHERE action IN ('REASSIGN', 'RETIRE')) q ON q.call_id = b.call_id AND q.item_id = b.item_id WHERE coalesce(q.action, '') <> 'RETIRE'
 UNION ALL SELECT call_id, item_id, part_id, link_type, 'INCLUIDA', topic_id FROM pl WHERE action = 'ADD'""")
EXPECTED = f"ex AS (SELECT u.call_id, i.item_id, u.topic_id FROM f_items i JOIN (SELECT call_id, norm_id, base, min(topic_id) AS topic_id FROM l WHERE norm_id IS NOT NULL AND base IS NOT NULL GROUP BY ALL HAVING count(DISTINCT topic_id) = 1) u ON u.norm_id = i.norm_id AND u.base = {_base('i.article_n')} WHERE i.kind = 'JURIDICA')"
register("lk10_diff_bank", "f_items f_refs f_topics f_bank_links f_exclusions", lambda i, r, t, b, x: lk.diff_bank(lk.expected_bank(i, r, t), b, x), f"""WITH {LOCATED}, {EXPECTED}, j AS (SELECT coalesce(ex.call_id, b.call_id) AS call_id, coalesce(ex.item_id, b.item_id) AS item_id, ex.topic_id AS want, b.topic_id, b.part_id, b.link_type, b.state, b.item_id IS NOT NULL AS stored FROM ex FULL JOIN f_bank_links b ON b.call_id = ex.call_id AND b.item_id = ex.item_id),
 k AS (SELECT j.*, EXISTS (SELECT 1 FROM f_exclusions x WHERE x.item_id = j.item_id) AS excluded FROM j),
 f AS (SELECT call_id, item_id, concat_ws(',', CASE WHEN NOT stored AND NOT excluded THEN 'MISSING' END, CASE WHEN want IS NULL AND link_type = 'JURIDICA' AND NOT excluded THEN 'SURPLUS' END, CASE WHEN want <> topic_id THEN 'TOPIC' END, CASE WHEN want IS NOT NULL AND link_type <> 'JURIDICA' THEN 'TYPE' END, CASE WHEN stored AND part_id IS NULL THEN 'PART' END, CASE WHEN stored AND excluded AND state <> 'REVISION' THEN 'EXCLUDED' END) AS flags FROM k) SELECT * FROM f WHERE flags <> ''""")
register("lk11_expected_bank", "f_items f_refs f_topics", lk.expected_bank, f"WITH {LOCATED}, {EXPECTED} SELECT call_id, item_id, topic_id FROM ex")
register("lk12_surplus_links", "f_items f_refs f_topics f_bank_links", lambda i, r, t, b: lk.surplus_links(lk.expected_bank(i, r.filter("ref_id % 7 <> 0"), t), b).select("link_id"), f"WITH {LOCATED.replace('t.topic_id = r.topic_id', 't.topic_id = r.topic_id AND r.ref_id % 7 <> 0')}, {EXPECTED} SELECT link_id FROM f_bank_links b WHERE link_type = 'JURIDICA' AND NOT EXISTS (SELECT 1 FROM ex WHERE ex.call_id = b.call_id AND ex.item_id = b.item_id)")
register("lk13_repair_parts", "f_bank_links f_items f_topics f_part_rules", lambda b, i, t, p: lk.repair_parts(b, i, t, p), f"WITH rp0 AS (SELECT b.link_id, b.call_id, b.part_id AS old_part, t.part, t.content_type, i.theory_practice FROM f_bank_links b JOIN f_topics t ON t.topic_id = b.topic_id JOIN f_items i ON i.item_id = b.item_id), {_parts('rp', 'rp0')} SELECT link_id, old_part, new_part AS part_id, part_reason FROM rp WHERE new_part IS NULL OR old_part IS NULL OR new_part <> old_part")


# --- the gate: two clean calls, one with a bad syllabus, two with bad links
_gate_views = "f_calls f_gate_items f_exclusions f_gate_refs f_topics f_gate_rules f_gate_links f_category_topics"
_GATE_PLAN = PLAN.replace("f_refs", "f_gate_refs").replace("f_bank_links", "f_gate_links").replace("f_part_rules", "f_gate_rules").replace("f_items", "f_gate_items")


def _incidents(links: str) -> str:
    return f"""SELECT call_id, 'PART' AS incident FROM {links} WHERE part_id IS NULL UNION ALL SELECT call_id, 'TOPIC' FROM {links} WHERE topic_id IS NULL
 UNION ALL SELECT b.call_id, 'OTHER_CALL' FROM {links} b JOIN f_topics t ON t.topic_id = b.topic_id WHERE t.call_id <> b.call_id
 UNION ALL SELECT b.call_id, 'TYPE' FROM {links} b JOIN f_gate_items i ON i.item_id = b.item_id WHERE b.link_type = 'JURIDICA' AND i.kind <> 'JURIDICA' OR b.link_type = 'NO_JURIDICA' AND i.kind <> 'INFORMATICA'
 UNION ALL SELECT b.call_id, 'PRACTICE' FROM {links} b JOIN f_gate_items i ON i.item_id = b.item_id WHERE i.theory_practice = 'PRACTICA' AND b.call_id NOT IN (SELECT call_id FROM f_gate_rules WHERE theory_practice = 'PRACTICA')
 UNION ALL SELECT call_id, 'REPEATED' FROM (SELECT call_id, item_id FROM {links} GROUP BY call_id, item_id HAVING count(*) > 1)"""


_GATE = f"""{_GATE_PLAN},
inc AS (SELECT call_id, 'REFERENCE' AS incident FROM l WHERE norm_id IS NULL OR base IS NULL
 UNION ALL SELECT call_id, 'REPEATED_REFERENCE' FROM (SELECT call_id FROM l WHERE norm_id IS NOT NULL AND base IS NOT NULL AND fullref IS NOT NULL GROUP BY call_id, norm_id, fullref HAVING count(DISTINCT topic_id) > 1)
 UNION ALL SELECT call_id, 'CATEGORY' FROM (SELECT call_id FROM f_category_topics GROUP BY call_id, upper(trim(category)) HAVING count(DISTINCT topic_id) > 1)
 UNION ALL {_incidents('f_gate_links')}),
rv AS (SELECT c.call_id, (SELECT count(*) FROM inc WHERE inc.call_id = c.call_id) AS incidents FROM f_calls c),
q AS (SELECT * FROM pl WHERE call_id IN (SELECT call_id FROM rv WHERE incidents = 0)),
nw_links AS (SELECT b.call_id, b.item_id, coalesce(z.part_id, b.part_id) AS part_id, b.link_type, b.state, coalesce(z.topic_id, b.topic_id) AS topic_id FROM f_gate_links b LEFT JOIN (SELECT * FROM q WHERE action IN ('REASSIGN', 'RETIRE')) z ON z.call_id = b.call_id AND z.item_id = b.item_id WHERE coalesce(z.action, '') <> 'RETIRE'
 UNION ALL SELECT call_id, item_id, part_id, link_type, 'INCLUIDA', topic_id FROM q WHERE action = 'ADD'),
back AS (SELECT DISTINCT call_id FROM ({_incidents('nw_links')}) WHERE call_id IN (SELECT call_id FROM rv WHERE incidents = 0))"""
register("ch06_gate", _gate_views, lambda *v: lk.sync_banks(*v)[1], f"""{_GATE} SELECT rv.call_id, count(*) FILTER (WHERE action = 'ADD') AS "add", count(*) FILTER (WHERE action = 'REASSIGN') AS reassign, count(*) FILTER (WHERE action = 'RETIRE') AS retire, count(*) FILTER (WHERE action = 'BLOCKED') AS blocked,
 incidents, incidents > 0 AS vetoed, rv.call_id IN (SELECT call_id FROM back) AS rolled_back FROM rv LEFT JOIN pl ON pl.call_id = rv.call_id GROUP BY rv.call_id, incidents""")
register("ch06_incidents", _gate_views, lambda c, i, x, r, t, p, b, k: lk.plan_incidents(r, t, k).unionByName(lk.bank_incidents(b, i, t, p)), f"{_GATE} SELECT call_id, incident, count(*) AS n FROM inc GROUP BY call_id, incident")
register("ch07_sync_banks", _gate_views, lambda *v: lk.sync_banks(*v)[0], f"{_GATE} SELECT * FROM nw_links WHERE call_id NOT IN (SELECT call_id FROM back) UNION ALL SELECT call_id, item_id, part_id, link_type, state, topic_id FROM f_gate_links WHERE call_id IN (SELECT call_id FROM back)")
