"""Queries of the text rules (TX), each with its oracle."""

from __future__ import annotations

import re

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank.functions import textnorm as tx
from quillbank.plans.fixtures import tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_ACC = f"'{tx.ACCENTED}', '{tx.PLAIN}'"
_B = "[ \\t\\n\\x0b\\f\\r]"


def _ua(x: str) -> str:
    return f"translate({x}, {_ACC})"


def _col(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_B}+', ' ', 'g'))"


def _nsl(x: str) -> str:
    return f"lower({_col(f'translate(coalesce({x}, {chr(39) * 2}), chr(160), {chr(39)} {chr(39)})')})"


def _cite(x: str) -> str:
    return _col(f"regexp_replace(lower(coalesce({x}, '')), '[\"''“”«»’‘.,;:()\\[\\]–—-]', ' ', 'g')")


def _art(x: str) -> str:
    return f"regexp_replace(trim(lower({_ua(f'coalesce({x}, {chr(39) * 2})')})), '^(articulo|art)\\.?{_B}*', '')"


_W = "[^\\pL\\pN_]"


def _re2(pattern: str) -> str:
    """A shared pattern in the oracle's dialect, for tests: it folds case itself, but knows word borders of ASCII only."""
    p = pattern.replace("(?iuU)", "(?i)").replace("(?iu)", "(?i)").replace("'", "''")
    p = re.sub(r"\\b(?=$|[|)])", lambda _: f"(?:$|{_W})", p)
    return p.replace("\\b", f"(?:^|{_W})")


class _Columns:
    """Columns by name, made when a query is built: columns need a session, importing this module doesn't."""

    def __getattr__(self, name: str) -> Column:
        return F.col(name)

    @property
    def options(self) -> list[Column]:
        return [F.col(f"opt_{c}") for c in "abcd"]


def _rule(name: str, view: str, key: str, value: Callable[[_Columns], Column], sql: str | None) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tables(spark, sf_dir, view)[0].select(key, value(_Columns()).alias("v"))

    QUERIES[name] = query
    if sql is not None:
        ORACLE_SQL[name] = with_views(f"SELECT {key}, {sql} AS v FROM {view}")


D, C, T = ("documents", "doc_id"), ("f_citations", "item_id"), ("f_text_items", "item_id")

_rule("tx01_norm_spaces_lower", *D, lambda c: tx.norm_spaces_lower(c.text), _nsl("text"))
_rule("tx02_norm_ascii_alnum", *D, lambda c: tx.norm_ascii_alnum(c.text), f"trim(regexp_replace(lower({_ua('text')}), '[^a-z0-9]+', ' ', 'g'))")
_rule("tx03_norm_quotes", *C, lambda c: tx.norm_quotes(c.name), _col(f"translate(lower({_ua('name')}), '“”«»', '\"\"\"\"')"))
_rule("tx04_norm_punct", *D, lambda c: tx.norm_punct(c.text), _col(f"regexp_replace(lower({_ua('text')}), '[_/\\\\.,;:()\\[\\]{{}}\\-]+', ' ', 'g')"))
_rule("tx05_norm_keep_accents", *D, lambda c: tx.norm_keep_accents(c.text), "trim(regexp_replace(lower(text), '[^a-záéíóúüñ0-9%]+', ' ', 'g'))")
_rule("tx06_norm_nfkc_casefold", *C, lambda c: tx.norm_nfkc_casefold(c.name), None)
_rule("tx07_norm_citation", *D, lambda c: tx.norm_citation(c.text), _cite("text"))
_base = "'^([0-9]+)(?:[ \\t.\\-]*(bis|ter|quater|quinquies))?'"
_plain = f"regexp_replace(regexp_extract({_art('article')}, {_base}, 1), '^0+([0-9])', '\\1')"
_article_base_sql = f"CASE WHEN regexp_extract({_art('article')}, {_base}, 1) = '' THEN NULL WHEN regexp_extract({_art('article')}, {_base}, 2) <> '' THEN {_plain} || ' ' || regexp_extract({_art('article')}, {_base}, 2) ELSE {_plain} END"
_rule("tx08_article_base", *C, lambda c: tx.article_base(c.article), _article_base_sql)
_full = f"regexp_replace(regexp_replace(translate({_art('article')}, ',', '.'), '{_B}+', ' ', 'g'), '^([0-9]+)[ .\\-]*(bis|ter|quater|quinquies)($|[. ])', '\\1 \\2\\3')"
_rule("tx09_article_full", *C, lambda c: tx.article_full(c.article), f"CASE WHEN regexp_matches({_full}, '^[0-9]+( (bis|ter|quater|quinquies))?(\\.[0-9a-z]+)*$') THEN {_full} END")
_rule("tx10_article_unambiguous", *C, lambda c: tx.article_unambiguous(c.article), None)
_ref = "([0-9]+(?:\\.[0-9]+)*(?: *(?:bis|ter|quater|quinquies))?(?:\\.[A-Za-z])?)"
_at = _col("coalesce(article, '')")
_rule("tx11_article_precise", *C, lambda c: tx.article_precise(c.article), f"coalesce(nullif(regexp_extract({_at}, '(?i)^{_ref}', 1), ''), nullif(regexp_extract({_at}, '(?i)(?:art[ií]culo|art\\.) *{_ref}', 1), ''))")


def _identity_sql(x: str) -> str:
    t = f"regexp_replace(translate({_ua(f'lower(trim({x}))')}, '_', ' '), '{_B}+', ' ', 'g')"
    parts = []
    for k, (pattern, kind) in enumerate(tx.NORM_KINDS):
        whole = pattern + (" +([0-9]{4}) */? *([0-9]+)" if k >= 7 else " +([0-9]+) */? *([0-9]{4})")
        parts.append(f"SELECT {k} AS o, length(regexp_extract(t, '^(.*?){whole}', 1))  AS p, '{kind} ' || regexp_extract(t, '{whole}', 1) || '/' || regexp_extract(t, '{whole}', 2) AS key WHERE regexp_matches(t, '{whole}')")
    date = f"\\bde ([0-9]{{1,2}}) de {tx.MONTH}(?: de ([0-9]{{4}}))?\\b"
    alias = "CASE k " + " ".join("WHEN '{}' THEN '{}'".format(*kv) for kv in tx.ALIASES.items()) + " ELSE k END"
    tail = f"""CASE WHEN regexp_extract(r, '{date}', 1) = '' THEN '' ELSE ' de ' || regexp_replace(regexp_extract(r, '{date}', 1), '^0', '') || ' de ' || replace(regexp_extract(r, '{date}', 2), 'setiembre', 'septiembre')
        || CASE WHEN regexp_extract(r, '{date}', 3) <> '' THEN ' de ' || regexp_extract(r, '{date}', 3) ELSE '' END END"""
    return f"""WITH n AS (SELECT DISTINCT {x} AS x, {t} AS t FROM f_citations), b AS (SELECT x, t, (SELECT min(struct_pack(p := p, o := o, key := key)) FROM ({' UNION ALL '.join(parts)})) AS best FROM n),
        k AS (SELECT x, coalesce(best.key || ({tail.replace('(r,', '(substr(t, CAST(best.p AS INT) + 1),')}), t) AS k FROM b) SELECT x, {alias} AS v FROM k"""


QUERIES["tx12_norm_identity"] = lambda spark, sf_dir: tables(spark, sf_dir, "f_citations")[0].select(F.col("name").alias("x")).distinct().select("x", tx.norm_identity(F.col("x")).alias("v"))
ORACLE_SQL["tx12_norm_identity"] = with_views(_identity_sql("name"))
_dated = f"concat('ley ', CAST(item_id % 50 AS STRING), '/2015', CASE WHEN item_id % 2 = 0 THEN ' de 3 de mayo' ELSE '' END, CASE WHEN item_id % 4 = 0 THEN ' de 2015' ELSE '' END)"
_rule("tx13_norm_identity_undated", *C, lambda c: tx.norm_identity_undated(F.expr(_dated)), f"trim(regexp_replace({_dated}, ' +de [0-9]{{1,2}} de {tx.MONTH}(?: de [0-9]{{4}})?$', ''))")
_kind = "CASE item_id % 4 WHEN 0 THEN 'Ley Orgánica' WHEN 1 THEN 'rd' WHEN 2 THEN 'Decreto-Ley' ELSE 'Circular' END"
_k = f"regexp_replace(trim(upper({_ua(_kind)})), '[ -]+', '_', 'g')"
_nums = "regexp_extract_all(name, '([0-9]+) */ *([0-9]{4})', 0)"
_rule("tx14_norm_rule_lookup", *C, lambda c: tx.formal_rule(F.expr(_kind), c.name), f"CASE WHEN len({_nums}) = 1 THEN (CASE {_k} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in tx.FORMAL_KINDS.items()) + f" END) || ' ' || regexp_replace(replace({_nums}[1], ' ', ''), '^0+([0-9])', '\\1') END")
_rule("tx15_citation_parts", *C, lambda c: F.to_json(tx.citation_parts(c.name)), None)
_rule("tx16_cited_norms", *C, lambda c: F.array_join(tx.cited_norms(c.stem), ","), r"""array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(stem, '\b([0-9]{1,4})\s*/\s*([0-9]{2,4})\b', 0),
    lambda c: CAST(CAST(trim(string_split(c, '/')[1]) AS INT) AS VARCHAR) || '/' || CASE WHEN length(trim(string_split(c, '/')[2])) = 2 THEN CASE WHEN CAST(trim(string_split(c, '/')[2]) AS INT) > 30 THEN '19' ELSE '20' END ELSE '' END || trim(string_split(c, '/')[2])))), ',')""")  # fmt: skip
_tail = " *\\(([^()]{2,160})\\) *([:.?]?) *$"
_inner, _mark, _bare = f"regexp_extract(stem, '{_tail}', 1)", f"regexp_extract(stem, '{_tail}', 2)", f"rtrim(regexp_replace(stem, '{_tail}', ''))"
_rule("tx17_strip_trailing_origin", *C, lambda c: tx.strip_trailing_origin(c.stem), f"CASE WHEN {_inner} <> '' AND (regexp_matches({_inner}, '(?i)^\\s*dificultad(?:$|{_W})') OR regexp_matches({_inner}, '{_re2(tx.ORIGIN)}') AND NOT regexp_matches({_inner}, '{_re2(tx.INSTRUCTION)}') AND NOT regexp_matches({_inner}, '{_re2(tx.NO_ORIGIN)}')) THEN {_bare} || CASE WHEN ends_with({_bare}, {_mark}) THEN '' ELSE {_mark} END ELSE stem END")
_words = "ayuntamiento|diputaci[oó]n|mancomunidad|bolsa +(?:de|para)|convocatoria|oposiciones?|examen(?: +tipo)?|proceso +selectivo|prueba +selectiva"
_rule("tx18_strip_origin_anywhere", *C, lambda c: tx.strip_origin_anywhere(c.stem), f"trim(regexp_replace(regexp_replace(stem, '(?i) *[(\\[][^()\\[\\]]*(?:{_words})[^()\\[\\]]*[)\\]]', '', 'g'), '{_B}{{2,}}', ' ', 'g'), ' ;,.-')")
_rule("tx19_rephrase_stem", *C, lambda c: tx.rephrase_stem(c.stem), "CASE " + " ".join(f"WHEN regexp_matches(trim(stem), '(?i){p}') THEN regexp_replace(trim(stem), '(?i){p}', '{re.sub(chr(92) + chr(36), chr(92) * 2, r)}')" for p, r in tx.WHOLE_STEMS) + " " + " ".join(f"WHEN regexp_matches(trim(stem), '(?i){p}') THEN regexp_replace(trim(stem), '(?is)^(.*?){p}(.*)$', '\\1{r}\\2')" for p, r in tx.PHRASES) + " ELSE stem END")
_rule("tx20_dehyphenate", *C, lambda c: tx.dehyphenate(c.stem), _col(f"regexp_replace(replace(stem, chr(173), ''), '-[ \\t]*\\n{_B}*([0-9A-Za-záéíóúüñÁÉÍÓÚÜÑ])', '\\1', 'g')"))
_s = _nsl(_ua("stem"))
_rule("tx21_classify_theory_practice", *C, lambda c: tx.classify_theory_practice(c.stem, c.stem), f"CASE WHEN regexp_matches({_s}, '{tx.SUBJECT}') OR regexp_matches({_s}, '{tx.CASE}') OR regexp_matches({_s}, '{tx.HYPOTHESIS}') OR (regexp_matches({_s}, '{tx.DETAIL}') AND regexp_matches({_s}, '{tx.ACTION}')) THEN 'PRACTICA' ELSE 'TEORICA' END")
_n22 = "coalesce(" + ", ".join(f"nullif({_col(f"regexp_extract(stem, '{_re2(f'(?iuU)({p[2:]})')}', 1)")}, '')" for p in tx.NORM_PATTERNS) + ")"
_a22 = "nullif(regexp_extract(stem, '(?i)(?:^|[^\\pL\\pN_])art[íi]culos?\\s+([0-9]+(?:\\.[0-9]+)*)', 1), '')"
_found = lambda stem: F.concat_ws("|", *[F.coalesce(tx.detect_norm_article(stem)[k], F.lit("-")) for k in ("state", "norm", "article")])
_rule("tx22_detect_norm_article", *C, lambda c: _found(c.stem), f"CASE WHEN {_n22} IS NOT NULL AND {_a22} IS NOT NULL THEN 'JURIDICA' ELSE 'PENDIENTE' END || '|' || coalesce({_n22}, '-') || '|' || coalesce({_a22}, '-')")


def _prefix_sql(kinds: tuple) -> str:
    return "CASE " + " ".join(f"WHEN starts_with(lower({_col('name')}), '{p}') THEN '{k}'" for p, k in kinds) + " END"


_rule("tx23_infer_norm_type", *C, lambda c: tx.kind_by_prefix(c.name, tx.PREFIX_KINDS), _prefix_sql(tx.PREFIX_KINDS))
_cat = "CASE item_id % 5 WHEN 0 THEN 'Ofimática ' WHEN 1 THEN 'word' WHEN 2 THEN 'Ciber-seguridad' WHEN 3 THEN 'ciberseguridad!' ELSE 'redes  y más' END"
_known, _alias = ["MICROSOFT_365", "OFIMATICA_WORD", "SEGURIDAD", "REDES_Y_MAS"], {"WORD": "OFIMATICA_WORD", "OFIMATICA": "MICROSOFT_365", "CIBERSEGURIDAD": "SEGURIDAD"}
_c24 = f"trim(regexp_replace(upper({_ua(_cat)}), '[^A-Z0-9]+', '_', 'g'), '_')"
_c24 = f"(CASE {_c24} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _alias.items()) + f" ELSE {_c24} END)"
_rule("tx24_category_normalise", *C, lambda c: tx.category_normalise(F.expr(_cat), _alias, _known), f"CASE WHEN {_c24} IN ({', '.join(repr(k) for k in _known)}) THEN {_c24} END")
_src = "concat(CASE item_id % 5 WHEN 0 THEN 'boe-a-' WHEN 1 THEN 'DOGV-' WHEN 2 THEN 'local-dogv-' WHEN 3 THEN 'DOUE-' ELSE 'LOCAL-' END, CAST(item_id AS STRING))"
_rule("tx25_source_family", *C, lambda c: tx.source_family(F.expr(_src)), "CASE item_id % 5 WHEN 0 THEN 'BOE' WHEN 1 THEN 'DOGV' WHEN 2 THEN 'DOGV' WHEN 3 THEN 'DOUE' ELSE 'LOCAL' END")

_L = "[\\p{L}\\p{N}_]{6,}"
_lw = lambda x: f"list_distinct(regexp_extract_all(lower(coalesce({x}, '')), '{_L}', 0))"
_ITEM = """WITH o AS (SELECT item_id, stem, answer_key, source_type, [coalesce(opt_a, ''), coalesce(opt_b, ''), coalesce(opt_c, ''), coalesce(opt_d, '')] AS o, list_position(['A', 'B', 'C', 'D'], answer_key) AS k FROM f_text_items),
e AS (SELECT *, list_transform(o, lambda x: length(x)) AS n, list_transform(o, lambda x: len(list_intersect(LW_STEM, LW_X))) AS e FROM o)""".replace("LW_STEM", _lw("stem")).replace("LW_X", _lw("x"))
_score = f"""least(100, CASE WHEN n[k] = list_sort(n, 'DESC')[1] AND list_sort(n, 'DESC')[1] > list_sort(n, 'DESC')[2] THEN CASE WHEN n[k] >= 1.3 * list_sort(n, 'DESC')[2] THEN 35 ELSE 25 END ELSE 0 END
 + CASE WHEN regexp_matches(o[k], '{_re2(tx.ABSOLUTE)}') THEN 0 ELSE least(30, 12 * len(list_filter(o, lambda x: regexp_matches(x, '{_re2(tx.ABSOLUTE)}')))) END
 + CASE WHEN regexp_matches(o[k], '{_re2(tx.ALL_OF_THEM)}') THEN 15 ELSE 0 END
 + CASE WHEN e[k] > 0 AND e[k] = list_max(e) AND len(list_filter(e, lambda x: x = e[k])) = 1 THEN 15 ELSE 0 END + CASE WHEN length(coalesce(stem, '')) < 90 THEN 10 ELSE 0 END)"""
# the texts are invented, so some options get an absolute word
_LOUD = "concat(coalesce(opt_b, ''), CASE item_id % 6 WHEN 0 THEN ' siempre' WHEN 1 THEN ' con independencia' WHEN 2 THEN ' todo los' ELSE '' END)"
_LOUD_ITEM = _ITEM.replace("coalesce(opt_b, '')", _LOUD)
_clues = lambda: tx.clue_score(F.col("stem"), [F.expr(_LOUD) if k == 1 else o for k, o in enumerate(_Columns().options)], F.col("answer_key"))
QUERIES["tx26_clue_score"] = lambda spark, sf_dir: tables(spark, sf_dir, "f_text_items")[0].select("item_id", _clues().alias("v"))
ORACLE_SQL["tx26_clue_score"] = with_views(f"{_LOUD_ITEM} SELECT item_id, {_score} AS v FROM e")
QUERIES["tx27_difficulty_level"] = lambda spark, sf_dir: tables(spark, sf_dir, "f_text_items")[0].select("item_id", tx.difficulty_level(_clues(), F.col("source_type") == "src1", F.col("source_type") == "src2", F.when(F.col("item_id") % 5 > 0, "JURIDICA").otherwise("INFORMATICA")).alias("v"))
ORACLE_SQL["tx27_difficulty_level"] = with_views(f"{_LOUD_ITEM} SELECT item_id, CASE WHEN item_id % 5 = 0 THEN NULL WHEN source_type = 'src2' THEN CASE WHEN s < 20 THEN 1 WHEN s < 40 THEN 3 ELSE 4 END WHEN source_type = 'src1' THEN CASE WHEN s < 20 THEN 2 WHEN s < 40 THEN 3 ELSE 4 END ELSE CASE WHEN s < 20 THEN 1 WHEN s < 40 THEN 2 ELSE 3 END END AS v FROM (SELECT *, {_score} AS s FROM e)")
QUERIES["tx28_option_defects"] = lambda spark, sf_dir: tables(spark, sf_dir, "f_text_items")[0].select("item_id", F.array_join(tx.option_defects(F.col("stem"), _Columns().options, F.col("answer_key")), ",").alias("v"))
_defects = f"""CASE WHEN {_score} >= 20 THEN 'clues' END, CASE WHEN list_max(n) > 170 THEN 'too_long' END, CASE WHEN list_min(n) < 0.55 * list_max(n) THEN 'uneven' END,
 CASE WHEN regexp_matches(array_to_string(o, ' '), '{_re2(tx.ALL_OF_THEM)}') THEN 'all_or_none' END, CASE WHEN e[k] >= list_max([x for x, i in e if i <> k]) + 2 THEN 'echo' END"""
ORACLE_SQL["tx28_option_defects"] = with_views(f"""{_ITEM} SELECT item_id, concat_ws(',', {_defects},
 CASE WHEN regexp_matches(stem, '\\b(INCORRECTA|FALSA|NO es correcta|EXCEPTO)\\b') THEN 'negative' END) AS v FROM e""")  # fmt: skip
# stems that say a norm or count statements, for items of four norms, half of them in the format with statements
_SAYS = "concat(stem, CASE item_id % 3 WHEN 0 THEN ' según la Ley 39/2015 y el TUE' WHEN 1 THEN ' de la CONSTITUCIÓN: I, II y III' ELSE ' EXCEPTO esto' END)"
_NORM = "CASE item_id % 4 WHEN 0 THEN 'Ley 39/2015, de 1 de octubre' WHEN 1 THEN 'Constitución Española' WHEN 2 THEN 'Tratado de la Unión Europea' ELSE 'Otra' END"
QUERIES["tx28_defects_of_format"] = lambda spark, sf_dir: tables(spark, sf_dir, "f_text_items")[0].select("item_id", F.array_join(tx.option_defects(F.expr(_SAYS), _Columns().options, F.col("answer_key"), F.expr(_NORM), F.expr("CASE WHEN item_id % 2 = 0 THEN 'combinada' ELSE 'directa' END")), ",").alias("v"))
ORACLE_SQL["tx28_defects_of_format"] = with_views(f"""{_ITEM.replace("SELECT item_id, stem, answer_key", f"SELECT item_id, {_SAYS} AS stem, answer_key")} SELECT item_id, concat_ws(',', {_defects},
 CASE WHEN (item_id % 4 = 1 AND item_id % 3 <> 1) OR (item_id % 4 IN (0, 2) AND item_id % 3 <> 0) THEN 'norm_not_explicit' END,
 CASE WHEN item_id % 2 = 0 AND item_id % 3 <> 1 THEN 'statements_missing' END, CASE WHEN item_id % 3 = 2 THEN 'negative' END) AS v FROM e""")  # fmt: skip
_internal30 = _re2(tx.INTERNAL).replace("art\\.|", "") + f"|(?:^|{_W})art\\.[\\pL\\pN_]"
_section30 = f"(?i)(?:^|{_W})(?:apartado\\s+\\d|letras?\\s+[a-z](?:\\s*(?:,|y|o)\\s*[a-z])+\\s+del\\s+apartado\\s+\\d)"


def flags_sql(stem: str) -> str:
    return f"concat_ws(',', CASE WHEN regexp_matches({stem}, '{_internal30}') AND NOT regexp_matches({stem}, '{_re2(tx.ANY_NORM)}') THEN 'norm_not_named' END, CASE WHEN regexp_matches({stem}, '{_re2(tx.POINTING)}') THEN 'points_elsewhere' END, CASE WHEN regexp_matches({stem}, '{_section30}') AND NOT regexp_matches({stem}, '{_re2(tx.ANY_ARTICLE)}') THEN 'section_without_article' END)"


_rule("tx30_self_sufficiency_flags", *C, lambda c: F.array_join(tx.self_sufficiency_flags(c.stem, c.stem), ","), flags_sql("stem"))
_body = "CASE item_id % 4 WHEN 0 THEN concat('Artículo ', CAST(item_id % 90 AS STRING), '.') WHEN 1 THEN stem WHEN 2 THEN name ELSE '' END"
_ntb = _nsl(_ua(_body))
_pl = f"rtrim(regexp_replace({_ntb}, '[ .:;-]+$', ''))"
_rule("tx31_text_sufficient", *C, lambda c: tx.text_sufficient(F.expr(_body), c.name), f"{_ntb} <> '' AND NOT ({_pl} = regexp_replace({_nsl(_ua('name'))}, '[ .:;-]+$', '') AND length({_col(_body)}) < 80) AND NOT regexp_matches({_pl}, '^(articulo|art\\.?) [0-9]+(\\.[0-9]+)*( *(bis|ter|quater|quinquies))?(\\.[a-z])? *\\.?$')")
_low = f"(' ' || lower({_col('text')}) || ' ')"
_rule("tx32_source_usable", *D, lambda c: tx.source_usable(c.text, F.col("doc_id") % 3 == 0), f"length({_col('text')}) >= CASE WHEN doc_id % 3 = 0 THEN 250 ELSE 100 END AND ({' OR '.join(f'contains({_low}, {chr(39)}{w}{chr(39)})' for w in tx.NORMATIVE)} OR length({_col('text')}) >= 500)")
_rule("tx33_repealed_article", *C, lambda c: tx.repealed(c.name, c.stem), " OR ".join(f"regexp_matches(regexp_replace(regexp_replace({_nsl(_ua(x))}, '^articulo ([0-9]+(\\.[0-9]+)*( \\w+)?|unico) *[.:-]* *', ''), '^[\\[() .:-]+', ''), '^derogad[oa]s?\\b')" for x in ("name", "substr(stem, 1, 300)")))
_rule("tx33_repealed_norm", *C, lambda c: tx.repealed_norm(c.stem), f"regexp_matches(CASE WHEN contains({_s}, 'publicado en:') THEN string_split({_s}, 'publicado en:')[1] ELSE substr({_s}, 1, 5000) END, '\\bdisposicion derogada\\b')")
_sh = lambda: tx.option_shuffle(F.col("item_id"), _Columns().options, F.col("answer_key"), "s1")
QUERIES["tx34_option_shuffle"] = lambda spark, sf_dir: tables(spark, sf_dir, "f_text_items")[0].select("item_id", F.array_join(_sh()["options"], "|", "-").alias("opts"), _sh()["key"].alias("new_key"))
ORACLE_SQL["tx34_option_shuffle"] = with_views("""WITH d AS (SELECT item_id, answer_key, c, o, row_number() OVER (PARTITION BY item_id ORDER BY md5(concat_ws('|', CAST(item_id AS VARCHAR), c, 's1'))) AS r
 FROM (SELECT item_id, answer_key, unnest(['A', 'B', 'C', 'D']) AS c, unnest([opt_a, opt_b, opt_c, opt_d]) AS o FROM f_text_items))
SELECT item_id, string_agg(coalesce(o, '-'), '|' ORDER BY r) AS opts, max(CASE WHEN c = answer_key THEN substr('ABCD', CAST(r AS INT), 1) END) AS new_key FROM d GROUP BY item_id""")
_p35 = [re.sub(r"\(\?=(.*)\)$", r"(?:\1)", p).replace("(?iuU)", "(?i)").replace("(?imuU)", "(?im)") for p in tx.ANSWER_PATTERNS]
_f35 = "list_distinct(list_transform(list_concat(" + ", ".join(f"regexp_extract_all(stem, '{p}', 1)" for p in _p35) + "), lambda x: upper(x)))"
_rule("tx35_explicit_answer", *C, lambda c: tx.explicit_answer(c.stem), f"CASE WHEN len({_f35}) > 1 THEN '?' WHEN len({_f35}) = 1 THEN {_f35}[1] END")
_p36, _m36, _s36 = (p.replace("(?iuU)", "(?i)") for p in (tx.ARTICLE_OF_NORM, tx.ARTICLE_MENTION, tx.SEVERAL_NUMBERS))
_rule("tx36_unambiguous_reference", *C, lambda c: tx.unambiguous_reference(c.stem), f"CASE WHEN len(regexp_extract_all(stem, '{_m36}', 0)) = 1 AND len(regexp_extract_all(stem, '{_p36}', 0)) = 1 AND NOT regexp_matches(regexp_extract(stem, '{_p36}', 0), '{_s36}') THEN regexp_extract(stem, '{_p36}', 1) || '|' || {_col(f"regexp_extract(stem, '{_p36}', 2)")} END")
_quote = "CASE WHEN doc_id % 3 = 0 THEN substr(text, 10, 40) WHEN doc_id % 3 = 1 THEN concat(substr(text, 5, 30), '...', substr(text, 60, 30)) ELSE concat('z', substr(text, 20, 40)) END"
_ct = _cite("text")
_pieces = f"list_filter(list_transform(string_split({_quote}, '...'), lambda p: {_cite('p')}), lambda p: length(p) >= 12)"
_rule("tx37_citation_verified", *D, lambda c: tx.citation_verified(F.expr(_quote), c.text), f"""length({_cite(_quote)}) >= 25 AND (contains({_ct}, {_cite(_quote)}) OR (len({_pieces}) >= 2 AND contains({_ct}, {_pieces}[1])
 AND contains(substr({_ct}, CAST(instr({_ct}, {_pieces}[1]) + length({_pieces}[1]) AS INT)), {_pieces}[2])))""")
_own = "concat(CASE WHEN item_id % 2 = 0 THEN 'Artículo ' ELSE 'El artículo ' END, CAST(item_id % 30 AS STRING), CASE WHEN item_id % 3 = 0 THEN '. Objeto' ELSE '5 bis' END)"
_rule("tx38_source_is_own_article", *C, lambda c: tx.source_is_own_article(F.expr(_own), F.expr("CAST(item_id % 30 AS STRING)")), "item_id % 2 = 0 AND item_id % 3 = 0")
_hay = f"lower({_ua('text')})"
_w39 = f"list_filter(list_transform({_lw(_ua('substr(text, 400, 60)'))}, lambda w: instr({_hay}, w)), lambda p: p > 0)"
_rule("tx39_relevant_excerpt", *D, lambda c: tx.relevant_excerpt(c.text, F.substring("text", 400, 60), 200), f"CASE WHEN length(text) <= 200 THEN text ELSE substr(text, CAST(greatest(0, coalesce(list_min({_w39}), 1) - 1 - 50) AS INT) + 1, 200) END")
_rk = "CASE " + " ".join(f"WHEN contains(lower({_ua('article')}), '{w}') THEN {k}" for k, w in enumerate(tx.SUFFIXES, 1)) + " ELSE 0 END"
_rule("tx40_ordinal_article_key", *C, lambda c: F.array_join(tx.ordinal_article_key(c.article), "."), f"CASE WHEN article IS NULL OR NOT regexp_matches(article, '[0-9]') THEN '1000000000' ELSE array_to_string(list_append(list_transform(regexp_extract_all(article, '[0-9]+', 0), lambda n: CAST(n AS BIGINT)), {_rk}), '.') END")
_ls = f"list_filter(list_transform(string_split(text, chr(10)), lambda l: {_col('l')}), lambda l: l <> '' AND NOT regexp_matches(l, '{_re2(tx.GAZETTE_LINE)}'))"
_rule("tx41_strip_gazette_lines", *D, lambda c: tx.strip_gazette_lines(c.text), _col(f"array_to_string({_ls}, ' ')"))
_numbers = list(tx.number_words().items())
_pick = f"element_at(array({', '.join(repr(w) for w, _ in _numbers[::7])}), CAST(1 + item_id % {len(_numbers[::7])} AS INT))"
_rule("tx42_number_from_words", *C, lambda c: tx.number_from_words(F.expr(f"concat(' ', initcap({_pick}), '.')")), f"list_extract([{', '.join(str(n) for _, n in _numbers[::7])}], CAST(1 + item_id % {len(_numbers[::7])} AS INT))")
_unit = "CASE item_id % 6 WHEN 0 THEN 'Preliminar' WHEN 1 THEN 'ÚNICO' WHEN 2 THEN '007' WHEN 3 THEN 'XIV' WHEN 4 THEN 'iii' ELSE '3º' END"
_rule("tx43_unit_value", *C, lambda c: tx.unit_value(F.expr(_unit)), "CASE item_id % 6 WHEN 0 THEN 'preliminar' WHEN 1 THEN 'unico' WHEN 2 THEN '7' WHEN 3 THEN '14' WHEN 4 THEN '3' ELSE '3' END")
_rule("tx44_question_polarity", *C, lambda c: tx.question_polarity(c.stem), f"CASE WHEN regexp_matches({_s}, '\\bincorrect[ao]\\b|\\bno se corresponde\\b|\\bno es una?\\b|\\bno es verdader[ao]\\b|\\bexcepto\\b|\\bmenos\\b') THEN 'FALSE' ELSE 'TRUE' END")
_rule("tx45_make_norm_explicit", *C, lambda c: tx.make_norm_explicit(c.stem, F.lit("Ley 39/2015")), None)
_rule("tx46_norm_type_strict", *C, lambda c: tx.kind_by_prefix(c.name, tx.STRICT_KINDS), _prefix_sql(tx.STRICT_KINDS))


# --- the same rules on stems whose results are written down, one for each kind of stem (``#``: the row's number; ``=``: the stem)
_RESULTS = {
    "tx17_origins": (lambda c: tx.strip_trailing_origin(c.stem), ["=", "=", "¿Qué plazo hay?", "¿Qué plazo hay?", "=", "=", "=", "=", "=", "=", "=", "=", "=", "="]),
    "tx22_norms": (lambda c: tx.bound(tx.detect_norm_article(c.stem), lambda s: F.concat_ws("|", *[F.coalesce(s[k], F.lit("-")) for k in ("state", "kind", "norm", "article")])), [
        "JURIDICA|LEY_ORGANICA|LEY ORGÁNICA #/2012|#.1", "JURIDICA|LEY|Ley #/2015|5", "PENDIENTE|-|-|-", "PENDIENTE|-|-|-", "PENDIENTE|-|-|-", "PENDIENTE|-|-|-", "PENDIENTE|-|-|-", "PENDIENTE|-|-|-", "PENDIENTE|REAL_DECRETO|Real Decreto Legislativo 5/2015|-",
        "JURIDICA|LEY|Ley #/2010|5", "PENDIENTE|-|-|-", "PENDIENTE|-|-|-", "JURIDICA|CONSTITUCION|CONSTITUCIÓN ESPAÑOLA|#", "JURIDICA|LEY|Ley 39/2015|#",
    ]),
    "tx15_citations": (lambda c: tx.bound(tx.citation_parts(c.stem), lambda s: F.when(s.isNotNull(), F.concat_ws("|", *[s[k] for k in ("kind", "number", "year", "date", "scope")]))), [
        "ley organica|#|2012||", "ley|#|2015||", None, None, None, None, None, None, "real decreto legislativo|5|2015||", "ley|#|2010||", None, None, None, "ley|39|2015||",
    ]),
    "tx30_flags": (lambda c: F.array_join(tx.self_sufficiency_flags(c.stem, c.stem), ","), ["", "", "", "", "", "", "", "", "", "", "norm_not_named,points_elsewhere,section_without_article", "points_elsewhere", "", ""]),
    # the norm of these items is the Ley 39/2015, so others don't name it
    "tx30_flags_by_norm": (lambda c: F.array_join(tx.self_sufficiency_flags(c.stem, c.stem, F.lit("Ley 39 / 2015")), ","), ["norm_not_named", "", "", "", "", "", "", "", "", "norm_not_named", "norm_not_named,points_elsewhere,section_without_article", "norm_not_named,points_elsewhere", "norm_not_named", ""]),
    "tx35_answers": (lambda c: tx.explicit_answer(c.stem), [None, None, None, None, None, "C", "B", "?", None, None, None, None, None, None]),
    "tx36_references": (lambda c: tx.unambiguous_reference(c.stem), [None] * 8 + ["#.2.b|Real Decreto Legislativo 5/2015"] + [None] * 5),
}
for _name, (_value, _want) in _RESULTS.items():
    _cases = " ".join(f"WHEN {k} THEN {'NULL' if w is None else 'stem' if w == '=' else f"replace('{w}', '#', CAST(number AS VARCHAR))"}" for k, w in enumerate(_want))
    _rule(_name, "f_stems", "item_id", _value, f"CASE kind {_cases} END")
