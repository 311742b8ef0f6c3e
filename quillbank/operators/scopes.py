"""Scopes of norms: what ``Título I, Capítulo II`` or ``artículos 1 a 5, salvo el artículo 3`` takes from a norm's index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbank.functions.textnorm import SUFFIXES, collapsed, unaccented, unit_value

#: Kinds of structural units from the outermost inwards, and the ordinals that number them.
UNITS = ("libro", "titulo", "capitulo", "seccion", "subseccion")
ORDINALS = ("primer", "segund", "tercer", "cuart", "quint", "sext", "septim", "octav", "noven", "decim")
_SUFFIX = f"(?:[ ]+(?:{'|'.join(SUFFIXES)}))?"
_UNIT = r"(?iuU)^[ ]*(libro|t[ií]tulo|cap[ií]tulo|secci[oó]n|subsecci[oó]n)[ ]+(preliminar|[ivxlcdm]+|[0-9]+(?:[.ºª])?|(?:primer|segund|tercer|cuart|quint|sext|s[eé]ptim|octav|noven|d[eé]cim|[uú]nic)[oa])\b"
_ARTICLE = rf"(?iuU)^[ ]*(?:art[ií]culo|art\.)[ ]+([0-9]+(?:\.[0-9]+)*{_SUFFIX}|[uú]nico)\b"
_NUMBER = rf"[0-9]+(?:\.[0-9]+)?{_SUFFIX}"
#: Article numbers of a scope, unless an exception is opened in the 25 characters before them.
_LISTED = rf"(?iuU)(?<!excepto.{{0,18}})(?<!salvo.{{0,20}})\bart[ií]culos?[ ]+({_NUMBER}(?:[ ]*(?:a|al|-|y|,)[ ]*{_NUMBER})*)"
_EXCEPT = r"(?iu)(?:excepto|salvo)[ ]+(?:los[ ]+)?art[ií]culos?[ ]+([^.;)]+)"


def _plain(x: Column) -> Column:
    return F.btrim(collapsed(F.lower(unaccented(x))), F.lit(" .,:;"))


def unit(text: Column) -> Column:
    """``kind, value`` of the unit that a text begins with, else null: ``CAPÍTULO II. De …`` is (capitulo, 2)."""
    return _unit(collapsed(text))


def _unit(t: Column) -> Column:
    kind, value = F.regexp_extract(t, _UNIT, 1), F.regexp_extract(t, _UNIT, 2)
    numbers = F.create_map(*[F.lit(x) for k, o in enumerate(ORDINALS, 1) for x in (o, str(k))])
    plain = F.translate(_plain(value), "ºª.", "")
    named = F.try_element_at(numbers, F.regexp_replace(plain, "[oa]$", ""))
    return F.when(kind != "", F.struct(_plain(kind).alias("kind"), F.coalesce(named, unit_value(value)).alias("value")))


def article(text: Column) -> Column:
    """The article that an index line names, else null."""
    return _article(collapsed(text))


def _article(t: Column) -> Column:
    found = F.regexp_extract(t, _ARTICLE, 1)
    return F.when(found != "", F.btrim(_plain(found), F.lit(" .ºª")))


def articles_of(expression: Column) -> Column:
    """``1 a 5`` (also ``al`` and ``-``) as all numbers between, else each number that is named, with its suffix."""
    e = F.translate(_plain(expression), ",", ".")
    between = r"^([0-9]+) *(?:al|a|-) *([0-9]+)$"
    lo, hi = F.regexp_extract(e, between, 1).try_cast("long"), F.regexp_extract(e, between, 2).try_cast("long")
    named = F.transform(F.regexp_extract_all(e, F.lit(_NUMBER), F.lit(0)), lambda x: F.btrim(_plain(x), F.lit(" .ºª")))
    return F.when(lo <= hi, F.transform(F.sequence(lo, hi), lambda n: n.cast("string"))).otherwise(named)


def article_key(name: Column) -> Column:
    """Numbers of an article and the rank of its suffix; articles without a number come last."""
    numbers = F.transform(F.regexp_extract_all(name, F.lit("[0-9]+"), F.lit(0)), lambda x: F.coalesce(x.try_cast("long"), F.lit(10**18)))
    suffix = F.coalesce(*[F.when(name.contains(x), k) for k, x in enumerate(SUFFIXES, 1)], F.lit(0)).cast("long")
    return F.when(F.size(numbers) == 0, F.array(F.lit(10**9).cast("long"))).otherwise(F.concat(numbers, F.array(suffix)))


def scope_parts(scope: Column) -> dict[str, Column]:
    """``listed`` and ``excluded`` articles and ``path``, a map of unit kinds to values, of a scope's text."""
    t = collapsed(scope)
    listed = F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(t, F.lit(_LISTED), F.lit(1)), articles_of)))
    units = F.filter(F.transform(F.split(t, " *(?:,|>|;) *"), unit), lambda u: u.isNotNull())
    # of one kind named twice the last counts
    path = F.map_from_entries(F.filter(units, lambda u, i: ~F.exists(F.slice(units, i + 2, F.size(units)), lambda v: v["kind"] == u["kind"])))
    return {"listed": listed, "excluded": articles_of(F.regexp_extract(t, _EXCEPT, 1)), "path": path}


def parse_index(lines: DataFrame) -> DataFrame:
    """``norm_id, article, key, pos, path`` of an index's lines (``norm_id, pos, line``), each article once.

    Of several lines of an article the one within most units counts, then the first. ``key`` orders articles by their
    numbers and suffix, whatever the order of the lines. A unit line opens a unit within the open ones of outer kinds and closes the rest; lines of over 300 characters
    open none. ``path`` maps the kinds of the units around an article to their values.
    """
    rows = lines.select("norm_id", "pos", collapsed(F.col("line")).alias("t"))
    rows = rows.select("norm_id", "pos", F.when(F.length("t") <= 300, _unit(F.col("t"))).alias("u"), _article(F.col("t")).alias("article"))
    w = Window.partitionBy("norm_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    for k, kind in enumerate(UNITS):
        # open if no outer unit was opened since
        last = F.last(F.when(F.col("u.kind").isin(*UNITS[: k + 1]), F.col("u")), True).over(w)
        rows = rows.withColumn(kind, F.when(last["kind"] == kind, last["value"]))
    around = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in UNITS]), lambda u: u["value"].isNotNull()))
    found = rows.filter("article is not null and u is null").select("norm_id", "article", article_key(F.col("article")).alias("key"), "pos", around.alias("path"))
    first = F.row_number().over(Window.partitionBy("norm_id", "article").orderBy(F.size("path").desc(), "pos"))
    return found.withColumn("nth", first).filter("nth = 1").drop("nth")


def resolve_scopes(index: DataFrame, scopes: DataFrame) -> DataFrame:
    """Articles of each scope: ``scope_id, nth, article, error`` (``index`` as of ``parse_index``; ``scopes``: scope_id, norm_id, scope).

    Named articles count, in the order of the text; if one isn't in the index, the scope gives only its ``MISSING``
    ones. Else units count: articles whose path holds all of them (``EMPTY`` if there is none). Else the whole norm.
    Excluded articles are taken off. Null scopes are whole norms.

    A named article and the innermost unit of a path are places of a norm (kind, value). Scopes meet the index once, by norm and place, so a
    scope reads the articles of its smallest unit only; outer units are compared as they meet. A scope's text is read once, however many norms ask it.
    """
    text = F.coalesce("scope", F.lit(""))
    place = lambda kind, value: F.struct(kind.alias("kind"), value.alias("value"))
    inner = lambda path: F.coalesce(*[F.when(F.map_contains_key(path, k), place(F.lit(k), path[k])) for k in reversed(UNITS)], place(F.lit(""), F.lit("")))
    # parsed from the result of the grouping: a filter on parts of its key would be moved before it, to every scope
    spelt = scopes.groupBy(text.alias("_text")).agg(F.max(text).alias("_spelt"))
    spelt = spelt.select("_text", *[v.alias(k) for k, v in scope_parts(F.col("_spelt")).items()])
    at = F.when(F.size("listed") > 0, F.transform("listed", lambda a: place(F.lit("articulo"), a))).otherwise(F.array(inner(F.col("path"))))
    spelt = spelt.select("_text", (F.size("listed") > 0).alias("named"), "excluded", F.col("path").alias("want"), at.alias("places"))
    asked = scopes.select("scope_id", "norm_id", text.alias("_text")).join(spelt, "_text").select("scope_id", "norm_id", "named", "excluded", "want", F.posexplode("places").alias("k", "at"))

    every = F.concat(F.array(place(F.lit(""), F.lit("")), place(F.lit("articulo"), F.col("article"))), F.transform(F.map_entries("path"), lambda e: place(e["key"], e["value"])))
    places = index.select(F.col("norm_id").alias("_norm"), "article", "key", "pos", "path", F.explode(every).alias("_at"))
    holds = F.forall(F.map_entries("want"), lambda e: F.coalesce(F.try_element_at(F.col("path"), e["key"]) == e["value"], F.lit(False)))
    met = (F.col("norm_id") == F.col("_norm")) & (F.col("at") == F.col("_at")) & (F.col("named") | (holds & ~F.array_contains("excluded", F.col("article"))))
    found, name = F.col("article").isNotNull(), F.coalesce("article", "at.value")
    rows = asked.join(places, met, "left").select("scope_id", "named", "k", found.alias("found"), F.when(F.col("named"), name).otherwise(F.col("article")).alias("article"), "key", "pos", F.array_contains("excluded", name).alias("left_out"), (F.size("want") > 0).alias("asks"))
    of = Window.partitionBy("scope_id")
    rows = rows.withColumn("broken", F.max(F.col("named") & ~F.col("found")).over(of)).withColumn("nth", F.row_number().over(of.orderBy("key", "pos")))
    kept = F.when(F.col("broken"), ~F.col("found")).when(F.col("named"), ~F.col("left_out")).otherwise(F.col("found") | F.col("asks"))
    error = F.when(F.col("broken"), "MISSING").when(~F.col("found"), "EMPTY")
    return rows.filter(kept).select("scope_id", F.when(F.col("named"), F.col("k") + 1).otherwise(F.col("nth")).alias("nth"), "article", error.alias("error"))
