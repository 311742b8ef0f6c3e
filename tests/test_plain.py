"""Text rules that SQL can't express, against plain versions of them over whole tables."""

from __future__ import annotations

import json
import re
import unicodedata

import pytest
from oracle import SF
from pyspark.sql import functions as F

from quillbank.functions import textnorm as tx
from quillbank.plans.fixtures import tables


def bare(x: str) -> str:
    return " ".join("".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).lower().split())


def article(x: str | None) -> str | None:
    t = " ".join((x or "").split())
    suffix = r"(?:\s+(?:bis|ter|quater|quinquies|sexies|septies|octies|nonies|decies))"
    token = rf"\d+(?:(?:\.\d+)+)?{suffix}?(?:\.[A-Za-z])?|\d+{suffix}(?:(?:\.\d+)+)?(?:\.[A-Za-z])?"
    if not t or re.search(r"(?i)^\s*\d+(?:\.\w+)*\s+y\s+\d+", t):
        return None
    m = re.search(rf"(?i)\b(?:art[ií]culo|art\.)\s*({token})", t) or re.search(rf"(?i)^\s*({token})(?=\s*(?:$|\)|,|;|de\b|del\b|apartado\b|\(|t[ií]tulo\b|cap[ií]tulo\b|libro\b|parte\b))", t)
    if m is None or re.match(r"^\)\s*\d+\s*\.?[ºª]", t[m.end() :]):
        return None
    out = re.sub(r"\s*\.\s*", ".", m[1].strip()).lower()
    section, letter = re.search(r"(?i)\bapartado\s+(\d+(?:\.\d+)*)\b", t[m.end() :]), re.search(r"(?i)\bletra\s+([A-Za-z])\b", t[m.end() :])
    if section and "." not in out.split(" ")[0]:
        out += "." + section[1]
    return out + ("." + letter[1].lower() if letter and not re.search(r"\.[a-z]$", out) else "")


def citation(x: str | None) -> tuple | None:
    t = bare(x or "")
    kinds = [(r"real decreto legislativo",) * 2, (r"real decreto[\s-]+ley", "real decreto-ley"), (r"decreto legislativo",) * 2, (r"decreto[\s-]+ley", "decreto-ley"), *[(k, k) for k in ("ley organica", "real decreto", "ley", "decreto", "orden")]]
    for pattern, kind in kinds:
        if m := re.search(rf"\b({pattern})\s+(\d+)\s*[/_-]\s*(\d{{4}})\b", t):
            break
    else:
        return None
    d = re.search(rf"\bde\s+(\d{{1,2}})\s+de\s+{tx.MONTH}(?:\s+de\s+(\d{{4}}))?\b", t)
    date = f"{d[3] or m[3]}-{tx.MONTHS.index('septiembre' if d[2] == 'setiembre' else d[2]) + 1:02d}-{int(d[1]):02d}" if d else ""
    return kind, m[2], m[3], date, "valenciana" if any(s in t for s in ("comunitat valenciana", "comunidad valenciana", "generalitat valenciana", "consell")) else ""


MORE = [
    "artículo 5 apartado 2 letra b", "ARTÍCULO 12.3 Letra C", "14, apartado 3", "7 y 8", "art. 3) 2.º", "3.b de la ley", "21 ter del título II", "9.A", "Artículo 9 . 2", "según art.4 bis", "parte 3", "10 capítulo", "5 sobre", "artículo 7 sexies.1.c de", "5 bis.2 de la ley", "art. 5.apartado 6", "4 decies, letra z", "(artículo 6)", "artículos 4", None, "",
    "Ley 6/2025, de 3 de mayo", "Orden 3/2010 y Decreto 5 / 1999, de 12 de setiembre de 2000 del Consell", "RESOLUCIÓN 4/2010", "Real  Decreto-Ley 7_2012", "Decreto ley 8-1990 de la Generalitat Valenciana", "Ley 1/20", "Real Decreto 2/2003 que aplica la Ley Orgánica 3/2002",
]


@pytest.mark.parametrize("rule", ["article", "citation", "casefold"])
def test_rules_over_whole_tables(spark, rule):
    (rows,) = tables(spark, SF, "f_citations")
    (stems,) = tables(spark, SF, "f_stems")
    texts = rows.select(F.explode(F.array("name", "article", "stem")).alias("t")).union(stems.select("stem")).union(spark.createDataFrame([(x,) for x in MORE], "t string")).distinct()
    value = {"article": tx.article_unambiguous(F.col("t")), "citation": F.to_json(tx.citation_parts(F.col("t"))), "casefold": tx.norm_nfkc_casefold(F.col("t"))}[rule]
    got = {r["t"]: r["v"] for r in texts.select("t", value.alias("v")).collect()}
    assert len(got) > 1000
    if rule == "citation":
        assert {t: tuple(json.loads(v).values()) if v else None for t, v in got.items()} == {t: citation(t) for t in got}
    else:
        plain = {"article": article, "casefold": lambda t: " ".join(unicodedata.normalize("NFKC", t or "").casefold().split())}[rule]
        assert got == {t: plain(t) for t in got}
