"""Text normalisers and per-row rules as column functions. Each rule has its own name: the normalisers are not interchangeable."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Patterns ignore case and see words as Unicode does: accented capitals fold, and ``\\b``, ``\\w``, ``\\s``, ``\\d`` mean all scripts.
FLAGS = "(?iuU)"
ACCENTED = "áàäâãåéèëêíìïîóòöôõúùüûñçÁÀÄÂÃÅÉÈËÊÍÌÏÎÓÒÖÔÕÚÙÜÛÑÇ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC"
#: White space that regular expressions of both dialects agree on.
BLANK = r"[ \t\n\x0b\f\r]"
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
#: How a month may be written, and suffixes of inserted articles in their order.
MONTH = "(" + "|".join([*MONTHS[:9], "setiembre", *MONTHS[9:]]) + ")"
SUFFIXES = ("bis", "ter", "quater", "quinquies", "sexies", "septies", "octies", "nonies", "decies")


def unaccented(x: Column) -> Column:
    return F.translate(x, ACCENTED, PLAIN)


def collapsed(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, f"{BLANK}+", " "))


def norm_spaces_lower(x: Column) -> Column:
    """No-break spaces and runs of white space become one blank; lower case."""
    return F.lower(collapsed(F.translate(F.coalesce(x, F.lit("")), " ", " ")))


def norm_ascii_alnum(x: Column) -> Column:
    """Lower case without accents; everything but a-z and 0-9 becomes one blank."""
    return F.trim(F.regexp_replace(F.lower(unaccented(F.coalesce(x, F.lit("")))), "[^a-z0-9]+", " "))


def norm_quotes(x: Column) -> Column:
    """Lower case without accents; typographic double quotes become plain ones."""
    return collapsed(F.translate(F.lower(unaccented(F.coalesce(x, F.lit("")))), "“”«»", '""""'))


def norm_punct(x: Column) -> Column:
    r"""Lower case without accents; ``_ / \ . , ; : ( ) [ ] { } -`` become blanks."""
    return collapsed(F.regexp_replace(F.lower(unaccented(F.coalesce(x, F.lit("")))), r"[_/\\.,;:()\[\]{}\-]+", " "))


def norm_keep_accents(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-záéíóúüñ0-9%]+", " "))


@F.pandas_udf(T.StringType())
def norm_nfkc_casefold(x: pd.Series) -> pd.Series:
    """Compatibility composition and full case folding, which no built-in function has."""
    return x.map(lambda t: " ".join(unicodedata.normalize("NFKC", t or "").casefold().split()))


#: Texts of these characters alone are composed: none of them has a compatibility form or combines with the one before.
COMPOSED = r"^[\x00-\x9f¡-§©«¬®°±¶»¿-ÿ–—‘’“”]*$"


@F.arrow_udf(T.StringType())
def _composed(x: pa.Array) -> pa.Array:
    # a few texts at a time are held as Python's
    parts = [pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in x.slice(at, 64).to_pylist()], pa.string()) for at in range(0, len(x), 64)]
    return pa.concat_arrays([pa.array([], pa.string()), *parts])


def nfkc(x: Column) -> Column:
    """Compatibility composition, which no built-in function has; only texts that may change go through Arrow."""
    return F.coalesce(_composed(F.when(~x.rlike(COMPOSED), x)), x)


def norm_citation(x: Column) -> Column:
    """Compatibility composition in lower case; quotes and punctuation of citations become blanks."""
    return citation_words(nfkc(F.coalesce(x, F.lit(""))))


def citation_words(x: Column) -> Column:
    """:func:`norm_citation` of a text that is composed already."""
    return collapsed(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[\"'“”«»’‘.,;:()\\[\\]–—-]", " "))


def _article_text(x: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(unaccented(F.coalesce(x, F.lit(""))))), rf"^(articulo|art)\.?{BLANK}*", "")


def article_base(x: Column) -> Column:
    """Main article: ``Art. 24.1`` is ``24``, ``14-bis`` is ``14 bis``; null if it doesn't start with a number."""
    t = _article_text(x)
    pattern = r"^([0-9]+)(?:[ \t.\-]*(bis|ter|quater|quinquies))?"
    number, suffix = F.regexp_extract(t, pattern, 1), F.regexp_extract(t, pattern, 2)
    plain = F.regexp_replace(number, "^0+([0-9])", "$1")
    return F.when(number != "", F.when(suffix != "", F.concat(plain, F.lit(" "), suffix)).otherwise(plain))


def article_full(x: Column) -> Column:
    """Reference with its sub-sections: ``23,2`` is ``23.2``; null if any other text remains."""
    t = F.regexp_replace(F.translate(_article_text(x), ",", "."), f"{BLANK}+", " ")
    t = F.regexp_replace(t, r"^([0-9]+)[ .\-]*(bis|ter|quater|quinquies)($|[. ])", "$1 $2$3")
    return F.when(t.rlike(r"^[0-9]+( (bis|ter|quater|quinquies))?(\.[0-9a-z]+)*$"), t)


def article_unambiguous(x: Column) -> Column:
    """Explicit or leading article with its section and letter; null for several or ordinal ones."""
    suffix = f"(?: +(?:{'|'.join(SUFFIXES)}))"
    token = rf"[0-9]+(?:(?:\.[0-9]+)+)?{suffix}?(?:\.[A-Za-z])?|[0-9]+{suffix}(?:(?:\.[0-9]+)+)?(?:\.[A-Za-z])?"
    t = collapsed(F.coalesce(x, F.lit("")))
    explicit = rf"(?iuU)^.*?\b(?:art[ií]culo|art\.) *({token})(.*)$"
    leading = rf"(?iuU)^({token})(?= *(?:$|[),;(]|de\b|del\b|apartado\b|t[ií]tulo\b|cap[ií]tulo\b|libro\b|parte\b))(.*)$"
    which = F.when(t.rlike(explicit), F.struct(F.regexp_extract(t, explicit, 1).alias("a"), F.regexp_extract(t, explicit, 2).alias("rest"))).when(
        t.rlike(leading), F.struct(F.regexp_extract(t, leading, 1).alias("a"), F.regexp_extract(t, leading, 2).alias("rest"))
    )
    number, rest = F.lower(F.regexp_replace(which["a"], r" *\. *", ".")), which["rest"]
    section, letter = F.regexp_extract(rest, r"(?iuU)\bapartado +([0-9]+(?:\.[0-9]+)*)\b", 1), F.regexp_extract(rest, r"(?iuU)\bletra +([A-Za-z])\b", 1)
    whole = F.when((section != "") & ~F.split(number, " ")[0].contains("."), F.concat(number, F.lit("."), section)).otherwise(number)
    whole = F.when((letter != "") & ~whole.rlike(r"\.[a-z]$"), F.concat(whole, F.lit("."), F.lower(letter))).otherwise(whole)
    several = t.rlike(r"(?iuU)^ *[0-9]+(?:\.\w+)* +y +[0-9]+") | rest.rlike(r"^\) *[0-9]+ *\.?[ºª]")
    return F.when(which.isNotNull() & ~several, whole)


def article_precise(x: Column) -> Column:
    """Article at the start, or after an article marker; never the number of the law. Null if there is none."""
    ref = r"([0-9]+(?:\.[0-9]+)*(?: *(?:bis|ter|quater|quinquies))?(?:\.[A-Za-z])?)"
    t = collapsed(F.coalesce(x, F.lit("")))
    first, marked = F.regexp_extract(t, f"(?iu)^{ref}", 1), F.regexp_extract(t, rf"(?iu)(?:art[ií]culo|art\.) *{ref}", 1)
    return F.coalesce(F.nullif(first, F.lit("")), F.nullif(marked, F.lit("")))


#: Kinds of norms that are named by number and year, as patterns on the lower-case name without accents; what their identity starts with.
NORM_KINDS = (
    ("ley organica", "ley organica"), ("real decreto legislativo", "real decreto legislativo"), ("real decreto", "real decreto"), ("decreto legislativo", "decreto legislativo"),
    (r"decreto[- ]+ley", "decreto ley"), ("decreto", "decreto"), ("ley", "ley"),
    (r"directiva(?: *\( *ue *\)| +ue)?", "directiva ue"), (r"reglamento *\( *ue *, *euratom *\)", "reglamento ue euratom"), (r"reglamento(?: *\( *ue *\)| +ue)?", "reglamento ue"),
)
#: Other names of norms.
ALIASES = {
    "estatuto de los trabajadores": "real decreto legislativo 2/2015",
    "estatuto de autonomia": "ley organica 5/1982",
    "ley organica del poder judicial": "ley organica 6/1985",
    "ley organica del regimen electoral general": "ley organica 5/1985",
    "ley de expropiacion forzosa": "ley de expropiacion forzosa de 1954",
    "real decreto 2/2015": "real decreto legislativo 2/2015",
    "real decreto 5/2015": "real decreto legislativo 5/2015",
    "ley 3/2018": "ley organica 3/2018",
    "tfue": "tratado de funcionamiento de la union europea",
    "tue": "tratado de la union europea",
    "constitucion espanola de 1978": "constitucion espanola",
    "constitucion espanola.": "constitucion espanola",
}


def _aliased(x: Column, aliases: dict[str, str]) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in aliases.items() for v in kv]), x), x)


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def norm_identity(x: Column, aliases: dict[str, str] = ALIASES) -> Column:
    """Identity of a norm: the kind, number and year that occur first, the date that follows if any; else the plain name. Aliases apply last.

    Many patterns are tried, so callers reduce a table to its distinct names before.
    """
    plain = F.regexp_replace(F.translate(unaccented(F.lower(F.trim(F.coalesce(x, F.lit(""))))), "_", " "), f"{BLANK}+", " ")
    date = rf"\bde ([0-9]{{1,2}}) de {MONTH}(?: de ([0-9]{{4}}))?\b"

    def first(t: Column) -> Column:
        found = []
        for order, (pattern, kind) in enumerate(NORM_KINDS):
            whole = pattern + (" +([0-9]{4}) */? *([0-9]+)" if order >= 7 else " +([0-9]+) */? *([0-9]{4})")
            key = F.concat(F.lit(f"{kind} "), F.regexp_extract(t, whole, 1), F.lit("/"), F.regexp_extract(t, whole, 2))
            at = F.length(F.regexp_extract(t, f"^(.*?){whole}", 1))
            found.append(F.when(t.rlike(whole), F.struct(at.alias("at"), F.lit(order).alias("order"), key.alias("key"))))
        return F.array_min(F.filter(F.array(*found), lambda s: s.isNotNull()))

    def dated(best: Column, t: Column) -> Column:
        rest = F.substring(t, best["at"] + 1, F.length(t))
        day, month, year = (F.regexp_extract(rest, date, k) for k in (1, 2, 3))
        tail = F.concat(F.lit(" de "), F.regexp_replace(day, "^0", ""), F.lit(" de "), F.when(month == "setiembre", "septiembre").otherwise(month), F.when(year != "", F.concat(F.lit(" de "), year)).otherwise(""))
        return F.coalesce(F.concat(best["key"], F.when(day != "", tail).otherwise("")), t)

    return bound(bound(plain, lambda t: bound(first(t), lambda b: dated(b, t))), lambda k: _aliased(k, aliases))


def norm_identity_undated(x: Column) -> Column:
    """Identity without its final date, where it has a number and year."""
    dated = rf" +de [0-9]{{1,2}} de {MONTH}(?: de [0-9]{{4}})?$"
    return F.when(x.rlike(r"\b[0-9]+/[0-9]{4}\b"), F.trim(F.regexp_replace(x, dated, ""))).otherwise(x)


#: Spellings of formal kinds of norms.
FORMAL_KINDS = {
    "LEY": "LEY", "LEY_ORGANICA": "LEY_ORGANICA", "LO": "LEY_ORGANICA", "REAL_DECRETO": "REAL_DECRETO", "RD": "REAL_DECRETO",
    "REAL_DECRETO_LEGISLATIVO": "REAL_DECRETO_LEGISLATIVO", "DECRETO_LEGISLATIVO": "DECRETO_LEGISLATIVO", "DECRETO": "DECRETO", "DECRETO_LEY": "DECRETO_LEY",
}


def formal_rule(kind: Column, name: Column) -> Column:
    """Name of a norm by the general rule: a formal kind and exactly one number/year in the name; else null (pending)."""
    k = F.regexp_replace(F.trim(F.upper(unaccented(kind))), "[ -]+", "_")
    canon = reduce(lambda acc, kv: F.when(k == kv[0], F.lit(kv[1])).otherwise(acc), FORMAL_KINDS.items(), F.lit(None).cast("string"))
    numbers = F.regexp_extract_all(name, F.lit(r"([0-9]+) */ *([0-9]{4})"), F.lit(0))
    number = F.regexp_replace(F.regexp_replace(numbers[0], " ", ""), "^0+([0-9])", "$1")
    return F.when(F.size(numbers) == 1, F.concat(canon, F.lit(" "), number))


#: Kinds of norms in the order in which they are looked for.
CITED_KINDS = (
    (r"real decreto legislativo", "real decreto legislativo"), (r"real decreto[ -]+ley", "real decreto-ley"), (r"decreto legislativo", "decreto legislativo"), (r"decreto[ -]+ley", "decreto-ley"),
    (r"ley organica", "ley organica"), (r"real decreto", "real decreto"), (r"ley", "ley"), (r"decreto", "decreto"), (r"orden", "orden"),
)


def citation_parts(x: Column) -> Column:
    """Struct ``(kind, number, year, date, scope)`` of a citation; null if it has no kind, number and year.

    Kinds are tried in their order, each anywhere in the text: a law that is cited goes before a decree cited earlier.
    """

    def first(t: Column) -> Column:
        # a citation holds a number and its year
        return F.when(t.rlike(r"[0-9] *[/_-] *[0-9]{4}\b"), F.coalesce(*[F.when(t.rlike(p), F.struct(F.lit(kind).alias("kind"), F.regexp_extract(t, p, 1).alias("number"), F.regexp_extract(t, p, 2).alias("year"))) for k, kind in CITED_KINDS for p in (rf"\b{k} ([0-9]+) *[/_-] *([0-9]{{4}})\b",)]))

    return bound(norm_spaces_lower(unaccented(x)), lambda t: bound(first(t), lambda found: F.when(found.isNotNull(), _dated_citation(found, t))))


def _dated_citation(found: Column, t: Column) -> Column:
    year = found["year"]
    date = rf"\bde ([0-9]{{1,2}}) de {MONTH}(?: de ([0-9]{{4}}))?\b"
    day, month, dated = (F.regexp_extract(t, date, k) for k in (1, 2, 3))
    at = F.array_position(F.array(*map(F.lit, MONTHS)), F.when(month == "setiembre", "septiembre").otherwise(month))
    iso = F.when(day != "", F.concat_ws("-", F.when(dated != "", dated).otherwise(year), F.lpad(at.cast("string"), 2, "0"), F.lpad(day, 2, "0"))).otherwise("")
    scope = F.when(t.rlike("comuni(tat|dad) valenciana|generalitat valenciana|consell"), "valenciana").otherwise("")
    return F.struct(found["kind"].alias("kind"), found["number"].alias("number"), year.alias("year"), iso.alias("date"), scope.alias("scope"))


def cited_norms(x: Column) -> Column:
    """Sorted ``number/year`` of all norms cited; two-digit years over 30 are of the last century."""
    cited = F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(r"(?U)\b([0-9]{1,4})\s*/\s*([0-9]{2,4})\b"), F.lit(0))

    def one(c: Column) -> Column:
        number, year = F.trim(F.split(c, "/")[0]), F.trim(F.split(c, "/")[1])
        year = F.when(F.length(year) == 2, F.concat(F.when(year.cast("int") > 30, "19").otherwise("20"), year)).otherwise(year)
        return F.concat_ws("/", number.cast("int").cast("string"), year)

    return F.array_sort(F.array_distinct(F.transform(cited, one)))


#: Words that mark a bracket as the origin of an item, as an instruction, or as part of the text, and its meta data.
ORIGIN = (
    r"(?iuU)(\b(19|20)\d{2}\b|\bOPE\b|\boficial\b|\bcuerpo\b|\bAGE\b|\bGVA\b|auxiliar|\baux\b|administrativ|adtivo|advo|estabilizaci|turno|promoci|\bTAG\b"
    r"|\b[ABC][12]\b|t[eé]cnico|subalterno|gesti[oó]n\b|\bgen(eralitat)?\b|ayuntamiento|diputaci|\bconsell\b|\bOEP\b|\bGACE\b|orientador|libre|covid|examen|convocatoria|oposici|bolsa|admón|admon)"
)
INSTRUCTION = r"(?iuU)^\s*(señal|indi|marqu|elij|escoj|seleccion|respuesta|opción|afirmaci)"
NO_ORIGIN = (
    r"(?iuU)^\s*(ley\b|lo\b|l\.o\.|rd\b|real decreto|decreto|art[íi]?c?u?l?o?\.?\s*\d|art\.|artículo|en adelante|considere|se asume|se entiende|nota|o\s|y\s|y,|disposiciones|consell\s*$)"
    r'|[:;"=]|^[A-Z]\d+-[A-Z]\d+$'
)
META = r"(?iuU)^\s*dificultad\b"


def strip_trailing_origin(x: Column) -> Column:
    """Drop a final bracket that names the item's origin or its difficulty; final punctuation stays."""
    tail = r"(?U)\s*\(([^()]{2,160})\)\s*([:.?]?)\s*$"
    inner, mark = F.regexp_extract(x, tail, 1), F.regexp_extract(x, tail, 2)
    base = F.rtrim(F.regexp_replace(x, tail, ""))
    origin = (inner != "") & (inner.rlike(META) | (inner.rlike(ORIGIN) & ~inner.rlike(INSTRUCTION) & ~inner.rlike(NO_ORIGIN)))
    return F.when(origin, F.when(F.endswith(base, mark), base).otherwise(F.concat(base, mark))).otherwise(x)


def strip_origin_anywhere(x: Column) -> Column:
    words = r"ayuntamiento|diputaci[oó]n|mancomunidad|bolsa\s+(?:de|para)|convocatoria|oposiciones?|examen(?:\s+tipo)?|proceso\s+selectivo|prueba\s+selectiva"
    cut = F.regexp_replace(x, rf"(?iuU)\s*[(\[][^()\[\]]*(?:{words})[^()\[\]]*[)\]]", "")
    return F.btrim(F.regexp_replace(cut, f"{BLANK}{{2,}}", " "), F.lit(" ;,.-"))


#: Phrases of stems and what they become; the first that occurs is replaced once.
PHRASES = (
    (r"\bconforme +la +", "Según la "), (r"\bconforme +el +", "Según el "), (r"\bconforme +(?:a|al|a +la) +", "Según "),
    (r"\bindique +(?:cu[aá]l +es +)?la +respuesta +correcta\b", "señale la afirmación correcta"), (r"\bindique +la +opci[oó]n +correcta\b", "señale la opción correcta"),
    (r"\bseñale +la +respuesta +correcta\b", "señale la afirmación correcta"),
)


#: Whole stems and what they become (``$k``: the k-th group); they go before the phrases.
WHOLE_STEMS = (
    (r"^Las normas dictadas por el Estado:?$", "Respecto de las normas dictadas por el Estado, señale la opción correcta."),
    (r"^¿Cuál de los siguientes principios no está recogido en (.+?)\?$", "Indique el principio que no figura en $1."),
    (r"^¿Cuál es la especialidad en relación con (.+?) según (.+?)\?$", "Según $2, ¿qué particularidad presenta $1?"),
    (r"^Señale la respuesta incorrecta, de conformidad con (.+?):$", "De conformidad con $1, identifique la afirmación incorrecta:"),
    (r"^Por lo que respecta a (.+?) y tal y como dispone (.+?), (.+?) indique cuál será éste:$", "De acuerdo con $2, $3 ¿Cuál es el límite aplicable?"),
)


def rephrase_stem(x: Column) -> Column:
    """Rewrite a whole stem that is known, else replace the first phrase rule that applies, once; other text stays."""
    t = F.trim(x)
    phrases = reduce(lambda acc, r: F.when(t.rlike(f"{FLAGS}{r[0]}"), F.regexp_replace(t, rf"(?isuU)^(.*?){r[0]}(.*)$", f"$1{r[1]}$2")).otherwise(acc), reversed(PHRASES), x)
    return reduce(lambda acc, r: F.when(t.rlike(f"(?iu){r[0]}"), F.regexp_replace(t, f"(?iu){r[0]}", r[1])).otherwise(acc), reversed(WHOLE_STEMS), phrases)


def dehyphenate(x: Column) -> Column:
    """Join words cut at line ends; soft hyphens go; white space collapses."""
    return collapsed(F.regexp_replace(F.translate(x, "­", ""), rf"-[ \t]*\n{BLANK}*([0-9A-Za-záéíóúüñÁÉÍÓÚÜÑ])", "$1"))


#: Marks of practical questions (on text without accents): an acting subject, a case, a hypothesis, a detail, an action.
SUBJECT = r"\b((una? (ciudadan[oa]|interesad[oa]|funcionari[oa]|emplead[oa] +public[oa]|trabajadora?|aspirante|solicitante|contratista|licitadora?|empresa|sociedad|mercantil|asociacion|ayuntamiento)|la conselleria +[a-z])\b|(don|dona|senor|senora|sr\.?|sra\.?) +[a-z])"
CASE = r"\b(se presenta personalmente|ha presentado|presenta una solicitud|interpone una?|solicita (un|una|el|la)|recibe (un|una|el|la)|se le notifica|se le comunica|esta tramitando|se encuentra tramitando|ante la siguiente situacion|supuesto practico|supuesto de hecho|en el siguiente supuesto|en el caso planteado)\b"
HYPOTHESIS = r"\b(en caso de que|en el supuesto de que|suponiendo que|suponga que|imaginemos que|si una?|si la persona|si el interesado|si se (presenta|solicita|interpone|produce)|que ocurriria si|que procederia)\b"
DETAIL = r"\b([0-9]{1,2}:[0-9]{2}|[0-9]{1,2} de [a-z]+ de [0-9]{4}|[0-9]+([.,][0-9]+)? *euros?|durante [0-9]+ (dias?|meses|horas?))\b"
ACTION = r"\b(presenta|presentado|solicita|solicitado|interpone|notifica|notificado|tramita|recibe|recibido|comparece|fallece|incumple|comete|celebra|contrata|adjudica|reclama)\b"


def classify_theory_practice(stem: Column, whole: Column) -> Column:
    s, w = norm_spaces_lower(unaccented(stem)), norm_spaces_lower(unaccented(whole))
    practical = s.rlike(SUBJECT) | w.rlike(CASE) | w.rlike(HYPOTHESIS) | (w.rlike(DETAIL) & w.rlike(ACTION))
    return F.when(practical, "PRACTICA").otherwise("TEORICA")


#: How norms are written, in the order in which they are looked for, and what their kind begins with.
NORM_PATTERNS = (
    r"\bLey\s+Orgánica\s+\d+/\d{4}", r"\bLey\s+\d+/\d{4}", r"\bReal\s+Decreto(?:-ley|\s+Legislativo)?\s+\d+/\d{4}", r"\bDecreto(?:-ley|\s+Legislativo)?\s+\d+/\d{4}", r"\bConstitución\s+Española\b",
)
NORM_STARTS = (("ley orgánica", "LEY_ORGANICA"), ("ley ", "LEY"), ("real decreto", "REAL_DECRETO"), ("decreto", "DECRETO"))


def detect_norm_article(x: Column) -> Column:
    """Struct ``(state, kind, norm, article)``: legal if the text names a norm and an article, else pending.

    The norm is the first text of the first pattern that occurs anywhere, so a law later in the text goes before a decree.
    """
    first = lambda p, group: F.get(F.regexp_extract_all(x, F.lit(f"{FLAGS}{p}"), F.lit(group)), F.lit(0))
    *numbered, constitution = NORM_PATTERNS
    # the numbered norms hold a slash, which is cheaper to look for than their patterns
    norm = F.coalesce(F.when(x.contains("/"), F.coalesce(*[first(p, 0) for p in numbered])), first(constitution, 0))
    article = first(r"\bart(?:í|i)culo(?:s)?\s+(\d+(?:\.\d+)*)", 1)

    def of(found: Column) -> Column:
        norm, article = found["norm"], found["article"]
        kind = F.when(norm.isNotNull(), F.coalesce(*[F.when(F.startswith(F.lower(norm), F.lit(start)), F.lit(k)) for start, k in NORM_STARTS], F.lit("CONSTITUCION")))
        return F.struct(F.when(norm.isNotNull() & article.isNotNull(), "JURIDICA").otherwise("PENDIENTE").alias("state"), kind.alias("kind"), norm.alias("norm"), article.alias("article"))

    return bound(F.struct(collapsed(norm).alias("norm"), article.alias("article")), of)


#: What a norm's name starts with, in order, and its kind.
PREFIX_KINDS = (
    ("constitución", "CONSTITUCION"), ("ley orgánica", "LEY ORGANICA"), ("l.o.", "LEY ORGANICA"), ("real decreto legislativo", "REAL DECRETO LEGISLATIVO"), ("real decreto-ley", "REAL DECRETO-LEY"),
    ("real decreto", "REAL DECRETO"), ("decreto legislativo", "DECRETO LEGISLATIVO"), ("decreto-ley", "DECRETO-LEY"), ("decreto", "DECRETO"), ("tratado", "TRATADO"), ("reglamento", "REGLAMENTO"), ("ley", "LEY"),
)
STRICT_KINDS = (
    ("constitución", "CONSTITUCION"), ("constitucion", "CONSTITUCION"), ("ley orgánica", "LEY_ORGANICA"), ("ley organica", "LEY_ORGANICA"), ("real decreto legislativo", "REAL_DECRETO_LEGISLATIVO"),
    ("real decreto-ley", "DECRETO_LEY"), ("real decreto ley", "DECRETO_LEY"), ("decreto legislativo", "DECRETO_LEGISLATIVO"), ("decreto-ley", "DECRETO_LEY"), ("decreto ley", "DECRETO_LEY"),
    ("real decreto", "REAL_DECRETO"), ("ley ", "LEY"), ("decreto ", "DECRETO"), ("orden ", "ORDEN"), ("reglamento ", "REGLAMENTO"), ("tratado ", "TRATADO_UE"), ("directiva ", "DIRECTIVA"), ("gen-", "GEN"),
    ("carta de los derechos fundamentales de la unión europea", "CARTA"),
)


def kind_by_prefix(x: Column, kinds: tuple[tuple[str, str], ...]) -> Column:
    """Kind of the first prefix that fits the collapsed lower-case name; null if none does."""
    t = F.lower(collapsed(x))
    return reduce(lambda acc, k: F.when(t.startswith(k[0]), F.lit(k[1])).otherwise(acc), reversed(kinds), F.lit(None).cast("string"))


def category_normalise(x: Column, aliases: dict[str, str], known: list[str]) -> Column:
    """Upper case without accents, other characters as one ``_``; aliases; null outside of the closed list."""
    c = F.btrim(F.regexp_replace(F.upper(unaccented(x)), "[^A-Z0-9]+", "_"), F.lit("_"))
    c = _aliased(c, aliases)
    return F.when(c.isin(known), c)


def source_family(x: Column) -> Column:
    u = F.upper(x)
    return F.when(u.startswith("BOE-A-"), "BOE").when(u.startswith("DOGV-") | u.startswith("LOCAL-DOGV-"), "DOGV").when(u.startswith("DOUE-"), "DOUE").otherwise("LOCAL")


#: Absolute words and "all of them" options.
ABSOLUTE = r"(?iuU)\b(siempre|nunca|en ningún caso|en todo caso|exclusivamente|únicamente|solo|cualquier|todos? los|sólo|jamás|sin excepción|con independencia)\b"
ALL_OF_THEM = r"(?iu)todas (las )?(anteriores|opciones|respuestas)? ?(son )?correctas|todas las anteriores"


def long_words(x: Column) -> Column:
    """Distinct lower-case words of over five letters or digits."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit(r"[\p{L}\p{N}_]{6,}"), F.lit(0)))


def clue_score(stem: Column, options: list[Column], key: Column) -> Column:
    """0-100: how far an item gives its key away; null if the key isn't one of the options' letters."""
    letters = F.array(*[F.lit(c) for c in "ABCD"[: len(options)]])
    opts = F.array(*[F.coalesce(o, F.lit("")) for o in options])
    at = F.array_position(letters, key).cast("int")
    own = F.element_at(opts, F.when(at > 0, at).otherwise(1))
    sizes = F.transform(opts, F.length)
    most, second = F.element_at(F.sort_array(sizes, False), 1), F.element_at(F.sort_array(sizes, False), 2)
    length = F.when((F.length(own) == most) & (most > second), F.when(F.length(own) >= 1.3 * second, 35).otherwise(25)).otherwise(0)
    absolute = F.size(F.filter(opts, lambda o: o.rlike(ABSOLUTE)))
    loud = F.when(own.rlike(ABSOLUTE), 0).otherwise(F.least(F.lit(30), 12 * absolute))
    every = F.when(own.rlike(ALL_OF_THEM), 15).otherwise(0)
    words = long_words(stem)
    echoes = F.transform(opts, lambda o: F.size(F.array_intersect(words, long_words(o))))
    mine = F.element_at(echoes, F.when(at > 0, at).otherwise(1))
    echo = F.when((mine > 0) & (mine == F.array_max(echoes)) & (F.size(F.filter(echoes, lambda e: e == mine)) == 1), 15).otherwise(0)
    short = F.when(F.length(F.coalesce(stem, F.lit(""))) < 90, 10).otherwise(0)
    return F.when(at > 0, F.least(F.lit(100), length + loud + every + echo + short))


def difficulty_level(score: Column, generated: Column, newest: Column, kind: Column) -> Column:
    """Levels 1-4 from the clue score: generated items start one higher, those of the newest generator from 20 points; none for items that aren't legal."""
    low, mid = score < 20, score < 40
    old = F.when(low, 2).when(mid, 3).otherwise(4)
    new = F.when(low, 1).when(mid, 3).otherwise(4)
    human = F.when(low, 1).when(mid, 2).otherwise(3)
    return F.when(score.isNull() | kind.isNull() | (kind != "JURIDICA"), None).when(newest, new).when(generated, old).otherwise(human)


#: What a stem must hold to name a norm without a number, by what the norm's name holds.
NAMED_BY = (("constituci", "constituci"), ("estatut", "estatut"), ("tratado de funcionamiento", r"tratado de funcionamiento|TFUE"), ("tratado de la uni", r"tratado de la uni[oó]n|TUE\b"))


def names_norm(stem: Column, name: Column) -> Column:
    """Whether a stem names a norm by its number and year, or by its own word; true for norms that have neither."""
    low, number = F.lower(F.coalesce(name, F.lit(""))), F.regexp_extract(F.coalesce(name, F.lit("")), r"\b[0-9]{1,4}/[0-9]{4}\b", 0)
    by_word = reduce(lambda acc, r: F.when(low.contains(r[0]), stem.rlike(f"{FLAGS}{r[1]}")).otherwise(acc), reversed(NAMED_BY), F.lit(True))
    return F.when(number != "", stem.contains(number)).otherwise(by_word)


def option_defects(stem: Column, options: list[Column], key: Column, norm: Column | None = None, form: Column | None = None) -> Column:
    """Names of an item's defects, in order. ``norm``: the name of the norm that the stem should say; ``form``: the item's format."""
    opts = F.array(*[F.coalesce(o, F.lit("")) for o in options])
    sizes = F.transform(opts, F.length)
    words = long_words(stem)
    echoes = F.transform(opts, lambda o: F.size(F.array_intersect(words, long_words(o))))
    at = F.greatest(F.lit(1), F.array_position(F.array(*[F.lit(c) for c in "ABCD"]), key).cast("int"))
    others = F.array_max(F.transform(F.filter(F.arrays_zip(echoes.alias("e"), F.sequence(F.lit(1), F.lit(4)).alias("k")), lambda z: z["k"] != at), lambda z: z["e"]))
    none = F.lit(None).cast("string")
    flags = [
        F.when(clue_score(stem, options, key) >= 20, "clues"), F.when(F.array_max(sizes) > 170, "too_long"), F.when(F.array_min(sizes) < 0.55 * F.array_max(sizes), "uneven"), F.when(F.array_join(opts, " ").rlike(ALL_OF_THEM), "all_or_none"),
        F.when(F.element_at(echoes, at) >= others + 2, "echo"), none if norm is None else F.when(~names_norm(stem, norm), "norm_not_explicit"),
        none if form is None else F.when((form == "combinada") & ~(stem.rlike(r"\bI\b") & stem.rlike(r"\bII\b") & stem.rlike(r"\bIII\b")), "statements_missing"),
        F.when(stem.rlike(r"\b(INCORRECTA|FALSA|NO es correcta|EXCEPTO)\b"), "negative"),
    ]
    return F.filter(F.array(*flags), lambda f: f.isNotNull())


#: References inside a text, words that point elsewhere, sections, articles, names and numbers of norms, and names of norms without a number.
INTERNAL = r"(?iuU)\b(?:art[ií]culo|art\.|apartado|apartados|p[aá]rrafo|p[aá]rrafos|letra|letras|inciso|incisos|disposici[oó]n|anexo)\b"
POINTING = (
    r"(?iuU)\b(?:apartado|apartados|p[aá]rrafo|p[aá]rrafos|art[ií]culo|art[ií]culos|letra|letras|inciso|incisos|precepto|preceptos)\s+anterior(?:es)?\b"
    r"|\b(?:citado|citada|citados|citadas|mencionado|mencionada|mencionados|mencionadas|referido|referida|referidos|referidas)\s+(?:apartado|apartados|p[aá]rrafo|p[aá]rrafos|art[ií]culo|art[ií]culos|letra|letras|precepto|preceptos)\b"
)
#: What every text of the two patterns around it holds, which is cheaper to look for.
POINTING_HINT, SUBSECTION_HINT = r"(?iu)anterior|citad|mencionad|referid", r"(?iu)apartado"
SUBSECTION = r"(?iuU)\b(?:apartado\s+\d+[\w.ºª-]*|letras?\s+[a-z](?:\s*(?:,|y|o)\s*[a-z])+\s+del\s+apartado\s+\d+)\b"
ANY_ARTICLE = r"(?iuU)\b(?:art[ií]culo|art\.)\s*\d+"
ANY_NORM = r"(?iuU)\b(?:constituci[oó]n|estatuto|ley(?:\s+org[aá]nica)?|decreto(?:-ley)?|real\s+decreto|orden|reglamento|directiva|tratado|resoluci[oó]n)\b"
NORM_NUMBER = r"\b[0-9]{1,4}[ \t\n\x0b\f\r]*/[ \t\n\x0b\f\r]*[0-9]{2,4}\b"
UNNUMBERED = ("constitucion", "estatuto", "tratado", "reglamento", "directiva")


def norm_is_named(stem: Column, names: Column) -> Column:
    """Whether a stem names its norm: by one of the numbers in the norm's ``names``, else by a word that they hold, else by any word for a norm."""
    compact = lambda x: F.lower(F.regexp_replace(x, f"{BLANK}+", ""))
    numbers = F.transform(F.regexp_extract_all(F.coalesce(names, F.lit("")), F.lit(NORM_NUMBER), F.lit(0)), compact)
    held, said = norm_ascii_alnum(names), norm_ascii_alnum(stem)
    words = F.filter(F.array(*map(F.lit, UNNUMBERED)), lambda w: held.contains(w))
    whole = compact(stem)
    return F.when(F.size(numbers) > 0, F.exists(numbers, lambda n: whole.contains(n))).when(F.size(words) > 0, F.exists(words, lambda w: said.contains(w))).otherwise(stem.rlike(ANY_NORM))


def self_sufficiency_flags(stem: Column, whole: Column, names: Column | None = None) -> Column:
    """What keeps an item from being understood by itself: ``names`` are those of its norm, if known."""
    named = stem.rlike(ANY_NORM) if names is None else norm_is_named(stem, names)
    flags = [F.when(~named & stem.rlike(INTERNAL), "norm_not_named"), F.when(whole.rlike(POINTING_HINT) & whole.rlike(POINTING), "points_elsewhere"), F.when(stem.rlike(SUBSECTION_HINT) & stem.rlike(SUBSECTION) & ~stem.rlike(ANY_ARTICLE), "section_without_article")]
    return F.filter(F.array(*flags), lambda f: f.isNotNull())


def text_sufficient(text: Column, heading: Column) -> Column:
    """False if empty, no more than its short heading, or a bare article number."""
    t = norm_spaces_lower(unaccented(text))
    plain, head = F.rtrim(F.regexp_replace(t, "[ .:;-]+$", "")), F.regexp_replace(norm_spaces_lower(unaccented(heading)), "[ .:;-]+$", "")
    only_heading = (head != "") & (plain == head) & (F.length(collapsed(text)) < 80)
    bare = plain.rlike(r"^(articulo|art\.?) [0-9]+(\.[0-9]+)*( *(bis|ter|quater|quinquies))?(\.[a-z])? *\.?$")
    return (t != "") & ~only_heading & ~bare


NORMATIVE = (" deberá ", " deberán ", " podrá ", " podrán ", " será ", " serán ", " corresponde ", " tendrá ", " tendrán ", " tiene derecho ", " se garantizará ", " se aplicará ", " that ", " de ")


def source_usable(text: Column, practical: Column) -> Column:
    """Long enough (100 characters, 250 for practice) with a normative verb, or 500."""
    t = collapsed(F.coalesce(text, F.lit("")))
    low = F.concat(F.lit(" "), F.lower(t), F.lit(" "))
    verb = reduce(lambda a, b: a | b, [low.contains(w) for w in NORMATIVE])
    n = F.length(t)
    return (n >= F.when(practical, 250).otherwise(100)) & (verb | (n >= 500))


def repealed(heading: Column, text: Column) -> Column:
    """The heading or the start of the text says that the article is repealed."""

    def says(x: Column) -> Column:
        t = F.regexp_replace(norm_spaces_lower(unaccented(x)), r"^articulo ([0-9]+(\.[0-9]+)*( \w+)?|unico) *[.:-]* *", "")
        return F.regexp_replace(t, r"^[\[() .:-]+", "").rlike(r"^derogad[oa]s?\b")

    return says(heading) | says(F.substring(text, 1, 300))


def repealed_norm(text: Column) -> Column:
    """The head of a norm's page, up to where it says how it was published (else 5,000 characters), says that it is repealed."""
    t = norm_spaces_lower(unaccented(text))
    head = F.when(t.contains("publicado en:"), F.substring_index(t, "publicado en:", 1)).otherwise(F.substring(t, 1, 5000))
    return head.rlike(r"\bdisposicion derogada\b")


def option_shuffle(row: Column, options: list[Column], key: Column, seed: str) -> Column:
    """Struct ``(options, key)`` in an order drawn from ``md5(id, letter, seed)``; unchanged if an option refers to others."""
    letters = "ABCD"
    drawn = F.array_sort(F.array(*[F.struct(F.md5(F.concat_ws("|", row.cast("string"), F.lit(c), F.lit(seed))).alias("d"), F.lit(c).alias("c"), o.alias("o")) for c, o in zip(letters, options, strict=True)]))
    depends = F.array_join(F.array(*[F.coalesce(o, F.lit("")) for o in options]), " ").rlike(r"(?iuU)anteriores|\b[abcd]\) y [abcd]\)")
    place = F.array_position(F.transform(drawn, lambda s: s["c"]), key).cast("int")
    new = F.element_at(F.array(*map(F.lit, letters)), F.greatest(place, F.lit(1)))
    return F.when(depends, F.struct(F.array(*options).alias("options"), key.alias("key"))).otherwise(F.struct(F.transform(drawn, lambda s: s["o"]).alias("options"), new.alias("key")))


#: How an explanation gives its answer; each pattern has the letter as its group.
ANSWER_PATTERNS = (
    r"(?iuU)(?:\bRespuesta\s+correcta|\bRespuesta)\s*[:.-]?\s*(?:es\s+)?(?:la\s+)?([ABCD])(?=\s*[).,:;]|\s|$)",
    r"(?iuU)\bLa\s+respuesta\s+correcta\s+es\s+(?:la\s+)?([ABCD])(?=\s*[).,:;]|\s|$)",
    r"(?iuU)\bOpci[oó]n\s+([ABCD])\s*\(?\s*Correcta\s*\)?\s*[:.-]?",
    r"(?iuU)\bLa\s+([ABCD])\s+es\s+la\s+correcta\b",
    r"(?imuU)^\s*La\s+([ABCD])[.)]?\s*$",
)


def explicit_answer(x: Column) -> Column:
    """The only answer letter that an explanation gives in any of the known ways; ``?`` if it gives several, null if none."""
    t = F.coalesce(x, F.lit(""))
    found = F.array_distinct(F.transform(F.concat(*[F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in ANSWER_PATTERNS]), F.upper))
    return F.when(F.size(found) > 1, "?").when(F.size(found) == 1, found[0])


#: An article with its norm close behind, a mention of an article, and several numbers in one reference.
ARTICLE_OF_NORM = (
    r"(?iuU)\bart(?:[íi]culo|s?\.)\s*(\d+(?:\.\d+)*(?:\.[a-z])?)(?:\s*(?:,|y)\s*\d+(?:\.\d+)*)?[^\n.;:]{0,70}?(?:de\s+la\s+|del\s+|de\s+)?"
    r"(Ley\s+Org[aá]nica\s+\d+/\d{4}|Ley\s+\d+/\d{4}|Real\s+Decreto(?:\s+Legislativo|-ley)?\s+\d+/\d{4}|Decreto(?:\s+Legislativo|-ley)?\s+\d+/\d{4})"
)
ARTICLE_MENTION = r"(?iuU)\bart(?:[íi]culos?|s?\.)\s*\d+"
SEVERAL_NUMBERS = r"(?iuU)(?:,|\by\b)\s*\d+"


def unambiguous_reference(x: Column) -> Column:
    """``article|norm`` if the text mentions exactly one article, exactly one with its norm, and no further number in between."""
    t = F.coalesce(x, F.lit(""))
    mentions, pairs = (F.regexp_extract_all(t, F.lit(p), F.lit(0)) for p in (ARTICLE_MENTION, ARTICLE_OF_NORM))
    one = (F.size(mentions) == 1) & (F.size(pairs) == 1) & ~F.coalesce(F.get(pairs, F.lit(0)).rlike(SEVERAL_NUMBERS), F.lit(False))
    return F.when(one, F.concat_ws("|", F.regexp_extract(t, ARTICLE_OF_NORM, 1), collapsed(F.regexp_extract(t, ARTICLE_OF_NORM, 2))))


def citation_verified(quote: Column, text: Column, least: int = 25, piece: int = 12) -> Column:
    """The quote, normalised and long enough, is in the text, or its pieces between ellipses are, in order.

    Both are taken as composed (:func:`nfkc`, in a projection before: its lambdas admit no Python function).
    """
    q, t = citation_words(quote), citation_words(text)
    pieces = F.filter(F.transform(F.split(quote, r"\.\.\.|…"), citation_words), lambda p: F.length(p) >= piece)
    found = lambda p, at: F.call_function("locate", p, t, F.greatest(at, F.lit(1)))
    end = F.aggregate(pieces, F.lit(1), lambda at, p: F.when((at > 0) & (found(p, at) > 0), found(p, at) + F.length(p)).otherwise(F.lit(0)))
    return (F.length(q) >= least) & (t.contains(q) | ((F.size(pieces) >= 2) & (end > 0)))


def source_is_own_article(text: Column, article: Column) -> Column:
    """The block starts with its own article's heading."""
    start = F.substring(norm_spaces_lower(unaccented(text)), 1, 160)
    head = F.concat(F.lit("articulo "), article)
    after = F.substring(start, F.length(head) + 1, F.lit(1))
    return start.startswith(head) & after.isin("", " ", ".", "-")


def relevant_excerpt(text: Column, needle: Column, most: int) -> Column:
    """A window of ``most`` characters that starts a quarter before the first needle word found."""
    hay = F.lower(unaccented(text))
    at = F.array_min(F.filter(F.transform(long_words(unaccented(needle)), lambda w: F.call_function("locate", w, hay)), lambda p: p > 0))
    start = F.greatest(F.lit(0), F.coalesce(at, F.lit(1)) - 1 - most // 4)
    return F.when(F.length(text) <= most, text).otherwise(F.substring(text, start + 1, F.lit(most)))


def ordinal_article_key(x: Column) -> Column:
    """Array to sort articles by: their numbers, then the rank of the suffix."""
    numbers = F.transform(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit("[0-9]+"), F.lit(0)), lambda n: n.cast("long"))
    low = F.lower(unaccented(x))
    rank = reduce(lambda acc, k: F.when(low.contains(k[1]), k[0]).otherwise(acc), reversed(list(enumerate(SUFFIXES, 1))), F.lit(0))
    return F.when(F.size(numbers) > 0, F.concat(numbers, F.array(rank.cast("long")))).otherwise(F.array(F.lit(10**9).cast("long")))


GAZETTE_LINE = r"(?iu)^(CVE:.*|.*https://dogv.*|N[uú]m\. *[0-9].*|[0-9]+ */ *[0-9]+|Anexo +[IVXLCDM]+|Convocatoria +[0-9]+/[0-9]+)$"


def strip_gazette_lines(x: Column) -> Column:
    lines = F.transform(F.split(x, "\n"), collapsed)
    return collapsed(F.array_join(F.filter(lines, lambda line: (line != "") & ~line.rlike(GAZETTE_LINE)), " "))


def number_words() -> dict[str, int]:
    """Spanish number words 1-199, built by rule."""
    ones = ["", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve"]
    teens = ["diez", "once", "doce", "trece", "catorce", "quince", "dieciseis", "diecisiete", "dieciocho", "diecinueve"]
    tens = ["treinta", "cuarenta", "cincuenta", "sesenta", "setenta", "ochenta", "noventa"]
    low = {w: n for n, w in enumerate(ones) if n} | {w: 10 + n for n, w in enumerate(teens)} | {"veinte": 20} | {f"veinti{w}": 20 + n for n, w in enumerate(ones) if n}
    low |= {(f"{t} y {w}" if w else t): 30 + 10 * k + n for k, t in enumerate(tens) for n, w in enumerate(ones)}
    return low | {"cien": 100, "ciento": 100} | {f"ciento {w}": 100 + n for w, n in low.items()}


def number_from_words(x: Column) -> Column:
    words = number_words()
    table = F.create_map(*[v for w, n in words.items() for v in (F.lit(w), F.lit(n))])
    return F.try_element_at(table, norm_ascii_alnum(x))


def unit_value(x: Column) -> Column:
    """Value of a structural unit: ``preliminar``, ``unico``, digits without zeros, or the value of a roman number."""
    v = F.translate(F.lower(F.trim(unaccented(x))), "ºª.", "")
    roman = F.filter(F.split(v, ""), lambda c: c != "")
    value = F.create_map(*[y for c, n in zip("ivxlcdm", (1, 5, 10, 50, 100, 500, 1000), strict=True) for y in (F.lit(c), F.lit(n))])
    total = F.aggregate(F.reverse(roman), F.struct(F.lit(0).alias("t"), F.lit(0).alias("last")), lambda acc, c: F.when(F.try_element_at(value, c) < acc["last"], F.struct((acc["t"] - F.try_element_at(value, c)).alias("t"), acc["last"].alias("last"))).otherwise(F.struct((acc["t"] + F.try_element_at(value, c)).alias("t"), F.try_element_at(value, c).alias("last"))), lambda acc: acc["t"])
    return F.when(v.isin("unico", "unica"), "unico").when(v.rlike("^[0-9]+$"), F.regexp_replace(v, "^0+([0-9])", "$1")).when(v.rlike("^[ivxlcdm]+$"), total.cast("string")).otherwise(v)


def question_polarity(stem: Column) -> Column:
    false = r"\bincorrect[ao]\b|\bno se corresponde\b|\bno es una?\b|\bno es verdader[ao]\b|\bexcepto\b|\bmenos\b"
    return F.when(norm_spaces_lower(unaccented(stem)).rlike(false), "FALSE").otherwise("TRUE")


def make_norm_explicit(stem: Column, norm: Column) -> Column:
    """Add the norm's name after the first article cited, or in front; null if the result still isn't self-sufficient."""
    cited = r"(?isuU)^(.*?(?:artículo|articulo|art\.) *[0-9]+(?:\.[0-9]+)*)(.*)$"
    named = F.when(stem.rlike(cited), F.concat(F.regexp_extract(stem, cited, 1), F.lit(" de la "), norm, F.regexp_extract(stem, cited, 2))).otherwise(F.concat(F.lit("Según la "), norm, F.lit(", "), stem))
    named = F.when(stem.rlike(ANY_NORM), stem).otherwise(named)
    return bound(named, lambda n: F.when(F.size(self_sufficiency_flags(n, n)) == 0, n))
