"""URL filters, HTML extraction, nearest neighbours and the pipeline."""

from __future__ import annotations

import random

import numpy as np
import pytest
from oracle import SF, connect, same

from quillbank.llm import neighbours, pages, queries, urls

RULES = queries.RULES


def test_url_parts_and_rules(spark):
    cases = {
        "http://A.Example.COM/en/5?x#y": ("a.example.com", "/en/5", "com/en/", "block"), "https://example.com/en/71": ("example.com", "/en/71", "example.com/en/7", "allow"),
        "http://notexample.com/en/7": ("notexample.com", "/en/7", "com/en/", "block"), "x://a.net#/de/": ("a.net", "", None, "allow"), "http://m.example.net/de/80": ("m.example.net", "/de/80", "example.net/de/8", "block"),
        "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://ÀB.org/es/": ("Àb.org", "/es/", "org/es/", "block"), "http://h?/en/": ("h", "", None, "allow"),
    }
    df = spark.createDataFrame([(k, u, 1) for k, u in enumerate(cases)] + [(0, next(iter(cases)), 1)], "page_id long, url string, host int")
    got = urls.judge_urls(df, spark.createDataFrame([], "page_id long, bad int"), RULES).collect()
    assert len(got) == len(cases) + 1
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == dict(enumerate(cases.values()))


def test_templates_are_rejected_by_purity(spark):
    rows = [(k, f"http://h.x/{'spam' if k % 2 else 'news'}/{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}q/{k}") for k in range(400)]
    labels = [(k, k % 2) for k in range(0, 400, 3)] + [(1, None), (9999, 1)]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int"), []).collect()
    assert {(r["template"], r["verdict"]) for r in got} == {("h.x/spam/*/*", "block"), ("h.x/news/*/*", "allow")}


def test_template_tree_by_brute_force(spark):
    import math
    import random

    rng = random.Random(12)
    rows, labels = [], []
    for k in range(900):
        host = rng.choice(["a.x", "a.x", "a.x", "b.y", "c.z"])
        segs = [rng.choice(["en", "de", "fr"]), rng.choice([str(k), "about", "new", "old", "spam"]), rng.choice(["p", "q", f"x{k}"]), "deep", "er"][: rng.randrange(6)]
        rows.append((k, f"http://{host}/" + "/".join(segs)))
        if k % 2:
            labels.append((k, int(rng.random() < (0.9 if "spam" in segs or host == "b.y" else 0.2))))
    rows += [(k, f"http://num.x/{'en' if k % 2 else 'de'}/{k % 37}/t") for k in range(5000, 5090)] + [(k, f"http://one.x/{k}") for k in range(2000, 2002)] + [(3000, None), (3001, "http://c.z/" + "long/" * 5000)]
    known = dict(labels)
    items = []
    for i, u in rows:
        path = "" if u is None else "/" + u.split("://")[1].split("/", 1)[1]
        items.append({"id": i, "host": "" if u is None else u.split("/")[2], "segs": path.removeprefix("/").split("/", 3), "bad": known.get(i, 0), "seen": int(i in known)})
    shared = lambda xs, base: (sum(x["bad"] for x in xs) + 4 * base) / (sum(x["seen"] for x in xs) + 4)
    want = {}

    def down(xs, name, share, depth):
        for x in xs:
            want[x["id"]] = (name, share)
        xs = [x for x in xs if len(x["segs"]) > depth]
        if depth == 4 or not xs:
            return
        kids = {}
        for x in xs:
            kids.setdefault(x["segs"][depth], []).append(x)
        h = -sum(len(v) / len(xs) * math.log(len(v) / len(xs)) for v in kids.values())
        if math.exp(h) > 16 or (len(xs) >= 4 and h >= 0.75 * math.log(len(xs)) - 1e-12):
            groups = {"*": xs}
        else:
            alike = []
            for seg, v in kids.items():
                bad, seen = sum(x["bad"] for x in v), sum(x["seen"] for x in v)
                if not seen or abs(bad / seen - share) <= math.sqrt(share * (1 - share) / seen):
                    alike.append(seg)
            alike = alike if len(alike) > 1 else []
            groups = {seg: v for seg, v in kids.items() if seg not in alike}
            if alike:
                groups["~"] = [x for seg in alike for x in kids[seg]]
        for seg, v in groups.items():
            down(v, f"{name}/{seg}", shared(v, share), depth + 1)

    prior = (sum(x["bad"] for x in items) + 1) / (sum(x["seen"] for x in items) + 4)
    for host in {x["host"] for x in items}:
        xs = [x for x in items if x["host"] == host]
        down(xs, host, shared(xs, prior), 0)
    df = spark.createDataFrame([(i, u, "clash", 1) for i, u in rows], "page_id long, url string, template string, seen int")
    got = {r["page_id"]: (r["template"], r["bad_share"], r["verdict"]) for r in urls.judge_urls(df, spark.createDataFrame(labels, "page_id long, bad int"), []).collect()}
    assert {i: n for i, (n, *_) in got.items()} == {i: n for i, (n, _) in want.items()}
    assert all(abs(got[i][1] - s) < 1e-9 and got[i][2] == ("block" if got[i][1] >= 0.5 else "allow") for i, (_, s) in want.items())
    assert {"*", "~"} <= {x for n, *_ in got.values() for x in n.split("/")} and len({v for *_, v in got.values()}) == 2


def test_urls_empty(spark):
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "page_id long, bad int"), RULES).isEmpty()


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p><article>";</script></head><body class="has-sidebar"><header>H</header><nav><ul><li><a>m</a></ul></nav>
<div class="ad-box ad">buy</div><article><h1>Title &amp; more</h1><p><b>One
 two<br>three<p>Four &lt;5&gt;<aside>side</aside><form>f</form><section id="comments"><p>me too</p></section><ul><li>i<li>ii</ul></article><div class="cookie-notice">c</div><footer>&copy;</footer></body></html>"""


def test_article():
    assert pages.article(PAGE, frozenset()) == "Title & more\n\nOne two three\n\nFour <5>\n\ni\n\nii"
    assert pages.article("", frozenset()) == "" and pages.article("plain < text", frozenset()) == "plain < text"
    assert pages.article("<p>cut off <b>here", frozenset()) == "cut off here"
    assert pages.article("<div>" * 3000 + "deep", frozenset()) == "deep"


@pytest.mark.parametrize("attributes", ["style='overflow:hidden'", 'style="overflow: hidden"', 'title="hidden gems"', "data-hidden=false", 'data-hidden="false"', 'data-id="share"', 'data-class="ad" data-role=banner', 'alt = "class=ad hidden"', "x-hidden", 'title="a > hidden', "href=/a?id=share"])
def test_names_inside_other_attributes_say_nothing(attributes):
    assert pages._style("div", " " + attributes) == ("div", False, False)
    assert pages._style("div", f' CLASS=Big {attributes.replace(chr(34), chr(39))}') == ("div.big", False, False)


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN", 'hidden=""', "title='x'hidden", "aria-hidden = true", 'class="a share"', "id=share", "data-x='1' role='banner' /"])
def test_attributes_that_say_no_content(attributes):
    assert any(pages._style("div", " " + attributes)[1:])


@pytest.mark.parametrize("name", ["page no-sidebar", "has-sidebar", "long-form", "skip-rope", "readable", "comment-le-monde", "advertise-policy"])
def test_names_that_say_something_else(name):
    assert pages._style("div", f' class="{name}"')[1:] == (False, False)


@pytest.mark.parametrize("name", ["ad-slot-3", "site-footer", "cookie-notice", "post_comments", "big share", "nav-bar"])
def test_names_made_of_words_against_content(name):
    assert pages._style("div", f' class="{name}"')[2]


def test_overflow_keeps_its_content():
    assert pages.article('<div style="overflow:hidden"><p data-id="share">kept</p></div><div hidden>lost</div>', frozenset()) == "kept"


def extracted(spark, rows):
    return {r["page_id"]: r["text"] for r in pages.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_style_tree_removes_what_repeats(spark, monkeypatch):
    rows = [(k, f"http://a.b/{k}", f"<body><div class='x'>same words on all pages</div><div class='y'><p>own text {k} of this page and {'more ' * k}</p></div></body>") for k in range(8)] + [(20, None, None), (21, "http://a.b/9", "")]
    want = {k: f"own text {k} of this page and {'more ' * k}".strip() for k in range(8)} | {20: "", 21: ""}
    assert extracted(spark, rows) == want
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in pages.extract_articles(df, broadcast_rows=-1).collect()} == want
    assert pages.extract_articles(spark.createDataFrame([], "page_id long, url string, html string")).isEmpty()
    # without the tree the repeated words stay
    monkeypatch.setattr(pages, "style_tree", lambda *_: spark.createDataFrame([], "host string, path long, pages long, shift double, importance double"))
    assert extracted(spark, rows)[3].startswith("same words on all pages")


def test_style_tree_works_inside_articles(spark):
    page = "<body><article><h1>Head {0}</h1><div>Read more of us on other sites</div><p>text {0} that only this page has</p><p>{1}</p></article><div>aside {0}</div></body>"
    got = extracted(spark, [(k, f"http://a.b/{k}", page.format(k, "more " * (k + 1))) for k in range(9)])
    assert got == {k: f"Head {k}\n\ntext {k} that only this page has\n\n{('more ' * (k + 1)).strip()}" for k in range(9)}


def test_the_tree_decides_about_headers_of_articles(spark):
    """A header within an article stays where its text differs and goes where it repeats; those of pages go."""
    page = "<body><header><div>Site of many</div><div>{1}</div></header><article><header><h1>{0}</h1></header><p>text {1} that only this page has</p><p>{2}</p></article></body>"
    rows = [(k, "http://a.b/", page.format(f"Head {k}", f"no {k}", "more " * (k + 1))) for k in range(9)] + [(20 + k, "http://c.d/", page.format("Always this", f"no {k}", "more " * (k + 1))) for k in range(9)]
    body = lambda k: f"text no {k} that only this page has\n\n{('more ' * (k + 1)).strip()}"
    assert extracted(spark, rows) == {k: f"Head {k}\n\n{body(k)}" for k in range(9)} | {20 + k: body(k) for k in range(9)}
    # with too few pages to tell the mark-up decides
    assert extracted(spark, rows[9:11]) == {20 + k: f"Always this\n\n{body(k)}" for k in range(2)}


def test_the_tree_sees_menus_without_any_list(spark, monkeypatch):
    """On the given pages: with no words and elements against content and no articles, the tree alone removes what they would."""
    df = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    texts = lambda: {r["page_id"]: r["text"].split("\n\n") for r in pages.extract_articles(df).collect()}
    full = texts()
    for name in ("CHROME", "NOISE", "MAIN"):
        monkeypatch.setattr(pages, name, frozenset())
    on = texts()
    monkeypatch.setattr(pages, "style_tree", lambda *_: spark.createDataFrame([], "host string, path long, pages long, shift double, importance double"))
    off = texts()
    assert all(set(full[k]) <= set(on[k]) for k in full)
    same = lambda got: sum(got[k] == full[k] for k in full) / len(full)
    assert same(off) == 0 and same(on) > 0.6 and sum(on[k] != off[k] for k in full) > 0.6 * len(full)


def test_extraction_by_brute_force(spark):
    """Whole extraction of well-formed pages by a plain DOM: entropies node by node, marks, articles."""
    import math
    import xml.etree.ElementTree as ET
    from collections import Counter

    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefg", k=4))
    inner = lambda n: "".join(f"<p>{word()} {word()}</p>" for _ in range(n))
    htmls = []
    for k in range(24):
        parts = [f"<nav><ul><li>{word()}</li><li>{word()}</li></ul></nav>", f"<div class='x'>{rng.choice(['same words', 'other words'])}</div>", f"<div class='ad'>{word()}</div>"]
        parts += [f"<article><header><h1>{word() if k % 2 else 'one head'}</h1></header><section>{inner(rng.randrange(1, 5))}</section><aside>{word()}</aside><div class='by'>by us</div></article>", f"<div class='y'>{inner(rng.randrange(1, 4))}</div>", f"<footer>{word()}</footer>"]
        htmls.append(f"<body>{''.join(parts)}</body>")
    chrome, noise, hosts = {"nav", "aside", "footer", "header"}, {"ad"}, [k % 2 for k in range(24)]

    def walk(e, path=(), main=False, gone=False):
        """(path, own and inner texts, child names, shift, main) of every element but paragraphs, which belong to theirs."""
        name = e.tag + (f".{e.get('class')}" if e.get("class") else "")
        path, inside = (*path, name), main or e.tag == "article"
        bad = (e.tag in chrome and not (e.tag == "header" and main)) or e.get("class") in noise
        shift = -0.8 if bad else 0.0 if e.tag == "header" else 0.1 if inside else 0.0
        own = [t for t in [e.text or "", *[c.text for c in e if c.tag == "p"]] if t.strip()]
        below = [x for c in e if c.tag != "p" for x in walk(c, path, inside, gone or bad)]
        return [(path, own, [c.tag + (f".{c.get('class')}" if c.get("class") else "") for c in e], shift, inside, gone or bad), *below]

    doms = [walk(ET.fromstring(h)) for h in htmls]
    share = lambda xs: -sum(n / len(xs) * math.log(n / len(xs), max(2, len(xs))) for n in Counter(xs).values())
    want = {}
    for k, dom in enumerate(doms):
        mine = [d for d, h in zip(doms, hosts, strict=True) if h == hosts[k]]
        low = set()
        for path, own, _, shift, _, _ in dom:
            held = [[x for x in d if x[0][: len(path)] == path] for d in mine]
            contents = [tuple(t for x in h for t in x[1]) for h in held]
            branches = [sum(bool([t for x in h if x[0][: len(path) + 1] == c for t in x[1]]) for c in {x[0][: len(path) + 1] for x in h if len(x[0]) > len(path)}) for h in held]
            shown = [c for c, h, b in zip(contents, held, branches, strict=True) if c and (h[0][1] or b > 1 or shift == -0.8)]
            names = [tuple(h[0][2]) for c, h, b in zip(contents, held, branches, strict=True) if c and (h[0][1] or b > 1 or shift == -0.8)]
            if len(shown) >= 3 and (share(shown) + share(names)) / 2 + shift < 0.45 <= 0.5 + shift:
                low.add(path)
        left = [(own, main) for path, own, _, _, main, gone in dom if not gone and not any(path[: len(p)] == p for p in low)]
        size = lambda rows: sum(len(t) for own, _ in rows for t in own)
        if 2 * size([x for x in left if x[1]]) >= size(left):
            left = [x for x in left if x[1]]
        want[k] = "\n\n".join(t for own, _ in left for t in own)
    assert extracted(spark, [(k, f"http://h{hosts[k]}.b/{k}", h) for k, h in enumerate(htmls)]) == want
    assert len({bool("words" in t) for t in want.values()}) == 1 and any("one head" not in t for t in want.values())


def test_pages_that_repeat_keep_their_text(spark):
    page = "<body><div>menu</div><article><p>one text on many urls</p></article></body>"
    assert set(extracted(spark, [(k, f"http://a.b/{k}", page) for k in range(6)] + [(0, "http://a.b/0", page)]).values()) == {"one text on many urls"}


def test_importance_by_brute_force(spark):
    """Entropies of content and presentation, as shares of their maximum, over pages that differ."""
    import math
    from collections import Counter

    page = "<body><div class=m>menu {0}</div><div class=t><p>text {1}</p>{2}</div></body>"
    cases = [(k % 2, k, "<p>x</p>" * (k % 3)) for k in range(6)] + [(0, 0, "")]
    df = spark.createDataFrame([(k, "http://a.b/", page.format(*c)) for k, c in enumerate(cases)], "page_id long, url string, html string")
    got = sorted(r["importance"] for r in pages.style_tree(df).collect())
    share = lambda xs: -sum(n / 6 * math.log(n / 6, 6) for n in Counter(xs).values())
    menu, text = (share([k % 2 for k in range(6)]) + 0) / 2, (1 + share([k % 3 for k in range(6)])) / 2
    assert got == pytest.approx(sorted([menu, text, (1 + 0) / 2]))  # the last: the body


def test_marks_are_weighed():
    none = frozenset()
    long = "words of a long text " * 5
    assert pages.article(f"<div class='content form'><p>{long}</p></div><div class=ad>buy</div>", none) == long.strip()
    assert pages.article(f"<article class=teaser>read on</article><div><p>{long}</p></div>", none) == f"read on\n\n{long.strip()}"
    assert pages.article(f"<article>x</article><div class=ad>{long}</div>", none) == "x"
    assert pages.article(f"<article><p>{long}</p></article><div id=comments><article>me too {long}{long}</article></div>", none) == long.strip()
    assert pages.article(f"<div><p>{long}</p></div><ul><li><a href=x>one</a><li><a>two</a><li><a>three</a></ul>", none) == long.strip()
    assert pages.article("<article><pre><span class=comment># note</span> x = 1</pre><p class=ad>buy</p>t <span class=ad>now</span> u</article>", none) == "# note x = 1\n\nt\n\nu"


def test_deep_pages_take_linear_time():
    import time

    began = time.perf_counter()
    assert pages.article("<div>" * 100_000 + "deep" + "</div>" * 100_000, frozenset()) == "deep"
    assert pages.article("<div><p><b>" * 30_000 + "deep", frozenset()) == "deep"
    assert len(list(pages.Page("<div>" * 50_000 + "deep").branches())) == 1
    assert time.perf_counter() - began < 20


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x[700:900] = x[3]  # one very common vector
    x[5] = 2 * x[4]
    rows = [(int(k), [float(v) for v in row]) for k, row in enumerate(x)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [1.0, None] + [0.0] * 14), (2004, [1.0] * 3), (None, rows[0][1]), (10, rows[10][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    ask = df.filter("vec_id % 50 = 0")
    got = {}
    for r in neighbours.nearest(df, ask, leaf=64).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hit = 0
    for q in range(0, 1500, 50):
        s = unit @ unit[q]
        s[q] = -9
        best = np.lexsort((np.arange(1500), -np.round(s, 12)))[:5]
        assert sorted(got[q]) == [1, 2, 3, 4, 5] and q not in {v for v, _ in got[q].values()}
        hit += len(set(best) & {v for v, _ in got[q].values()})
        for v, score in got[q].values():
            assert abs(score - s[v]) < 1e-12
    assert set(got) == set(range(0, 1500, 50)) and hit / 150 >= 0.9
    assert [got[750][k][0] for k in (1, 2, 3, 4, 5)] == [3, 700, 701, 702, 703]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    """The query as it is registered against brute force."""
    folder = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.stack(rows["embedding"]).astype(float)
    x, ids = x / np.linalg.norm(x, axis=1, keepdims=True), rows["vec_id"].to_numpy()
    got = {}
    for r in queries.op2_nearest_neighbours(spark, folder).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = 0
    for q in np.flatnonzero(ids % 50 == 0):
        near = x @ x[q]
        near[q] = -9
        hit += len(got[ids[q]] & set(ids[np.lexsort((ids, -near))[:5]]))
    assert hit / (5 * len(got)) >= 0.9 and len(got) == (ids % 50 == 0).sum()


def test_leaves_are_dealt(spark, monkeypatch):
    """Chunks of points and of queries change nothing; extra columns with clashing names are not read."""
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(k, [float(v) for v in rng.standard_normal(8)], 1.0, 2) for k in range(300)], "vec_id long, embedding array<double>, score double, p int")
    whole = sorted(map(tuple, neighbours.nearest(df, df.filter("vec_id % 3 = 0"), leaf=64).collect()))
    monkeypatch.setattr(neighbours, "CHUNK", 10)
    assert sorted(map(tuple, neighbours.nearest(df, df.filter("vec_id % 3 = 0"), leaf=64).collect())) == whole


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, neighbours.nearest(df, df.filter("vec_id = 0")).collect())) == [(0, 1, 2, 1.0), (0, 2, 1, 0.0)]
    assert neighbours.nearest(df.limit(0), df).isEmpty()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_like_oracle(spark, name):
    same(spark, connect(), queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows and ids, clashing columns; and empty tables."""
    import corpus_pipeline as p

    names = "doc_id long, text string, lang string, source string, n_chars long, kept string, id long, score double, word string"
    prose = "Once the sun had gone, old Mara walked home along the river, and nobody spoke to her. "
    rows = [(k, prose + f"It was day {k} of the long walk, number {k * k}. " * (2 + k % 3), "en", f"s{k % 3}", 5, "x", 1, 0.5, "w") for k in range(30)]
    rows += [(None, "no id here at all, but some words", None, None, None, None, None, None, None), (40, None, None, None, None, "x", None, None, None), (41, "", "en", "s0", 0, "x", 1, 0.5, "w")]
    rows += [rows[3], rows[3], (3, "another text of that id, with other words in it", "en", "s1", 3, "x", 1, 0.5, "w"), (42, "word " * 200_000, "en", "s2", 7, "x", 1, 0.5, "w"), (None, None, None, None, None, None, None, None, None)]
    other = {"labels": ([(k, k % 2, 0) for k in range(20)] + [(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int"), "benchmark": ([(1, rows[4][1]), (2, None), (None, "x")], "item_id long, text string")}
    for what in ("odd", "empty"):
        folder = f"{tmp_path}/{what}"
        for name, (data, schema) in other.items():
            spark.createDataFrame(data if what == "odd" else [], schema).write.parquet(f"{folder}/{name}.parquet")
        docs = spark.createDataFrame(rows if what == "odd" else [], names)
        docs.write.parquet(f"{folder}/documents.parquet")
        for name, stage in p.STAGES[1:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == list(p.COLUMNS), name
            kept = [r["doc_id"] for r in out.collect()]
            assert set(kept) <= {r[0] for r in rows} and bool(kept) == (what == "odd"), name
            if name == "line dedup" and what == "odd":
                assert len(kept) == len(rows)
            if name == "benchmark decontamination" and what == "odd":
                assert 4 not in kept and 40 in kept and kept.count(None) == 2
        assert p.run(spark, folder).columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = docs
    for name, stage in p.STAGES[:-1]:
        before = {r["doc_id"] for r in out.select("doc_id").collect()}
        out = stage(spark, out, SF).cache()
        after = [r["doc_id"] for r in out.select("doc_id").collect()]
        assert out.columns == docs.columns and len(after) == len(set(after)) and set(after) <= before, name
    mixed = p.run(spark, SF).collect()
    assert {r["doc_id"] for r in mixed} == set(after)
    texts = out.select("text").collect()
    assert len({r["text"] for r in texts}) == len(texts)
