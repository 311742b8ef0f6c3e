"""URL filters: explicit rules, then a path-template tree per host; DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbank.functions.session import use_checkpoints

#: Parts that the paths of one host are dealt to.
SALTS = 32
#: (verdict, host, path prefix)
Rule = tuple[str, str, str]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if null or without ``://``."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def match_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct ``(rule, verdict)`` of the longest rule that fits, else null. The rules are an expression, so the list is a parameter of moderate length."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    fits = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in longest]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def template_tree(paths: DataFrame, levels: int, fan: float, spread: float, weight: float, z: float) -> DataFrame:
    """``host, path, template, bad_share`` of ``host, path, segs, n, bad, seen`` (``n`` urls; ``bad`` of ``seen`` labels are bad).

    Level by level, the children of each (host, template so far) are generalised and merged:

    * A position is variable, and becomes ``*``, if the effective number of its segments, the exponential of their
      entropy, exceeds ``fan``, or if at least four urls have ``spread`` of the entropy of segments that all differ.
    * Elsewhere, children whose share of bad labels lies within ``z`` standard errors of the parent's, or that have no
      labels, are not told apart from it. If several, they are merged to one branch, ``~``, and so is what follows.

    A branch's share of bad labels is smoothed by ``weight`` labels with the parent's share; a host's with that of all.
    """
    total = paths.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.coalesce(F.sum("seen"), F.lit(0)).alias("seen"))
    # without labels the prior is a quarter, so nothing is rejected
    prior = total.select(((F.col("bad") + 1) / (F.col("seen") + 4)).alias("prior"))
    smooth = lambda bad, seen, base: (bad + weight * base) / (seen + weight)
    hosts = paths.groupBy("host").agg(F.sum("bad").alias("host_bad"), F.sum("seen").alias("host_seen")).join(F.broadcast(prior))  # one row
    hosts = hosts.select("host", smooth(F.col("host_bad"), F.col("host_seen"), F.col("prior")).alias("share"))
    # a host with a third of all paths meets its share in SALTS tasks
    hosts = hosts.select("host", "share", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    out = paths.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int")).join(hosts, ["host", "salt"]).drop("salt").withColumn("template", F.col("host"))
    for k in range(levels):
        out = out.withColumn("seg", F.get("segs", F.lit(k)))
        kids = out.filter("seg is not null").groupBy("host", "template", "seg").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("seen").alias("seen"), F.first("share").alias("base"))
        off = F.abs(F.col("bad") / F.greatest(F.col("seen"), F.lit(1)) - F.col("base"))
        like = (F.col("seen") == 0) | (off <= z * F.sqrt(F.col("base") * (1 - F.col("base")) / F.greatest(F.col("seen"), F.lit(1))))
        kids = kids.withColumn("like", like).checkpoint()
        entropy = F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")
        at = kids.groupBy("host", "template").agg(entropy.alias("h"), F.sum("n").alias("urls"), F.count_if("like").alias("alike"))
        wide = (F.exp("h") > fan) | ((F.col("urls") >= 4) & (F.col("h") >= spread * F.log("urls")))
        at = at.select("host", "template", wide.alias("wide"), (F.col("alike") > 1).alias("merge"))
        step = F.when(F.col("wide"), "*").when(F.col("merge") & F.col("like"), "~").otherwise(F.col("seg"))
        steps = kids.join(at, ["host", "template"]).select("host", "template", "seg", step.alias("step"), "bad", "seen", "base")
        shares = steps.groupBy("host", "template", "step").agg(smooth(F.sum("bad"), F.sum("seen"), F.first("base")).alias("next"))
        named = steps.select("host", "template", "seg", "step").join(shares, ["host", "template", "step"])
        met = out.join(named, ["host", "template", "seg"], "left")
        on = F.col("step").isNotNull()
        out = met.select("host", "path", "segs", "n", "bad", "seen", F.when(on, F.concat("template", F.lit("/"), "step")).otherwise(F.col("template")).alias("template"), F.when(on, F.col("next")).otherwise(F.col("share")).alias("share")).checkpoint()
    return out.select("host", "path", "template", F.col("share").alias("bad_share"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url", *, levels: int = 4, fan: float = 16.0, spread: float = 0.75, weight: float = 4.0, z: float = 1.0, reject: float = 0.5) -> DataFrame:
    """Judge every url: ``page_id, host, path, rule, template, bad_share, verdict``, a row per input row.

    Explicit rules come first. Else the url's template decides (:func:`template_tree`): it is blocked if its smoothed
    share of bad labels (``labels``: page id, ``bad`` 0 or 1) reaches ``reject``. Segments beyond ``levels`` are the
    last level's, together. Urls are first counted by host and path; sums per child are combined before they are
    shuffled, so a host with a third of all rows is many partial sums.

    Null urls and urls without ``://``: empty host and path, judged as one template. Null labels and labels of
    unknown pages say nothing; repeated ones count each time. Rows that repeat a page id are judged row by row. No
    labels at all: nothing is blocked by the method. Shares of just ``reject`` are blocked. Very long urls are read
    whole. An empty table gives an empty result.
    """
    use_checkpoints(pages.sparkSession)
    host, path = url_parts(F.col(url).cast("string"))
    base = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    known = labels.filter("bad in (0, 1)").groupBy("page_id").agg(F.sum("bad").alias("bad"), F.count("*").alias("seen"))
    none = F.lit(0)
    paths = base.join(known, "page_id", "left").groupBy("host", "path").agg(F.count("*").alias("n"), F.coalesce(F.sum("bad"), none).alias("bad"), F.coalesce(F.sum("seen"), none).alias("seen"))
    tree = template_tree(paths.withColumn("segs", F.split(F.regexp_replace("path", "^/", ""), "/", levels)).checkpoint(), levels, fan, spread, weight, z)
    met = base.join(tree, ["host", "path"], "left").withColumn("fit", match_rule(F.col("host"), F.col("path"), rules))
    by_method = F.when(F.col("bad_share") >= reject, "block").otherwise("allow")
    return met.select("page_id", "host", "path", "fit.rule", "template", "bad_share", F.coalesce("fit.verdict", by_method).alias("verdict"))
