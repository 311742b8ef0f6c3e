"""Linking items to norms, topics and parts. All calls are handled in one plan: the call is a join key, never a loop."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbank.functions.session import kept
from quillbank.functions.textnorm import article_base, article_full, norm_identity, norm_identity_undated


def blank(x: Column) -> Column:
    return F.trim(F.coalesce(x, F.lit(""))) == ""


def completeness_reason(kind: Column, name: Column, norm_id: Column, article: Column) -> Column:
    """Missing normalised fields, comma-joined; empty if complete."""
    return F.concat_ws(",", F.when(blank(kind), "norm_type"), F.when(blank(name), "norm_name"), F.when(norm_id.isNull(), "norm_id"), F.when(blank(article), "article"))


def article_forms(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``base`` and ``full``, the normal forms of an article column, made once for each distinct spelling."""
    spelt = rows.select(F.col(column).alias("_spelt")).distinct().withColumn("base", article_base(F.col("_spelt"))).withColumn("full", article_full(F.col("_spelt")))
    return rows.join(spelt, rows[column].eqNullSafe(spelt["_spelt"]), "left").drop("_spelt")


def eligible_items(items: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Legal items, with both forms of their article, and the reason why they can't enter a bank (null: they can, if the call admits their kind of question)."""
    out = article_forms(items.filter("kind = 'JURIDICA'"), "article_n").join(exclusions.filter("state in ('CUARENTENA', 'RETIRADA')").select("item_id").distinct().withColumn("excluded", F.lit(True)), "item_id", "left")
    missing = completeness_reason(F.col("norm_type_n"), F.col("norm_name_n"), F.col("norm_id"), F.col("article_n"))
    reason = (
        F.when(F.col("excluded"), "EXCLUDED").when(F.upper(F.trim("validity")).startswith("OBSOLETA"), "OBSOLETE").when(missing != "", F.concat(F.lit("INCOMPLETE:"), missing))
        .when(F.col("base").isNull(), "ARTICLE")
    )
    return out.withColumn("reason", reason).drop("excluded")


def calls_with_practice(rules: DataFrame) -> DataFrame:
    """Calls with a rule for practical questions."""
    return rules.filter("upper(theory_practice) = 'PRACTICA'").select("call_id").distinct()


def located_refs(refs: DataFrame, topics: DataFrame) -> DataFrame:
    """References with their topic's attributes and both normal forms of the article."""
    t = topics.select("topic_id", "part", "number", "title", "content_type")
    return article_forms(refs.join(t, "topic_id"), "article_asked")


def ref_index(located: DataFrame, mode: str = "first") -> DataFrame:
    """``call_id, norm_id, base`` to one topic: the first by article, part, number and id, or (``unambiguous``) only where there is one."""
    valid = located.filter("norm_id is not null and base is not null")
    key = ["call_id", "norm_id", "base"]
    if mode == "unambiguous":
        return valid.groupBy(*key).agg(F.min("topic_id").alias("topic_id"), F.max("topic_id").alias("other")).filter("topic_id = other").drop("other")
    order = F.struct("article_asked", "part", "number", "ref_id")
    return valid.groupBy(*key).agg(F.min_by(F.struct("topic_id", "part", "content_type"), order).alias("t")).select(*key, "t.*")


def invalid_refs(located: DataFrame) -> DataFrame:
    reason = F.when(F.col("norm_id").isNull(), "NORM_NULL").when(F.col("base").isNull(), "ARTICLE")
    return located.withColumn("reason", reason).filter("reason is not null").select("ref_id", "call_id", "reason")


def repeated_refs(located: DataFrame) -> DataFrame:
    """Full references that stand in several topics of a call."""
    found = located.filter("norm_id is not null and base is not null and full is not null").groupBy("call_id", "norm_id", "full").agg(F.array_sort(F.collect_set("topic_id")).alias("topics"))
    return found.filter(F.size("topics") > 1).select("call_id", "norm_id", "full", F.array_join("topics", ",").alias("topics"))


def category_index(categories: DataFrame) -> DataFrame:
    """``call_id, category`` with the only topic, or the reason why there is none."""
    c = F.upper(F.trim(F.coalesce("category", F.lit(""))))
    by = categories.groupBy("call_id", c.alias("category")).agg(F.min("topic_id").alias("topic_id"), F.count_distinct("topic_id").alias("n"))
    reason = F.when(F.col("category") == "", "EMPTY").when(F.col("n") > 1, "SEVERAL")
    return by.select("call_id", "category", F.when(reason.isNull(), F.col("topic_id")).alias("topic_id"), reason.alias("reason"))


def match_items(items: DataFrame, exclusions: DataFrame, index: DataFrame, links: DataFrame, rules: DataFrame) -> DataFrame:
    """Outcome of every legal item that the syllabus of a call reaches: ``call_id, item_id, topic_id, part, content_type, outcome``.

    Items are joined with the index by norm and article; the index is broadcast only if adaptive execution finds it small.
    """
    base = eligible_items(items, exclusions).filter("reason is null")
    met = base.join(index, ["norm_id", "base"])
    have = links.select("call_id", "item_id").distinct().withColumn("known", F.lit(True))
    practice = calls_with_practice(rules).withColumn("practice", F.lit(True))
    met = met.join(have, ["call_id", "item_id"], "left").join(F.broadcast(practice), "call_id", "left")
    outcome = F.when((F.upper("theory_practice") == "PRACTICA") & F.col("practice").isNull(), "PRACTICE_NOT_ADMITTED").when(F.col("known"), "EXISTING").otherwise("NEW")
    return met.select("call_id", "item_id", "topic_id", "part", "content_type", "theory_practice", outcome.alias("outcome"))


def match_categories(items: DataFrame, exclusions: DataFrame, categories: DataFrame, topics: DataFrame, links: DataFrame) -> DataFrame:
    """Outcome of every non-legal item, as :func:`match_items`: NEW or EXISTING in the calls whose syllabus has its category.

    Items without a category are INCOMPLETE, those whose category no call has (or none with one topic) OUTSIDE; their call is null.
    """
    out = exclusions.filter("state in ('CUARENTENA', 'RETIRADA')").select("item_id").distinct()
    i = items.filter("kind = 'INFORMATICA'").join(out, "item_id", "left_anti").select("item_id", "theory_practice", F.upper(F.trim(F.coalesce("category", F.lit("")))).alias("category"))
    index = category_index(categories).filter("topic_id is not null").select("call_id", "category", "topic_id").join(topics.select("topic_id", "part", "content_type"), "topic_id")
    have = links.select("call_id", "item_id").distinct().withColumn("known", F.lit(True))
    met = i.join(index, "category", "left").join(have, ["call_id", "item_id"], "left")
    outcome = F.when(F.col("category") == "", "INCOMPLETE").when(F.col("topic_id").isNull(), "OUTSIDE").when(F.col("known"), "EXISTING").otherwise("NEW")
    return met.select("call_id", "item_id", "topic_id", "part", "content_type", "theory_practice", outcome.alias("outcome"))


def unmatched_items(items: DataFrame, exclusions: DataFrame, index: DataFrame) -> DataFrame:
    """Legal items that enter no bank: ``item_id, outcome``, INCOMPLETE (fields missing) or OUTSIDE of every syllabus."""
    base = eligible_items(items, exclusions).filter("reason is null or reason like 'INCOMPLETE%'").select("item_id", "reason", "norm_id", "base")
    left = base.join(index.select("norm_id", "base").distinct().withColumn("covered", F.lit(True)), ["norm_id", "base"], "left")
    return left.filter("reason is not null or covered is null").select("item_id", F.when(F.col("reason").isNotNull(), "INCOMPLETE").otherwise("OUTSIDE").alias("outcome"))


def blocked_calls(refs: DataFrame, topics: DataFrame, categories: DataFrame) -> DataFrame:
    """``call_id, incidents``: invalid or repeated references and invalid categories; any incident blocks the plan of a call."""
    located = located_refs(refs, topics)
    every = invalid_refs(located).select("call_id").unionAll(repeated_refs(located).select("call_id")).unionAll(category_index(categories).filter("reason is not null").select("call_id"))
    return every.groupBy("call_id").agg(F.count("*").alias("incidents"))


#: Fixed value: items whose topics a task resolves, so that its memory doesn't grow with the input.
_ITEMS = 1 << 18


def _agreed_topics(items: DataFrame, located: DataFrame, rows: int) -> DataFrame:
    """``call_id, item_id, topic_id`` (null if ambiguous) of items (item_id, norm_id, base, full), at most ``rows`` of them.

    Nearly every pair of a call and an item is a group of its own, so pairs are dealt to as many tasks as the items
    need, and aren't grouped before that.
    """
    exact = F.when(F.col("full") == F.col("item_full"), F.col("topic_id"))
    # a task holds its references, the smaller side, and items stream past without being sorted
    met = items.select("item_id", "norm_id", "base", F.col("full").alias("item_full")).join(located.select("call_id", "norm_id", "base", "full", "topic_id").hint("shuffle_hash"), ["norm_id", "base"])
    tasks = max(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // _ITEMS))
    dealt = met.select("call_id", "item_id", "topic_id", exact.alias("exact")).repartition(tasks, "call_id", "item_id")
    by = dealt.groupBy("call_id", "item_id").agg(F.min("topic_id").alias("lo"), F.max("topic_id").alias("hi"), F.min("exact").alias("elo"), F.max("exact").alias("ehi"))
    return by.select("call_id", "item_id", F.when(F.col("lo") == F.col("hi"), F.col("lo")).when(F.col("elo") == F.col("ehi"), F.col("elo")).alias("topic_id"))


def resolve_topic(items: DataFrame, located: DataFrame, rows: int | None = None) -> DataFrame:
    """Topic of an item in each call without picking among several: the only candidate, else the only exact reference, else ambiguous.

    ``rows``: at most how many items there are; they are counted if it isn't given.
    """
    i = article_forms(items.filter("norm_id is not null").select("item_id", "norm_id", "article_n"), "article_n").filter("base is not null")
    by = _agreed_topics(i, located, items.count() if rows is None else rows)
    return by.withColumn("reason", F.when(F.col("topic_id").isNull(), "AMBIGUOUS"))


def resolve_part(rows: DataFrame, rules: DataFrame, key: list[str], kinds: DataFrame | None = None) -> DataFrame:
    """Part of each row by the call's wildcard rules (null fits all): that of the lowest priority, if it is the only one.

    ``rows`` has ``call_id, part, content_type, theory_practice``. Rows are reduced to their distinct attributes before
    the wildcard join, so its size follows the number of attribute combinations, not of rows. ``kinds``: combinations
    that hold all those of ``rows`` in calls with rules, where they are known without making ``rows`` twice.
    """
    attributes = ["call_id", "part", "content_type", "theory_practice"]
    kinds = rows.select(*attributes).distinct() if kinds is None else kinds
    r = rules.select("call_id", F.col("part_id").alias("rule_part"), "priority", F.upper("syllabus_part").alias("p"), F.upper("content_type").alias("c"), F.upper("theory_practice").alias("t"))
    fits = lambda rule, x: F.col(rule).isNull() | (F.col(rule) == F.upper(F.coalesce(x, F.lit(""))))
    met = kinds.join(r, "call_id", "left").filter(F.col("rule_part").isNull() | (fits("p", F.col("part")) & fits("c", kinds["content_type"]) & fits("t", kinds["theory_practice"])))
    won = met.withColumn("least", F.min("priority").over(Window.partitionBy(*attributes))).filter("priority = least").groupBy(*attributes).agg(F.min("rule_part").alias("lo"), F.max("rule_part").alias("hi"))
    won = won.select(*[F.col(a).alias(f"_{a}") for a in attributes], "lo", "hi")
    same = [rows[a].eqNullSafe(won[f"_{a}"]) for a in attributes]
    out = rows.join(won, on=same[0] & same[1] & same[2] & same[3], how="left")
    part_id = F.when(F.col("lo") == F.col("hi"), F.col("lo"))
    return out.select(*[rows[k] for k in key], part_id.alias("part_id"), F.when(F.col("lo").isNull(), "NO_RULE").when(part_id.isNull(), "AMBIGUOUS").alias("part_reason"))


def reassignable_links(links: DataFrame, items: DataFrame, located: DataFrame, topics: DataFrame, rules: DataFrame) -> DataFrame:
    """Legal links whose topic differs from the resolved one and whose part resolves: ``link_id, call_id, item_id, old_topic, topic_id, part_id``."""
    linked = items.join(links.filter("link_type = 'JURIDICA'").select("item_id").distinct(), "item_id", "left_semi")
    want = resolve_topic(linked, located, items.count()).filter("topic_id is not null").select("call_id", "item_id", "topic_id")
    moved = links.filter("link_type = 'JURIDICA'").select("link_id", "call_id", "item_id", F.col("topic_id").alias("old_topic")).join(want, ["call_id", "item_id"]).filter("old_topic <> topic_id")
    moved = moved.join(topics.select("topic_id", "part", "content_type"), "topic_id").join(items.select("item_id", "theory_practice"), "item_id")
    parts = resolve_part(moved, rules, ["link_id", "call_id", "item_id", "old_topic", "topic_id"])
    return parts.filter("part_reason is null").drop("part_reason")


def retirable_links(links: DataFrame, items: DataFrame, exclusions: DataFrame, located: DataFrame) -> DataFrame:
    """Included legal links whose item is no longer eligible or whose reference left the syllabus; the first reason counts."""
    e = eligible_items(items, exclusions).select("item_id", "reason", "norm_id", "base")
    known = located.filter("norm_id is not null and base is not null").select("call_id", "norm_id", "base").distinct().withColumn("covered", F.lit(True))
    met = links.filter("link_type = 'JURIDICA' and state = 'INCLUIDA'").select("link_id", "call_id", "item_id").join(e, "item_id", "left").join(known, ["call_id", "norm_id", "base"], "left")
    reason = F.coalesce("reason", F.when(F.col("covered").isNull(), "OUT_OF_SYLLABUS"))
    return met.select("link_id", "call_id", "item_id", reason.alias("reason")).filter("reason is not null")


def bank_plan(items: DataFrame, exclusions: DataFrame, refs: DataFrame, topics: DataFrame, rules: DataFrame, links: DataFrame, categories: DataFrame) -> DataFrame:
    """What to do for the banks of all calls: ``call_id, item_id, action, topic_id, part_id, reason, link_type`` (add, reassign, retire, or blocked).

    Items are judged and their articles normalised once, located references and links are made once; all are narrow and
    kept, compressed, in the checkpoint folder for their readers; the parts of new and of reassigned links are resolved together.
    """
    links = kept(links.select("link_id", "call_id", "item_id", "link_type", "state", "topic_id"))
    return _bank_plan(items, exclusions, refs, topics, rules, links, categories)


#: Fixed value: different spellings of articles that every task may hold.
_SPELT = 1 << 16


def _bank_plan(items: DataFrame, exclusions: DataFrame, refs: DataFrame, topics: DataFrame, rules: DataFrame, links: DataFrame, categories: DataFrame) -> DataFrame:
    """:func:`bank_plan` over links that are made already."""
    out = exclusions.filter("state in ('CUARENTENA', 'RETIRADA')").select("item_id").distinct().withColumn("excluded", F.lit(True))
    missing = completeness_reason(F.col("norm_type_n"), F.col("norm_name_n"), F.col("norm_id"), F.col("article_n"))
    reason = (
        F.when(F.upper(F.trim("validity")).startswith("OBSOLETA"), "OBSOLETE").when(missing != "", F.concat(F.lit("INCOMPLETE:"), missing))
        .when(F.col("base").isNull(), "ARTICLE")
    )
    spelt = kept(items.select(F.col("article_n").alias("_spelt")).distinct().withColumn("base", article_base(F.col("_spelt"))).withColumn("full", article_full(F.col("_spelt"))))
    # counted, so that items aren't shuffled by their article where its spellings are few
    spelt = F.broadcast(spelt) if spelt.count() <= _SPELT else spelt
    judged = items.join(spelt, items["article_n"].eqNullSafe(spelt["_spelt"]), "left")
    # nothing but what is asked for later is shuffled by item
    judged = judged.select("item_id", "kind", "norm_id", "base", "full", "category", F.upper("theory_practice").alias("theory_practice"), reason.alias("reason")).join(out, "item_id", "left")
    judged = kept(judged.withColumn("reason", F.when(F.col("excluded"), "EXCLUDED").otherwise(F.col("reason"))))
    located = located_refs(refs, topics).filter("norm_id is not null and base is not null")
    located = kept(located.select("ref_id", "call_id", "norm_id", "article_asked", "base", "full", "topic_id", "part", "number", "content_type"))

    have = links.select("call_id", "item_id").distinct()
    practice = calls_with_practice(rules).withColumn("practice", F.lit(True))
    legal = judged.filter("kind = 'JURIDICA' and reason is null").select("item_id", "norm_id", "base", "theory_practice").join(ref_index(located), ["norm_id", "base"])
    legal = legal.join(practice, "call_id", "left").filter("theory_practice is null or theory_practice <> 'PRACTICA' or practice").join(have, ["call_id", "item_id"], "left_anti")
    index = category_index(categories).filter("topic_id is not null").select("call_id", "category", "topic_id").join(topics.select("topic_id", "part", "content_type"), "topic_id")
    other = judged.filter("kind = 'INFORMATICA' and excluded is null").select("item_id", "theory_practice", F.upper(F.trim("category")).alias("category")).join(index, "category").join(have, ["call_id", "item_id"], "left_anti")

    old = links.filter("link_type = 'JURIDICA'").select("link_id", "call_id", "item_id", F.col("topic_id").alias("old_topic"), "state")
    covered = located.select("call_id", "norm_id", "base").distinct().withColumn("covered", F.lit(True))
    held = judged.filter("kind = 'JURIDICA'").select("item_id", "norm_id", "base", "reason")
    gone = old.filter("state = 'INCLUIDA'").join(held, "item_id", "left").join(covered, ["call_id", "norm_id", "base"], "left")
    gone = gone.withColumn("reason", F.coalesce("reason", F.when(F.col("covered").isNull(), "OUT_OF_SYLLABUS"))).filter("reason is not null").select("link_id", "call_id", "item_id", "reason")
    gone = kept(gone)
    retire = gone.select("call_id", "item_id", F.lit("RETIRE").alias("action"), F.lit(None).cast("bigint").alias("topic_id"), F.lit(None).cast("bigint").alias("part_id"), "reason", F.lit("JURIDICA").alias("link_type"))

    # the topic that the references of a linked item agree on
    linked = judged.select("item_id", "norm_id", "base", "full").join(old.select("item_id").distinct(), "item_id", "left_semi")
    met = _agreed_topics(linked, located, items.count())
    moved = old.join(met, ["call_id", "item_id"]).filter("old_topic <> topic_id").join(gone, "link_id", "left_anti")
    moved = moved.select("call_id", "item_id", "topic_id").join(topics.select("topic_id", "part", "content_type"), "topic_id").join(judged.select("item_id", "theory_practice"), "item_id")

    columns = ["call_id", "item_id", "topic_id", "part", "content_type", "theory_practice"]
    kinds = ((legal, "ADD", "JURIDICA"), (other, "ADD", "NO_JURIDICA"), (moved, "REASSIGN", "JURIDICA"))
    rows = reduce(DataFrame.unionByName, [x.select(*columns, F.lit(action).alias("action"), F.lit(kind).alias("link_type")) for x, action, kind in kinds])
    # a part and a content type are a topic's, a kind of question is an item's: few values each
    kinds = rules.select("call_id").distinct().crossJoin(topics.select("part", "content_type").distinct()).crossJoin(judged.select("theory_practice").distinct())
    parts = resolve_part(rows, rules, ["call_id", "item_id", "topic_id", "action", "link_type"], kinds).filter("action = 'ADD' or part_reason is null")
    made = parts.select("call_id", "item_id", F.when(F.col("part_reason").isNull(), F.col("action")).otherwise("BLOCKED").alias("action"), "topic_id", "part_id", F.col("part_reason").alias("reason"), "link_type")
    return made.unionByName(retire)


def bank_incidents(links: DataFrame, items: DataFrame, topics: DataFrame, rules: DataFrame) -> DataFrame:
    """What is wrong with stored links: ``call_id, incident, n``.

    ``PART`` (none), ``TOPIC`` (none), ``OTHER_CALL`` (the topic's), ``TYPE`` (of link and item), ``PRACTICE`` (not
    admitted by the call) by links; ``REPEATED`` by items that a call has several times.
    """
    def counted(rows: DataFrame, *flags: Column) -> DataFrame:
        return rows.select("call_id", F.explode(F.array_compact(F.array(*flags))).alias("incident")).groupBy("call_id", "incident").agg(F.count("*").alias("n"))

    t = topics.select("topic_id", F.col("call_id").alias("topic_call"))
    placed = links.select("call_id", "part_id", "topic_id").join(t, "topic_id", "left")
    by_link = counted(placed, F.when(F.col("part_id").isNull(), "PART"), F.when(F.col("topic_id").isNull(), "TOPIC"), F.when(F.col("topic_call") != F.col("call_id"), "OTHER_CALL"))
    practice = calls_with_practice(rules).withColumn("practice", F.lit(True))
    met = links.select("call_id", "item_id", "link_type").join(items.select("item_id", "kind", "theory_practice"), "item_id").join(practice, "call_id", "left")
    wrong_type = ((F.col("link_type") == "JURIDICA") & (F.col("kind") != "JURIDICA")) | ((F.col("link_type") == "NO_JURIDICA") & (F.col("kind") != "INFORMATICA"))
    by_item = counted(met, F.when(wrong_type, "TYPE"), F.when((F.upper(F.trim("theory_practice")) == "PRACTICA") & F.col("practice").isNull(), "PRACTICE"))
    twice = links.groupBy("call_id", "item_id").agg(F.count("*").alias("k")).filter("k > 1").groupBy("call_id").agg(F.count("*").alias("n"))
    return by_link.unionByName(by_item).unionByName(twice.select("call_id", F.lit("REPEATED").alias("incident"), "n"))


def plan_incidents(refs: DataFrame, topics: DataFrame, categories: DataFrame) -> DataFrame:
    """What is wrong with a call's syllabus: ``call_id, incident, n`` (``REFERENCE``, ``REPEATED_REFERENCE``, ``CATEGORY``)."""
    located = located_refs(refs, topics)
    kinds = ((invalid_refs(located), "REFERENCE"), (repeated_refs(located), "REPEATED_REFERENCE"), (category_index(categories).filter("reason is not null"), "CATEGORY"))
    rows = reduce(DataFrame.unionAll, [x.select("call_id", F.lit(k).alias("incident")) for x, k in kinds])
    return rows.groupBy("call_id", "incident").agg(F.count("*").alias("n"))


def gate(calls: DataFrame, plan: DataFrame, incidents: DataFrame, together: bool = False) -> DataFrame:
    """Review of every call: ``call_id, add, reassign, retire, blocked, incidents, vetoed``.

    Any incident vetoes the changes of its call; ``together``: of all calls.
    """
    counted = incidents.groupBy("call_id").agg(F.sum("n").alias("incidents"))
    n = [F.count_if(F.col("action") == a).alias(a.lower()) for a in ("ADD", "REASSIGN", "RETIRE", "BLOCKED")]
    met = calls.select("call_id").distinct().join(plan.groupBy("call_id").agg(*n), "call_id", "left").join(counted, "call_id", "left").na.fill(0)
    vetoed = F.col("incidents") > 0
    # one row per call
    return met.withColumn("vetoed", F.max(vetoed).over(Window.partitionBy()) if together else vetoed)


def sync_banks(calls: DataFrame, items: DataFrame, exclusions: DataFrame, refs: DataFrame, topics: DataFrame, rules: DataFrame, links: DataFrame, categories: DataFrame, together: bool = False) -> tuple[DataFrame, DataFrame]:
    """Links of all calls after their plans, and the review (:func:`gate`, with ``rolled_back``), in two phases of one job.

    First all calls are planned and reviewed: calls with incidents in their syllabus or their stored links keep their
    links. Then plans of the other calls are applied and the result is audited: a call whose new links have incidents
    keeps its old ones.
    """
    items = kept(items.select("item_id", "kind", "norm_id", "norm_type_n", "norm_name_n", "article_n", "category", "theory_practice", "validity"))
    links = kept(links)
    plan = kept(_bank_plan(items, exclusions, refs, topics, rules, links, categories))
    before = plan_incidents(refs, topics, categories).unionByName(bank_incidents(links, items, topics, rules))
    review = gate(calls, plan, before, together).checkpoint()
    new = kept(_applied(links, plan, review.filter("vetoed")))
    after = bank_incidents(new, items, topics, rules).join(review.filter("not vetoed"), "call_id", "left_semi").select("call_id").distinct().withColumn("rolled_back", F.lit(True)).checkpoint()
    stay = new.join(after, "call_id", "left_anti").unionByName(links.select(*new.columns).join(after, "call_id", "left_semi"))
    return stay, review.join(after, "call_id", "left").na.fill(False, ["rolled_back"])


def apply_bank_plan(links: DataFrame, plan: DataFrame, blocked: DataFrame | None = None) -> DataFrame:
    """Links after a plan: without the retired, with new topics and parts, and with the added ones. Applying it again changes nothing.

    Calls in ``blocked`` (see :func:`blocked_calls`) keep their links as they are.
    """
    # the plan has two readers
    return _applied(links, kept(plan), blocked)


def _applied(links: DataFrame, plan: DataFrame, blocked: DataFrame | None) -> DataFrame:
    if blocked is not None:
        plan = plan.join(blocked.select("call_id").distinct(), "call_id", "left_anti")
    p = plan.filter("action <> 'BLOCKED'").select("call_id", "item_id", "action", F.col("topic_id").alias("to_topic"), F.col("part_id").alias("to_part"), F.col("link_type").alias("to_type"))
    held = links.join(p.filter("action <> 'ADD'"), ["call_id", "item_id"], "left").filter("action is null or action <> 'RETIRE'")
    held = held.select("call_id", "item_id", F.coalesce("to_part", "part_id").alias("part_id"), "link_type", "state", F.coalesce("to_topic", "topic_id").alias("topic_id"))
    added = p.filter("action = 'ADD'").join(links.select("call_id", "item_id"), ["call_id", "item_id"], "left_anti")
    return held.unionByName(added.select("call_id", "item_id", F.col("to_part").alias("part_id"), F.col("to_type").alias("link_type"), F.lit("INCLUIDA").alias("state"), F.col("to_topic").alias("topic_id")))


def plan_totals(plan: DataFrame) -> DataFrame:
    """Per call: how much of each action, and whether anything blocks it."""
    n = [F.count_if(F.col("action") == a).alias(a.lower()) for a in ("ADD", "REASSIGN", "RETIRE", "BLOCKED")]
    return plan.groupBy("call_id").agg(*n).withColumn("blocks", F.col("blocked") > 0)


def expected_bank(items: DataFrame, refs: DataFrame, topics: DataFrame) -> DataFrame:
    """Independent re-derivation: legal items whose reference belongs to exactly one topic of a call."""
    index = ref_index(located_refs(refs, topics), "unambiguous")
    i = items.filter("kind = 'JURIDICA' and norm_id is not null").select("item_id", "norm_id", article_base(F.col("article_n")).alias("base"))
    return i.join(index, ["norm_id", "base"]).select("call_id", "item_id", "topic_id")


def diff_bank(expected: DataFrame, links: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Full comparison of expected and stored links: ``call_id, item_id, flags``; only rows with a flag."""
    e = expected.select("call_id", "item_id", F.col("topic_id").alias("want"))
    a = links.select("call_id", "item_id", "topic_id", "part_id", "link_type", "state", F.lit(True).alias("stored"))
    x = exclusions.select("item_id").distinct().withColumn("excluded", F.lit(True))
    met = e.join(a, ["call_id", "item_id"], "full").join(x, "item_id", "left")
    stored, out = F.col("stored").isNotNull(), F.col("excluded").isNotNull()
    flags = F.concat_ws(
        ",", F.when(~stored & ~out, "MISSING"), F.when(F.col("want").isNull() & (F.col("link_type") == "JURIDICA") & ~out, "SURPLUS"), F.when(F.col("want") != F.col("topic_id"), "TOPIC"),
        F.when(F.col("want").isNotNull() & (F.col("link_type") != "JURIDICA"), "TYPE"), F.when(stored & F.col("part_id").isNull(), "PART"), F.when(stored & out & (F.col("state") != "REVISION"), "EXCLUDED"),
    )
    return met.select("call_id", "item_id", flags.alias("flags")).filter("flags <> ''")


def surplus_links(expected: DataFrame, links: DataFrame) -> DataFrame:
    return links.filter("link_type = 'JURIDICA'").join(expected.select("call_id", "item_id"), ["call_id", "item_id"], "left_anti")


def repair_parts(links: DataFrame, items: DataFrame, topics: DataFrame, rules: DataFrame) -> DataFrame:
    """Links whose part is null or not the resolved one: ``link_id, old_part, part_id, part_reason``."""
    rows = links.select("link_id", "call_id", "item_id", F.col("part_id").alias("old_part"), "topic_id").join(topics.select("topic_id", "part", "content_type"), "topic_id").join(items.select("item_id", "theory_practice"), "item_id")
    return resolve_part(rows, rules, ["link_id", "old_part"]).filter("part_id is null or old_part is null or part_id <> old_part")


def norm_catalogue(names: DataFrame, known: DataFrame) -> DataFrame:
    """New entries of the norm catalogue: ``key, name`` of the first name per identity that is not known; undated identities with a dated form are left out."""
    keyed = names.select("name").distinct().select("name", norm_identity(F.col("name")).alias("key")).withColumn("undated", norm_identity_undated(F.col("key")))
    entry = lambda key, name, dated: F.struct(F.col(key).alias("key"), name.alias("name"), F.lit(dated).alias("dated"))
    # an identity and the undated form that it replaces meet in one grouping, so identities are made once
    entries = keyed.select(F.inline(F.array(entry("key", F.col("name"), False), F.when(F.col("undated") != F.col("key"), entry("undated", F.lit(None).cast("string"), True)))))
    met = entries.filter("key <> ''").groupBy("key").agg(F.min("name").alias("name"), F.max("dated").alias("dated"))
    return met.filter("name is not null and not dated").join(known.select("key"), "key", "left_anti").select("key", "name")


def link_to_norms(rows: DataFrame, key: Column, norms: DataFrame, overwrite: bool) -> DataFrame:
    """Set ``norm_id`` from the catalogue by key: always where it is found, or only where it is null."""
    n = norms.select(F.col("norm_key").alias("_key"), F.col("norm_id").alias("_found"))
    met = rows.withColumn("_key", key).join(n, "_key", "left")
    value = F.coalesce("_found", "norm_id") if overwrite else F.coalesce("norm_id", "_found")
    return met.withColumn("norm_id", value).drop("_key", "_found")


def longest_text(articles: DataFrame) -> DataFrame:
    """Longest text of each (norm, article)."""
    return articles.groupBy("norm_id", "article_no").agg(F.max_by("article_id", F.struct(F.length("text"), -F.col("article_id"))).alias("article_id"), F.max(F.length("text")).alias("chars"))


def text_coverage(items: DataFrame, articles: DataFrame) -> DataFrame:
    """State of each legal item's source: no norm, no article, no text, several texts, or verifiable."""
    texts = articles.groupBy("norm_id", F.col("article_no").cast("string").alias("base")).agg(F.count_distinct("text_hash").alias("n"))
    i = items.filter("kind = 'JURIDICA'").select("item_id", "norm_id", article_base(F.col("article_n")).alias("base"))
    state = F.when(F.col("norm_id").isNull(), "NO_NORM").when(F.col("base").isNull(), "NO_ARTICLE").when(F.col("n").isNull(), "NO_TEXT").when(F.col("n") > 1, "SEVERAL").otherwise("VERIFIABLE")
    return i.join(texts, ["norm_id", "base"], "left").select("item_id", state.alias("state"))


def seed_sources(rows: DataFrame) -> DataFrame:
    """``source_id`` with its norm if exactly one uses it, else a conflict."""
    by = rows.filter("norm_id is not null").groupBy("source_id").agg(F.min("norm_id").alias("norm_id"), F.count_distinct("norm_id").alias("n"))
    return by.select("source_id", F.when(F.col("n") == 1, F.col("norm_id")).alias("norm_id"), (F.col("n") > 1).alias("conflict"))


def resolve_sources(names: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Norm of each source from all its names: several catalogue hits are a conflict; none and not one identity is pending; else link or create."""
    keys = names.select("name").distinct().select("name", norm_identity(F.col("name")).alias("key"))
    k = names.select("source_id", "name").distinct().join(keys, "name").select("source_id", "key").distinct()
    met = k.join(catalogue.select("key", "norm_id"), "key", "left").groupBy("source_id").agg(F.count_distinct("norm_id").alias("hits"), F.min("norm_id").alias("norm_id"), F.count_distinct("key").alias("keys"))
    state = F.when(F.col("hits") > 1, "CONFLICT").when(F.col("hits") == 1, "LINK").when(F.col("keys") == 1, "CREATE").otherwise("PENDING")
    return met.select("source_id", state.alias("state"), F.when(F.col("hits") == 1, F.col("norm_id")).alias("norm_id"))


def unresolved_sources(articles: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents that no norm claims, with the norms that use them."""
    a = articles.join(sources.select("source_id"), "source_id", "left_anti")
    return a.groupBy("source_id").agg(F.array_join(F.array_sort(F.collect_set("norm_id")), ",").alias("norms"), F.count("*").alias("n"))


def precise_or_link(refs: DataFrame, norms: DataFrame) -> DataFrame:
    """For refs with a dated or undated identity: link to the only exact or undated norm, upgrade a lone undated one, create, or block."""
    r = refs.select("ref_id", "key", norm_identity_undated(F.col("key")).alias("plain"))
    n = norms.select(F.col("key").alias("nkey"), norm_identity_undated(F.col("key")).alias("plain"), "norm_id")
    met = r.join(n, "plain", "left").groupBy("ref_id", "key", "plain").agg(
        F.count("norm_id").alias("all"), F.min(F.when(F.col("nkey") == F.col("key"), F.col("norm_id"))).alias("exact"), F.min("norm_id").alias("lone"), F.count_if(F.col("nkey") == F.col("plain")).alias("undated")
    )
    action = (
        F.when(F.col("exact").isNotNull(), "LINK").when(F.col("all") == 0, "CREATE").when(F.col("all") > 1, "BLOCKED").when((F.col("undated") == 1) & (F.col("key") != F.col("plain")), "UPGRADE")
        .when(F.col("key") == F.col("plain"), "LINK").otherwise("BLOCKED")
    )
    return met.select("ref_id", action.alias("action"), F.coalesce("exact", F.when(action.isin("LINK", "UPGRADE"), F.col("lone"))).alias("norm_id"))


def filter_by_citations(rows: DataFrame) -> DataFrame:
    """Keep rows whose cited norms, if any, include the assigned one (``cited`` array, ``assigned``)."""
    return rows.filter((F.size("cited") == 0) | F.array_contains("cited", F.col("assigned")))


def disambiguate(candidates: DataFrame, key: str, stages: list[str]) -> DataFrame:
    """Filter cascade over boolean columns: a stage applies where any candidate of the key passes it; one left is chosen, else none."""
    w = Window.partitionBy(key)
    out = candidates
    for s in stages:
        any_ = F.max(F.coalesce(F.col(s), F.lit(False)).cast("int")).over(w)
        out = out.withColumn("_any", any_).filter((F.col("_any") == 0) | F.col(s)).drop("_any")
    return out.withColumn("_n", F.count("*").over(w)).filter("_n = 1").drop("_n")


def current_block(blocks: DataFrame) -> DataFrame:
    """The most recent block per (source, article): ``article_id``, or an incident if there is no date or a tie."""
    w = Window.partitionBy("source_id", "article_no")
    top = blocks.withColumn("latest", F.max("dated").over(w)).withColumn("undated", F.count_if(F.col("dated").isNull()).over(w)).filter("dated = latest or (latest is null)")
    by = top.groupBy("source_id", "article_no").agg(F.min("article_id").alias("a"), F.count("*").alias("n"), F.max("undated").alias("undated"))
    reason = F.when(F.col("undated") > 0, "NO_DATE").when(F.col("n") > 1, "TIE")
    return by.select("source_id", "article_no", F.when(reason.isNull(), F.col("a")).alias("article_id"), reason.alias("incident"))


def missing_numbers_of_norms(official: DataFrame, held: DataFrame) -> DataFrame:
    """Official article numbers of a norm that none of its documents holds."""
    return official.select("norm_id", "article_no").distinct().join(held.select("norm_id", "article_no").distinct(), ["norm_id", "article_no"], "left_anti")


def canonical_partial(parts: DataFrame, key: str) -> DataFrame:
    """Best tier (complete and preferred, complete, preferred, any) if exactly one part has it."""
    tier = F.when(F.col("complete") & F.col("preferred"), 1).when(F.col("complete"), 2).when(F.col("preferred"), 3).otherwise(4)
    ranked = parts.withColumn("tier", tier)
    best = ranked.groupBy(key).agg(F.min("tier").alias("tier"))
    by = ranked.join(best, [key, "tier"]).groupBy(key, "tier").agg(F.min("part_id").alias("part_id"), F.count("*").alias("n"))
    return by.select(key, "tier", F.when(F.col("n") == 1, F.col("part_id")).alias("part_id"))


def metadata_fallback(rows: DataFrame, examples: DataFrame, pool: DataFrame) -> DataFrame:
    """Kind of norm from an example of the item, else from any item of the norm (lowest id), else derived."""
    of_norm = pool.filter("norm_type_n is not null and norm_id is not null").groupBy("norm_id").agg(F.min_by("norm_type_n", "item_id").alias("of_norm"))
    met = rows.join(examples.select("item_id", F.col("norm_type_n").alias("of_example")), "item_id", "left").join(of_norm, "norm_id", "left")
    return met.select("item_id", F.coalesce("of_example", "of_norm", F.lit("DERIVED")).alias("norm_type"))


def alias_link(refs: DataFrame, aliases: dict[str, int]) -> DataFrame:
    """Norm of references without one by the alias of their name."""
    names = F.create_map(*[x for k, v in aliases.items() for x in (F.lit(k), F.lit(v))])
    return refs.withColumn("norm_id", F.coalesce("norm_id", F.try_element_at(names, F.lower(F.trim("norm_name")))))


def part_errors(items: DataFrame, exclusions: DataFrame, located: DataFrame, links: DataFrame, rules: DataFrame) -> DataFrame:
    """New items whose part can't be resolved, by call, attributes and reason."""
    rows = match_items(items, exclusions, ref_index(located), links, rules).filter("outcome = 'NEW'")
    parts = resolve_part(rows, rules, ["call_id", "item_id", "part", "content_type", "theory_practice"])
    return parts.filter("part_reason is not null").groupBy("call_id", "part", "content_type", "theory_practice", "part_reason").agg(F.count("*").alias("n"))


def best_named_source(names: DataFrame, sources: DataFrame, least: float = 0.7) -> DataFrame:
    """Source whose name shares most words with each name (share of all words), if at least ``least``; ties only within one identity, official before local.

    ``names``: id, tokens; ``sources``: source_id, tokens, identity, official. They meet at shared words.
    """
    a = names.select("id", F.explode("tokens").alias("token"), F.size("tokens").alias("na"))
    b = sources.select("source_id", "identity", "official", F.explode("tokens").alias("token"), F.size("tokens").alias("nb"))
    s = a.join(b, "token").groupBy("id", "source_id", "identity", "official", "na", "nb").agg(F.count("*").alias("n"))
    s = s.withColumn("score", F.round(F.col("n") / (F.col("na") + F.col("nb") - F.col("n")), 6)).filter(F.col("score") >= least)
    top = s.withColumn("r", F.rank().over(Window.partitionBy("id").orderBy(F.desc("score")))).filter("r = 1")
    by = top.groupBy("id").agg(F.count_distinct("identity").alias("identities"), F.min(F.struct((~F.col("official")).alias("local"), "source_id")).alias("best"), F.max("score").alias("score"))
    return by.filter("identities = 1").select("id", "best.source_id", "score")


def material_scope(topics: DataFrame, headings: DataFrame) -> DataFrame:
    """Headings of the official index whose words stand in a row in a topic's text and that are unique in their norm, but for ancestors of other hits.

    ``topics``: topic_id, norm_id, words (blank-joined, blanks at both ends); ``headings``: norm_id, path, words (the same).
    A heading meets the topics of its norm that hold its first two words in a row.
    """
    h = headings.withColumn("n", F.count("*").over(Window.partitionBy("norm_id", "words"))).filter((F.col("n") == 1) & (F.size(F.split(F.trim("words"), " ")) >= 2)).select("norm_id", "path", F.col("words").alias("hw"))
    w = F.split(F.trim("words"), " ")
    # zipped, as a lambda would split the text again for each word
    twos = F.array_distinct(F.zip_with(w, F.slice(w, F.lit(2), F.size(w)), lambda x, y: F.xxhash64(x, y)))
    held = topics.filter(F.size(w) >= 2).select("topic_id", "norm_id", F.explode(twos).alias("two"))
    first = F.split(F.trim("hw"), " ")
    met = held.join(h.withColumn("two", F.xxhash64(first[0], first[1])), ["norm_id", "two"]).select("topic_id", "norm_id", "path", "hw")
    hit = met.join(topics.select("topic_id", "norm_id", "words"), ["topic_id", "norm_id"]).filter(F.col("words").contains(F.col("hw"))).select("topic_id", "norm_id", "path").distinct()
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))
    below = hit.filter(F.size(steps) > 1).select("topic_id", "norm_id", F.explode(above).alias("path"))
    return hit.join(below, ["topic_id", "norm_id", "path"], "left_anti")
