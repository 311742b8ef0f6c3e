"""Read-only audits: violating rows and counts."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillbank.functions.textnorm import norm_spaces_lower


def violations(rows: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """One row per key and failed check, in a single pass."""
    failed = F.array(*[F.when(bad, F.lit(name)) for name, bad in checks.items()])
    return rows.select(key, F.explode(F.filter(failed, lambda f: f.isNotNull())).alias("check"))


def conditional_counts(rows: DataFrame, counts: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """How many rows satisfy each condition, overall or by group."""
    return rows.groupBy(*(by or [])).agg(*[F.count_if(c).alias(n) for n, c in counts.items()])


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key has no parent; null keys refer to nothing and are no orphans."""
    return child.filter(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def duplicate_keys(table: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    by = table.groupBy(*keys).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(row_id)), ",").alias("ids"))
    return by.filter("n > 1")


def included_but_excluded(links: DataFrame, exclusions: DataFrame) -> DataFrame:
    return links.filter("state = 'INCLUIDA'").join(exclusions.select("item_id"), "item_id", "left_semi")


def unreferenced(rows: DataFrame, key: str, *users: DataFrame) -> DataFrame:
    """Rows that no user table refers to by ``key``."""
    return reduce(lambda acc, u: acc.join(u.select(key), key, "left_anti"), users, rows)


def topic_defects(links: DataFrame, link_topics: DataFrame, topics: DataFrame) -> DataFrame:
    """Links with no topic, several, no single main one, or one of another call: ``link_id, defect``."""
    t = link_topics.join(topics.select("topic_id", F.col("call_id").alias("topic_call")), "topic_id", "left")
    by = links.select("link_id", "call_id").join(t, "link_id", "left").groupBy("link_id").agg(
        F.count_distinct("topic_id").alias("n"), F.count_if("is_main").alias("mains"), F.max(F.coalesce(F.col("topic_call") != F.col("call_id"), F.lit(False))).alias("foreign")
    )
    return violations(by, "link_id", {"NO_TOPIC": F.col("n") == 0, "SEVERAL": F.col("n") > 1, "NOT_ONE_MAIN": F.col("mains") != 1, "FOREIGN": F.col("foreign")}).withColumnRenamed("check", "defect")


def type_mismatch(links: DataFrame, items: DataFrame) -> DataFrame:
    """Links whose type contradicts their item's kind; an unknown kind contradicts nothing."""
    met = links.join(items.select("item_id", "kind"), "item_id")
    return met.filter(((F.col("kind") == "JURIDICA") & (F.col("link_type") != "JURIDICA")) | ((F.col("kind") != "JURIDICA") & (F.col("link_type") == "JURIDICA"))).select("link_id", "kind", "link_type")


def item_quality(items: DataFrame) -> DataFrame:
    """Included items with an invalid key, a key text that another option repeats, or repeated distractors."""
    opts = F.array(*[norm_spaces_lower(F.col(f"opt_{c}")) for c in "abcd"])
    at = F.array_position(F.array(*map(F.lit, "ABCD")), F.col("answer_key")).cast("int")
    rows = items.select("item_id", "answer_key", opts.alias("o"), at.alias("k"))
    own = F.element_at("o", F.greatest(F.col("k"), F.lit(1)))
    same = F.size(F.filter("o", lambda x: x == own))
    others = F.filter("o", lambda x: x != own)
    return violations(rows, "item_id", {"BAD_KEY": F.coalesce(F.col("k"), F.lit(0)) == 0, "KEY_REPEATED": (F.col("k") > 0) & (same > 1), "DISTRACTORS": (F.col("k") > 0) & (F.size(F.array_distinct(others)) < F.size(others))})


def field_defects(items: DataFrame) -> DataFrame:
    """Counts of defective fields in one pass, as rows."""
    empty = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    checks = {"key": ~F.coalesce(F.col("answer_key").isin(*"ABCD"), F.lit(False)), "norm_name": empty("norm_name_n"), "kind": empty("kind"), "import": F.col("import_id").isNull(), "page": F.coalesce(F.col("page"), F.lit(0)) <= 1}
    return conditional_counts(items, checks).unpivot([], list(checks), "field", "n")


def distribution(rows: DataFrame, c: str) -> DataFrame:
    """Counts by value, blanks under one label."""
    value = F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit("(blank)"))
    return rows.groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def topic_distribution(topics: DataFrame, links: DataFrame) -> DataFrame:
    """Included items per topic by kind; topics without any count zero."""
    l = links.filter("state = 'INCLUIDA'").select("topic_id", "item_id", "link_type")
    met = topics.select("call_id", "topic_id").join(l, "topic_id", "left")
    return met.groupBy("call_id", "topic_id").agg(F.count_distinct("item_id").alias("items"), F.count_distinct(F.when(F.col("link_type") == "JURIDICA", F.col("item_id"))).alias("legal"))


def bank_totals(links: DataFrame) -> DataFrame:
    """By call and over all calls (null) in one aggregation."""
    return links.rollup("call_id").agg(F.count("*").alias("total"), F.count_if(F.col("link_type") == "JURIDICA").alias("legal"), F.count_if(F.col("link_type") != "JURIDICA").alias("other"), F.count_if(F.col("state") == "REVISION").alias("review"))


def ref_states(refs: DataFrame) -> DataFrame:
    """References by state with their inconsistencies."""
    return refs.groupBy("state").agg(F.count("*").alias("n"), F.count_if(F.col("norm_id").isNull()).alias("no_norm"), F.count_if((F.col("state") == "COMPLETADO") & F.col("norm_id").isNull()).alias("done_without_norm"))


def norms_never_completed(refs: DataFrame) -> DataFrame:
    return refs.filter("norm_id is not null").groupBy("norm_id").agg(F.count("*").alias("n"), F.count_if(F.col("state") == "COMPLETADO").alias("done")).filter("done = 0").select("norm_id", "n")


def resolution_disagreements(refs: DataFrame, resolutions: DataFrame, texts: DataFrame) -> DataFrame:
    """References whose article isn't the resolved one (null-safe), and whether both texts are the same."""
    t = texts.select("article_id", "text_hash")
    met = refs.join(resolutions.select("norm_id", "article_no", F.col("article_id").alias("resolved")), ["norm_id", "article_no"], "left").filter(~F.col("article_id").eqNullSafe(F.col("resolved")))
    met = met.join(t.withColumnRenamed("text_hash", "h1"), "article_id", "left").join(t.select(F.col("article_id").alias("resolved"), F.col("text_hash").alias("h2")), "resolved", "left")
    return met.select("ref_id", "article_id", "resolved", F.coalesce(F.col("h1") == F.col("h2"), F.lit(False)).alias("same_text"))


def corpus_completeness(refs: DataFrame) -> DataFrame:
    return refs.groupBy("call_id").agg(F.count("*").alias("total"), F.count_if(F.col("state") == "COMPLETADO").alias("done"), F.count_if(F.col("norm_id").isNotNull()).alias("linked"), F.count_distinct(F.when(F.col("state") == "COMPLETADO", F.struct("norm_id", "article_asked"))).alias("articles"))


def name_variants(names: DataFrame, key: Column) -> DataFrame:
    """Normalised names with more than one spelling."""
    by = names.groupBy(key.alias("key")).agg(F.array_join(F.array_sort(F.collect_set("name")), " | ").alias("variants"), F.count_distinct("name").alias("n"), F.min("item_id").alias("first_id"), F.max("item_id").alias("last_id"))
    return by.filter("n > 1")


def blueprint_check(blueprint: DataFrame, parts: DataFrame, allowed: DataFrame) -> DataFrame:
    """Defects of each part's blueprint: orders not 1..n, sum not the part's size, norms outside of the part."""
    by = blueprint.groupBy("part_id").agg(F.array_sort(F.collect_list("block_order")).alias("orders"), F.sum("amount").alias("total"))
    foreign = blueprint.filter("block_type = 'NORMA'").join(allowed.select("part_id", "norm_id").distinct(), ["part_id", "norm_id"], "left_anti").groupBy("part_id").agg(F.count("*").alias("foreign"))
    met = by.join(parts.select("part_id", "n_items"), "part_id").join(foreign, "part_id", "left")
    run = F.transform(F.sequence(F.lit(1), F.size("orders")), lambda i: i.cast("int"))
    return violations(met.withColumn("orders", F.transform("orders", lambda o: o.cast("int"))), "part_id", {"ORDER": F.col("orders") != run, "SUM": F.col("total") != F.col("n_items"), "NORM": F.coalesce("foreign", F.lit(0)) > 0})


def rule_coverage(rules: DataFrame, topics: DataFrame, refs: DataFrame) -> DataFrame:
    """Topics and references that each wildcard rule reaches. Rules meet topics, both small and of one call; references meet topics by id."""
    r, t = rules.alias("r"), topics.alias("t")
    fits = (F.col("r.call_id") == F.col("t.call_id")) & (F.col("r.syllabus_part").isNull() | (F.upper("r.syllabus_part") == F.upper("t.part"))) & (F.col("r.content_type").isNull() | (F.upper("r.content_type") == F.upper("t.content_type")))
    met = r.join(t, fits, "left").select("r.part_id", "r.priority", "t.topic_id")
    n = refs.groupBy("topic_id").agg(F.count("*").alias("refs"))
    return met.join(n, "topic_id", "left").groupBy("part_id", "priority").agg(F.count_distinct("topic_id").alias("topics"), F.sum(F.coalesce("refs", F.lit(0))).alias("refs"))


def gap_report(located: DataFrame, links: DataFrame, items: DataFrame) -> DataFrame:
    """References that no included item covers, by topic."""
    from quillbank.functions.textnorm import article_base

    have = links.filter("state = 'INCLUIDA'").select("call_id", "item_id").join(items.select("item_id", "norm_id", article_base(F.col("article_n")).alias("base")), "item_id").select("call_id", "norm_id", "base").distinct()
    open_ = located.filter("norm_id is not null and base is not null").join(have, ["call_id", "norm_id", "base"], "left_anti")
    return open_.groupBy("call_id", "topic_id").agg(F.count("*").alias("open_refs"))


def content_hash(rows: DataFrame, key: str) -> DataFrame:
    """Hash of a group's rows in article order: of the rows' own hashes, so what is gathered per group is small."""
    row = F.struct("article_no", "article_id", F.col("text_hash"))
    return rows.groupBy(key).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["text_hash"]), ""), 256).alias("hash"), F.count("*").alias("n"))


def freshness(catalogue: DataFrame, corpus: DataFrame) -> DataFrame:
    """State of each norm's study material against the corpus: new, no hash, stale, ok, or surplus."""
    c = content_hash(corpus, "norm_id")
    met = catalogue.select("norm_id", F.col("stored_hash")).withColumn("known", F.lit(True)).join(c, "norm_id", "full")
    state = F.when(F.col("known").isNull(), "NEW").when(F.col("hash").isNull(), "SURPLUS").when(F.col("stored_hash").isNull(), "NO_HASH").when(F.col("stored_hash") != F.col("hash"), "STALE").otherwise("OK")
    return met.select("norm_id", state.alias("state"))


def canonical_source(rows: DataFrame) -> DataFrame:
    """Document with most rows of each norm; a tie only if the tied documents have the same hash (then the smallest id)."""
    by = rows.groupBy("norm_id", "source_id").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("text_hash")), ""), 256).alias("h"))
    top = by.withColumn("r", F.rank().over(Window.partitionBy("norm_id").orderBy(F.desc("n")))).filter("r = 1")
    one = top.groupBy("norm_id").agg(F.min("source_id").alias("source_id"), F.count_distinct("h").alias("hashes"))
    return one.select("norm_id", F.when(F.col("hashes") == 1, F.col("source_id")).alias("source_id"))


def full_validation(metrics: list[tuple[str, DataFrame, int]]) -> DataFrame:
    """One row per check with its value (rows of its frame), limit and whether it passes; ``ALL`` for the verdict."""
    rows = reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("value")).select(F.lit(n).alias("check"), "value", F.lit(limit).alias("most")) for n, df, limit in metrics])
    rows = rows.withColumn("ok", F.col("value") <= F.col("most"))
    return rows.unionByName(rows.agg(F.sum(F.when(~F.col("ok"), 1).otherwise(0)).alias("value"), F.bool_and("ok").alias("ok")).select(F.lit("ALL").alias("check"), "value", F.lit(0).alias("most"), "ok"))


def cost_by_session(log: DataFrame, opening: float) -> DataFrame:
    """Calls and cost per session, and the closing balance chained over sessions by id. Sessions are summed before they are ordered."""
    by = log.groupBy("session_id").agg(F.count("*").alias("calls"), F.sum("cost").alias("total"))
    balance = F.lit(opening).cast("decimal(18,2)") - F.sum("total").over(Window.orderBy("session_id").rowsBetween(Window.unboundedPreceding, 0))
    return by.withColumn("closing", balance.cast("decimal(18,2)"))


def budget_stop(log: DataFrame, limit: float) -> DataFrame:
    """First event per day and operation at which the running cost passes the limit."""
    w = Window.partitionBy("day", "operation").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    run = log.withColumn("day", F.to_date("ts").cast("string")).withColumn("spent", F.sum("cost").over(w)).filter(F.col("spent") > limit)
    return run.groupBy("day", "operation").agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.min("spent").alias("_s")).drop("_s")


def _standing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keys that stand in a text of their article. Frames hold an article's keys (with ``k``) before its texts.

    Keys are looked up by their first 16, 4 or 1 characters among those of the text at every place; a key that was
    found isn't looked for again.
    """
    group, left = None, {}
    for pdf in frames:
        found = []
        for norm, article, k, text in zip(pdf["norm_id"], pdf["article_no"], pdf["k"], pdf["text"], strict=True):
            if (norm, article) != group:
                group, left = (norm, article), {16: {}, 4: {}, 1: {}, 0: {}}
            if k is not None:
                q = next(q for q in left if len(text) >= q)
                left[q].setdefault(text[:q], []).append((text, k))
                continue
            for q, keys in left.items():
                starts = [s for s in keys if s in text] if len(keys) < 100 else {text[i : i + q] for i in range(len(text) - q + 1)} & keys.keys()
                for s in starts:
                    rest = []
                    for key in keys.pop(s):
                        if key[0] in text:
                            found.append((norm, article, key[1]))
                        else:
                            rest.append(key)
                    if rest:
                        keys[s] = rest
        yield pd.DataFrame(found, columns=["norm_id", "article_no", "k"])


def textuality(items: DataFrame, articles: DataFrame) -> DataFrame:
    """Whether the key's text stands literally in one of its article's texts: counts by state. Texts and different keys of an article are shuffled once, and meet in its task."""
    key = F.element_at(F.array(*[norm_spaces_lower(F.col(f"opt_{c}")) for c in "abcd"]), F.greatest(F.array_position(F.array(*map(F.lit, "ABCD")), F.col("answer_key")).cast("int"), F.lit(1)))
    i = items.select("item_id", F.col("norm_id").cast("long").alias("norm_id"), F.col("article_no").cast("long").alias("article_no"), key.alias("text")).withColumn("k", F.sha2("text", 256))
    a = articles.select(F.col("norm_id").cast("long").alias("norm_id"), F.col("article_no").cast("long").alias("article_no"), norm_spaces_lower(F.col("text")).alias("text")).filter("norm_id is not null and article_no is not null and text is not null")
    keys = i.filter("norm_id is not null and article_no is not null and text is not null").groupBy("norm_id", "article_no", "k").agg(F.first("text").alias("text"))
    rows = keys.select("norm_id", "article_no", "k", "text").unionByName(a.withColumn("k", F.lit(None).cast("string")))
    found = rows.repartition("norm_id", "article_no").sortWithinPartitions("norm_id", "article_no", F.col("k").isNull()).mapInPandas(_standing, "norm_id long, article_no long, k string").withColumn("literal", F.lit(True))
    texts = a.groupBy("norm_id", "article_no").agg(F.count("*").alias("texts"))
    by = i.select("item_id", "norm_id", "article_no", "k").join(texts, ["norm_id", "article_no"], "left").join(found, ["norm_id", "article_no", "k"], "left").groupBy("item_id").agg(F.coalesce(F.sum("texts"), F.lit(0)).alias("texts"), F.max("literal").alias("literal"))
    state = F.when(F.col("texts") == 0, "NO_TEXT").when(F.col("literal"), "LITERAL").otherwise("NOT_LITERAL")
    return by.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def part_sizes_check(parts: DataFrame, calls: DataFrame) -> DataFrame:
    """Calls whose parts don't sum to their size or whose orders repeat or aren't positive."""
    by = parts.groupBy("call_id").agg(F.sum("n_items").alias("total"), F.count("*").alias("n"), F.count_distinct("part_order").alias("orders"), F.min("part_order").alias("least"))
    return violations(calls.join(by, "call_id", "left"), "call_id", {"SUM": F.coalesce("total", F.lit(0)) != F.col("n_items"), "ORDER": (F.col("n") != F.col("orders")) | (F.col("least") < 1)})


def expected_rows_check(expected: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Missing and surplus keys."""
    e, s = expected.select(*keys), stored.select(*keys)
    return e.subtract(s).withColumn("diff", F.lit("MISSING")).unionByName(s.subtract(e).withColumn("diff", F.lit("SURPLUS")))
