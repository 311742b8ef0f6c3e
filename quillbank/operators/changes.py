"""Change sets: previews and their application. Applying a change twice is applying it once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delta(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys added and removed."""
    b, a = before.select(*keys), after.select(*keys)
    return a.subtract(b).withColumn("change", F.lit("ADDED")).unionByName(b.subtract(a).withColumn("change", F.lit("REMOVED")))


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source values over target values by key, new keys added. A source with repeated keys is an error of the caller."""
    others = [c for c in target.columns if c not in keys]
    s = source.select(*keys, *[F.col(c).alias(f"_{c}") for c in others], F.lit(True).alias("_new"))
    met = target.join(s, keys, "full")
    return met.select(*keys, *[F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in others])


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(source.select(*target.columns).dropDuplicates(keys).join(target.select(*keys), keys, "left_anti").select(*target.columns))


def delete_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(source.select(*keys), keys, "left_semi")


def correction_preview(items: DataFrame, corrections: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Status of each correction: repeated in the batch, unknown item, excluded, stored value differs from the expected, no change, or ready."""
    n = corrections.groupBy("item_id").agg(F.count("*").alias("n"))
    x = exclusions.select("item_id").distinct().withColumn("excluded", F.lit(True))
    met = corrections.join(n, "item_id").join(items.select("item_id", F.col("answer_key").alias("stored")).dropDuplicates(["item_id"]), "item_id", "left").join(x, "item_id", "left")
    status = (
        F.when(F.col("n") > 1, "REPEATED").when(F.col("stored").isNull(), "UNKNOWN").when(F.col("excluded"), "EXCLUDED").when(F.col("stored") != F.col("old_key"), "STALE").when(F.col("old_key") == F.col("new_key"), "UNCHANGED")
        .otherwise("READY")
    )
    return met.select("item_id", "old_key", "new_key", status.alias("status"))


def apply_corrections(items: DataFrame, preview: DataFrame) -> DataFrame:
    ready = preview.filter("status = 'READY'").select("item_id", "new_key")
    return items.join(ready, "item_id", "left").withColumn("answer_key", F.coalesce("new_key", "answer_key")).drop("new_key")


def quarantine_preview(cases: DataFrame, items: DataFrame, exclusions: DataFrame, links: DataFrame) -> DataFrame:
    """Status of each case, and how many links it would put under review."""
    n = links.filter("state = 'INCLUIDA'").groupBy("item_id").agg(F.count("*").alias("links"))
    met = cases.join(items.select("item_id", F.col("answer_key").alias("now")).dropDuplicates(["item_id"]), "item_id", "left").join(exclusions.select("item_id", F.lit(True).alias("already")).distinct(), "item_id", "left").join(n, "item_id", "left")
    status = F.when(F.col("now").isNull(), "MISSING").when(F.col("now") != F.col("stored_key"), "KEY_CHANGED").when(F.col("already"), "ALREADY").otherwise("READY")
    return met.select("item_id", status.alias("status"), F.coalesce("links", F.lit(0)).alias("links"))


def quarantine_apply(links: DataFrame, preview: DataFrame) -> DataFrame:
    """Links of the ready cases go to review."""
    r = preview.filter("status = 'READY'").select("item_id", F.lit(True).alias("_q"))
    return links.join(r, "item_id", "left").withColumn("state", F.when(F.col("_q"), "REVISION").otherwise(F.col("state"))).drop("_q")


def undo_withdrawal(exclusions: DataFrame, links: DataFrame, undone: Column) -> tuple[DataFrame, DataFrame]:
    """Exclusions without the undone ones, and their links included again unless another exclusion holds."""
    rest = exclusions.filter(~undone)
    freed = exclusions.filter(undone).select("item_id").join(rest.select("item_id"), "item_id", "left_anti").distinct().withColumn("_f", F.lit(True))
    back = links.join(freed, "item_id", "left").withColumn("state", F.when(F.col("_f"), "INCLUIDA").otherwise(F.col("state"))).drop("_f")
    return rest, back


def sync_plan(corpus: DataFrame, official: DataFrame, keys: list[str]) -> DataFrame:
    """Insert, repair or unchanged for each official row, by content hash."""
    met = official.join(corpus.select(*keys, F.col("text_hash").alias("have")), keys, "left")
    return met.select(*keys, F.when(F.col("have").isNull(), "INSERT").when(F.col("have") != F.col("text_hash"), "REPAIR").otherwise("UNCHANGED").alias("action"))


def changed_outside_plan(before: DataFrame, after: DataFrame, planned: DataFrame, key: str) -> DataFrame:
    """Rows outside of the plan that aren't the same as before, with repeats; they should be none."""
    b, a = (x.join(planned.select(key), key, "left_anti").select(key, F.xxhash64(*[F.col(c) for c in x.columns if c != key]).alias("h")) for x in (before, after))
    return b.exceptAll(a).unionByName(a.exceptAll(b)).select(key).distinct()


def scope_findings(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Per (topic, norm): articles to add and delete; inserted articles (bis, ter) and deletions beside an implicit reference are doubts."""
    e = expected.groupBy("topic_id", "norm_id").agg(F.collect_set("article").alias("e"))
    a = actual.groupBy("topic_id", "norm_id").agg(F.collect_set("article").alias("a"), F.bool_or(F.col("article") == "*").alias("implicit"))
    none = F.array().cast("array<string>")
    met = e.join(a, ["topic_id", "norm_id"], "full").withColumn("e", F.coalesce("e", none)).withColumn("a", F.coalesce("a", none))
    doubt = r" (bis|ter|quater|quinquies)$"
    add = F.transform(F.array_except("e", "a"), lambda x: F.struct(x.alias("article"), F.when(x.rlike(doubt), "DOUBT").otherwise("ADD").alias("action")))
    gone = F.transform(F.filter(F.array_except("a", "e"), lambda x: x != "*"), lambda x: F.struct(x.alias("article"), F.when(x.rlike(doubt) | F.coalesce("implicit", F.lit(False)), "DOUBT").otherwise("DELETE").alias("action")))
    return met.select("topic_id", "norm_id", F.inline(F.concat(add, gone)))


def enrichment_plan(items: DataFrame, proposals: dict[str, Column]) -> DataFrame:
    """Empty fields and what would fill them: ``item_id, field, value``."""
    empty = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    fills = F.array(*[F.when(empty(c) & v.isNotNull(), F.struct(F.lit(c).alias("field"), v.cast("string").alias("value"))) for c, v in proposals.items()])
    return items.select("item_id", F.inline(F.filter(fills, lambda f: f.isNotNull())))


def call_status_impact(calls: DataFrame, parts: DataFrame, topics: DataFrame, links: DataFrame) -> DataFrame:
    """What deactivating a call touches."""
    counts = [t.groupBy("call_id").agg(F.count("*").alias(n)) for t, n in ((parts, "parts"), (topics, "topics"), (links, "links"))]
    out = reduce(lambda acc, c: acc.join(c, "call_id", "left"), counts, calls.select("call_id", "active"))
    return out.na.fill(0, ["parts", "topics", "links"])


def rules_to_refs(rules: DataFrame, stored: DataFrame) -> DataFrame:
    """Expected references of the topics that have rules (``expression`` of articles and ranges), against the stored ones of those topics."""
    e = rules.select("topic_id", "norm_id", F.explode(F.split("expression", ",")).alias("x")).select("topic_id", "norm_id", F.trim("x").alias("x"))
    lo, hi = F.regexp_extract("x", "^([0-9]+)-([0-9]+)$", 1), F.regexp_extract("x", "^([0-9]+)-([0-9]+)$", 2)
    spread = F.when(lo != "", F.transform(F.sequence(lo.cast("int"), hi.cast("int")), lambda n: n.cast("string"))).otherwise(F.array("x"))
    expected = e.select("topic_id", "norm_id", F.explode(spread).alias("article")).distinct()
    mine = stored.join(rules.select("topic_id").distinct(), "topic_id", "left_semi")
    return delta(mine, expected, ["topic_id", "norm_id", "article"])


def insert_plan_check(plan: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Inserts that repeat in the plan or exist already."""
    again = plan.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys, F.lit("REPEATED").alias("reason"))
    return again.unionByName(plan.select(*keys).distinct().join(table.select(*keys), keys, "left_semi").withColumn("reason", F.lit("EXISTS")))


def apply_recovered(items: DataFrame, proposals: DataFrame) -> DataFrame:
    """Fill norm and article from proposals only while an item is still pending (no norm)."""
    p = proposals.select("item_id", F.col("norm_id").alias("_n"), F.col("article").alias("_a")).dropDuplicates(["item_id"])
    met = items.join(p, "item_id", "left")
    open_ = F.col("norm_id").isNull() & F.col("_n").isNotNull()
    return met.withColumn("article_n", F.when(open_, F.col("_a")).otherwise(F.col("article_n"))).withColumn("norm_id", F.when(open_, F.col("_n")).otherwise(F.col("norm_id"))).drop("_n", "_a")


def retract_items(links: DataFrame, items: DataFrame, ids: DataFrame) -> DataFrame:
    """Links without those of the generated items asked for; other sources are refused."""
    ok = ids.join(items.filter("source_type = 'ia_generada'").select("item_id"), "item_id", "left_semi")
    return links.join(ok, "item_id", "left_anti")


def ingest(batch: DataFrame, pool: DataFrame, log: DataFrame, key: str = "content_key") -> tuple[DataFrame, DataFrame]:
    """New pool rows of a batch and its log rows: files whose hash is done are skipped; rows the pool has, or that repeat, are counted as duplicates."""
    done = log.filter("state = 'DONE'").select("file_hash").distinct()
    todo = batch.join(done, "file_hash", "left_anti")
    first = todo.groupBy(key).agg(F.min("row_id").alias("row_id"))
    new = todo.join(first, [key, "row_id"], "left_semi").join(pool.select(key).distinct(), key, "left_anti")
    n = todo.groupBy("file_hash").agg(F.count("*").alias("rows")).join(new.groupBy("file_hash").agg(F.count("*").alias("inserted")), "file_hash", "left")
    return new, n.select("file_hash", F.coalesce("inserted", F.lit(0)).alias("inserted"), (F.col("rows") - F.coalesce("inserted", F.lit(0))).alias("duplicates"), F.lit("DONE").alias("state"))


# --- publication ---


def publish_subset(links: DataFrame, topics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Only included links, and the topics that they use."""
    kept = links.filter("state = 'INCLUIDA'")
    return kept, topics.join(kept.select("topic_id"), "topic_id", "left_semi")


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    return reduce(DataFrame.unionByName, [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows", F.lit(len(t.columns)).alias("columns")) for n, t in tables.items()])


def call_totals(calls: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per call with its rows in each table (by ``call_id``), 0 if none; each table is counted before it is joined."""
    out = calls.select("call_id").distinct()
    for name, t in tables.items():
        out = out.join(t.groupBy("call_id").agg(F.count("*").alias(name)), "call_id", "left")
    return out.select("call_id", *[F.coalesce(n, F.lit(0)).alias(n) for n in tables])


def compare_inventory(a: DataFrame, b: DataFrame) -> DataFrame:
    met = a.select("table_name", F.col("rows").alias("a")).join(b.select("table_name", F.col("rows").alias("b")), "table_name", "full")
    return met.filter(~F.col("a").eqNullSafe(F.col("b")))


def content_fingerprint(links: DataFrame) -> DataFrame:
    """Counts of what is served; the same before and after the reduction."""
    i = links.filter("state = 'INCLUIDA'")
    return i.agg(F.count("*").alias("links"), F.count_distinct("item_id").alias("items"), F.count_distinct("topic_id").alias("topics"), F.sum(F.col("item_id") % 1000).alias("mark"))


def activity_filter(calls: DataFrame) -> DataFrame:
    """Active calls, or all if the table doesn't say."""
    return calls.filter("active") if "active" in calls.columns else calls


def upsert_ref(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """What an incoming reference does: same identity, else the only one that is the same without its date, several are an error, none is an insert.

    Both have ``topic_id, key, plain, article``; stored ones an id.
    """
    i, s = incoming, stored
    exact = s.select("topic_id", "key", "article", F.col("ref_id").alias("same")).groupBy("topic_id", "key", "article").agg(F.min("same").alias("same"))
    loose = s.groupBy("topic_id", "plain", "article").agg(F.count("*").alias("n"), F.min("ref_id").alias("like"))
    met = i.join(exact, ["topic_id", "key", "article"], "left").join(loose, ["topic_id", "plain", "article"], "left")
    action = F.when(F.col("same").isNotNull(), "SAME").when(F.col("n") > 1, "AMBIGUOUS").when(F.col("n") == 1, "UPDATE").otherwise("INSERT")
    return met.select("in_id", action.alias("action"), F.coalesce("same", F.when(F.col("n") == 1, F.col("like"))).alias("ref_id"))


def accept_candidates(candidates: DataFrame, pool: DataFrame, norms: DataFrame, key: Column) -> DataFrame:
    """Reject reason of each candidate, null if accepted: state, structure, norm, article, or a duplicate of the pool."""
    from quillbank.functions.textnorm import article_base, article_precise

    have = pool.select(F.sha2(key, 256).alias("_k")).distinct().withColumn("_dup", F.lit(True))
    met = candidates.withColumn("_k", F.sha2(key, 256)).join(have, "_k", "left").join(norms.select("norm_id", F.lit(True).alias("_norm")).distinct(), "norm_id", "left")
    whole = ~F.exists(F.array("stem", "opt_a", "opt_b", "opt_c", "opt_d"), lambda x: F.trim(F.coalesce(x, F.lit(""))) == "")
    same = article_base(article_precise(F.col("article"))) == article_base(F.col("asked"))
    reason = F.when(F.col("state") != "CONFIRMED", "STATE").when(~whole, "STRUCTURE").when(F.col("_norm").isNull(), "NORM").when(~F.coalesce(same, F.lit(False)), "ARTICLE").when(F.col("_dup"), "DUPLICATE")
    return met.select("item_id", reason.alias("reason"))


def apply_scope_findings(refs: DataFrame, findings: DataFrame) -> DataFrame:
    """References without the confirmed deletions and with the missing ones, copied from a template of the same norm in the topic, else of the topic."""
    from pyspark.sql import Window

    gone = findings.filter("action = 'DELETE'").select("topic_id", "norm_id", "article")
    kept = refs.join(gone, ["topic_id", "norm_id", "article"], "left_anti")
    w = lambda *k: F.row_number().over(Window.partitionBy(*k).orderBy("ref_id"))
    own = refs.withColumn("r", w("topic_id", "norm_id")).filter("r = 1").select("topic_id", "norm_id", F.col("state").alias("own_state"))
    any_ = refs.withColumn("r", w("topic_id")).filter("r = 1").select("topic_id", F.col("state").alias("any_state"))
    add = findings.filter("action = 'ADD'").select("topic_id", "norm_id", "article").distinct().join(refs.select("topic_id", "norm_id", "article"), ["topic_id", "norm_id", "article"], "left_anti")
    add = add.join(own, ["topic_id", "norm_id"], "left").join(any_, "topic_id", "left").select("topic_id", "norm_id", "article", F.coalesce("own_state", "any_state", F.lit("SIN_RESOLVER")).alias("state"))
    return kept.select("topic_id", "norm_id", "article", "state").unionByName(add)
