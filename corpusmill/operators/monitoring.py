"""Coverage, freshness, gold-set scores, votes, and gates before publishing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coverage_matrix(rows: DataFrame, regions: DataFrame | None, themes: Iterable[str], region: str = "region", theme_ids: str = "theme_ids", since: Column | None = None) -> DataFrame:
    """(region, theme, n[, n_new]) dense: a theme counts when it is a substring of one of a row's themes (D7). With a regions table all its regions appear, else those of the rows."""
    themes = list(themes)
    holds = lambda t: F.exists(theme_ids, lambda x: x.contains(t))
    counts = [F.count_if(holds(t)).alias(t) for t in themes]
    wide = rows.where(F.coalesce(region, F.lit("")) != "").groupBy(region).agg(*counts)
    long = wide.unpivot([region], themes, "theme", "n")
    if regions is not None:
        grid = regions.select(region).distinct().select(region, F.explode(F.array(*[F.lit(t) for t in themes])).alias("theme"))
        long = grid.join(long, [region, "theme"], "left").select(region, "theme", F.coalesce("n", F.lit(0)).alias("n"))
    if since is not None:
        fresh = coverage_matrix(rows.where(since), None, themes, region, theme_ids).withColumnRenamed("n", "n_new")
        long = long.join(fresh, [region, "theme"], "left").withColumn("n_new", F.coalesce("n_new", F.lit(0)))
    return long


def with_totals(matrix: DataFrame, region: str = "region") -> DataFrame:
    """The matrix with a total row per region (theme null)."""
    return matrix.rollup(region, "theme").agg(F.sum("n").alias("n")).where(F.col(region).isNotNull())


def zero_alerts(matrix: DataFrame, key_regions: Iterable[str], region: str = "region", dense: bool = False) -> DataFrame:
    """Cells without a document in key regions (D8). Regions that have no row at all alert only with dense=True."""
    key_regions = list(key_regions)
    m = matrix.where(F.col(region).isin(*key_regions))
    if dense:
        spark = matrix.sparkSession
        grid = spark.createDataFrame([(r,) for r in key_regions], f"{region} string").join(matrix.select("theme").distinct(), F.lit(True))
        m = grid.join(matrix, [region, "theme"], "left").select(region, "theme", F.coalesce("n", F.lit(0)).alias("n"))
    return m.where("n = 0").select(region, "theme", "n", F.lit("HIGH").alias("severity"))


def gap_cause(scanned: Column) -> Column:
    return F.when(scanned == 0, "collection_gap").otherwise("attribution_gap")


def freshness(rows: DataFrame, group: str, day: str) -> DataFrame:
    """(group, last_date): the latest day of each group."""
    return rows.where((F.coalesce(F.col(group).cast("string"), F.lit("")) != "") & F.col(day).isNotNull()).groupBy(group).agg(F.max(F.to_date(day)).alias("last_date"))


def stale(fresh: DataFrame, as_of: str, days: int = 60) -> DataFrame:
    return fresh.where(F.col("last_date") < F.date_sub(F.lit(as_of).cast("date"), days)).withColumn("severity", F.lit("WARN"))


def judge_score(rows: DataFrame) -> DataFrame:
    """One row recall, precision over (is_planted, rejected): planted rows caught, and caught among the rejected; 0 and 1 for empty denominators."""
    p, r = F.count_if("is_planted"), F.count_if("rejected")
    caught = F.count_if(F.col("is_planted") & F.col("rejected"))
    return rows.agg(p.alias("planted"), r.alias("rejected"), caught.alias("caught"), F.when(p > 0, caught / p).otherwise(0.0).alias("recall"), F.when(r > 0, caught / r).otherwise(1.0).alias("precision"))


def calibration(rows: DataFrame, bar: float = 0.9) -> DataFrame:
    """One row over (gold, decision, is_planted): planted recall and whether it meets the bar, kept accepts, agreement."""
    p = F.count_if("is_planted")
    caught = F.count_if(F.col("is_planted") & (F.col("decision") != "accept"))
    clean = ~F.col("is_planted")
    accepts = F.count_if(clean & (F.col("gold") == "accept"))
    kept = F.count_if(clean & (F.col("gold") == "accept") & (F.col("decision") == "accept"))
    n = F.count_if(clean)
    recall = F.when(p > 0, caught / p).otherwise(0.0)
    return rows.agg(F.count("*").alias("rows"), recall.alias("planted_recall"), (recall >= bar).alias("meets_bar"), F.when(accepts > 0, kept / accepts).otherwise(0.0).alias("kept_accepts"), F.when(n > 0, F.count_if(clean & (F.col("gold") == F.col("decision"))) / n).otherwise(0.0).alias("agreement"))


def class_recall(rows: DataFrame, gold: str = "gold", decision: str = "decision") -> DataFrame:
    """(class, support, recall) of each gold class, and precision of its decisions."""
    g = rows.groupBy(F.col(gold).alias("class")).agg(F.count("*").alias("support"), F.count_if(F.col(gold) == F.col(decision)).alias("hits"))
    d = rows.groupBy(F.col(decision).alias("_c")).agg(F.count("*").alias("decided"))
    return g.join(d, F.col("class") == F.col("_c"), "left").select("class", "support", (F.col("hits") / F.col("support")).alias("recall"), F.when(F.coalesce("decided", F.lit(0)) > 0, F.col("hits") / F.col("decided")).otherwise(1.0).alias("precision"))


def agreement_rate(rows: DataFrame, agrees: str = "agrees", comparable: str = "comparable") -> DataFrame:
    """One row: agreeing among comparable ones, 1.0 if there are none."""
    n = F.count_if(comparable)
    return rows.agg(F.when(n > 0, F.count_if(F.col(comparable) & F.col(agrees)) / n).otherwise(1.0).alias("agree_rate"))


def vote_consensus(votes: DataFrame) -> DataFrame:
    """votes (item_id, rater, choice, score) -> (item_id, raters, choice, median, spread, level).

    A choice needs floor(n / 2) + 1 raters. level: high = a majority and spread at most 1, mid = a majority and spread at most 2, low = a majority, failed = none.
    """
    n = votes.groupBy("item_id").agg(F.countDistinct("rater").alias("raters"), F.percentile("score", 0.5).alias("median"), (F.max("score") - F.min("score")).alias("spread"))
    c = votes.groupBy("item_id", "choice").agg(F.countDistinct("rater").alias("n"))
    best = c.withColumn("_rn", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("n"), "choice"))).where("_rn = 1").drop("_rn")
    j = n.join(best, "item_id")
    won = F.col("n") >= F.floor(F.col("raters") / 2) + 1
    level = F.when(~won, "failed").when(F.col("spread") <= 1, "high").when(F.col("spread") <= 2, "mid").otherwise("low")
    return j.select("item_id", "raters", F.when(won, F.col("choice")).alias("choice"), "median", "spread", level.alias("level"))


def majority_themes(votes: DataFrame, themes: str = "themes") -> DataFrame:
    """(item_id, themes): those that more than half of an item's raters name."""
    n = votes.groupBy("item_id").agg(F.countDistinct("rater").alias("raters"))
    t = votes.select("item_id", "rater", F.explode(themes).alias("t")).groupBy("item_id", "t").agg(F.countDistinct("rater").alias("n"))
    return t.join(n, "item_id").where(F.col("n") >= F.floor(F.col("raters") / 2) + 1).groupBy("item_id").agg(F.array_sort(F.collect_list("t")).alias("themes"))


def counts_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def growth_alert(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """(key, n, previous) where the count grew."""
    b = before.select(F.col(key).alias("_k"), F.col("n").alias("previous"))
    return now.join(b, F.col(key).eqNullSafe(F.col("_k")), "left").select(key, "n", F.coalesce("previous", F.lit(0)).alias("previous")).where("n > previous")


def contaminated_ends(edges: DataFrame, reason: str = "marker") -> DataFrame:
    """(node_id, marker): ends of dropped edges with the first marker each, by edge id (D21). edges: edge_id, from_id, from_marker, to_id, to_marker."""
    ends = edges.select("edge_id", F.explode(F.array(F.struct(F.col("from_id").alias("node_id"), F.col("from_marker").alias(reason)), F.struct(F.col("to_id").alias("node_id"), F.col("to_marker").alias(reason)))).alias("e")).select("edge_id", "e.*").where(F.col(reason).isNotNull())
    return ends.withColumn("_rn", F.row_number().over(Window.partitionBy("node_id").orderBy("edge_id", reason))).where("_rn = 1").select("node_id", reason)


def city_priority(cities: DataFrame, rules_table: DataFrame, municipal: str = "is_municipality", extra: str = "has_signal") -> DataFrame:
    """Score 3 a rule hit, 2 for a municipality, 1 for an extra signal; by score, then name (D22). rules_table: (city, reason)."""
    r = rules_table.select(F.col("city").alias("_c"), "reason").distinct().groupBy("_c").agg(F.count("*").alias("hits"), F.array_sort(F.collect_list("reason")).alias("reasons"))
    j = cities.join(r, F.col("city") == F.col("_c"), "left").drop("_c")
    score = F.coalesce("hits", F.lit(0)) * 3 + F.when(F.col(municipal), 2).otherwise(0) + F.when(F.col(extra), 1).otherwise(0)
    return j.withColumn("score", score.cast("double")).withColumn("reasons", F.coalesce("reasons", F.array().cast("array<string>"))).drop("hits").orderBy(F.desc("score"), "city")


def verified_counts(cities: DataFrame, channels: DataFrame, status: str = "验证") -> tuple[DataFrame, DataFrame]:
    """(cities with verified channel counts, channels outside the list)."""
    n = channels.groupBy("city").agg(F.count_if(F.col("status") == status).alias("verified"))
    return cities.join(n, "city", "left").withColumn("verified", F.coalesce("verified", F.lit(0))), channels.join(cities.select("city").distinct(), "city", "left_anti")


def audit_rollup(findings: DataFrame) -> DataFrame:
    """(check, source, n) with totals per check and overall."""
    return findings.rollup("check", "source").agg(F.count("*").alias("n"))


def vocabulary_report(items: DataFrame) -> DataFrame:
    """(problem, key, ids) of items (id, kind, aliases, label): repeated ids, aliases of several ids (real only when none of them is a theme), missing labels."""
    dup = items.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("repeated_id").alias("problem"), F.col("id").alias("key"), F.array("id").alias("ids"))
    a = items.select("id", "kind", F.explode(F.array_distinct("aliases")).alias("alias")).where(F.trim("alias") != "").groupBy(F.lower(F.trim("alias")).alias("key")).agg(F.array_sort(F.collect_set("id")).alias("ids"), F.max((F.col("kind") == "theme").cast("int")).alias("theme"))
    conflict = a.where((F.size("ids") > 1) & (F.col("theme") == 0)).select(F.lit("alias_conflict").alias("problem"), "key", "ids")
    missing = items.where(F.coalesce(F.trim("label"), F.lit("")) == "").select(F.lit("missing_label").alias("problem"), F.col("id").alias("key"), F.array("id").alias("ids"))
    return dup.union(conflict).union(missing)


def two_way_missing(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, missing_in): keys that one of two vocabularies lacks."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").select(key, F.lit("second").alias("missing_in")).union(y.join(x, key, "left_anti").select(key, F.lit("first").alias("missing_in")))


def shrink_gate(new: DataFrame, old: DataFrame, ratio: float = 0.8) -> str | None:
    """A reason to refuse a result that is empty or much smaller than what it replaces, else None (D16): two counts."""
    n, o = new.count(), old.count()
    return "new result is empty" if n == 0 else f"new result has {n} rows, less than {ratio:g} of {o}" if n < ratio * o else None


def unique_gate(rows: DataFrame, key: str, expected: int | None = None) -> str | None:
    """A reason to refuse rows with a repeated key, or of another number than expected, else None."""
    n, d = rows.agg(F.count("*"), F.countDistinct(key)).first()
    return f"{n - d} repeated keys" if n != d else f"{n} rows, expected {expected}" if expected is not None and n != expected else None
