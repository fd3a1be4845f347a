"""Contexts: what signals and relations say of each document, theme and region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import reasons


def level_of_count(n: Column) -> Column:
    return F.when(n >= 3, "strong").when(n >= 2, "medium").when(n >= 1, "weak").otherwise("none")


def heat_of_count(n: Column) -> Column:
    return F.when(n >= 8, "high").when(n >= 2, "medium").when(n >= 1, "low").otherwise("none")


def attention_of(n: Column, risk: Column) -> Column:
    return F.when((risk >= 2) | (n >= 5), "high").when(n > 0, "medium").otherwise("low")


def certainty_of(risk: Column, execution: Column, market: Column) -> Column:
    some = (risk > 0) | (execution > 0)
    return F.when(some & (market == 0), "lower").when((market >= 2) & ~some, "raise").otherwise("neutral")


def notes_of(risk: Column, execution: Column, comments: Column, market: Column) -> Column:
    return reasons(
        (risk > 0, "commentary_risk_present"),
        (execution > 0, "commentary_execution_friction_present"),
        ((comments > 0) & (market == 0), "attention_without_market_validation"),
        ((market > 0) & (comments == 0), "market_validation_without_commentary_attention"),
        (market == 1, "market_validation_weak"),
    )


def coverage_of(comments: Column, market: Column) -> Column:
    return F.when((comments > 0) & (market == 0), "commentary_only").when((market > 0) & (comments == 0), "market_only").when(comments + market == 1, "thin_evidence").otherwise("none")


def _counted(df: DataFrame, key: str, kind: str, id_col: str, name: str) -> DataFrame:
    """Per key: number of rows, a map kind -> count, the kinds by falling count (ties by first place), sorted ids. Two-level, so hot keys combine first."""
    kinds = df.groupBy(key, F.coalesce(F.nullif(F.col(kind), F.lit("")), F.lit("unknown")).alias("k")).agg(F.count("*").alias("n"), F.min("pos").alias("p"), F.collect_list(id_col).alias("ids"))
    pairs = F.collect_list(F.struct("k", "n"))
    ranked = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "p", "k"))), lambda x: x["k"])
    return kinds.groupBy(key).agg(F.sum("n").alias(f"{name}_count"), F.map_from_entries(F.array_sort(pairs)).alias(f"{name}_kinds"), ranked.alias(f"{name}_ranked"), F.array_sort(F.flatten(F.collect_list("ids"))).alias(f"{name}_ids"))


def _both(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Full outer join of two counted sides, with zeros and empty collections for the missing one (C14)."""
    out = a.join(b, key, "full")
    fill = []
    for name, kind in (*a.dtypes, *b.dtypes):
        if name == key or any(f[0] == name for f in fill):
            continue
        c = F.col(name)
        fill.append((name, F.coalesce(c, F.lit(0)) if kind == "bigint" else F.coalesce(c, F.create_map().cast(kind)) if kind.startswith("map") else F.coalesce(c, F.array().cast(kind))))
    return out.select(key, *[c.alias(n) for n, c in fill])


def _count_in(m: Column, key: str) -> Column:
    return F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(0))


def document_context(comments: DataFrame, market: DataFrame) -> DataFrame:
    """Per document.

    comments: (signal_id, role, doc_ids array, pos); market: (signal_id, signal_type, current_id, doc_ids array, pos). A market row counts for its current and its
    related documents, once each; a comment for each entry of its list.
    """
    c = comments.select(F.explode("doc_ids").alias("doc_id"), "role", "signal_id", "pos").where(F.coalesce(F.col("doc_id").cast("string"), F.lit("")) != "")
    linked = F.array_distinct(F.concat(F.array("current_id"), F.coalesce("doc_ids", F.array().cast(market.schema["doc_ids"].dataType))))
    m = market.select(F.explode(linked).alias("doc_id"), "signal_type", "signal_id", "pos").where(F.coalesce(F.col("doc_id").cast("string"), F.lit("")) != "")
    j = _both(_counted(c, "doc_id", "role", "signal_id", "commentary"), _counted(m, "doc_id", "signal_type", "signal_id", "market"), "doc_id")
    risk, execution = _count_in(F.col("commentary_kinds"), "risk"), _count_in(F.col("commentary_kinds"), "execution")
    n, k = F.col("commentary_count"), F.col("market_count")
    return j.select(
        "doc_id", n.alias("commentary_signal_count"), k.alias("market_signal_count"), F.col("commentary_kinds").alias("commentary_roles"), F.col("market_kinds").alias("market_signal_types"),
        attention_of(n, risk).alias("attention_level"), level_of_count(k).alias("validation_level"), certainty_of(risk, execution, k).alias("certainty_adjustment"),
        notes_of(risk, execution, n, k).alias("internal_notes"), F.col("commentary_ids"), F.col("market_ids").alias("market_signal_ids"),
    )


def theme_context(comments: DataFrame, market: DataFrame) -> DataFrame:
    """Per theme (D3, D6); inputs with a theme_ids array instead of doc_ids; a theme twice in a row counts twice."""
    part = lambda df, kind: df.select(F.explode("theme_ids").alias("theme_id"), kind, "signal_id", "pos").where(F.coalesce("theme_id", F.lit("")) != "")
    j = _both(_counted(part(comments, "role"), "theme_id", "role", "signal_id", "commentary"), _counted(part(market, "signal_type"), "theme_id", "signal_type", "signal_id", "market"), "theme_id")
    n, k = F.col("commentary_count"), F.col("market_count")
    return j.select(
        "theme_id", n.alias("commentary_signal_count"), k.alias("market_signal_count"), F.slice("commentary_ranked", 1, 3).alias("dominant_commentary_roles"), F.slice("market_ranked", 1, 3).alias("dominant_market_signal_types"),
        heat_of_count(n + k).alias("heat_level"), level_of_count(k).alias("validation_level"), coverage_of(n, k).alias("coverage_warning"), F.col("commentary_ids"), F.col("market_ids").alias("market_signal_ids"),
    )


def region_context(market: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per region, one row unknown_region_rows) of market rows with region_code, region_name, theme_ids, business_lines."""
    known = (F.coalesce("region_code", F.lit("")) != "") & (F.coalesce("region_name", F.lit("")) != "")
    rows = market.where(known)
    key = ["region_code", "region_name"]
    kinds = rows.groupBy(*key, F.coalesce(F.nullif(F.col("signal_type"), F.lit("")), F.lit("unknown")).alias("k")).agg(
        F.count("*").alias("n"), F.collect_list("signal_id").alias("ids"), F.array_distinct(F.flatten(F.collect_set("theme_ids"))).alias("t"), F.array_distinct(F.flatten(F.collect_set("business_lines"))).alias("b"))
    per = kinds.groupBy(*key).agg(
        F.sum("n").alias("market_signal_count"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("t")))).alias("theme_ids"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("b")))).alias("business_lines"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias("signal_types"), F.array_sort(F.flatten(F.collect_list("ids"))).alias("market_signal_ids"))
    code, name = F.col("region_code"), F.col("region_name")
    warn = reasons((code.endswith("0000") & ~code.isin("000000", *rules.DIRECT_CITIES) & name.endswith("市"), "province_code_with_city_name"))
    return per.withColumn("recency_level", F.lit("current")).withColumn("validation_level", level_of_count(F.col("market_signal_count"))).withColumn("region_warnings", warn), market.agg(F.count_if(~known).alias("unknown_region_rows"))


def context_flags(d: dict[str, Column]) -> Column:
    """Flags in fixed order."""
    c, m = d["commentary_signal_count"], d["market_signal_count"]
    return reasons(
        ((d["cites_basis_out"] > 0) | (d["cites_basis_in"] > 0), "has_basis_chain"),
        ((d["references_out"] > 0) | (d["references_in"] > 0), "has_references"),
        (d["supersedes_out"] > 0, "supersedes_policy"),
        (d["supersedes_in"] > 0, "superseded_by_policy"),
        ((d["clarifies_out"] > 0) | (d["clarifies_in"] > 0), "has_clarification"),
        ((c > 0) & d["attention_level"].isin("medium", "high"), F.concat(F.lit("commentary_attention_"), d["attention_level"])),
        ((m > 0) & d["validation_level"].isin("weak", "medium", "strong"), F.concat(F.lit("market_validation_"), d["validation_level"])),
        ((c > 0) & (m == 0), "no_market_validation"),
        (d["certainty_adjustment"].isin("lower", "raise"), F.concat(F.lit("certainty_"), d["certainty_adjustment"])),
        (d["has_relation"] & ~d["has_signal"], "relation_only_no_signal_context"),
        (d["has_signal"] & ~d["has_relation"], "signal_only_no_relation_context"),
    )


def analysis_context(degrees: DataFrame, signals: DataFrame) -> DataFrame:
    """Relations and signals of every document that has either (H13): degrees of relation_degrees, signals of document_context."""
    r = degrees.withColumn("has_relation", F.lit(True))
    s = signals.withColumnRenamed("doc_id", "node_id").withColumn("has_signal", F.lit(True))
    j = r.join(s, "node_id", "full")
    defaults = {"attention_level": "low", "validation_level": "none", "certainty_adjustment": "neutral"}
    out = []
    for name, kind in j.dtypes:
        c = F.col(name)
        if name == "node_id":
            out.append(c)
        elif kind == "boolean":
            out.append(F.coalesce(c, F.lit(False)).alias(name))
        elif kind == "bigint":
            out.append(F.coalesce(c, F.lit(0)).alias(name))
        elif kind.startswith("map"):
            out.append(F.coalesce(c, F.create_map().cast(kind)).alias(name))
        elif kind.startswith("array"):
            out.append(F.coalesce(c, F.array().cast(kind)).alias(name))
        else:
            out.append(F.coalesce(c, F.lit(defaults.get(name, ""))).alias(name))
    j = j.select(*out)
    return j.withColumn("analysis_flags", context_flags({c: F.col(c) for c in j.columns}))


def context_summary(rows: DataFrame) -> DataFrame:
    """(metric, key, n): totals and counts by flag, one long table."""
    total = rows.agg(F.count("*").alias("analysis_context_count"), F.count_if("has_relation").alias("rows_with_relation_context"), F.count_if("has_signal").alias("rows_with_signal_context"), F.count_if(F.col("has_relation") & F.col("has_signal")).alias("rows_with_both"))
    totals = total.unpivot([], total.columns, "metric", "n").select("metric", F.lit("").alias("key"), "n")
    flags = rows.select(F.explode("analysis_flags").alias("key")).groupBy("key").agg(F.count("*").alias("n")).select(F.lit("rows_by_flag").alias("metric"), "key", "n")
    return totals.unionByName(flags)


def assert_disjoint(accepted: DataFrame, blocked: DataFrame, key: str = "signal_id") -> None:
    """Raise when an accepted id is blocked (C16, F3); only the first few ids come to the driver, for the message."""
    bad = accepted.join(blocked.select(key).distinct(), key, "left_semi").select(key).limit(5).collect()
    if bad:
        raise ValueError(f"accepted rows include blocked ids: {', '.join(str(r[0]) for r in bad)}")


def dominant(df: DataFrame, key: str, kind: str, k: int = 3) -> DataFrame:
    """(key, rank, kind, n): the k most common kinds of each key, ties by kind."""
    n = df.groupBy(key, kind).agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), F.asc(kind)))).where(F.col("rank") <= k)


def overlay(docs: DataFrame, derived: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents with themes, primary_theme and importance of a derived table (one row a key) in place of their own.

    Where the table has no row, or a null, the themes are empty, the primary theme is '' and the importance is null.
    """
    names = ("themes", "primary_theme", "importance")
    d = derived.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in names])
    j = docs.drop(*names).join(d, F.col(key) == F.col("_k"), "left").drop("_k")
    return j.withColumns({"themes": F.coalesce("_themes", F.array().cast("array<string>")), "primary_theme": F.coalesce("_primary_theme", F.lit("")), "importance": F.col("_importance")}).drop("_themes", "_primary_theme", "_importance")


#: Fields of the two summaries, with what stands where nothing is known.
RELATION_COUNTS = ("references_out", "references_in", "cites_basis_out", "cites_basis_in", "supersedes_out", "superseded_by_count", "clarifies_out", "clarified_by_count")
SIGNAL_DEFAULTS = {"commentary_attention": ("attention_level", "low"), "market_validation": ("validation_level", "none"), "certainty_adjustment": ("certainty_adjustment", "neutral")}


def relation_summary(row: dict[str, Column]) -> Column:
    """STRUCT of the relation counts, 0 where a column is missing or null, and the counts of other relations, an empty map."""
    counts = [F.coalesce(row[c], F.lit(0)).cast("long").alias(c) if c in row else F.lit(0).cast("long").alias(c) for c in RELATION_COUNTS]
    return F.struct(*counts, F.coalesce(row.get("other_rel_counts", F.lit(None)), F.create_map().cast("map<string,bigint>")).alias("other_rel_counts"))


def signal_summary(row: dict[str, Column]) -> Column:
    """STRUCT of a document's signals carried over, with defaults where they are missing, null or empty."""
    count = lambda c: F.coalesce(row[c], F.lit(0)).cast("long").alias(c)
    levels = [F.coalesce(F.nullif(row[c], F.lit("")), F.lit(default)).alias(name) for name, (c, default) in SIGNAL_DEFAULTS.items()]
    return F.struct(count("commentary_signal_count"), count("market_signal_count"), *levels, F.coalesce(row["internal_notes"], F.array().cast("array<string>")).alias("internal_notes"))


def signal_refs(commentary_ids: Column, market_ids: Column) -> Column:
    """STRUCT of sorted ids without nulls and empty ones."""
    clean = lambda c: F.array_sort(F.filter(F.coalesce(c.cast("array<string>"), F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != ""))
    return F.struct(clean(commentary_ids).alias("commentary_ids"), clean(market_ids).alias("market_signal_ids"))
