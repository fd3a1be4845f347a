"""Signals out of commentary and market notices, and what of them may be published."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import key_id, lines_of, readable, reasons, role_of, sanitize, signal_type_of, themes_of, time_validity, window_at_keyword
from .relations import contained


def related_ids(value: Column, pattern: str = r"P_[A-Za-z0-9_]+") -> Column:
    """Document ids named in a scalar or list, rendered as a string; first appearances in order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(value.cast("string"), F.lit("")), F.lit(pattern), F.lit(0)))


def commentary_signals(docs: DataFrame, themes: Mapping[str, Iterable[str]]) -> DataFrame:
    """docs (path, title, body, related array, not_policy_related boolean) -> signals with role, themes, confidence and evidence.

    Rows that are marked as unrelated or name no document give none.
    """
    d = docs.where(~F.coalesce("not_policy_related", F.lit(False)) & (F.size(F.coalesce("related", F.array().cast("array<string>"))) > 0))
    ok = readable(F.col("body"))
    title = sanitize(F.col("title"))
    text = sanitize(F.concat_ws(" ", title, F.when(ok, F.col("body")).otherwise(F.lit(""))))
    d = d.withColumn("_ok", ok).withColumn("title", title).withColumn("_text", text).withColumn("_r", role_of(F.col("_text"))).withColumn("theme_ids", themes_of(F.col("_text"), themes))
    has, role = F.size("theme_ids") > 0, F.col("_r.role")
    confidence = F.when((role != "interpretation") & has, 0.72).when(role != "interpretation", 0.62).when(has, 0.60).otherwise(0.52)
    evidence = F.when(F.col("_ok"), window_at_keyword(F.col("_text"), F.col("_r.keyword"))).otherwise(F.concat(F.lit("正文不可读; 仅保留标题线索: "), F.substring("title", 1, 100)))
    queue = reasons((~F.col("_ok"), "unreadable_body"), (~has, "no_theme_match"))
    return d.select(key_id("C_", F.col("path"), n=12, sha2=True).alias("commentary_id"), "path", "title", F.col("related").alias("related_policy_ids"), "theme_ids", role.alias("signal_role"), confidence.alias("confidence"), evidence.alias("evidence"), queue.alias("queue_reasons"))


def market_signals(rows: DataFrame, themes: Mapping[str, Iterable[str]]) -> DataFrame:
    """rows (pid, path, doc_id, title, body, region struct<level,code,name>, date, url) -> market signals."""
    title, body = sanitize(F.col("title")), sanitize(F.col("body"))
    d = rows.withColumn("title", title).withColumn("body", body).withColumn("theme_ids", themes_of(F.concat_ws(" ", F.col("title"), F.col("body")), themes)).withColumn("signal_type", signal_type_of(F.col("title"), F.col("body")))
    named = (F.coalesce("region.name", F.lit("")) != "") & (F.col("region.name") != "未知")
    score = F.lit(0.55) + F.when(F.col("signal_type") != "unknown", 0.15).otherwise(0.0) + F.when(F.size("theme_ids") > 0, 0.15).otherwise(0.0) + F.when(F.coalesce(named, F.lit(False)), 0.05).otherwise(0.0)
    queue = reasons((F.col("signal_type") == "unknown", "unknown_signal_type"), (F.size("theme_ids") == 0, "no_theme_match"), (~F.coalesce(named, F.lit(False)), "missing_region"))
    return d.select(
        key_id("MI_", F.col("pid"), F.col("path"), n=12, sha2=True).alias("market_signal_id"), F.col("pid").alias("source_pid"), sanitize(F.col("doc_id")).alias("current_policy_id"), F.col("path").alias("raw_path"), "title", "region", "theme_ids",
        lines_of(F.col("theme_ids")).alias("business_lines"), "signal_type", F.coalesce(F.col("date").cast("string"), F.lit("")).alias("observed_date"), time_validity(F.col("signal_type"), F.col("title"), F.col("body")).alias("time_validity"),
        F.array().cast("array<string>").alias("related_policy_ids"), F.round(F.least(score, F.lit(0.9)), 2).alias("confidence"), F.substring(sanitize(F.concat_ws(" ", "title", "body")), 1, 180).alias("evidence"), sanitize(F.col("url")).alias("source_url"), queue.alias("queue_reasons"),
    )


def themes_by_table(texts: DataFrame, registry: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, theme_ids) with the registry as a table (theme_id, aliases array, pos), by terms that the texts contain in any case.

    Texts and terms are joined on keys of their bytes (see relations.contained), then containment is checked; texts without a theme have no row.
    """
    terms = registry.select("theme_id", "pos", F.explode(F.concat(F.array("theme_id"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("term")).where(F.trim("term") != "").select("theme_id", "pos", F.lower(F.trim("term")).alias("term")).distinct()
    low = texts.select(F.col(id_col), F.lower(F.col(text_col)).alias("_t"))
    hit = low.join(contained(low, terms, id_col, "_t", "term"), id_col).where(F.expr("contains(_t, term)")).select(id_col, "term").join(terms, "term")
    return hit.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_set(F.struct("pos", "theme_id"))), lambda x: x["theme_id"]).alias("theme_ids"))


def match_keys(row: dict[str, Column]) -> Column:
    """Typed keys of a market row or queue entry: each id field that isn't empty, and the three source fields together."""
    s = lambda k: F.coalesce(row[k].cast("string"), F.lit("")) if k in row else F.lit("")
    single = [F.when(s(k) != "", F.concat(F.lit(f"{k}:"), s(k))) for k in ("source_pid", "current_policy_id", "raw_path", "market_signal_id")]
    three = F.concat_ws("|", s("source_pid"), s("current_policy_id"), s("raw_path"))
    return F.array_compact(F.array(*single, F.when(three != "||", F.concat(F.lit("composite:"), three))))


def block_by_queue(signals: DataFrame, queue: DataFrame, id_col: str, keys: Column, queue_keys: Column, reason_col: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(accepted, blocked with sorted queue_reasons): a row is blocked when any of its keys is in the queue (C15). Reasons of the rows themselves give way to the queue's."""
    q = queue.select(F.explode(queue_keys).alias("_key"), F.coalesce(F.nullif(F.col(reason_col), F.lit("")), F.lit("manual_review")).alias("_reason")).distinct()
    hit = signals.select(F.col(id_col).alias("_id"), F.explode(keys).alias("_key")).join(q, "_key").groupBy("_id").agg(F.array_sort(F.collect_set("_reason")).alias("queue_reasons"))
    marked = signals.drop("queue_reasons").join(hit, F.col(id_col) == F.col("_id"), "left").drop("_id")
    return marked.where(F.col("queue_reasons").isNull()).drop("queue_reasons"), marked.where(F.col("queue_reasons").isNotNull()).withColumn("publish_status", F.lit("blocked_pending_review"))


def publishable(row: DataFrame, prefix: str, path_col: str, kind: str) -> DataFrame:
    """Rows for publishing: path with its prefix (once), kind and status literals."""
    p = F.coalesce(F.col(path_col), F.lit(""))
    return row.withColumn(path_col, F.when((p == "") | p.startswith(prefix), p).otherwise(F.concat(F.lit(prefix), p))).withColumn("source_kind", F.lit(kind)).withColumn("publish_status", F.lit("publishable"))
