"""Incremental runs: what is new or changed, keyed merges, queues and ledgers kept as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import merge_keyed, one_row


def new_keys(tracked: DataFrame, covered: DataFrame, key: str) -> DataFrame:
    """Tracked keys that the ledger lacks (C17, F2)."""
    return tracked.select(key).distinct().join(covered.select(key).distinct(), key, "left_anti")


def touching(candidates: DataFrame, new: DataFrame, judged: DataFrame, key: str = "candidate_id", node: str = "node_id") -> DataFrame:
    """Candidates with a new end that haven't been judged (C17): two semi joins united, then an anti join."""
    n = new.select(F.col(node).alias("_n")).distinct()
    a = candidates.join(n, F.col("from_id") == F.col("_n"), "left_semi")
    b = candidates.join(n, F.col("to_id") == F.col("_n"), "left_semi").join(n, F.col("from_id") == F.col("_n"), "left_anti")
    return a.unionByName(b).join(judged.select(key).distinct(), key, "left_anti")


def content_hash(text: Column) -> Column:
    """SHA-256 of a text, null as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def needs_rebuild(docs: DataFrame, ledger: DataFrame, version: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with change: missing, version or content where the ledger (key, raw_content_hash, pipeline_version) differs (C18); unchanged rows go."""
    l = ledger.select(F.col(key).alias("_k"), F.col("raw_content_hash").alias("_h"), F.col("pipeline_version").alias("_v"))
    d = docs.withColumn("raw_content_hash", content_hash(F.col(text))).join(l, F.col(key) == F.col("_k"), "left")
    change = F.when(F.col("_k").isNull(), "missing").when(F.col("_v") != version, "version").when(F.col("_h") != F.col("raw_content_hash"), "content")
    return d.withColumn("change", change).where(F.col("change").isNotNull()).drop("_k", "_h", "_v")


def merge_ledger(ledger: DataFrame, done: DataFrame, version: int, key: str = "doc_id") -> DataFrame:
    return merge_keyed(ledger, done.select(key, "raw_content_hash", F.lit(version).alias("pipeline_version")), key)


def ledger_from_snapshot(snapshot: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Keys of an earlier snapshot that are still there become covered."""
    return current.select(key).distinct().join(snapshot.select(key).distinct(), key, "left_semi")


def upsert_documents(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents by pipeline_pid; importance stays where importance_override is set."""
    return merge_keyed(target, rows, "pipeline_pid", {"importance": "importance_override"})


def upsert_edges(target: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with resolved ends by (from_key, to_key, type)."""
    key = F.concat_ws("|", F.col("from_key").cast("string"), F.col("to_key").cast("string"), F.col("type"))
    out = merge_keyed(target.withColumn("_edge", key), edges.withColumn("_edge", key), "_edge")
    return out.drop("_edge")


def upsert_commentary(target: DataFrame, rows: DataFrame, key: str = "commentary_key") -> tuple[DataFrame, DataFrame]:
    """(merged, skipped): rows without a key are skipped; arrays go as JSON, dangling references stay."""
    ok = F.coalesce(F.col(key), F.lit("")) != ""
    as_json = rows
    for name, kind in rows.dtypes:
        if kind.startswith("array"):
            as_json = as_json.withColumn(name, F.to_json(name))
    return merge_keyed(target, as_json.where(ok), key), rows.where(~ok)


def upsert_undecided(target: DataFrame, rows: DataFrame, key: str = "dedupe_key") -> DataFrame:
    """Review rows by key: a row with a verdict doesn't change, others take all columns but the verdict."""
    guarded = {c: "verdict" for c in rows.columns if c not in (key, "verdict")}
    return merge_keyed(target, rows.drop("verdict"), key, guarded)


def insert_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of `rows` (each key once) that the target lacks."""
    return one_row(rows, keys).join(target.select(*keys).distinct(), keys, "left_anti")


def remove_resolved(pool: DataFrame, resolved: DataFrame, keys: tuple[str, str] = ("kind", "ref")) -> DataFrame:
    """The pool without resolved rows."""
    return pool.join(resolved.select(*keys).distinct(), list(keys), "left_anti")


def todo(candidates: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Candidates that haven't been judged yet."""
    return candidates.join(done.select(key).distinct(), key, "left_anti")


def sync_rows(derived: DataFrame, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, skipped with reason) (C19): derived (pid, …) against raw (doc_id, title, date, content)."""
    r = raw.select(F.col("doc_id").alias("_r"), F.trim(F.coalesce("title", F.lit(""))).alias("title"), F.try_to_date(F.substring("date", 1, 10)).alias("issue_date"), F.trim(F.coalesce("content", F.lit(""))).alias("content"))
    reason = F.when(F.col("_r").isNull(), "raw_missing").when(F.col("issue_date").isNull(), "bad_date").when(F.col("title") == "", "empty_title").when(F.col("content") == "", "empty_content")
    j = derived.join(r, F.col("pid") == F.col("_r"), "left").withColumn("reason", reason).drop("_r")
    return j.where(F.col("reason").isNull()).drop("reason"), j.where(F.col("reason").isNotNull())


def decision_status(decisions: DataFrame, queue: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, invalid, remaining queue): a decision is valid when the queue holds its content hash with the same pid and stage."""
    q = queue.withColumn("record_hash", F.sha2(F.to_json(F.struct(*sorted(queue.columns))), 256))
    k = q.select(F.col("record_hash").alias("_h"), F.col("pid").alias("_p"), F.col("stage").alias("_s"))
    j = decisions.join(k, (F.col("record_hash") == F.col("_h")) & (F.col("pid") == F.col("_p")) & (F.col("stage") == F.col("_s")), "left")
    valid = j.where(F.col("_h").isNotNull()).drop("_h", "_p", "_s")
    return valid, j.where(F.col("_h").isNull()).drop("_h", "_p", "_s"), q.join(valid.select("record_hash").distinct(), "record_hash", "left_anti")


def decision_record(items: DataFrame, operator: str, at: str) -> DataFrame:
    """Decision rows with an id that is the hash of their sorted content; a list or comma string of themes becomes an array."""
    d = items.withColumn("operator", F.lit(operator)).withColumn("decided_at", F.lit(at))
    if dict(d.dtypes).get("themes") == "string":
        d = d.withColumn("themes", F.filter(F.transform(F.split("themes", "[,，]"), lambda x: F.trim(x)), lambda x: x != ""))
    return d.withColumn("decision_id", F.sha2(F.to_json(F.struct(*sorted(d.columns))), 256))


def verdict_envelope(rows: DataFrame, at: str, kinds: dict[str, list[str]]) -> DataFrame:
    """rows (kind, ref, verdict) as envelopes with an idempotency key; verdicts not allowed for their kind are marked."""
    allowed = F.create_map(*[x for k, v in kinds.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    ok = F.array_contains(F.try_element_at(allowed, F.col("kind")), F.col("verdict"))
    return rows.select(F.concat_ws(":", "kind", "ref", "verdict").alias("idem_key"), "kind", "ref", "verdict", F.lit(at).alias("decided_at"), F.coalesce(ok, F.lit(False)).alias("allowed"))
