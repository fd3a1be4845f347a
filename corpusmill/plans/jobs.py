"""Composed jobs: what a user starts. Each takes and returns DataFrames; nothing that is dropped goes without a reason."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, rules, scoring
from ..functions.text import any_of, quoted_title, references, squeeze, strip_html
from ..operators import context, dedup, filters, identity, incremental, monitoring, ranking, relations, signals
from ..operators.tables import one_row, stage
from ..sources import readers


def corpus_audit(docs: DataFrame, canonical: dict[str, str], keywords: dict[str, Iterable[str]]) -> DataFrame:
    """Findings (check, doc_id, detail) of a dry run: news, issuer mismatches, duplicates, placeholder ids (H1)."""
    issuer = F.nullif(F.array_join("issuer", " "), F.lit(""))
    news = docs.select("doc_id", filters.news_reasons(F.col("url"), F.col("title"), issuer).alias("r")).where(F.size(F.filter("r", lambda x: ~x.startswith("issuer_unknown"))) > 0)
    out = news.select(F.lit("non_policy").alias("check"), "doc_id", F.array_join("r", ",").alias("detail"))
    mismatch = identity.id_issuer_findings(docs, canonical, keywords).select(F.lit("id_issuer").alias("check"), "doc_id", F.col("expected").alias("detail"))
    groups = dedup.duplicate_groups(docs.withColumn("number", F.col("official_number")).withColumn("pos", F.col("pos") if "pos" in docs.columns else F.col("doc_id")))
    dup = groups.where("doc_id <> keep_id").select(F.lit("dedup").alias("check"), "doc_id", F.col("keep_id").alias("detail"))
    old = docs.where(filters.placeholder_ids(F.col("doc_id"))).select(F.lit("placeholder_id").alias("check"), "doc_id", F.lit("").alias("detail"))
    return out.unionByName(mismatch).unionByName(dup).unionByName(old)


def audit_apply(docs: DataFrame, decisions: DataFrame, on: str) -> dict[str, DataFrame]:
    """Tables kept, archived, duplicates, reminted and manifest from decisions (doc_id, action archive | duplicate | remint, target, reason) (H2)."""
    d = one_row(decisions.select(F.col("doc_id").alias("_d"), "action", "target", "reason"), ["_d"])
    j = stage(docs.join(d, F.col("doc_id") == F.col("_d"), "left").drop("_d"))
    plain = lambda a: j.where(F.col("action") == a)
    reminted = identity.remint(plain("remint").drop("action", "target", "reason"), plain("remint").select("doc_id", F.col("target").alias("new_id"), F.col("reason").alias("method")), on)
    return {
        "kept": j.where(F.col("action").isNull()).drop("action", "target", "reason"), "archived": plain("archive").drop("action", "target"), "duplicates": plain("duplicate").withColumnRenamed("target", "_duplicate_of").drop("action"),
        "reminted": reminted, "manifest": j.where(F.col("action").isNotNull()).select("doc_id", "action", "target", "reason", F.lit(on).alias("at")),
    }


def identity_job(docs: DataFrame, registry: DataFrame, ledger: DataFrame, this_year: int) -> tuple[DataFrame, DataFrame]:
    """(resolved with repairs and conflicts, one row agree_rate) (H3): dates of the body by date_candidates, then the rules of resolve_identity."""
    d = docs.withColumn("_c", dates.date_candidates(F.col("body")))
    d = d.withColumn("body_date", dates.strict_issuance_date(F.col("_c"))).withColumn("date_is_other", dates.mislabelled(F.col("_c"), F.col("date")) & ~dates.stands_as_issuance(F.col("_c"), F.col("date"))).drop("_c")
    d = d.withColumn("title_issuer", F.nullif(F.regexp_extract(F.coalesce("title", F.lit("")), r"^([一-龥]{2,20}?(?:委员会|局|厅|部|政府|办公室))", 1), F.lit("")))
    resolved = stage(identity.resolve_identity(d, registry, docs.select(F.col("doc_id").alias("id")), this_year))
    checked = identity.cross_check(resolved.where("id_fix IS NOT NULL").select("doc_id", F.col("id_fix.value").alias("new_id")), ledger)
    return resolved, monitoring.agreement_rate(checked)


def identity_apply(docs: DataFrame, resolve: Callable[[DataFrame], DataFrame], ledger: DataFrame, dependants: Mapping[str, tuple[DataFrame, Iterable[str]]] | None = None, least_agreement: float = 0.95) -> dict:
    """Repairs applied to their fixed point (H3): docs, mapping, queue, log and second_run, and each of the dependants (rows, id columns) with the new ids.

    resolve gives resolve_identity's rows for documents. Rows that contradict the ledger stay as they are and are queued. Refused with ValueError, before anything is handed out, if fewer
    than least_agreement of the comparable new ids agree with the ledger, or if a second run over the repaired documents finds anything left to repair.
    """
    found = stage(resolve(docs))
    rate = monitoring.agreement_rate(identity.cross_check(found.where("id_fix IS NOT NULL").select("doc_id", F.col("id_fix.value").alias("new_id")), ledger)).first()[0]
    if rate is not None and rate < least_agreement:
        raise ValueError(f"not applied: {rate:.3f} of the new ids agree with the ledger, {least_agreement} are needed")
    resolved = stage(identity.without_contradicted(found, ledger))
    repaired, mapping = (stage(x) for x in identity.apply_repairs(docs, resolved))
    contradicted = resolved.where(F.exists("conflicts", lambda x: x["reason"] == "contradicts_ledger")).select("doc_id")
    again = resolve(repaired).join(contradicted, "doc_id", "left_anti").where(" OR ".join(f"{f}_fix IS NOT NULL" for f in identity.FIXES)).count()
    if again:
        raise ValueError(f"not applied: a second run would repair {again} documents more")
    none = docs.sparkSession.createDataFrame([], "id string")
    moved = {name: identity.remap(rows, mapping, none, cols)[0] for name, (rows, cols) in (dependants or {}).items()}
    fixes = [f"{f}_fix" for f in identity.FIXES]
    return moved | {"docs": repaired, "mapping": mapping, "queue": resolved.where(F.size("conflicts") > 0).select("doc_id", "conflicts"), "log": resolved.where(" OR ".join(f"{f} IS NOT NULL" for f in fixes)).select("doc_id", *fixes), "second_run": again}


def theme_scores(docs: DataFrame, drafts: DataFrame, verdicts: DataFrame, known: list[str], impact_keys: list[str], needed: dict[str, Iterable[str]], forced: tuple[str, Iterable[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted drafts, queue with stage and reasons) (H4): canonical ids, evidence, scores, program gate, verdict (missing: judge_error)."""
    d = drafts.join(docs.select(F.col("doc_id").alias("pid"), F.substring("body", 1, 2000).alias("_head"), F.col("region.level").alias("_level")), "pid", "left")
    d = d.withColumn("themes", scoring.canonical_themes(F.col("themes"), known)).withColumn("_e", scoring.correct_evidence(F.col("themes"), F.col("primary_theme"), F.coalesce("_head", F.lit("")), needed, forced))
    d = d.withColumn("themes", F.col("_e.themes")).withColumn("primary_theme", F.col("_e.primary_theme")).withColumn("importance", scoring.importance(F.col("scores"))).withColumn("action_class", scoring.action_class(F.col("scores")))
    d = d.withColumn("gate_passed_deep", scoring.gate_deep(F.col("importance"), F.col("_level"))).withColumn("value_tags", scoring.value_tags(F.col("importance"), F.col("themes")))
    d = d.withColumn("reasons", scoring.check_draft({c: F.col(c) for c in ("themes", "primary_theme", "scores", "importance", "action_class", "impact", "gate_passed_deep")}, known, impact_keys, F.col("_level")))
    v = one_row(verdicts.select(F.col("pid").alias("_v"), F.col("decision").alias("_dec")), ["_v"])
    d = d.join(v, F.col("pid") == F.col("_v"), "left")
    stage_ = F.when(F.size("reasons") > 0, "program_gate").when(F.col("_dec").isNull(), "judge_error").when(F.col("_dec") != "accept", "judge_reject")
    d = stage(d.withColumn("stage", stage_).drop("_head", "_level", "_e", "_v", "_dec"))
    return d.where("stage IS NULL").drop("stage", "reasons"), d.where("stage IS NOT NULL")


def rule_relations(docs: DataFrame) -> DataFrame:
    """Relations by cited official numbers, joined on number cores (H5). docs: doc_id, title, official_number, body."""
    core = F.regexp_extract(F.col("number"), r"((?:19|20)\d{2}[〕\])]\d+号)", 1)
    targets = docs.select("doc_id", F.col("official_number").alias("number"))
    return relations.citations(docs.select("doc_id", "title", "body"), targets.where(F.regexp_replace("number", r"\s+", "").rlike(r"(?:19|20)\d{2}[〕\])]\d+号")), core)


def semantic_relations(views: DataFrame, basis: DataFrame, verdicts: DataFrame, top_k: int = 8) -> tuple[DataFrame, DataFrame]:
    """(accepted, manual review or rejected) (H6): scored pairs, greedy cap, verdicts, contradictions."""
    c = relations.capped_pairs(views, basis, top_k)
    c = c.withColumn("candidate_id", relations.key_id("SRC_", F.col("from_id").cast("string"), F.col("to_id").cast("string"), F.col("rel")))
    d = stage(relations.demote_contradictions(relations.apply_verdicts(c, verdicts)))
    return d.where("decision = 'accept'"), d.where("decision <> 'accept'")


def relation_views(semantic: DataFrame, rule: DataFrame, nodes: DataFrame) -> dict[str, DataFrame]:
    """Canonical edges, counts and adjacency of two sources (H7); semantic edges win ties."""
    edges, counts = relations.merge_edges(relations.union_sources(sem=semantic, hpr=rule), nodes, (*rules.HIGH_PRECISION_RELATIONS, *rules.SEMANTIC_RELATIONS, "same_topic"))
    edges = stage(edges)
    return {"edges": edges, "counts": counts, "adjacency": relations.adjacency(edges)}


def relation_inventory(rows: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with end status and family, counts (metric, key, n)) (H8)."""
    r = stage(relations.endpoint_status(rows, index).withColumn("family", relations.relation_family(F.col("rel"))))
    by = lambda m, c: r.groupBy(c.alias("key")).agg(F.count("*").alias("n")).select(F.lit(m).alias("metric"), "key", "n")
    flags = r.select(F.explode("flags").alias("key")).groupBy("key").agg(F.count("*").alias("n")).select(F.lit("flag").alias("metric"), "key", "n")
    return r, by("rel", F.col("rel")).unionByName(by("family", F.col("family"))).unionByName(flags)


def commentary_job(docs: DataFrame, themes: Mapping[str, Iterable[str]]) -> dict[str, DataFrame]:
    """Signals, review queue and counts (H9); signals + skipped = input."""
    s = stage(signals.commentary_signals(docs, themes))
    skipped = docs.agg(F.count_if(F.coalesce("not_policy_related", F.lit(False))).alias("unrelated"), F.count_if(~F.coalesce("not_policy_related", F.lit(False)) & (F.size(F.coalesce("related", F.array().cast("array<string>"))) == 0)).alias("unlinked"))
    return {"signals": s, "queue": s.select("commentary_id", "path", F.explode("queue_reasons").alias("reason")), "skipped": skipped}


def market_job(manifest: DataFrame, docs: DataFrame, index: DataFrame, themes: Mapping[str, Iterable[str]]) -> dict[str, DataFrame]:
    """Market signals of manifest rows (pid, title), queue of reasons and of ids that aren't found."""
    found, missing = identity.lookup_or_queue(manifest.withColumnRenamed("title", "_title"), index, "pid")
    d = docs.withColumnRenamed("doc_id", "_doc")
    j = found.join(d, F.col("located_id") == F.col("_doc")).withColumn("title", F.coalesce(F.nullif(F.col("_title"), F.lit("")), F.col("title"))).withColumn("doc_id", F.col("_doc"))
    s = stage(signals.market_signals(j, themes))
    queue = s.select("source_pid", "current_policy_id", "raw_path", F.explode("queue_reasons").alias("reason"))
    return {"signals": s, "queue": queue.unionByName(missing.select(F.col("pid").alias("source_pid"), F.lit("").alias("current_policy_id"), F.lit("").alias("raw_path"), "reason"))}


def publishable_signals(commentary: DataFrame, commentary_queue: DataFrame, market: DataFrame, market_queue: DataFrame) -> dict[str, DataFrame]:
    """Accepted and blocked signals of both kinds."""
    key = F.array(F.concat(F.lit("id:"), "commentary_id"))
    ca, cb = signals.block_by_queue(commentary, commentary_queue, "commentary_id", key, key)
    cols = lambda df: {c: F.col(c) for c in df.columns}
    ma, mb = signals.block_by_queue(market, market_queue, "market_signal_id", signals.match_keys(cols(market)), signals.match_keys(cols(market_queue)))
    return {"commentary": ca, "market": ma, "blocked_commentary": cb, "blocked_market": mb}


def signal_context(comments: DataFrame, market: DataFrame, blocked: DataFrame) -> dict[str, DataFrame]:
    """Document, theme and region contexts after the check that nothing blocked got in."""
    context.assert_disjoint(comments.select("signal_id").unionByName(market.select("signal_id")), blocked)
    region, unknown = context.region_context(market)
    return {"document": context.document_context(comments, market), "theme": context.theme_context(comments, market), "region": region, "unknown_region": unknown}


def relation_increment(docs: DataFrame, views: DataFrame, ledger: DataFrame, judged: DataFrame, verdicts: DataFrame, accepted_before: DataFrame, old_edges: DataFrame) -> dict:
    """One nightly step (H14): rule relations over all documents, new pairs with verdicts, merged views, the shrink gate; the ledger grows only when the gate is open."""
    rule = stage(rule_relations(docs).select("from_id", "to_id", "rel", "confidence", F.col("candidate_id").alias("source"), "evidence"))
    new = incremental.new_keys(docs.select(F.col("doc_id").alias("node_id")), ledger, "node_id")
    basis = rule.where("rel = 'cites_basis'").select("from_id", "to_id")
    pairs = relations.capped_pairs(views, basis)
    pairs = pairs.withColumn("candidate_id", relations.key_id("SRC_", F.col("from_id").cast("string"), F.col("to_id").cast("string"), F.col("rel")))
    todo = incremental.touching(pairs, new, judged)
    decided = stage(relations.demote_contradictions(relations.apply_verdicts(todo, verdicts)))
    semantic = accepted_before.unionByName(decided.where("decision = 'accept'").select("from_id", "to_id", "rel", F.col("sim").alias("confidence"), F.col("candidate_id").alias("source"), F.lit("").alias("evidence")), allowMissingColumns=True)
    views_ = relation_views(semantic, rule, docs.select(F.col("doc_id").alias("node_id")))
    refused = monitoring.shrink_gate(views_["edges"], old_edges)
    return {**views_, "decided": decided, "refused": refused, "ledger": ledger if refused else ledger.unionByName(new).distinct()}


def summary_increment(summaries: DataFrame, docs: DataFrame, covered: DataFrame) -> dict:
    """New summaries that pass the row gate, the others with reasons, and a reason to refuse the batch."""
    fresh = summaries.join(incremental.new_keys(docs.select("doc_id"), covered, "doc_id"), "doc_id", "left_semi")
    r = stage(fresh.withColumn("reasons", scoring.summary_reasons(F.col("summary"), F.col("what"), F.col("why"))))
    ok = r.where(F.size("reasons") == 0).drop("reasons")
    return {"accepted": ok, "rejected": r.where(F.size("reasons") > 0), "refused": monitoring.unique_gate(ok, "doc_id")}


def isolate(rows: DataFrame, producer: str, models: Iterable[str], deprecated: Iterable[str], expected: Iterable[str], backup: DataFrame | None = None) -> dict[str, DataFrame]:
    """Manifest, kept and isolated rows (H16, H28); rows that the backup holds with the same hash are already_isolated, so a rerun changes nothing."""
    c = filters.provenance_class({k: F.col(k) for k in ("pid", "stem", "extracted_by", "extracted_model", "impact_keys")}, producer, models, deprecated, expected)
    d = rows.withColumn("_c", c).withColumn("sha256", F.sha2(F.to_json(F.struct(*sorted(rows.columns))), 256)).withColumn("action", F.col("_c.action")).withColumn("reasons", F.col("_c.reasons")).drop("_c")
    if backup is not None:
        b = backup.select(F.col("sha256").alias("_b")).distinct()
        d = d.join(b, F.col("sha256") == F.col("_b"), "left").withColumn("action", F.when((F.col("action") == "isolate_legacy") & F.col("_b").isNotNull(), "already_isolated").otherwise(F.col("action"))).drop("_b")
    d = stage(d)
    return {"manifest": d.select("pid", "action", "reasons", "sha256"), "kept": d.where("action IN ('keep_current', 'manual_review')"), "isolated": d.where("action = 'isolate_legacy'"), "counts": d.groupBy("action").agg(F.count("*").alias("n"))}


def sync(derived: DataFrame, raw: DataFrame, edges: DataFrame, target: DataFrame, target_edges: DataFrame) -> dict[str, DataFrame]:
    """Merged documents and edges of the store, skipped rows with reasons."""
    rows, skipped = incremental.sync_rows(derived, raw)
    up = rows.withColumn("pipeline_pid", F.col("pid")).withColumn("importance", scoring.importance_enum(F.col("importance")))
    docs = stage(incremental.upsert_documents(target, up.select(*[c for c in target.columns if c in up.columns])))
    ids = docs.select(F.col("pipeline_pid").alias("node_id"), F.col("pipeline_pid").alias("key"))
    e = relations.resolve_endpoints(edges, ids).select("from_key", "to_key", F.col("rel").alias("type"), "confidence")
    return {"documents": docs, "edges": incremental.upsert_edges(target_edges, e), "skipped": skipped}


def collection_chain(pages: DataFrame, known: DataFrame, bodies: DataFrame, keywords: Iterable[str] | None = None, verdicts: DataFrame | None = None) -> dict[str, DataFrame]:
    """Stored list pages -> items -> new ones -> documents by lane (H18). known: (url, number, title); bodies: (url, html) of stored articles."""
    items = readers.page_items(pages, keywords).withColumn("row_id", F.concat_ws(":", F.col("page_id").cast("string"), F.col("pos").cast("string"))).withColumn("number", F.lit(""))
    items = stage(items)
    fresh = dedup.known_duplicates(items, known, anti=True)
    kept = dedup.greedy_batch(fresh.withColumn("pos", F.row_number().over(dedup.Window.partitionBy("page_id").orderBy("pos")) + F.col("page_id") * 1_000_000)).where("kept").drop("kept")
    b = bodies.select(F.col("url").alias("_u"), strip_html(F.col("html"), 1).alias("body"))
    j = kept.join(b, F.col("url") == F.col("_u"), "left").drop("_u").withColumn("_c", dates.date_candidates(F.coalesce("body", F.lit(""))))
    j = j.withColumn("date", dates.extract_date(F.col("url"), F.col("_c"))["date"]).withColumn("official_number", dates.official_number(F.col("body"))).withColumn("issuer", dates.issuer_of_host(F.col("url"))).drop("_c")
    second = stage(filters.second_round(j))
    gated = stage(filters.gate(second.where("outcome = 'kept'").withColumn("ref", F.col("row_id")), verdicts))
    docs = gated.withColumn("doc_id", identity.compute_id(F.col("date"), F.col("issuer"), F.col("official_number"), F.col("title"), F.lit(None).cast("string"), F.lit(None).cast("string")))
    lane = lambda a: docs.where(F.col("action") == a)
    return {"items": items, "quarantine": second.where("outcome = 'quarantine'"), "pass": lane("pass"), "commentary": lane("commentary"), "review": lane("review_queue"), "reject": lane("reject")}


def backfill(commentary: DataFrame, docs: DataFrame, keywords: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """(candidates, one row dropped): titles quoted in commentary (path, text) that aren't collected yet and stand near a scope word."""
    refs = commentary.select("path", "text", F.posexplode(references(F.col("text"))).alias("p", "title"))
    at = F.expr("instr(text, title)")
    refs = refs.withColumn("context", squeeze(F.substring("text", F.greatest(F.lit(1), at - 60), F.length("title") + 120)))
    refs = refs.withColumn("ref_id", F.concat_ws("#", "path", F.lpad(F.col("p").cast("string"), 6, "0"))).withColumn("url", F.lit(None).cast("string")).drop("text", "p")
    new = stage(dedup.not_collected(refs, docs).withColumn("_ok", any_of(F.concat_ws("\n", "title", "context"), keywords)))
    return new.where("_ok").drop("_ok"), new.agg(F.count_if(~F.col("_ok")).alias("dropped"))


def route_interpretations(docs: DataFrame, markers: Iterable[str] = rules.COMMENTARY_MARKERS) -> tuple[DataFrame, DataFrame]:
    """(documents that stay, commentary with the name of what they interpret and its id where it is found)."""
    is_ = any_of(F.col("title"), markers)
    stay, moved = docs.where(~is_), docs.where(is_).withColumn("ref_name", quoted_title(F.col("title")))
    m = dedup.match_titles(moved.select(F.col("doc_id").alias("query_id"), F.col("ref_name").alias("name")), stay.select("doc_id", "title")).select(F.col("query_id").alias("_q"), F.col("doc_id").alias("related_policy"))
    return stay, moved.join(m, F.col("doc_id") == F.col("_q"), "left").drop("_q")


def consolidate(raw: DataFrame, derived: DataFrame, retired: DataFrame, key: str) -> dict[str, DataFrame]:
    """Raw rows that stay, retired ones, and derived rows that have lost theirs."""
    left = raw.join(retired.select(key).distinct(), key, "left_anti")
    return {"kept": left, "retired": raw.join(retired.select(key).distinct(), key, "left_semi"), "orphans": identity.orphans(derived, left, key)}


def golden_set(rows: DataFrame, planted: DataFrame, human: DataFrame, consensus: DataFrame, key: str = "record_id") -> DataFrame:
    """Rows with gold: planted rows before human labels before consensus (H22). The three tables: (key, gold)."""
    out = rows
    for name, t in (("p", planted), ("h", human), ("c", consensus)):
        t = one_row(t.select(F.col(key).alias(f"_k{name}"), F.col("gold").alias(f"_{name}")), [f"_k{name}"])
        out = out.join(t, F.col(key) == F.col(f"_k{name}"), "left").drop(f"_k{name}")
    source = F.when(F.col("_p").isNotNull(), "planted").when(F.col("_h").isNotNull(), "human").when(F.col("_c").isNotNull(), "consensus")
    return out.withColumn("gold", F.coalesce("_p", "_h", "_c")).withColumn("gold_source", source).withColumn("is_planted", F.col("_p").isNotNull()).drop("_p", "_h", "_c")


def discovery_targets(regions: DataFrame, institutions: Iterable[str], known: DataFrame) -> DataFrame:
    """(region, institution, domain): every region with every institution type and its known domain; of several, the first one that has a domain."""
    grid = regions.select("region", F.explode(F.array(*map(F.lit, institutions))).alias("institution"))
    k = known.groupBy("region", "institution").agg(F.min_by("domain", F.struct(F.when(F.coalesce("domain", F.lit("")) == "", 1).otherwise(0).alias("none"), F.col("pos"))).alias("domain"))
    return grid.join(k, ["region", "institution"], "left")


def reprobe(channels: DataFrame, probes: DataFrame, on: str) -> DataFrame:
    """The catalog after probe results (list_url, verdict) (H24): promoted when ok, ambiguous when the structure is unknown, else unchanged."""
    p = one_row(probes.select(F.col("list_url").alias("_u"), F.col("verdict").alias("_v")), ["_u"])
    j = channels.join(p, F.col("list_url") == F.col("_u"), "left")
    move = F.when((F.col("_v") == "ok") & (F.col("status") != "验证"), "promoted").when(F.col("_v") == "structure_unknown", "ambiguous").otherwise("unchanged")
    j = j.withColumn("transition", move).withColumn("status", F.when(F.col("transition") == "promoted", "验证").otherwise(F.col("status")))
    return j.withColumn("last_probed_at", F.when(F.col("_v").isNotNull(), F.lit(on)).otherwise(F.col("last_probed_at"))).withColumn("probe_result", F.coalesce("_v", "probe_result")).drop("_u", "_v")


def sweep(dead: DataFrame, history: DataFrame, queue: DataFrame, at: str, max_retries: int = 2, cap: int = 50) -> dict[str, DataFrame]:
    """Dead letters back to the queue, given up or left, with the new history."""
    plan = stage(ranking.plan_sweep(dead, history, max_retries, cap))
    again = plan.where("outcome = 'requeued'").select("pid", F.lit("dead_letter_sweep").alias("trigger"), F.lit("low").alias("priority"), F.lit(at).alias("requested_at"), (F.col("pos") + 1_000_000_000_000).alias("pos"))
    return {"queue": ranking.queue_order(queue.unionByName(again)), "archived": plan.where("outcome = 'given_up'"), "left": plan.where("outcome = 'left'"), "history": ranking.new_history(plan, history)}
