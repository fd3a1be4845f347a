"""Filters, gates and routings. Each gives a column (a class, a list of reasons) so that one pass decides and nothing is lost silently."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import any_of, first_of, first_pattern, host, host_ends, host_in, reasons
from .tables import one_row


def relevant(texts: Iterable[Column], keywords: Iterable[str]) -> Column:
    """A keyword stands in one of the texts (B1)."""
    return any_of(F.concat_ws("\n", *texts), keywords)


def issuer_is_gov(issuer: Column) -> Column:
    """Null: no (B3)."""
    return any_of(issuer, rules.GOV_ISSUER_KEYWORDS)


def news_reasons(url: Column, title: Column, issuer: Column, domains: Iterable[str] = rules.DOMAIN_BLACKLIST, suffixes: Iterable[str] = rules.GOV_SUFFIXES, markers: Iterable[str] = rules.NON_POLICY_TITLE_MARKERS) -> Column:
    """Ordered reasons why a row is news rather than a regulation (B4): host, title shape, marker or else result shape, box characters, issuer."""
    t = F.coalesce(title, F.lit(""))
    shape = first_pattern(t, rules.TITLE_BAD_PATTERNS, lambda p: f"title_pattern:{p}")
    marker = F.concat(F.lit("non_policy_title:"), first_of(t, markers))
    result = first_pattern(t, rules.NON_POLICY_TITLE_PATTERNS, lambda p: f"non_policy_title:{p}")
    gov = host_ends(url, suffixes) & issuer.isNull()
    return F.array_compact(F.array(
        F.when(host_in(url, domains), F.lit("domain_blacklist")), shape, F.coalesce(marker, result), F.when(t.rlike(rules.BOX_DRAWING), F.lit("non_policy_list_row")),
        F.when(~issuer_is_gov(issuer), F.when(gov, F.lit("issuer_unknown_but_gov_domain")).otherwise(F.lit("issuer_unknown"))),
    ))


def ingest_class(title: Column, skip=rules.SKIP_PATTERNS, market=rules.MARKET_PATTERNS, capacity: str = rules.CAPACITY, procurement: str = rules.PROCUREMENT) -> Column:
    """STRUCT<disposition, reason>: junk, market notice or ingest, the first rule that hits."""
    t = F.coalesce(title, F.lit(""))
    of = lambda d, r: F.struct(F.lit(d).alias("disposition"), F.lit(r).alias("reason"))
    c = None
    for pattern, reason in skip:
        c = F.when(t.rlike(pattern), of("skip_junk", reason)) if c is None else c.when(t.rlike(pattern), of("skip_junk", reason))
    c = c.when(t.rlike(capacity) & t.rlike(procurement), of("market_intel", "采购招标+容量"))
    for pattern, reason in market:
        c = c.when(t.rlike(pattern), of("market_intel", reason))
    return c.otherwise(of("ingest", ""))


def gate_heuristic(url: Column, title: Column, commentary: Iterable[str] = rules.COMMENTARY_MARKERS, signals: Iterable[str] = rules.POLICY_TITLE_SIGNALS, fast: Iterable[str] = rules.FAST_REJECT_DOMAINS) -> Column:
    """non_policy, commentary, policy or gray."""
    hard = F.size(F.filter(news_reasons(url, title, F.lit(None).cast("string")), lambda r: r != "issuer_unknown_but_gov_domain")) > 0
    return F.when(host_in(url, fast), "non_policy").when(any_of(title, commentary), "commentary").when(hard, "non_policy").when(host_ends(url, rules.GOV_SUFFIXES) & any_of(title, signals), "policy").otherwise("gray")


def gate(docs: DataFrame, verdicts: DataFrame | None = None, ref: str = "ref", threshold: float = rules.REVIEW_THRESHOLD, heuristic: Column | None = None) -> DataFrame:
    """docs (ref, url, title) with gate_label, gate_confidence and action pass, commentary, reject or review_queue.

    Gray rows take a verdict (ref, label, confidence) from a table; without a table they pass at 0.5; rows the table lacks or
    whose label is null (unparsable) go to review at 0.4. A label other than commentary and policy under the threshold goes to review.
    """
    h = gate_heuristic(F.col("url"), F.col("title")) if heuristic is None else heuristic
    d = docs.withColumn("_h", h)
    if verdicts is None:
        label, conf = F.lit("policy"), F.lit(0.5)
        gray = F.lit("pass")
    else:
        v = one_row(verdicts.select(F.col(ref).alias("_ref"), F.col("label").alias("_label"), F.col("confidence").cast("double").alias("_conf")), ["_ref"])
        d = d.join(v, F.col(ref) == F.col("_ref"), "left").drop("_ref")
        label, conf = F.coalesce("_label", F.lit("policy")), F.when(F.col("_label").isNull(), 0.4).otherwise(F.coalesce("_conf", F.lit(0.5)))
        gray = F.when(F.col("_label").isNull(), "review_queue").when(F.col("_label") == "commentary", "commentary").when(F.col("_label") == "policy", "pass").when(conf < threshold, "review_queue").otherwise("reject")
    action = F.when(F.col("_h") == "commentary", "commentary").when(F.col("_h") == "policy", "pass").when(F.col("_h") == "non_policy", "reject").otherwise(gray)
    d = d.withColumn("gate_label", F.when(F.col("_h") == "gray", label).when(F.col("_h") == "non_policy", "non_policy_news").otherwise(F.col("_h")))
    return d.withColumn("gate_confidence", F.when(F.col("_h") == "gray", conf).otherwise(F.lit(0.95))).withColumn("action", action).drop("_h", *([] if verdicts is None else ["_label", "_conf"]))


def second_round(rows: DataFrame) -> DataFrame:
    """Rows with a body, with outcome kept or quarantine: only unknown issuers and non-policy titles quarantine; date is the extracted one, else the hint."""
    r = news_reasons(F.col("url"), F.col("title"), F.col("issuer"))
    bad = F.filter(r, lambda x: (x == "issuer_unknown") | x.startswith("non_policy_"))
    date = F.coalesce(F.nullif(F.col("date"), F.lit("")), F.col("date_hint"), F.lit(""))
    return rows.where(F.coalesce("body", F.lit("")) != "").withColumn("quarantine_reasons", bad).withColumn("date", date).withColumn("outcome", F.when(F.size(bad) > 0, "quarantine").otherwise("kept"))


def since(date: Column, bound: str) -> Column:
    """Unknown dates and dates from the bound on; the bound must be an ISO date."""
    import datetime

    datetime.date.fromisoformat(bound)
    return (F.coalesce(date.cast("string"), F.lit("")) == "") | (date.cast("string") >= bound)


def select_channels(channels: DataFrame, levels: Iterable[str], types: Iterable[str] = (), status: str = "验证") -> DataFrame:
    """Verified channels of the levels whose type holds one of the given words."""
    out = channels.where(F.col("level").isin(*levels) & (F.col("status") == status))
    return out.where(any_of(F.col("channel_type"), types)) if types else out


def contract_violations(front: Column, sections: Column, required: Iterable[str], allowed: Iterable[str], legacy: Iterable[str] = (), forbidden: Iterable[str] = ()) -> Column:
    """Array of STRUCT<kind, name>: required keys that are missing or empty, keys not allowed (hard or legacy drift), forbidden sections."""
    arr = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    keys = F.coalesce(F.map_keys(front), F.array().cast("array<string>"))
    present = F.filter(keys, lambda k: F.coalesce(F.try_element_at(front, k), F.lit("")) != "")
    tag = lambda xs, kind: F.transform(xs, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("name")))
    extra = F.array_except(keys, arr([*required, *allowed]))
    return F.concat(tag(F.array_except(arr(required), present), "missing"), tag(F.array_except(extra, arr(legacy)), "unexpected"), tag(F.array_intersect(extra, arr(legacy)), "legacy"), tag(F.array_intersect(F.coalesce(sections, arr([])), arr(forbidden)), "forbidden_section"))


def contract_ok(violations: Column) -> Column:
    """No violation but legacy drift."""
    return ~F.exists(violations, lambda v: v["kind"] != "legacy")


def drift_inventory(docs: DataFrame, violations: str = "violations") -> DataFrame:
    """(kind, name, docs, ratio): how many documents show each violation."""
    total = docs.agg(F.count("*").alias("all"))
    v = docs.select(F.explode(F.array_distinct(F.col(violations))).alias("v")).groupBy("v.kind", "v.name").agg(F.count("*").alias("docs"))
    return v.join(total, F.lit(True)).select("kind", "name", "docs", (F.col("docs") / F.col("all")).alias("ratio"))


def placeholder_ids(pid: Column, prefix: str = "P_1900") -> Column:
    return pid.startswith(prefix)


def provenance_class(row: dict[str, Column], producer: str, models: Iterable[str], deprecated: Iterable[str], expected: Iterable[str]) -> Column:
    """STRUCT<action, reasons> of a derived row: keep_current, isolate_legacy or manual_review (B16). row: pid, stem, extracted_by, extracted_model, impact_keys."""
    arr = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    old = ~F.coalesce(row["extracted_by"] == producer, F.lit(False))
    keys = F.coalesce(row["impact_keys"], arr([]))
    why = reasons((old, "legacy_extracted_by"), (old & (F.coalesce(row["extracted_model"], F.lit("")).isin("", *models)), "legacy_model"), (F.arrays_overlap(keys, arr(deprecated)), "deprecated_key"), ((F.size(keys) > 0) & (F.array_sort(F.array_distinct(keys)) != F.array_sort(arr(expected))), "impact_schema_mismatch"))
    manual = F.when(F.coalesce(row["pid"], F.lit("")) == "", F.array(F.lit("missing_pid"))).when(row["pid"] != row["stem"], F.array(F.lit("pid_filename_mismatch")))
    return F.when(manual.isNotNull(), F.struct(F.lit("manual_review").alias("action"), manual.alias("reasons"))).when(F.size(why) > 0, F.struct(F.lit("isolate_legacy").alias("action"), why.alias("reasons"))).otherwise(F.struct(F.lit("keep_current").alias("action"), F.array(F.lit("current_flow")).alias("reasons")))


def distribution_warnings(drafts: DataFrame, n_themes: int) -> DataFrame:
    """Drafts that hold all themes."""
    return drafts.where(F.size("themes") >= n_themes)


def wants_refetch(content: Column, min_len: int = 800) -> Column:
    return F.length(F.coalesce(content, F.lit(""))) < min_len


def upgrade_bodies(docs: DataFrame, refetched: DataFrame, key: str = "doc_id") -> DataFrame:
    """Bodies replaced by refetched ones that are strictly longer."""
    r = one_row(refetched.select(F.col(key).alias("_k"), F.col("body").alias("_b")), ["_k"])
    longer = F.coalesce(F.length("_b") > F.length(F.coalesce("body", F.lit(""))), F.lit(False))
    return docs.join(r, F.col(key) == F.col("_k"), "left").withColumn("upgraded", longer).withColumn("body", F.when(longer, F.col("_b")).otherwise(F.col("body"))).drop("_k", "_b")


def list_page_verdict(html: Column, next_words: Iterable[str] = ("下一页", "下页", "next"), date: str = r"20\d{2}[-/.年]\d{1,2}") -> Column:
    """ok for a list page (a next-page word with any link, or three links near dates), structure_unknown for other pages with links, empty."""
    h = F.lower(F.coalesce(html, F.lit("")))
    links = F.regexp_count(h, F.lit(r"<a\s[^>]*href"))
    dated = F.regexp_count(h, F.lit(rf"<a\s[^>]*href[^<]*<[^>]*>[^<]{{0,80}}{date}|{date}[^<]{{0,40}}<[^>]*>\s*<a\s[^>]*href"))
    return F.when(F.trim(h) == "", "empty").when((any_of(h, next_words) & (links > 0)) | (dated >= 3), "ok").when(links > 0, "structure_unknown").otherwise("empty")


def non_policy_endpoint(title: Column, markers: Iterable[str] = rules.NON_POLICY_TITLE_MARKERS, shape: str = rules.NON_POLICY_TITLE_PATTERNS[0]) -> Column:
    """The first marker, else the news shape that hits; null if none."""
    return F.coalesce(first_of(title, markers), F.when(title.rlike(shape), F.lit(shape)))


def policy_url(url: Column) -> Column:
    """A path that is neither empty nor an index or search page."""
    path = F.lower(F.trim(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1), F.lit("/")))
    return (path != "") & ~path.isin("index.html", "index.htm") & ~path.rlike(r"search|sousuo|so\.html")


def candidate_channel_class(domain: Column, url: Column) -> Column:
    """junk, promotable or maybe by host, extension and path."""
    u = F.lower(F.coalesce(url, F.lit("")))
    return F.when(u.rlike(r"\.(pdf|docx?|xlsx?|zip|jpg|png)$") | (F.coalesce(domain, F.lit("")) == ""), "junk").when(domain.rlike(r"\.gov\.cn$") & u.rlike(r"(list|index|col|channel|zcfg|zwgk|tzgg)"), "promotable").when(domain.rlike(r"\.gov\.cn$"), "maybe").otherwise("junk")


def area_match(domain: Column, tokens: Column) -> Column:
    """A segment of the host equals an area token."""
    return F.arrays_overlap(F.split(host(F.concat(F.lit("http://"), domain)), r"\."), tokens)


def institution_match(domain: Column, markers: Iterable[str]) -> Column:
    return any_of(host(F.concat(F.lit("http://"), domain)), markers)


def ids_in_text(docs: DataFrame, pattern: str = r"P_\d{4}_[A-Za-z0-9_]+", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line_no, found): document ids that stand in a text, with line numbers from 1."""
    lines = docs.select(id_col, F.posexplode(F.split(F.coalesce(text_col, F.lit("")), "\n")).alias("p", "line"))
    return lines.select(id_col, (F.col("p") + 1).alias("line_no"), F.explode(F.regexp_extract_all("line", F.lit(pattern), F.lit(0))).alias("found"))


def channels_of(channels: DataFrame, batches: DataFrame | None, batch: str | None = None, cities: Iterable[str] = (), status: str = "验证") -> DataFrame:
    """Verified channels of the cities of a batch (city, batch), or of a list of cities."""
    verified = channels.where(F.col("status") == status)
    if batch is not None and batches is not None:
        return verified.join(batches.where(F.col("batch") == batch).select("city").distinct(), "city", "left_semi")
    return verified.where(F.col("city").isin(*cities))


def move_keys(docs: DataFrame, keys: Iterable[str], id_col: str = "doc_id", front: str = "fm") -> tuple[DataFrame, DataFrame]:
    """(docs without these header keys, table (id, key, value) of what was taken out)."""
    names = list(keys)
    gone = docs.select(id_col, F.explode(F.map_filter(front, lambda k, v: k.isin(*names))).alias("key", "value"))
    return docs.withColumn(front, F.map_filter(front, lambda k, v: ~k.isin(*names))), gone
