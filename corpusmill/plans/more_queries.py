"""Queries over composed jobs, sinks and small operators, with their SQL. The supplied tables stand in for the pipeline's own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..functions import text as T
from ..operators import context, filters, identity, incremental, monitoring, ranking, relations, signals
from ..operators.tables import new_path
from ..sources import sinks
from . import jobs
from .queries import first_line, query, table


def text_of(c: str) -> F.Column:
    return F.col(c).cast("string")


# ---- composed jobs ---------------------------------------------------------------------------------------------------------------------

SYNC_SQL = """d AS (SELECT o_orderkey AS pid, o_custkey AS c, CASE o_orderpriority WHEN '1-URGENT' THEN 1 ELSE 0 END AS urgent, CASE WHEN o_orderkey % 7 = 0 THEN 'raw_missing' WHEN o_orderkey % 11 = 0 THEN 'bad_date' WHEN o_orderkey % 13 = 0 THEN 'empty_title' WHEN o_orderkey % 17 = 0 THEN 'empty_content' END AS reason FROM orders)"""


def sync_tables(spark, d):
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    derived = o.select(text_of("o_orderkey").alias("pid"), F.when(F.col("o_orderpriority") == "1-URGENT", 9).otherwise(1).alias("importance"))
    raw = o.where(key % 7 != 0).select(text_of("o_orderkey").alias("doc_id"), F.when(key % 13 == 0, " ").otherwise(F.col("o_orderstatus")).alias("title"), F.when(key % 11 == 0, "soon").otherwise("2024-01-05T10:00").alias("date"), F.when(key % 17 == 0, "").otherwise("body").alias("content"))
    target = o.where(key % 3 == 0).select(text_of("o_orderkey").alias("pipeline_pid"), F.lit("old").alias("title"), F.lit("kept").alias("importance"), F.when(key % 2 == 0, "kept").alias("importance_override"))
    edges = o.select(text_of("o_orderkey").alias("from_id"), (key - key % 5).cast("string").alias("to_id"), F.lit("references").alias("rel"), F.lit(0.5).alias("confidence"))
    old = spark.createDataFrame([], "from_key string, to_key string, type string, confidence double")
    return jobs.sync(derived, raw, edges, target, old)


@query(f"""WITH {SYNC_SQL} SELECT CAST(pid AS VARCHAR) AS pid, reason FROM d WHERE reason IS NOT NULL""")
def sync_job_skips(spark, d):
    """H17, C19."""
    return sync_tables(spark, d)["skipped"].select("pid", "reason")


@query(f"""WITH {SYNC_SQL} SELECT CAST(pid AS VARCHAR) AS pid, CASE WHEN reason IS NULL THEN o_orderstatus ELSE 'old' END AS title, pid % 3 = 0 AND pid % 2 = 0 AND reason IS NULL OR pid % 3 = 0 AND reason IS NOT NULL AS importance_kept FROM d JOIN orders ON o_orderkey = pid WHERE reason IS NULL OR pid % 3 = 0""")
def sync_job_documents(spark, d):
    """The override keeps the importance, new and merged rows take the raw title."""
    return sync_tables(spark, d)["documents"].select(F.col("pipeline_pid").alias("pid"), "title", (F.coalesce(F.col("importance"), F.lit("")) == "kept").alias("importance_kept"))


@query(f"""WITH {SYNC_SQL}, n AS (SELECT pid FROM d WHERE reason IS NULL OR pid % 3 = 0) SELECT DISTINCT CAST(a.pid AS VARCHAR) AS from_key, CAST(b.pid AS VARCHAR) AS to_key, 'references' AS type FROM n a JOIN n b ON b.pid = a.pid - a.pid % 5""")
def sync_job_edges(spark, d):
    """H17, A14, C20."""
    return sync_tables(spark, d)["edges"].select("from_key", "to_key", "type")


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 4 = 0 THEN 'retired' ELSE 'kept' END AS lane, CASE WHEN c_nationkey % 4 = 0 THEN (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) ELSE 0 END AS orphans FROM customer""")
def consolidated_sources(spark, d):
    """Retired customers and the orders that lose theirs."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), "c_nationkey")
    out = jobs.consolidate(c, table(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), "o_orderkey"), c.where("c_nationkey % 4 = 0").select("doc_id"), "doc_id")
    n = out["orphans"].groupBy("doc_id").agg(F.count("*").alias("n"))
    rows = out["kept"].select("doc_id", F.lit("kept").alias("lane")).union(out["retired"].select("doc_id", F.lit("retired")))
    return rows.join(n, "doc_id", "left").select(F.col("doc_id").alias("c_custkey"), "lane", F.coalesce("n", F.lit(0)).alias("orphans"))


@query("""SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'p' WHEN doc_id % 4 = 0 THEN 'h' WHEN doc_id % 2 = 0 THEN 'c' END AS gold, CASE WHEN doc_id % 6 = 0 THEN 'planted' WHEN doc_id % 4 = 0 THEN 'human' WHEN doc_id % 2 = 0 THEN 'consensus' END AS gold_source, doc_id % 6 = 0 AS is_planted FROM documents""")
def golden_rows(spark, d):
    """H22."""
    x = table(spark, d, "documents").select(F.col("doc_id").alias("record_id"))
    gold = lambda m, name: x.where(F.col("record_id") % m == 0).select("record_id", F.lit(name).alias("gold"))
    return jobs.golden_set(x, gold(6, "p"), gold(4, "h"), gold(2, "c")).withColumnRenamed("record_id", "doc_id")


@query("""WITH i AS (SELECT unnest(['HQ', 'BRANCH', 'LAB']) AS institution), k AS (SELECT s_nationkey, CASE WHEN s_suppkey % 2 = 0 THEN 'HQ' ELSE 'BRANCH' END AS institution, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE concat('d', CAST(s_suppkey AS VARCHAR)) END AS domain, row_number() OVER (PARTITION BY s_nationkey, s_suppkey % 2 ORDER BY CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END, s_suppkey) AS rn FROM supplier)
SELECT n_name AS region, i.institution, domain FROM nation CROSS JOIN i LEFT JOIN k ON s_nationkey = n_nationkey AND k.institution = i.institution AND rn = 1""")
def discovery_grid(spark, d):
    """H23, C29."""
    n = table(spark, d, "nation")
    key = F.col("s_suppkey")
    known = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("region"), F.when(key % 2 == 0, "HQ").otherwise("BRANCH").alias("institution"), F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("d"), key.cast("string"))).alias("domain"), key.alias("pos"))
    return jobs.discovery_targets(n.select(F.col("n_name").alias("region")), ["HQ", "BRANCH", "LAB"], known).select("region", "institution", "domain")


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 AND p_size % 2 = 0 THEN 'promoted' WHEN p_size % 3 = 1 THEN 'ambiguous' ELSE 'unchanged' END AS transition, CASE WHEN p_size % 2 = 1 OR p_size % 3 = 0 THEN '验证' ELSE '待验证' END AS status, CASE WHEN p_size % 3 = 2 THEN 'never' ELSE '2026-01-01' END AS last_probed_at FROM part""")
def reprobed_channels(spark, d):
    """H24."""
    p, size = table(spark, d, "part"), F.col("p_size")
    channels = p.select("p_partkey", text_of("p_partkey").alias("list_url"), F.when(size % 2 == 0, "待验证").otherwise("验证").alias("status"), F.lit("never").alias("last_probed_at"), F.lit("").alias("probe_result"))
    probes = p.where(size % 3 != 2).select(text_of("p_partkey").alias("list_url"), F.when(size % 3 == 0, "ok").otherwise("structure_unknown").alias("verdict"))
    return jobs.reprobe(channels, probes, "2026-01-01").select("p_partkey", "transition", "status", "last_probed_at")


# ---- keyed merges, ledgers, decisions ----------------------------------------------------------------------------------------------------

@query("""WITH t AS (SELECT c_custkey AS a, c_nationkey AS b FROM customer WHERE c_custkey % 2 = 0), e AS (SELECT c_custkey AS a, c_nationkey AS b FROM customer WHERE c_custkey % 3 = 0)
SELECT coalesce(t.a, e.a) AS from_key, coalesce(t.b, e.b) AS to_key, 'lives_in' AS type, CASE WHEN e.a IS NOT NULL THEN 0.9 ELSE 0.5 END AS confidence FROM t FULL JOIN e ON t.a = e.a AND t.b = e.b""")
def edge_upserts(spark, d):
    """A14."""
    c = table(spark, d, "customer")
    side = lambda m, conf: c.where(F.col("c_custkey") % m == 0).select(F.col("c_custkey").alias("from_key"), F.col("c_nationkey").alias("to_key"), F.lit("lives_in").alias("type"), F.lit(conf).alias("confidence"))
    return incremental.upsert_edges(side(2, 0.5), side(3, 0.9))


@query("""SELECT CAST(doc_id AS VARCHAR) AS commentary_key, CASE WHEN doc_id % 3 = 0 THEN '["a","' || lang || '"]' ELSE 'old' END AS refs FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 = 0 UNION ALL SELECT 'skipped', CAST(count(*) AS VARCHAR) FROM documents WHERE doc_id % 3 = 1""")
def commentary_upserts(spark, d):
    """Rows without a key are skipped, lists go as JSON."""
    x = table(spark, d, "documents")
    target = x.where("doc_id % 2 = 0").select(text_of("doc_id").alias("commentary_key"), F.lit("old").alias("refs"))
    rows = x.where("doc_id % 3 <> 2").select(F.when(F.col("doc_id") % 3 == 0, text_of("doc_id")).otherwise("").alias("commentary_key"), F.array(F.lit("a"), "lang").alias("refs"))
    merged, skipped = incremental.upsert_commentary(target, rows)
    return merged.select("commentary_key", "refs").union(skipped.agg(F.lit("skipped"), F.count("*").cast("string")))


@query("""SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id""")
def last_lines(spark, d):
    """E12."""
    return ranking.last_line(table(spark, d, "events").select("user_id", "event_id"), "user_id", "event_id")


@query("""WITH q AS (SELECT o_orderkey AS pid, o_orderstatus AS stage, sha256(concat('{"pid":', CAST(o_orderkey AS VARCHAR), ',"stage":"', o_orderstatus, '"}')) AS h FROM orders)
SELECT pid, CASE WHEN pid % 4 = 0 THEN 'open' WHEN pid % 4 = 1 THEN 'invalid' ELSE 'valid' END AS status, h AS record_hash FROM q UNION ALL SELECT pid, 'open', h FROM q WHERE pid % 4 = 1""")
def decision_checks(spark, d):
    """A decision counts when the queue holds its content hash; what isn't decided stays open."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("pid"), F.col("o_orderstatus").alias("stage"))
    made = o.where("pid % 4 > 0").select("pid", F.when(F.col("pid") % 4 == 1, "elsewhere").otherwise(F.col("stage")).alias("stage"), F.sha2(F.to_json(F.struct("pid", "stage")), 256).alias("record_hash"))
    valid, invalid, left = incremental.decision_status(made, o)
    pick = lambda t, s: t.select("pid", F.lit(s).alias("status"), "record_hash")
    return pick(valid, "valid").union(pick(invalid, "invalid")).union(pick(left, "open"))


@query("""SELECT doc_id, sha256(concat('{"decided_at":"2026","doc_id":', CAST(doc_id AS VARCHAR), ',"operator":"me","themes":["', lang, '","x"]}')) AS decision_id FROM documents""")
def decision_records(spark, d):
    """A list written with commas becomes an array; the id is the hash of the sorted content."""
    x = table(spark, d, "documents").select("doc_id", F.concat("lang", F.lit(" ,x,")).alias("themes"))
    return incremental.decision_record(x, "me", "2026").select("doc_id", "decision_id")


@query("""SELECT concat('label:', CAST(doc_id AS VARCHAR), ':', CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END) AS idem_key, quality = 1 AS allowed FROM labels WHERE quality IS NOT NULL""")
def verdict_envelopes(spark, d):
    """G25."""
    v = table(spark, d, "labels").where("quality IS NOT NULL").select(F.lit("label").alias("kind"), text_of("doc_id").alias("ref"), F.when(F.col("quality") == 1, "good").otherwise("bad").alias("verdict"))
    return incremental.verdict_envelope(v, "2026", {"label": ["good"]}).select("idem_key", "allowed")


@query("""SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def snapshot_coverage(spark, d):
    """C32."""
    snap = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return incremental.ledger_from_snapshot(snap, table(spark, d, "orders").select("o_custkey"), "o_custkey")


@query("""SELECT c_custkey, c_custkey % 2 = 0 AS comparable, c_custkey % 2 = 1 OR c_custkey % 3 = 0 AS agrees, (SELECT CAST(count(*) FILTER (WHERE c_custkey % 6 = 0) AS DOUBLE) / count(*) FILTER (WHERE c_custkey % 2 = 0) FROM customer) AS agree_rate FROM customer""")
def ledger_agreement(spark, d):
    """C24, D15, G30."""
    c = table(spark, d, "customer").select("c_custkey", text_of("c_custkey").alias("doc_id"))
    changes = c.select("c_custkey", "doc_id", F.concat(F.lit("P_2020_"), F.when(F.col("c_custkey") % 3 == 0, "AA").otherwise("BB"), F.lit("_"), F.col("doc_id")).alias("new_id"))
    checked = identity.cross_check(changes, c.where("c_custkey % 2 = 0").select("doc_id", F.lit("AA").alias("issuer_short")))
    return checked.crossJoin(F.broadcast(monitoring.agreement_rate(checked))).select("c_custkey", "comparable", "agrees", "agree_rate")  # one row


# ---- filters and reports -----------------------------------------------------------------------------------------------------------------

@query("""WITH e AS (SELECT l_orderkey * 10 + l_linenumber AS edge_id, l_partkey AS node_id, 'large' AS marker FROM lineitem WHERE l_quantity > 45 UNION ALL SELECT l_orderkey * 10 + l_linenumber, l_suppkey + 10000000, 'cheap' FROM lineitem WHERE l_discount > 0.08)
SELECT node_id, arg_min(marker, edge_id) AS marker FROM e GROUP BY node_id""")
def contaminated_nodes(spark, d):
    """D21."""
    l = table(spark, d, "lineitem")
    edges = l.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("edge_id"), F.col("l_partkey").alias("from_id"), F.when(F.col("l_quantity") > 45, "large").alias("from_marker"), (F.col("l_suppkey") + 10000000).alias("to_id"), F.when(F.col("l_discount") > 0.08, "cheap").alias("to_marker"))
    return monitoring.contaminated_ends(edges)


@query("""SELECT n_name AS city, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 0) AS verified FROM nation WHERE n_nationkey < 20 UNION ALL SELECT n_name, -1 FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey >= 20""")
def city_channels(spark, d):
    """Verified channels of the listed cities; those of other cities apart."""
    n = table(spark, d, "nation")
    channels = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("city"), F.when(F.col("s_acctbal") > 0, "验证").otherwise("失效").alias("status"))
    inside, outside = monitoring.verified_counts(n.where("n_nationkey < 20").select(F.col("n_name").alias("city")), channels)
    return inside.select("city", "verified").union(outside.select("city", F.lit(-1)))


CHANNELS = "CASE WHEN p_size % 2 = 0 THEN '验证' ELSE '失效' END AS status"


@query("""SELECT p_partkey FROM part WHERE p_size % 2 = 0 AND p_brand IN ('Brand#11', 'Brand#23') AND (contains(p_type, 'STEEL') OR contains(p_type, 'PROMO'))""")
def selected_channels(spark, d):
    """B10."""
    p = table(spark, d, "part").selectExpr("p_partkey", "p_brand AS level", "p_type AS channel_type", CHANNELS)
    return filters.select_channels(p, ["Brand#11", "Brand#23"], ["STEEL", "PROMO"]).select("p_partkey")


@query("""SELECT p_partkey, 'batch' AS how FROM part WHERE p_size % 2 = 0 AND p_size % 10 < 3 UNION ALL SELECT p_partkey, 'list' FROM part WHERE p_size % 2 = 0 AND p_size IN (4, 6)""")
def batch_of_channels(spark, d):
    """C31."""
    p = table(spark, d, "part").selectExpr("p_partkey", "CAST(p_size AS STRING) AS city", CHANNELS)
    batches = table(spark, d, "part").selectExpr("CAST(p_size AS STRING) AS city", "CASE WHEN p_size % 10 < 3 THEN 'b1' ELSE 'b2' END AS batch")
    a, b = filters.channels_of(p, batches, "b1"), filters.channels_of(p, None, cities=["4", "6"])
    return a.select("p_partkey", F.lit("batch").alias("how")).union(b.select("p_partkey", F.lit("list")))


@query("""SELECT d.doc_id, toxic = 1 AND toxic IS NOT NULL AND l.doc_id IS NOT NULL AS upgraded, length(coalesce(text, '')) + CASE WHEN toxic = 1 THEN 5 ELSE 0 END AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def upgraded_bodies(spark, d):
    """Only a strictly longer body replaces the old one."""
    x = table(spark, d, "documents").select("doc_id", F.col("text").alias("body"))
    again = x.join(table(spark, d, "labels"), "doc_id").select("doc_id", F.when(F.col("toxic") == 1, F.concat(F.coalesce("body", F.lit("")), F.lit(" more"))).otherwise(F.substring("body", 1, 3)).alias("body"))
    return filters.upgrade_bodies(x, again).select("doc_id", "upgraded", F.length(F.coalesce("body", F.lit(""))).cast("long").alias("n"))


@query(r"""SELECT doc_id, contains(coalesce(text, ''), 'License') OR contains(coalesce(text, ''), 'water') OR contains(source, 'web') AS relevant FROM documents""")
def relevant_documents(spark, d):
    """B1."""
    return table(spark, d, "documents").select("doc_id", filters.relevant([F.col("text"), F.col("source")], ["License", "water", "web"]).alias("relevant"))


@query("""WITH r AS (SELECT item_id, concat('item_', CAST(item_id AS VARCHAR)) AS theme_id, trim(lower(concat(split_part(text, ' ', 1), ' ', split_part(text, ' ', 2)))) AS term FROM benchmark)
SELECT doc_id, string_agg(theme_id, ',' ORDER BY item_id) AS themes FROM documents, r WHERE term <> '' AND contains(lower(text), term) OR contains(lower(text), theme_id) GROUP BY doc_id""")
def registry_themes(spark, d):
    """The first two words of each benchmark text as a theme's alias."""
    alias = F.array(F.substring_index("text", " ", 2))
    registry = table(spark, d, "benchmark").select(F.concat(F.lit("item_"), text_of("item_id")).alias("theme_id"), alias.alias("aliases"), F.col("item_id").alias("pos"))
    return signals.themes_by_table(table(spark, d, "documents"), registry).select("doc_id", F.array_join("theme_ids", ",").alias("themes"))


@query(r"""WITH p AS (SELECT page_id, url, trim(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/') AS path, regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) AS h FROM pages)
SELECT page_id, lower(path) NOT IN ('', 'index.html', 'index.htm') AND NOT regexp_matches(lower(path), 'search|sousuo|so\.html') AS policy, list_has_any(string_split(h, '.'), ['example', 'org']) AS area,
 CASE WHEN regexp_matches(lower(url), '\.(pdf|docx?|xlsx?|zip|jpg|png)$') THEN 'junk' WHEN page_id % 2 = 0 AND regexp_matches(lower(url), '(list|index|col|channel|zcfg|zwgk|tzgg)') THEN 'promotable' WHEN page_id % 2 = 0 THEN 'maybe' ELSE 'junk' END AS class FROM p""")
def url_classes(spark, d):
    """B26, B27, B28."""
    p = table(spark, d, "pages")
    domain = F.when(F.col("page_id") % 2 == 0, "a.gov.cn").otherwise("b.net")
    return p.select("page_id", filters.policy_url(F.col("url")).alias("policy"), filters.area_match(T.host(F.col("url")), F.array(F.lit("example"), F.lit("org"))).alias("area"), filters.candidate_channel_class(domain, F.col("url")).alias("class"))


# ---- sinks, written and read back --------------------------------------------------------------------------------------------------------

LINES = "SELECT CAST(l_orderkey AS VARCHAR) AS from_id, CAST(l_partkey AS VARCHAR) AS to_id, CASE WHEN l_returnflag = 'A' THEN 'references' ELSE 'clarifies' END AS rel FROM lineitem"


def line_edges(spark, d):
    return table(spark, d, "lineitem").select(text_of("l_orderkey").alias("from_id"), text_of("l_partkey").alias("to_id"), F.when(F.col("l_returnflag") == "A", "references").otherwise("clarifies").alias("rel"))


@query(LINES)
def relation_folders(spark, d):
    """One folder a relation type."""
    path = new_path(spark, "relations")
    sinks.write_by_relation(line_edges(spark, d), path)
    return spark.read.schema("from_id string, to_id string, rel string").json(path).select("from_id", "to_id", "rel")


@query(LINES)
def ordered_edges(spark, d):
    """A10."""
    path = new_path(spark, "edges")
    sinks.write_ordered_edges(line_edges(spark, d), path)
    return spark.read.schema("from_id string, to_id string, rel string").json(path)


@query("""SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0 THEN '2026-01-01' ELSE '2026-01-02' END AS run_date FROM supplier""")
def items_by_run(spark, d):
    """A22."""
    path, s = new_path(spark, "runs"), table(spark, d, "supplier")
    for k, day in enumerate(("2026-01-01", "2026-01-02")):
        sinks.append_by_run(s.where(F.col("s_nationkey") % 2 == k).select("s_suppkey"), path, day)
    return spark.read.parquet(path).select("s_suppkey", F.col("run_date").cast("string").alias("run_date"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'first' ELSE 'second' END AS batch FROM customer""")
def keyed_appends(spark, d):
    """The second batch adds only the keys that the first one lacks."""
    path, c = new_path(spark, "appends"), table(spark, d, "customer")
    sinks.append_absent(c.where("c_custkey % 2 = 0").select("c_custkey", F.lit("first").alias("batch")), path, ["c_custkey"])
    sinks.append_absent(c.select("c_custkey", F.lit("second").alias("batch")), path, ["c_custkey"])
    return spark.read.parquet(path)


@query("""WITH e AS (SELECT DISTINCT c_nationkey AS a, s_nationkey AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)
SELECT CAST(n_nationkey AS VARCHAR) AS node_id, (SELECT count(*) FROM e WHERE a = n_nationkey) AS n_out, (SELECT count(*) FROM e WHERE b = n_nationkey) AS n_in FROM nation WHERE n_nationkey IN (SELECT a FROM e UNION SELECT b FROM e)""")
def adjacency_index(spark, d):
    """The index written and read back."""
    j = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    e = j.select(text_of("c_nationkey").alias("from_id"), text_of("s_nationkey").alias("to_id"), F.lit("references").alias("rel"), F.lit(0.5).alias("confidence"), F.lit("x").alias("source")).distinct()
    path, nodes = new_path(spark, "adjacency"), relations.adjacency(e)
    sinks.write_adjacency(nodes, path)
    back = spark.read.schema(nodes.schema).json(path)
    return back.select("node_id", F.size("outbound").cast("long").alias("n_out"), F.size("inbound").cast("long").alias("n_in"))


# ---- overlays, repairs, defaults -----------------------------------------------------------------------------------------------------------

@query("""SELECT d.doc_id, CASE WHEN d.doc_id % 3 = 0 THEN source || ',x' ELSE '' END AS themes, CASE WHEN d.doc_id % 6 = 0 THEN lang ELSE '' END AS primary_theme, CASE WHEN d.doc_id % 3 = 0 THEN 4 ELSE -1 END AS importance FROM documents d""")
def overlaid_views(spark, d):
    """C13."""
    x = table(spark, d, "documents").withColumn("primary_theme", F.lit("own"))
    derived = x.where("doc_id % 3 = 0").select("doc_id", F.array("source", F.lit("x")).alias("themes"), F.when(F.col("doc_id") % 6 == 0, F.col("lang")).alias("primary_theme"), F.lit(4).alias("importance"))
    return context.overlay(x, derived).select("doc_id", F.array_join("themes", ",").alias("themes"), "primary_theme", F.coalesce("importance", F.lit(-1)).alias("importance"))


@query(r"""WITH n AS (SELECT c_custkey, c_name, c_custkey % 5 AS k FROM customer)
SELECT c_custkey, CASE k WHEN 0 THEN concat('T ', c_name) WHEN 4 THEN '-a.b' ELSE c_name END AS title FROM n""")
def repaired_titles(spark, d):
    """G28."""
    c, name = table(spark, d, "customer"), F.col("c_name")
    k = F.col("c_custkey") % 5
    file = F.when(k == 0, F.concat(F.lit("【 T "), name, F.lit(" 】rest.md"))).when(k == 1, F.concat(name, F.lit(" - www.example.org.md"))).when(k == 2, F.concat(name, F.lit(".PDF.md"))).when(k == 3, F.concat(name, F.lit(".shtml - x.y"))).otherwise(F.lit("-a.b.md"))
    return c.select("c_custkey", T.title_of_file(file).alias("title"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE '' END AS region, CASE WHEN n_nationkey % 3 = 0 THEN concat('http://p/', n_name) WHEN n_nationkey % 3 = 1 THEN concat('http://s/', n_name) ELSE '' END AS url FROM nation""")
def market_fallbacks(spark, d):
    """Regions and URLs."""
    n = table(spark, d, "nation")
    region = F.when(F.col("n_nationkey") % 2 == 0, F.struct(F.lit(None).cast("string").alias("level"), F.lit("1").alias("code"), F.col("n_name").alias("name")))
    k = F.col("n_nationkey") % 3
    url = T.first_url(F.when(k == 0, F.concat(F.lit("http://p/"), "n_name")).when(k == 1, F.lit("")), F.when(k < 2, F.concat(F.lit("http://s/"), "n_name")))
    return n.select("n_nationkey", T.region_or_empty(region)["name"].alias("region"), url.alias("url"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def iso_days(spark, d):
    """Dates, timestamps and nulls."""
    k, day = F.col("o_orderkey") % 3, F.col("o_orderdate")
    as_day, as_time = dates.iso_date(day.cast("date")), dates.iso_date(F.when(k == 1, day.cast("timestamp")))
    return table(spark, d, "orders").select("o_orderkey", F.when(k == 0, as_day).otherwise(as_time).alias("day"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey ELSE 0 END AS n, CASE WHEN c_custkey % 4 = 0 THEN 'high' ELSE 'low' END AS attention, 'none' AS validation, 0 AS supersedes, CASE WHEN c_custkey % 4 = 0 THEN 'a,b' ELSE '' END AS refs FROM customer""")
def default_summaries(spark, d):
    """Summaries carried over where there are signals, defaults elsewhere."""
    c, even = table(spark, d, "customer"), F.col("c_custkey") % 2 == 0
    fourth = F.col("c_custkey") % 4 == 0
    row = {"commentary_signal_count": F.when(even, F.col("c_nationkey")), "market_signal_count": F.lit(None), "attention_level": F.when(fourth, "high").when(even, ""), "validation_level": F.lit(None).cast("string"), "certainty_adjustment": F.lit(None).cast("string"), "internal_notes": F.lit(None).cast("array<string>")}
    s, r = context.signal_summary(row), context.relation_summary({"references_out": F.col("c_nationkey")})
    refs = context.signal_refs(F.when(fourth, F.array(F.lit("b"), F.lit(""), F.lit("a"), F.lit(None))), F.lit(None))
    return c.select("c_custkey", s["commentary_signal_count"].alias("n"), s["commentary_attention"].alias("attention"), s["market_validation"].alias("validation"), r["supersedes_out"].alias("supersedes"), F.array_join(refs["commentary_ids"], ",").alias("refs"))
