"""Registered queries over the document pipeline's operators, with DuckDB SQL for what SQL can express.

The supplied tables stand in for the pipeline's own: orders and lineitem give edges and signals, documents are documents, nations are regions.
Arrays are compared as strings, joined in order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, scoring
from ..functions import text as T
from ..operators import context, dedup, filters, identity, incremental, monitoring, ranking, relations, signals
from ..operators.tables import deal
from ..sources import readers
from ..streaming import streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(key, *values):
    """The value whose place is key modulo their number; None for null."""
    n, out = len(values), None
    for i, v in enumerate(values[:-1]):
        hit = F.pmod(key, F.lit(n)) == i
        v = F.lit(v) if not hasattr(v, "cast") else v
        out = F.when(hit, v) if out is None else out.when(hit, v)
    last = values[-1]
    return out.otherwise(last if hasattr(last, "cast") else F.lit(last))


def pick_sql(key: str, *values: str) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def any_sql(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def quoted(values) -> list[str]:
    return ["NULL" if v is None else f"'{v}'" for v in values]


# ---- stand-ins, in Spark and in SQL ----------------------------------------------------------------------------------------------------

RELATIONS = ["references", "cites_basis", "supersedes", "clarifies"]
REL_SQL = "CASE WHEN l_returnflag = 'A' THEN 'references' WHEN l_returnflag = 'N' THEN 'cites_basis' WHEN l_linestatus = 'O' THEN 'supersedes' ELSE 'aligns_with' END"
EDGES_SQL = f"""
edges AS (SELECT o_custkey AS from_id, l_suppkey + 10000000 AS to_id, {REL_SQL} AS rel, l_discount AS confidence, concat('E', CAST(l_orderkey AS VARCHAR), '_', CAST(l_linenumber AS VARCHAR), '_', CAST(l_partkey AS VARCHAR)) AS source
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
nodes AS (SELECT c_custkey AS node_id FROM customer WHERE c_acctbal > 0 UNION ALL SELECT s_suppkey + 10000000 FROM supplier WHERE s_acctbal > 0)"""
BEST_SQL = EDGES_SQL + """,
located AS (SELECT e.* FROM edges e WHERE from_id IN (SELECT node_id FROM nodes) AND to_id IN (SELECT node_id FROM nodes)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY from_id, to_id, rel ORDER BY confidence DESC, source) AS rn FROM located) x WHERE rn = 1)"""
ROLE_SQL = "CASE o_orderpriority WHEN '1-URGENT' THEN 'risk' WHEN '2-HIGH' THEN 'execution' WHEN '3-MEDIUM' THEN 'attention' ELSE 'opportunity' END"
SIGNALS_SQL = f"""
comments AS (SELECT o_orderkey AS signal_id, o_custkey AS doc_id, {ROLE_SQL} AS role FROM orders WHERE o_orderstatus = 'F'),
market_one AS (SELECT o_orderkey AS signal_id, o_custkey AS doc_id, o_orderpriority AS signal_type FROM orders WHERE o_orderstatus = 'O'
  UNION SELECT o_orderkey, o_custkey % 100 + 1, o_orderpriority FROM orders WHERE o_orderstatus = 'O')"""


def n_edges(spark: SparkSession, d: str) -> int:
    """Lines, of which each gives an edge at most; counted by the footers of the files."""
    return table(spark, d, "lineitem").count()


def edges_of(spark: SparkSession, d: str) -> DataFrame:
    rel = F.when(F.col("l_returnflag") == "A", "references").when(F.col("l_returnflag") == "N", "cites_basis").when(F.col("l_linestatus") == "O", "supersedes").otherwise("aligns_with")
    n = n_edges(spark, d)
    j = deal(table(spark, d, "lineitem"), n, "l_orderkey").join(deal(table(spark, d, "orders"), n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    source = F.concat(F.lit("E"), F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")))
    return j.select(F.col("o_custkey").alias("from_id"), (F.col("l_suppkey") + 10000000).alias("to_id"), rel.alias("rel"), F.col("l_discount").alias("confidence"), source.alias("source"))


def nodes_of(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("node_id")).union(table(spark, d, "supplier").where("s_acctbal > 0").select((F.col("s_suppkey") + 10000000).alias("node_id")))


def best_of(spark: SparkSession, d: str) -> DataFrame:
    return relations.best_edge(relations.drop_dangling(edges_of(spark, d), nodes_of(spark, d)), F.col("source"))


def signals_of(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, d, "orders")
    role = F.when(F.col("o_orderpriority") == "1-URGENT", "risk").when(F.col("o_orderpriority") == "2-HIGH", "execution").when(F.col("o_orderpriority") == "3-MEDIUM", "attention").otherwise("opportunity")
    theme = F.array(F.concat(F.lit("T"), (F.col("o_custkey") % 7).cast("string")), F.concat(F.lit("T"), (F.col("o_orderkey") % 5).cast("string")))
    c = o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("signal_id"), role.alias("role"), F.array("o_custkey").alias("doc_ids"), theme.alias("theme_ids"), F.col("o_orderkey").alias("pos"))
    m = o.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("signal_id"), F.col("o_orderpriority").alias("signal_type"), F.col("o_custkey").alias("current_id"), F.array(F.col("o_custkey") % 100 + 1).alias("doc_ids"), theme.alias("theme_ids"), "o_custkey", F.col("o_orderkey").alias("pos"))
    return c, m


def joined(c: str) -> F.Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def pairs(c: str) -> F.Column:
    """A map as a string, sorted by key."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")


# ---- relations and contexts ---------------------------------------------------------------------------------------------------------------

@query(f"WITH {BEST_SQL} SELECT from_id, to_id, rel, confidence, source FROM best")
def best_edge(spark, d):
    return best_of(spark, d).select("from_id", "to_id", "rel", "confidence", "source")


def degree_sql(src: str) -> str:
    cols = ", ".join(f"count(*) FILTER (WHERE rel = '{r}' AND side = '{s}') AS {r}_{s}" for r in RELATIONS for s in ("out", "in"))
    return f"sides AS (SELECT from_id AS node_id, 'out' AS side, rel, source FROM {src} UNION ALL SELECT to_id, 'in', rel, source FROM {src}), degrees AS (SELECT node_id, {cols}, count(*) FILTER (WHERE rel NOT IN ('references', 'cites_basis', 'supersedes', 'clarifies')) AS other_rels, count(DISTINCT source) AS n_candidates FROM sides GROUP BY node_id)"


DEGREE_COLS = [f"{r}_{s}" for r in RELATIONS for s in ("out", "in")]


@query(f"WITH {EDGES_SQL}, {degree_sql('edges')} SELECT * FROM degrees")
def relation_degree(spark, d):
    deg = relations.relation_degrees(edges_of(spark, d))
    return deg.select("node_id", *DEGREE_COLS, F.coalesce(F.aggregate(F.map_values("other_rel_counts"), F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).alias("other_rels"), F.size("candidate_ids").cast("long").alias("n_candidates"))


@query(f"""WITH {BEST_SQL} SELECT node_id, coalesce(string_agg(o, ',' ORDER BY rel, peer) FILTER (WHERE o IS NOT NULL), '') AS outbound, coalesce(string_agg(i, ',' ORDER BY rel, peer) FILTER (WHERE i IS NOT NULL), '') AS inbound FROM (
  SELECT from_id AS node_id, rel, to_id AS peer, concat(rel, ':', CAST(to_id AS VARCHAR)) AS o, NULL AS i FROM best
  UNION ALL SELECT to_id, rel, from_id, NULL, concat(rel, ':', CAST(from_id AS VARCHAR)) FROM best) x GROUP BY node_id""")
def adjacency(spark, d):
    a = relations.adjacency(best_of(spark, d))
    s = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["rel"], x["peer"].cast("string"))), ",").alias(c)
    return a.select("node_id", s("outbound"), s("inbound"))


@query(f"""WITH {EDGES_SQL}, e AS (SELECT *, from_id IN (SELECT node_id FROM nodes) AS f, to_id IN (SELECT node_id FROM nodes) AS t FROM edges WHERE rel <> 'aligns_with')
SELECT (SELECT count(*) FROM edges) AS read, (SELECT count(*) FROM edges WHERE rel = 'aligns_with') AS invalid, count(*) FILTER (WHERE NOT (f AND t)) AS dangling,
  count(*) FILTER (WHERE f AND t) - (SELECT count(*) FROM (SELECT DISTINCT from_id, to_id, rel FROM e WHERE f AND t) y) AS duplicates FROM e""")
def merge_counts(spark, d):
    src = relations.union_sources(semantic=edges_of(spark, d))
    return relations.merge_edges(src, nodes_of(spark, d), ["references", "cites_basis", "supersedes"])[1]


@query(f"""WITH {EDGES_SQL} SELECT from_status, to_status, count(*) AS n FROM (SELECT CASE WHEN from_id IN (SELECT node_id FROM nodes) THEN 'located' ELSE 'missing' END AS from_status, CASE WHEN to_id IN (SELECT node_id FROM nodes) THEN 'located' ELSE 'missing' END AS to_status FROM edges) x GROUP BY ALL""")
def endpoint_status(spark, d):
    e = relations.endpoint_status(edges_of(spark, d), nodes_of(spark, d).withColumnRenamed("node_id", "key"))
    return e.groupBy("from_status", "to_status").agg(F.count("*").alias("n"))


NATION_EDGES_SQL = f"""pairs AS (SELECT DISTINCT c_nationkey AS from_id, s_nationkey AS to_id, {REL_SQL} AS rel FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
decided AS (SELECT *, CASE WHEN (from_id + to_id) % 3 = 0 THEN 'reject' ELSE 'accept' END AS decision FROM pairs)"""


@query(f"""WITH {NATION_EDGES_SQL}, k AS (SELECT least(from_id, to_id) AS a, greatest(from_id, to_id) AS b, count(DISTINCT rel) AS n FROM decided WHERE decision = 'accept' AND rel <> 'aligns_with' GROUP BY ALL)
SELECT from_id, to_id, rel, CASE WHEN decision = 'accept' AND rel <> 'aligns_with' AND coalesce(n, 0) > 1 THEN 'manual_review' ELSE decision END AS decision FROM decided LEFT JOIN k ON a = least(from_id, to_id) AND b = greatest(from_id, to_id)""")
def contradiction_demotion(spark, d):
    rel = F.when(F.col("l_returnflag") == "A", "references").when(F.col("l_returnflag") == "N", "cites_basis").when(F.col("l_linestatus") == "O", "supersedes").otherwise("aligns_with")
    j = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    e = j.select(F.col("c_nationkey").alias("from_id"), F.col("s_nationkey").alias("to_id"), rel.alias("rel")).distinct()
    e = e.withColumn("decision", F.when((F.col("from_id") + F.col("to_id")) % 3 == 0, "reject").otherwise("accept"))
    return relations.demote_contradictions(e).select("from_id", "to_id", "rel", "decision")


LEVELS_SQL = """CASE WHEN m >= 3 THEN 'strong' WHEN m >= 2 THEN 'medium' WHEN m >= 1 THEN 'weak' ELSE 'none' END"""
DOC_SQL = SIGNALS_SQL + f""",
c AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE role = 'risk') AS risk, count(*) FILTER (WHERE role = 'execution') AS exe FROM comments GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS m FROM market_one GROUP BY doc_id),
j AS (SELECT coalesce(c.doc_id, m.doc_id) AS doc_id, coalesce(n, 0) AS n, coalesce(risk, 0) AS risk, coalesce(exe, 0) AS exe, coalesce(m, 0) AS m FROM c FULL JOIN m ON c.doc_id = m.doc_id),
docs_context AS (SELECT doc_id, n AS commentary_signal_count, m AS market_signal_count, CASE WHEN risk >= 2 OR n >= 5 THEN 'high' WHEN n > 0 THEN 'medium' ELSE 'low' END AS attention_level, {LEVELS_SQL} AS validation_level,
  CASE WHEN (risk > 0 OR exe > 0) AND m = 0 THEN 'lower' WHEN m >= 2 AND risk = 0 AND exe = 0 THEN 'raise' ELSE 'neutral' END AS certainty_adjustment,
  concat_ws(',', CASE WHEN risk > 0 THEN 'commentary_risk_present' END, CASE WHEN exe > 0 THEN 'commentary_execution_friction_present' END, CASE WHEN n > 0 AND m = 0 THEN 'attention_without_market_validation' END, CASE WHEN m > 0 AND n = 0 THEN 'market_validation_without_commentary_attention' END, CASE WHEN m = 1 THEN 'market_validation_weak' END) AS internal_notes FROM j)"""


@query(f"WITH {DOC_SQL} SELECT * FROM docs_context")
def document_context(spark, d):
    out = context.document_context(*signals_of(spark, d))
    return out.select("doc_id", "commentary_signal_count", "market_signal_count", "attention_level", "validation_level", "certainty_adjustment", joined("internal_notes").alias("internal_notes"))


THEMES_SQL = f"""t AS (SELECT o_orderkey AS signal_id, o_orderstatus AS st, {ROLE_SQL} AS role, unnest([concat('T', CAST(o_custkey % 7 AS VARCHAR)), concat('T', CAST(o_orderkey % 5 AS VARCHAR))]) AS theme_id FROM orders WHERE o_orderstatus IN ('F', 'O'))"""


@query(f"""WITH {THEMES_SQL}, j AS (SELECT theme_id, count(*) FILTER (WHERE st = 'F') AS n, count(*) FILTER (WHERE st = 'O') AS m FROM t GROUP BY theme_id),
r AS (SELECT theme_id, role, row_number() OVER (PARTITION BY theme_id ORDER BY count(*) DESC, min(signal_id)) AS k FROM t WHERE st = 'F' GROUP BY theme_id, role)
SELECT theme_id, n AS commentary_signal_count, m AS market_signal_count, (SELECT string_agg(role, ',' ORDER BY k) FROM r WHERE r.theme_id = j.theme_id AND k <= 3) AS dominant_commentary_roles,
 CASE WHEN n + m >= 8 THEN 'high' WHEN n + m >= 2 THEN 'medium' WHEN n + m >= 1 THEN 'low' ELSE 'none' END AS heat_level, {LEVELS_SQL} AS validation_level, CASE WHEN n > 0 AND m = 0 THEN 'commentary_only' WHEN m > 0 AND n = 0 THEN 'market_only' WHEN n + m = 1 THEN 'thin_evidence' ELSE 'none' END AS coverage_warning FROM j""")
def theme_context(spark, d):
    out = context.theme_context(*signals_of(spark, d))
    return out.select("theme_id", "commentary_signal_count", "market_signal_count", joined("dominant_commentary_roles").alias("dominant_commentary_roles"), "heat_level", "validation_level", "coverage_warning")


@query(f"""SELECT concat(lpad(CAST(n_nationkey + 10 AS VARCHAR), 2, '0'), '0000') AS region_code, concat(n_name, '市') AS region_name, count(*) AS market_signal_count, count(DISTINCT o_orderpriority) AS n_types, CASE WHEN count(*) >= 3 THEN 'strong' WHEN count(*) >= 2 THEN 'medium' ELSE 'weak' END AS validation_level,
 CASE WHEN n_nationkey + 10 IN (11, 12, 31, 50) THEN '' ELSE 'province_code_with_city_name' END AS region_warnings FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'O' AND n_nationkey <> 7 GROUP BY n_nationkey, n_name""")
def region_context(spark, d):
    _, m = signals_of(spark, d)
    j = m.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    j = j.withColumn("region_code", F.concat(F.lpad((F.col("n_nationkey") + 10).cast("string"), 2, "0"), F.lit("0000"))).withColumn("region_name", F.when(F.col("n_nationkey") != 7, F.concat("n_name", F.lit("市")))).withColumn("business_lines", F.array(F.lit("power")))
    out, _ = context.region_context(j)
    return out.select("region_code", "region_name", "market_signal_count", F.size("signal_types").cast("long").alias("n_types"), "validation_level", joined("region_warnings").alias("region_warnings"))


FLAGS_SQL = """concat_ws(',', CASE WHEN cites_basis_out > 0 OR cites_basis_in > 0 THEN 'has_basis_chain' END, CASE WHEN references_out > 0 OR references_in > 0 THEN 'has_references' END, CASE WHEN supersedes_out > 0 THEN 'supersedes_policy' END, CASE WHEN supersedes_in > 0 THEN 'superseded_by_policy' END, CASE WHEN clarifies_out > 0 OR clarifies_in > 0 THEN 'has_clarification' END,
 CASE WHEN cn > 0 AND att IN ('medium', 'high') THEN concat('commentary_attention_', att) END, CASE WHEN mn > 0 AND va <> 'none' THEN concat('market_validation_', va) END, CASE WHEN cn > 0 AND mn = 0 THEN 'no_market_validation' END, CASE WHEN ce IN ('lower', 'raise') THEN concat('certainty_', ce) END, CASE WHEN hr AND NOT hs THEN 'relation_only_no_signal_context' END, CASE WHEN hs AND NOT hr THEN 'signal_only_no_relation_context' END)"""
ZEROS = ", ".join(f"coalesce({c}, 0) AS {c}" for c in DEGREE_COLS)
ANALYSIS_SQL = BEST_SQL + ", " + degree_sql("best") + ", " + DOC_SQL.replace("\nc AS", "\ncc AS").replace("FROM c FULL JOIN m ON c.doc_id", "FROM cc FULL JOIN m ON cc.doc_id").replace("coalesce(c.doc_id", "coalesce(cc.doc_id") + f""",
full_rows AS (SELECT coalesce(node_id, doc_id) AS node_id, {ZEROS}, coalesce(n_candidates, 0) AS n_candidates, coalesce(commentary_signal_count, 0) AS cn, coalesce(market_signal_count, 0) AS mn, coalesce(attention_level, 'low') AS att, coalesce(validation_level, 'none') AS va, coalesce(certainty_adjustment, 'neutral') AS ce, node_id IS NOT NULL AS hr, doc_id IS NOT NULL AS hs FROM degrees FULL JOIN docs_context ON node_id = doc_id),
analysis AS (SELECT *, {FLAGS_SQL} AS analysis_flags FROM full_rows)"""


def analysis_of(spark, d):
    return context.analysis_context(relations.relation_degrees(best_of(spark, d)), context.document_context(*signals_of(spark, d)))


@query(f"WITH {ANALYSIS_SQL} SELECT node_id, {', '.join(DEGREE_COLS)}, n_candidates, cn AS commentary_signal_count, mn AS market_signal_count, att AS attention_level, va AS validation_level, ce AS certainty_adjustment, analysis_flags FROM analysis")
def analysis_context(spark, d):
    a = analysis_of(spark, d)
    return a.select("node_id", *DEGREE_COLS, F.size("candidate_ids").cast("long").alias("n_candidates"), "commentary_signal_count", "market_signal_count", "attention_level", "validation_level", "certainty_adjustment", joined("analysis_flags").alias("analysis_flags"))


@query(f"""WITH {ANALYSIS_SQL} SELECT 'rows_by_flag' AS metric, f AS "key", count(*) AS n FROM (SELECT unnest(string_split(analysis_flags, ',')) AS f FROM analysis) x WHERE f <> '' GROUP BY f
UNION ALL SELECT 'analysis_context_count', '', count(*) FROM analysis UNION ALL SELECT 'rows_with_relation_context', '', count(*) FILTER (WHERE hr) FROM analysis UNION ALL SELECT 'rows_with_signal_context', '', count(*) FILTER (WHERE hs) FROM analysis UNION ALL SELECT 'rows_with_both', '', count(*) FILTER (WHERE hr AND hs) FROM analysis""")
def context_summary(spark, d):
    return context.context_summary(analysis_of(spark, d))


@query("""WITH q AS (SELECT user_id AS k, event_type AS reason FROM events WHERE event_type IN ('error', 'signup') AND user_id % 10 = 0),
h AS (SELECT k, string_agg(DISTINCT reason, ',' ORDER BY reason) AS queue_reasons FROM q GROUP BY k)
SELECT o_orderkey, coalesce(queue_reasons, '') AS queue_reasons, CASE WHEN queue_reasons IS NULL THEN 'accepted' ELSE 'blocked' END AS lane FROM orders LEFT JOIN h ON o_custkey = k""")
def blocked_publish(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    q = table(spark, d, "events").where("event_type IN ('error', 'signup') AND user_id % 10 = 0").select(F.col("user_id").cast("string").alias("source_pid"), F.col("event_type").alias("reason"))
    key = lambda c: F.array(F.concat(F.lit("source_pid:"), F.col(c).cast("string")))
    ok, bad = signals.block_by_queue(o, q, "o_orderkey", key("o_custkey"), key("source_pid"))
    context.assert_disjoint(ok, bad, "o_orderkey")
    return ok.select("o_orderkey", F.lit("").alias("queue_reasons"), F.lit("accepted").alias("lane")).union(bad.select("o_orderkey", joined("queue_reasons"), F.lit("blocked")))


# ---- coverage, scores, votes ----------------------------------------------------------------------------------------------------------------

PART_THEMES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "LUXURY"]


def nation_parts(spark, d):
    l = table(spark, d, "lineitem")
    j = l.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return j.where("n_nationkey % 5 <> 1 AND NOT (n_nationkey % 3 = 0 AND p_type = 'PROMO')").select(F.col("n_name").alias("region"), F.array(F.concat(F.col("p_type"), F.lit("_theme"))).alias("theme_ids"), "l_shipdate")


NATION_PARTS_SQL = """np AS (SELECT n_name AS region, concat(p_type, '_theme') AS theme_id, l_shipdate FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 5 <> 1 AND NOT (n_nationkey % 3 = 0 AND p_type = 'PROMO')),
themes AS (SELECT unnest(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD', 'LUXURY']) AS theme)"""


@query(f"""WITH {NATION_PARTS_SQL} SELECT n_name AS region, theme, (SELECT count(*) FROM np WHERE np.region = n_name AND contains(theme_id, theme)) AS n FROM nation, themes""")
def coverage_matrix(spark, d):
    return monitoring.coverage_matrix(nation_parts(spark, d), table(spark, d, "nation").select(F.col("n_name").alias("region")), PART_THEMES)


@query(f"""WITH {NATION_PARTS_SQL}, k AS (SELECT DISTINCT region FROM np WHERE region IN ('NATION_0', 'NATION_1', 'NATION_3', 'NATION_6', 'NATION_9')) SELECT region, theme, 0 AS n, 'HIGH' AS severity FROM k, themes WHERE NOT EXISTS (SELECT 1 FROM np WHERE np.region = k.region AND contains(theme_id, theme))""")
def zero_alerts(spark, d):
    m = monitoring.coverage_matrix(nation_parts(spark, d), None, PART_THEMES)
    return monitoring.zero_alerts(m, ["NATION_0", "NATION_1", "NATION_3", "NATION_6", "NATION_9"]).select("region", "theme", F.col("n").cast("int").alias("n"), "severity")


@query("""SELECT user_id, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last_date, 'WARN' AS severity FROM events GROUP BY user_id HAVING max(CAST(ts AS DATE)) < DATE '2024-01-30'""")
def stale_groups(spark, d):
    f = monitoring.freshness(table(spark, d, "events"), "user_id", "ts")
    return monitoring.stale(f, "2024-02-29", 30).select("user_id", F.col("last_date").cast("string").alias("last_date"), "severity")


@query("""SELECT count(*) FILTER (WHERE toxic = 1) AS planted, count(*) FILTER (WHERE quality = 0) AS rejected, count(*) FILTER (WHERE toxic = 1 AND quality = 0) AS caught, round(count(*) FILTER (WHERE toxic = 1 AND quality = 0) / count(*) FILTER (WHERE toxic = 1), 6) AS recall, round(count(*) FILTER (WHERE toxic = 1 AND quality = 0) / count(*) FILTER (WHERE quality = 0), 6) AS precision FROM labels""")
def judge_score(spark, d):
    r = monitoring.judge_score(table(spark, d, "labels").select((F.col("toxic") == 1).alias("is_planted"), (F.col("quality") == 0).alias("rejected")))
    return r.withColumn("recall", F.round("recall", 6)).withColumn("precision", F.round("precision", 6))


LABELS_SQL = "g AS (SELECT toxic = 1 AS p, CASE WHEN quality = 1 THEN 'accept' ELSE 'reject' END AS gold, CASE WHEN n_chars > 600 OR quality = 1 AND labels.doc_id % 5 > 0 THEN 'accept' ELSE 'reject' END AS decision FROM labels JOIN documents ON labels.doc_id = documents.doc_id)"


def labelled(spark, d):
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return j.select((F.col("toxic") == 1).alias("is_planted"), F.when(F.col("quality") == 1, "accept").otherwise("reject").alias("gold"), F.when((F.col("n_chars") > 600) | (F.col("quality") == 1) & (F.col("doc_id") % 5 > 0), "accept").otherwise("reject").alias("decision"))


@query(f"""WITH {LABELS_SQL} SELECT count(*) AS "rows", round(count(*) FILTER (WHERE p AND decision <> 'accept') / count(*) FILTER (WHERE p), 6) AS planted_recall, count(*) FILTER (WHERE p AND decision <> 'accept') / count(*) FILTER (WHERE p) >= 0.9 AS meets_bar,
 round(count(*) FILTER (WHERE NOT p AND gold = 'accept' AND decision = 'accept') / count(*) FILTER (WHERE NOT p AND gold = 'accept'), 6) AS kept_accepts, round(count(*) FILTER (WHERE NOT p AND gold = decision) / count(*) FILTER (WHERE NOT p), 6) AS agreement FROM g""")
def calibration(spark, d):
    r = monitoring.calibration(labelled(spark, d))
    return r.select("rows", *[F.round(c, 6).alias(c) if c != "meets_bar" else F.col(c) for c in ("planted_recall", "meets_bar", "kept_accepts", "agreement")])


@query(f"""WITH {LABELS_SQL} SELECT gold AS class, count(*) AS support, round(count(*) FILTER (WHERE gold = decision) / count(*), 6) AS recall, round(count(*) FILTER (WHERE gold = decision) / (SELECT count(*) FROM g h WHERE h.decision = g.gold), 6) AS precision FROM g GROUP BY gold""")
def class_recall(spark, d):
    return monitoring.class_recall(labelled(spark, d)).withColumn("recall", F.round("recall", 6)).withColumn("precision", F.round("precision", 6))


@query("""WITH v AS (SELECT l_orderkey AS item_id, l_linenumber AS rater, l_returnflag AS choice, l_quantity % 5 AS score FROM lineitem), n AS (SELECT item_id, count(DISTINCT rater) AS raters, quantile_cont(score, 0.5) AS median, max(score) - min(score) AS spread FROM v GROUP BY item_id),
c AS (SELECT item_id, choice, count(DISTINCT rater) AS k, row_number() OVER (PARTITION BY item_id ORDER BY count(DISTINCT rater) DESC, choice) AS rn FROM v GROUP BY item_id, choice)
SELECT n.item_id, raters, CASE WHEN k >= floor(raters / 2) + 1 THEN choice END AS choice, median, spread, CASE WHEN k < floor(raters / 2) + 1 THEN 'failed' WHEN spread <= 1 THEN 'high' WHEN spread <= 2 THEN 'mid' ELSE 'low' END AS level FROM n JOIN c ON n.item_id = c.item_id AND rn = 1""")
def vote_consensus(spark, d):
    v = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("item_id"), F.col("l_linenumber").alias("rater"), F.col("l_returnflag").alias("choice"), (F.col("l_quantity") % 5).alias("score"))
    return monitoring.vote_consensus(v)


@query("""WITH b AS (SELECT CAST(p_size AS INTEGER) % 6 AS d1, CAST(p_partkey AS INTEGER) % 6 AS d2, CAST(floor(p_retailprice) AS INTEGER) % 6 AS d3, CAST(p_size AS INTEGER) % 5 AS d4, CAST(p_partkey AS INTEGER) % 5 AS d5, CAST(p_partkey AS INTEGER) % 7 AS d6, p_partkey FROM part),
s AS (SELECT *, CAST(round(round(d1 * 0.4 + d2 * 0.4 + d3 * 0.2, 6)) AS INTEGER) AS imp, CASE WHEN d4 >= 4 THEN CASE WHEN d5 >= 4 THEN 0 ELSE 1 END ELSE CASE WHEN d5 >= 4 THEN 2 ELSE 3 END END + CASE WHEN d6 >= 4 THEN -1 WHEN d6 <= 2 THEN 1 ELSE 0 END AS a FROM b)
SELECT p_partkey, imp AS importance, substr('ABCD', CAST(greatest(0, least(3, a)) + 1 AS INTEGER), 1) AS action_class, imp >= 3 AS deep, CASE WHEN imp >= 5 THEN 'STRATEGIC' WHEN imp = 4 THEN 'MAJOR' WHEN imp = 3 THEN 'GENERAL' ELSE 'INFO' END AS grade FROM s""")
def scoring_columns(spark, d):
    p = table(spark, d, "part")
    i = lambda c, m: F.col(c).cast("int") % m
    s = F.struct(i("p_size", 6).alias("D1"), i("p_partkey", 6).alias("D2"), (F.floor("p_retailprice").cast("int") % 6).alias("D3"), i("p_size", 5).alias("D4"), i("p_partkey", 5).alias("D5"), i("p_partkey", 7).alias("D6"))
    p = p.withColumn("s", s)
    imp = scoring.importance(F.col("s"))
    return p.select("p_partkey", imp.alias("importance"), scoring.action_class(F.col("s")).alias("action_class"), scoring.gate_deep(imp, F.lit("市")).alias("deep"), scoring.importance_enum(imp).alias("grade"))


# ---- texts, filters, duplicates ----------------------------------------------------------------------------------------------------------------

NORM_URL_SQL = r"""concat(lower(regexp_extract(url, '^([A-Za-z]+)://', 1)), '://', lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/$', ''), CASE WHEN regexp_extract(url, '[?&](page=[0-9]+)', 1) <> '' THEN concat('?', regexp_extract(url, '[?&](page=[0-9]+)', 1)) ELSE '' END)"""


@query(f"SELECT page_id, {NORM_URL_SQL} AS url_key, substr(sha1({NORM_URL_SQL}), 1, 16) AS url_hash FROM pages")
def normalize_url(spark, d):
    p = table(spark, d, "pages")
    u = T.normalize_url(F.col("url"))
    return p.select("page_id", u.alias("url_key"), T.short_hash(u).alias("url_hash"))


@query(r"""WITH RECURSIVE k AS (SELECT page_id AS row_id, 'u' || {NORM} AS u, lower(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)(?:</h1>|$)', 1), '[\s\(\)\[\]"'':;,.!?\-_]+', '', 'g')) AS t, row_number() OVER (ORDER BY page_id) AS rn FROM pages),
s AS (SELECT CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS row_id, CAST([] AS VARCHAR[]) AS seen, false AS kept UNION ALL
SELECT k.rn, k.row_id, CASE WHEN list_contains(seen, u) OR list_contains(seen, 't' || t) THEN seen ELSE seen || [u] || CASE WHEN t <> '' THEN ['t' || t] ELSE [] END END, NOT (list_contains(seen, u) OR list_contains(seen, 't' || t)) FROM s JOIN k ON k.rn = s.rn + 1)
SELECT row_id, kept FROM s WHERE rn > 0""".replace("{NORM}", NORM_URL_SQL))
def greedy_batch_filter(spark, d):
    p = table(spark, d, "pages").select(F.col("page_id").alias("row_id"), "url", F.regexp_extract("html", r"(?s)<h1>(.*?)(?:</h1>|$)", 1).alias("title"), F.col("page_id").alias("pos"))
    return dedup.greedy_batch(p).select("row_id", "kept")


@query(r"""WITH b AS (SELECT item_id, regexp_replace(text, '\s+', '', 'g') AS n, text AS raw FROM benchmark), c AS (SELECT doc_id, text, regexp_replace(text, '\s+', '', 'g') AS c FROM documents)
SELECT doc_id AS from_id, item_id + 100000000 AS to_id, 'references' AS rel, CASE WHEN CASE WHEN strpos(text, n) > 0 THEN strpos(text, n) ELSE strpos(c, n) END <= 800 THEN 'opening' ELSE 'body' END AS location FROM c, b WHERE contains(c, n)""")
def citation_relations(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.lit("").alias("title"), F.col("text").alias("body"))
    items = table(spark, d, "benchmark").select((F.col("item_id") + 100000000).alias("doc_id"), F.col("text").alias("number"))
    return relations.citations(docs, items).where("rel = 'references'").select("from_id", "to_id", "rel", "location")


VIEWS_SQL = """v AS (SELECT doc_id, lang AS region_name, source AS issuer, doc_id % 3 AS rank, CAST(2000 + doc_id % 9 AS INTEGER) AS year, concat(lang, CAST(doc_id % 40 AS VARCHAR)) AS theme FROM documents),
basis AS (SELECT a.doc_id AS f, b.doc_id AS t FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 40 WHERE a.doc_id % 2 = 0)"""


def first_line(c: str) -> F.Column:
    return F.substring_index(F.coalesce(F.col(c), F.lit("")), "\n", 1)


def views_of(spark, d, whole: bool = True):
    """All documents as views, with their whole first lines as titles; levels differ by doc_id % 3."""
    x = table(spark, d, "documents")
    level = F.element_at(F.array(F.lit("县"), F.lit("市"), F.lit("省")), (F.col("doc_id") % 3 + 1).cast("int"))
    return x.select("doc_id", first_line("text").alias("title"), level.alias("region_level"), F.col("lang").alias("region_name"), F.col("source").alias("issuer"), (F.lit(2000) + F.col("doc_id") % 9).cast("int").alias("year"), F.concat("lang", (F.col("doc_id") % 40).cast("string")).alias("primary_theme"), F.col("doc_id").alias("pos"))


def basis_of(spark, d):
    """Each even document rests on the one 40 further on."""
    x = table(spark, d, "documents").select("doc_id")
    return x.where("doc_id % 2 = 0").select(F.col("doc_id").alias("from_id"), (F.col("doc_id") + 40).alias("to_id")).join(x.withColumnRenamed("doc_id", "to_id"), "to_id", "left_semi").select("from_id", "to_id")


@query(r"""SELECT doc_id, CASE WHEN lower(text) LIKE '%license%' THEN 'skip_junk' WHEN regexp_matches(text, '[0-9]{6,}') THEN 'market_intel' ELSE 'ingest' END AS disposition FROM documents""")
def first_match_class(spark, d):
    c = filters.ingest_class(F.col("text"), skip=[(r"(?i)license", "license")], market=[(r"[0-9]{6,}", "long number")], capacity=r"\bx{40}\b", procurement=r"\bx{40}\b")
    return table(spark, d, "documents").select("doc_id", c["disposition"].alias("disposition"))


@query(r"""SELECT page_id, CAST(length(regexp_replace(html, '[^<]', '', 'g')) AS BIGINT) AS tags, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages""")
def page_titles(spark, d):
    p = table(spark, d, "pages")
    return p.select("page_id", F.length(F.regexp_replace("html", "[^<]", "")).cast("long").alias("tags"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


LINKS_SQL = r"""a AS (SELECT page_id, url AS base, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS a FROM (SELECT page_id, url, regexp_extract_all(coalesce(html, ''), '(?is)<a\s[^>]*?href\s*=\s*["''][^"'']*["''][^>]*>.*?</a>[^<]{0,200}') AS l FROM pages) x),
b AS (SELECT page_id, base, pos, a, trim(regexp_extract(a, '(?is)href\s*=\s*["'']([^"'']*)["'']', 1)) AS href, trim(regexp_replace(regexp_replace(regexp_extract(a, '(?is)^<a\s[^>]*>(.*?)</a>', 1), '(?s)<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS title, regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) AS origin FROM a),
c AS (SELECT *, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN href WHEN href LIKE '//%' THEN concat(regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.\-]*:)', 1), href) WHEN href LIKE '/%' THEN concat(origin, href) WHEN href = '' THEN base ELSE concat(regexp_replace(regexp_extract(base, '^([^?#]*)', 1), '[^/]*$', ''), regexp_replace(href, '^(\./)+', '')) END AS url FROM b WHERE length(title) BETWEEN 5 AND 200 AND NOT regexp_matches(href, '(?i)^(javascript:|#|mailto:)'))"""
DATE_SQL = r"'(20\d{2})[-/.年](\d{1,2})[-/.月](\d{1,2})'"


@query(f"""WITH {LINKS_SQL} SELECT page_id, CAST(pos AS INTEGER) AS pos, title, url, CASE WHEN regexp_matches(a, {DATE_SQL}) THEN concat_ws('-', regexp_extract(a, {DATE_SQL}, 1), lpad(regexp_extract(a, {DATE_SQL}, 2), 2, '0'), lpad(regexp_extract(a, {DATE_SQL}, 3), 2, '0')) ELSE '' END AS date_hint FROM (SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY pos) AS rn FROM c) x WHERE rn = 1""")
def link_items(spark, d):
    return readers.page_items(table(spark, d, "pages"), None)


BODY_SQL = "coalesce(html, '')"
for _tag in ("script", "style", "nav", "header", "footer"):
    BODY_SQL = rf"regexp_replace({BODY_SQL}, '(?is)<{_tag}\b.*?</{_tag}\s*>', ' ', 'g')"
BODY_SQL = rf"regexp_replace({BODY_SQL}, '(?s)<!--.*?-->|<[^>]*>', ' ', 'g')"
for _name, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    BODY_SQL = f"replace({BODY_SQL}, '{_name}', '{_char}')"
BODY_SQL = rf"trim(regexp_replace({BODY_SQL}, '\s+', ' ', 'g'))"


@query(rf"""WITH p AS (SELECT page_id, {BODY_SQL} AS t, lower(coalesce(html, '')) AS h FROM pages), c AS (SELECT *, len(regexp_extract_all(h, '<a\s[^>]*href')) AS links, len(regexp_extract_all(h, '<a\s[^>]*href[^<]*<[^>]*>[^<]{{0,80}}20\d{{2}}[-/.年]\d{{1,2}}|20\d{{2}}[-/.年]\d{{1,2}}[^<]{{0,40}}<[^>]*>\s*<a\s[^>]*href')) AS dated FROM p)
SELECT page_id, CASE WHEN length(t) >= 200 THEN t END AS body, CASE WHEN trim(h) = '' THEN 'empty' WHEN (contains(h, '下一页') OR contains(h, '下页') OR contains(h, 'next')) AND links > 0 OR dated >= 3 THEN 'ok' WHEN links > 0 THEN 'structure_unknown' ELSE 'empty' END AS verdict FROM c""")
def main_text(spark, d):
    return table(spark, d, "pages").select("page_id", T.strip_html(F.col("html"), 200).alias("body"), filters.list_page_verdict(F.col("html")).alias("verdict"))


@query("""SELECT doc_id, CASE WHEN n_chars < 200 OR n_chars < 500 AND contains(text, 'License') THEN true ELSE false END AS low_quality, n_chars < 800 AS wants_refetch FROM (SELECT doc_id, text, length(trim(text)) AS n_chars FROM documents) x""")
def thin_bodies(spark, d):
    return table(spark, d, "documents").select("doc_id", T.low_quality(F.col("text"), ["License"]).alias("low_quality"), filters.wants_refetch(F.trim("text")).alias("wants_refetch"))


@query(r"""SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, found FROM (SELECT doc_id, line_no, unnest(regexp_extract_all(line, '[0-9]{8,}')) AS found FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents) x) y""")
def ids_in_lines(spark, d):
    return filters.ids_in_text(table(spark, d, "documents"), r"[0-9]{8,}")


@query("""WITH c AS (SELECT doc_id, list_distinct(string_split(split_part(coalesce(text, ''), chr(10), 1), '')) AS a, list_distinct(string_split(coalesce(text, ''), '')) AS b FROM documents)
SELECT doc_id, CASE WHEN len(list_filter(b, lambda x: x <> '')) = 0 THEN 0 ELSE round(len(list_filter(list_intersect(a, b), lambda x: x <> '')) / len(list_filter(list_distinct(list_concat(a, b)), lambda x: x <> '')), 6) END AS jaccard FROM c""")
def title_similarity(spark, d):
    """The characters of each document's first line against those of its whole text."""
    x = table(spark, d, "documents").select("doc_id", first_line("text").alias("t"), F.coalesce("text", F.lit("")).alias("u"))
    return x.select("doc_id", F.round(T.char_jaccard(F.col("t"), F.col("u")), 6).alias("jaccard"))


# ---- ranking, samples, queues, increments ----------------------------------------------------------------------------------------------------------------

@query("""SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) x ORDER BY rn, source, doc_id LIMIT 30""")
def round_robin_sample(spark, d):
    return ranking.round_robin(table(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 30)


@query("""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS a, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS b FROM documents) x WHERE a <= 3 OR b <= 3""")
def quota_sample(spark, d):
    return ranking.quota_sample(table(spark, d, "documents").select("doc_id", "source", "lang"), ["source", "lang"], "doc_id", 3).select("doc_id")


@query("""SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'F') x WHERE rn > 200 AND rn <= 300""")
def batch_slice(spark, d):
    return ranking.batch_slice(table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey"), "o_orderkey", 2, 100)


@query("""SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY source) AS n FROM documents) x WHERE rn = 1 OR n >= 4 AND rn = floor(n / 2) + 1""")
def spot_checks(spark, d):
    return ranking.spot_checks(table(spark, d, "documents").select("source", "doc_id"), "source", "doc_id")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) x WHERE rn = 1""")
def latest_per_key(spark, d):
    return ranking.latest(table(spark, d, "events"), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


@query("""WITH q AS (SELECT user_id, event_id, CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END AS r, event_type FROM events)
SELECT CAST(user_id AS VARCHAR) AS pid, min(event_id) AS pos, CAST(min(r) AS INTEGER) AS rank, arg_min(event_type, r * 1000000000 + event_id) AS "trigger" FROM q GROUP BY user_id""")
def queue_order(spark, d):
    e = table(spark, d, "events")
    p = F.when(F.col("event_type") == "error", "high").when(F.col("event_type") == "purchase", "normal").otherwise("low")
    return ranking.queue_order(e.select(F.col("user_id").cast("string").alias("pid"), F.col("event_type").alias("trigger"), p.alias("priority"), F.col("ts").cast("string").alias("requested_at"), F.col("event_id").alias("pos"))).select("pid", "pos", "rank", "trigger")


@query("""WITH f AS (SELECT user_id, min(event_id) AS pos FROM events WHERE event_type = 'error' GROUP BY user_id), h AS (SELECT user_id, count(*) % 4 AS tries FROM events WHERE event_type = 'signup' GROUP BY user_id),
d AS (SELECT CAST(f.user_id AS VARCHAR) AS pid, pos, coalesce(tries, 0) AS tries FROM f LEFT JOIN h ON f.user_id = h.user_id), o AS (SELECT pid, row_number() OVER (ORDER BY pos) AS rn FROM d WHERE tries < 2)
SELECT d.pid, pos, tries, CASE WHEN tries >= 2 THEN 'given_up' WHEN rn <= 50 THEN 'requeued' ELSE 'left' END AS outcome FROM d LEFT JOIN o ON d.pid = o.pid""")
def sweep_plan(spark, d):
    e = table(spark, d, "events")
    dead = e.where("event_type = 'error'").select(F.col("user_id").cast("string").alias("pid"), F.col("event_id").alias("pos"))
    history = e.where("event_type = 'signup'").groupBy(F.col("user_id").cast("string").alias("pid")).agg((F.count("*") % 4).alias("tries"))
    return ranking.plan_sweep(dead, history, 2, 50)


@query("""WITH a AS (SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1), b AS (SELECT event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1) SELECT a.event_type, a.n, coalesce(b.n, 0) AS previous FROM a LEFT JOIN b ON a.event_type = b.event_type WHERE a.n > coalesce(b.n, 0)""")
def dead_letter_growth(spark, d):
    e = table(spark, d, "events")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    return monitoring.growth_alert(monitoring.counts_by(e.where(F.col("ts") >= cut), "event_type"), monitoring.counts_by(e.where(F.col("ts") < cut), "event_type"), "event_type")


@query("""WITH i AS (SELECT DISTINCT event_type AS channel, CAST(floor(value / 5) AS BIGINT) AS page, user_id % 60 AS url FROM events), f AS (SELECT *, page = min(page) OVER (PARTITION BY channel, url) AS fresh FROM i),
p AS (SELECT channel, page, count(*) AS a, count(*) FILTER (WHERE fresh) AS n FROM f GROUP BY 1, 2), s AS (SELECT *, max(CASE WHEN n * 1.0 / a < 0.1 THEN 1 ELSE 0 END) OVER (PARTITION BY channel ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stop FROM p)
SELECT f.channel, f.page, f.url FROM f JOIN s ON f.channel = s.channel AND f.page = s.page WHERE fresh AND coalesce(stop, 0) = 0""")
def page_yield_cutoff(spark, d):
    i = table(spark, d, "events").select(F.col("event_type").alias("channel"), F.floor(F.col("value") / 5).alias("page"), (F.col("user_id") % 60).alias("url")).distinct()
    return ranking.page_yield(i).select("channel", "page", "url")


@query("""WITH r AS (SELECT c_custkey, concat('P_2020_', CAST(c_nationkey AS VARCHAR), '_', substr(c_mktsegment, 1, 1), CAST(c_custkey % 4 AS VARCHAR)) AS base FROM customer), n AS (SELECT DISTINCT base, s, CASE WHEN s = 0 THEN base ELSE concat(base, '_', substr('abcdefghij', s, 1)) END AS new_id FROM r, (SELECT unnest(range(0, 11)) AS s) x),
t AS (SELECT DISTINCT concat('P_2020_', CAST(s_nationkey AS VARCHAR), '_B', CAST(s_suppkey % 4 AS VARCHAR)) AS id FROM supplier), f AS (SELECT base, new_id, row_number() OVER (PARTITION BY base ORDER BY s) AS rk FROM n WHERE new_id NOT IN (SELECT id FROM t)), q AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY c_custkey) AS rk FROM r)
SELECT c_custkey, q.base, f.new_id FROM q LEFT JOIN f ON q.base = f.base AND q.rk = f.rk""")
def id_allocation(spark, d):
    base = F.concat(F.lit("P_2020_"), F.col("c_nationkey").cast("string"), F.lit("_"), F.substring("c_mktsegment", 1, 1), (F.col("c_custkey") % 4).cast("string"))
    r = table(spark, d, "customer").select(F.col("c_custkey").alias("row_id"), base.alias("base"), F.col("c_custkey").alias("pos"))
    taken = table(spark, d, "supplier").select(F.concat(F.lit("P_2020_"), F.col("s_nationkey").cast("string"), F.lit("_B"), (F.col("s_suppkey") % 4).cast("string")).alias("id"))
    return identity.allocate_ids(r, taken).select(F.col("row_id").alias("c_custkey"), "base", "new_id")


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 11 = 0 THEN o_custkey + 500000 ELSE o_custkey END AS custkey, CASE WHEN o_custkey % 13 = 0 THEN 'archived' ELSE 'kept' END AS lane FROM orders WHERE o_custkey % 13 <> 0 UNION ALL SELECT o_orderkey, o_custkey, 'archived' FROM orders WHERE o_custkey % 13 = 0""")
def id_remap(spark, d):
    c = table(spark, d, "customer")
    m = c.where("c_custkey % 11 = 0").select(F.col("c_custkey").alias("old_id"), (F.col("c_custkey") + 500000).alias("new_id"))
    a = c.where("c_custkey % 13 = 0").select(F.col("c_custkey").alias("id"))
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    kept, gone = identity.remap(o, m, a, ["custkey"])
    return kept.withColumn("lane", F.lit("kept")).unionByName(gone.withColumn("lane", F.lit("archived")))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def orphan_rows(spark, d):
    return identity.orphans(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("""WITH l AS (SELECT doc_id, sha256(CASE WHEN doc_id % 7 = 0 THEN concat(text, 'x') ELSE text END) AS h, CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 2 END AS v FROM documents WHERE doc_id % 3 <> 0)
SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN v <> 2 THEN 'version' ELSE 'content' END AS change FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR v <> 2 OR h <> sha256(text)""")
def hash_changes(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    old = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    ledger = docs.where("doc_id % 3 <> 0").select("doc_id", incremental.content_hash(old).alias("raw_content_hash"), F.when(F.col("doc_id") % 5 == 0, 1).otherwise(2).alias("pipeline_version"))
    return incremental.needs_rebuild(docs, ledger, 2).select("doc_id", "change")


@query(f"""WITH {EDGES_SQL}, n AS (SELECT node_id FROM nodes WHERE node_id % 50 = 3) SELECT source FROM edges WHERE (from_id IN (SELECT node_id FROM n) OR to_id IN (SELECT node_id FROM n)) AND rel <> 'cites_basis'""")
def increment_pairs(spark, d):
    e = edges_of(spark, d).withColumnRenamed("source", "candidate_id")
    return incremental.touching(e, nodes_of(spark, d).where("node_id % 50 = 3"), e.where("rel = 'cites_basis'")).select(F.col("candidate_id").alias("source"))


@query("""WITH t AS (SELECT c_custkey AS k, c_mktsegment AS importance, CASE WHEN c_custkey % 4 = 0 THEN 'yes' END AS o, c_name AS title FROM customer WHERE c_custkey % 3 <> 0), u AS (SELECT c_custkey AS k, 'NEW' AS importance, concat(c_name, '!') AS title FROM customer WHERE c_custkey % 2 = 0)
SELECT coalesce(t.k, u.k) AS pipeline_pid, CASE WHEN u.k IS NULL THEN t.importance WHEN t.k IS NULL OR t.o IS NULL THEN u.importance ELSE t.importance END AS importance, coalesce(u.title, t.title) AS title FROM t FULL JOIN u ON t.k = u.k""")
def merge_guard(spark, d):
    c = table(spark, d, "customer")
    t = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("pipeline_pid"), F.col("c_mktsegment").alias("importance"), F.when(F.col("c_custkey") % 4 == 0, "yes").alias("importance_override"), F.col("c_name").alias("title"))
    u = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("pipeline_pid"), F.lit("NEW").alias("importance"), F.concat("c_name", F.lit("!")).alias("title"))
    return incremental.upsert_documents(t, u).select("pipeline_pid", "importance", "title")


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def work_list(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return incremental.todo(o, table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


# ---- streams, with the batch twin as oracle ----------------------------------------------------------------------------------------------------------------

@query("""SELECT event_type, CAST(date_trunc('day', ts) AS VARCHAR) AS start, count(*) AS n, CASE WHEN count(*) >= 8 THEN 'high' WHEN count(*) >= 2 THEN 'medium' ELSE 'low' END AS heat FROM events GROUP BY 1, date_trunc('day', ts)""")
def heat_windows(spark, d):
    return streams.heat_windows(table(spark, d, "events")).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOURS THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def session_heat(spark, d):
    return streams.session_heat(table(spark, d, "events")).select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("""SELECT event_id, CASE WHEN event_id % 9 > 0 AND strftime(ts, '%Y-%m-%d') < '2024-01-10' THEN 'late' ELSE 'on_time' END AS lane FROM events""")
def late_split(spark, d):
    e = table(spark, d, "events")
    return streams.split_late(e, F.when(F.col("event_id") % 9 > 0, F.date_format("ts", "yyyy-MM-dd")), "2024-01-10").select("event_id", "lane")


@query("""SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen FROM events GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 26 HOURS""")
def silent_sources(spark, d):
    return streams.silent_sources(table(spark, d, "events"), "user_id", "ts", "2024-01-31 00:00:00").withColumn("last_seen", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss"))


# ---- look-ups, identity, contracts, merges ----------------------------------------------------------------------------------------------------------------

@query("""WITH k AS (SELECT s_suppkey AS doc_id, s_suppkey AS pos, 0 AS r, concat('S', CAST(s_suppkey AS VARCHAR)) AS k FROM supplier UNION ALL SELECT s_suppkey, s_suppkey, 1, concat('N', CAST(s_nationkey AS VARCHAR)) FROM supplier UNION ALL SELECT s_suppkey, s_suppkey, 2, concat('S', CAST(s_suppkey + 1 AS VARCHAR)) FROM supplier)
SELECT k AS "key", doc_id FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY CASE WHEN r = 0 THEN 0 ELSE 1 END, pos, doc_id) AS rn FROM k) x WHERE rn = 1""")
def alias_lookup(spark, d):
    key = lambda c: F.concat(F.lit("S"), F.col(c).cast("string"))
    s = table(spark, d, "supplier").select(key("s_suppkey").alias("doc_id"), F.col("s_suppkey").alias("pos"), F.array(F.concat(F.lit("N"), F.col("s_nationkey").cast("string")), F.concat(F.lit("S"), (F.col("s_suppkey") + 1).cast("string"))).alias("aliases"))
    return identity.alias_index(s, "id").select("key", F.substring("doc_id", 2, 20).cast("long").alias("doc_id"))


@query("""SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'manifest_pid_not_found' ELSE '' END AS reason FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 1000""")
def lookup_or_queue(spark, d):
    c = table(spark, d, "customer").where("c_acctbal > 1000").select(F.col("c_custkey").alias("key"), F.col("c_custkey").alias("doc_id"))
    found, missing = identity.lookup_or_queue(table(spark, d, "orders").select("o_orderkey", "o_custkey"), c, "o_custkey")
    return found.select("o_orderkey", F.lit("").alias("reason")).union(missing.select("o_orderkey", "reason"))


@query(r"""SELECT page_id, CASE WHEN regexp_matches(url, '://[^/]*\.org') THEN 'ORG' WHEN regexp_matches(url, '://blog\.') THEN 'BLOG' ELSE '' END AS issuer_short FROM pages""")
def registry_seed(spark, d):
    p = table(spark, d, "pages").select("page_id", T.host(F.col("url")).alias("domain"), F.regexp_extract("url", r"://[^/]*\.(org)", 1).alias("name"))
    ok, manual = identity.seed_registry(p, {"org": "ORG"}, {"blog": "BLOG"})
    return ok.select("page_id", "issuer_short").union(manual.select("page_id", F.lit("")))


@query("""WITH r AS (SELECT concat(n_name, '.x') AS domain, n_name AS code FROM nation WHERE n_nationkey % 2 = 0) SELECT c_custkey, coalesce(code, '') AS code FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN r ON lower(domain) = lower(concat(n_name, '.x'))""")
def host_registry(spark, d):
    n = table(spark, d, "nation")
    reg = n.where("n_nationkey % 2 = 0").select(F.concat("n_name", F.lit(".x")).alias("domain"), F.col("n_name").alias("code"), F.col("n_nationkey").alias("pos"))
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat(F.lit("https://"), "n_name", F.lit(".X/a?b=1")).alias("url"))
    return identity.host_lookup(c, reg).select("c_custkey", F.coalesce("code", F.lit("")).alias("code"))


@query("""WITH v AS (SELECT doc_id, unnest(list_concat(CASE WHEN doc_id % 4 = 0 OR lang = 'de' THEN ['missing:lang'] ELSE [] END, CASE WHEN doc_id % 3 = 0 THEN ['legacy:old'] ELSE [] END, CASE WHEN doc_id % 5 = 0 THEN ['unexpected:bad'] ELSE [] END)) AS v FROM documents)
SELECT string_split(v, ':')[1] AS kind, string_split(v, ':')[2] AS name, count(*) AS docs, round(count(*) * 1.0 / (SELECT count(*) FROM documents), 6) AS ratio FROM v GROUP BY v""")
def contract_drift(spark, d):
    x = table(spark, d, "documents")
    fm = F.map_concat(F.create_map(F.lit("id"), F.lit("1")), F.when(F.col("doc_id") % 4 == 0, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("lang"), F.when(F.col("lang") == "de", F.lit("")).otherwise(F.col("lang")))), F.when(F.col("doc_id") % 3 == 0, F.create_map(F.lit("old"), F.lit("1"))).otherwise(F.create_map().cast("map<string,string>")), F.when(F.col("doc_id") % 5 == 0, F.create_map(F.lit("bad"), F.lit("1"))).otherwise(F.create_map().cast("map<string,string>")))
    v = x.withColumn("violations", filters.contract_violations(fm, F.array().cast("array<string>"), ["id", "lang"], [], ["old"]))
    return filters.drift_inventory(v).withColumn("ratio", F.round("ratio", 6))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'manual_review' WHEN c_mktsegment <> 'BUILDING' OR c_nationkey % 4 = 0 THEN 'isolate_legacy' ELSE 'keep_current' END AS action FROM customer""")
def provenance_class(spark, d):
    c = table(spark, d, "customer")
    pid = F.col("c_custkey").cast("string")
    row = {"pid": pid, "stem": F.when(F.col("c_custkey") % 10 == 0, F.lit("other")).otherwise(pid), "extracted_by": F.col("c_mktsegment"), "extracted_model": F.lit("m"), "impact_keys": F.when(F.col("c_nationkey") % 4 == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("b"), F.lit("a")))}
    return c.select("c_custkey", filters.provenance_class(row, "BUILDING", ["m"], ["zz"], ["a", "b"])["action"].alias("action"))


@query("""SELECT least(c_nationkey, s_nationkey) AS a, greatest(c_nationkey, s_nationkey) AS b, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""")
def canonical_pairs(spark, d):
    j = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    a, b = relations.canonical_pair(F.col("c_nationkey"), F.col("s_nationkey"), F.lit(True))
    return j.select(a.alias("a"), b.alias("b")).groupBy("a", "b").agg(F.count("*").alias("n"))


@query(f"""WITH {EDGES_SQL}, k AS (SELECT s_suppkey + 10000000 AS node_id FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) SELECT from_id AS from_key, to_id AS to_key, count(*) AS n FROM edges WHERE from_id IN (SELECT node_id FROM k) AND to_id IN (SELECT node_id FROM k) GROUP BY ALL""")
def resolved_edges(spark, d):
    ids = table(spark, d, "supplier").where("s_suppkey % 2 = 0").select((F.col("s_suppkey") + 10000000).alias("node_id")).union(table(spark, d, "customer").where("c_custkey % 2 = 0").select("c_custkey"))
    return relations.resolve_endpoints(edges_of(spark, d), ids.withColumn("key", F.col("node_id"))).groupBy("from_key", "to_key").agg(F.count("*").alias("n"))


@query("""SELECT c_custkey AS pid, CASE WHEN o.k IS NULL THEN 'raw_missing' WHEN c_custkey % 7 = 0 THEN 'bad_date' WHEN c_custkey % 5 = 0 THEN 'empty_title' ELSE 'ok' END AS outcome FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') o ON c_custkey = k""")
def sync_skips(spark, d):
    raw = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("doc_id")).distinct()
    raw = raw.select("doc_id", F.when(F.col("doc_id") % 5 == 0, "  ").otherwise("t").alias("title"), F.when(F.col("doc_id") % 7 == 0, "2020-13-01").otherwise("2020-01-01T00").alias("date"), F.lit("c").alias("content"))
    ok, skipped = incremental.sync_rows(table(spark, d, "customer").select(F.col("c_custkey").alias("pid")), raw)
    return ok.select("pid", F.lit("ok").alias("outcome")).union(skipped.select("pid", "reason"))


@query("""WITH t AS (SELECT c_custkey AS k, c_mktsegment AS note, CASE WHEN c_custkey % 3 = 0 THEN 'accept' END AS verdict FROM customer WHERE c_custkey % 4 <> 0) SELECT coalesce(t.k, u.c_custkey) AS dedupe_key, CASE WHEN verdict IS NOT NULL THEN note WHEN u.c_custkey IS NULL THEN note ELSE u.c_name END AS note FROM t FULL JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) u ON t.k = u.c_custkey""")
def undecided_upsert(spark, d):
    c = table(spark, d, "customer")
    t = c.where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("dedupe_key"), F.col("c_mktsegment").alias("note"), F.when(F.col("c_custkey") % 3 == 0, "accept").alias("verdict"))
    return incremental.upsert_undecided(t, c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("dedupe_key"), F.col("c_name").alias("note"))).select("dedupe_key", "note")


@query("""SELECT user_id, event_type FROM (SELECT DISTINCT user_id, event_type FROM events WHERE event_id % 2 = 0) a WHERE NOT EXISTS (SELECT 1 FROM events b WHERE b.event_id % 5 = 1 AND a.user_id = b.user_id AND a.event_type = b.event_type)""")
def absent_inserts(spark, d):
    e = table(spark, d, "events")
    return incremental.insert_absent(e.where("event_id % 5 = 1").select("user_id", "event_type"), e.where("event_id % 2 = 0").select("user_id", "event_type"), ["user_id", "event_type"])


@query("""SELECT event_id FROM events a WHERE NOT EXISTS (SELECT 1 FROM events b WHERE b.event_type = 'purchase' AND b.value > 20 AND a.event_type = b.event_type AND a.user_id = b.user_id)""")
def resolved_removal(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("event_type").alias("kind"), F.col("user_id").alias("ref"), "value")
    return incremental.remove_resolved(e, e.where("kind = 'purchase' AND value > 20")).select("event_id")


@query("""SELECT p_name, p_partkey, CASE WHEN rn = 1 THEN p_brand ELSE concat(p_brand, '__', CAST(rn - 1 AS VARCHAR)) END AS unique_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part) x""")
def numbered_names(spark, d):
    return identity.numbered_names(table(spark, d, "part").select("p_name", "p_partkey", F.col("p_brand").alias("name")), "name", "p_partkey").select("p_name", "p_partkey", "unique_name")


@query("""WITH h AS (SELECT c_nationkey, count(DISTINCT c_mktsegment) AS hits FROM customer WHERE c_acctbal > 5000 GROUP BY 1) SELECT n_name AS city, CAST(coalesce(hits, 0) * 3 + CASE WHEN n_regionkey = 0 THEN 2 ELSE 0 END + CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS score FROM nation LEFT JOIN h ON n_nationkey = c_nationkey""")
def city_priority(spark, d):
    n = table(spark, d, "nation")
    r = table(spark, d, "customer").where("c_acctbal > 5000").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("city"), F.col("c_mktsegment").alias("reason"))
    return monitoring.city_priority(n.select(F.col("n_name").alias("city"), (F.col("n_regionkey") == 0).alias("is_municipality"), (F.col("n_nationkey") % 2 == 0).alias("has_signal")), r).select("city", "score")


@query("""SELECT o_orderstatus AS "check", o_orderpriority AS source, count(*) AS n FROM orders GROUP BY 1, 2 UNION ALL SELECT o_orderstatus, NULL, count(*) FROM orders GROUP BY 1 UNION ALL SELECT NULL, NULL, count(*) FROM orders""")
def audit_rollup(spark, d):
    return monitoring.audit_rollup(table(spark, d, "orders").select(F.col("o_orderstatus").alias("check"), F.col("o_orderpriority").alias("source")))


@query("""SELECT source, lang, n FROM (SELECT source, lang, count(*) AS n, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) AS rn FROM documents GROUP BY 1, 2) x WHERE rn <= 3""")
def dominant_kinds(spark, d):
    return context.dominant(table(spark, d, "documents"), "source", "lang", 3).select("source", "lang", "n")


@query("""WITH v AS (SELECT l_orderkey AS item_id, l_linenumber AS rater, unnest([l_returnflag, l_linestatus]) AS t FROM lineitem), n AS (SELECT item_id, count(DISTINCT rater) AS raters FROM v GROUP BY 1), c AS (SELECT item_id, t, count(DISTINCT rater) AS k FROM v GROUP BY 1, 2)
SELECT c.item_id, string_agg(t, ',' ORDER BY t) AS themes FROM c JOIN n ON c.item_id = n.item_id WHERE k >= floor(raters / 2) + 1 GROUP BY 1""")
def majority_themes(spark, d):
    v = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("item_id"), F.col("l_linenumber").alias("rater"), F.array("l_returnflag", "l_linestatus").alias("themes"))
    return monitoring.majority_themes(v).select("item_id", joined("themes").alias("themes"))


@query("""SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events""")
def json_blocks(spark, d):
    return table(spark, d, "events").select("event_id", T.json_block(F.concat(F.lit("note: "), "props", F.lit(" end")), "k int")["k"].alias("k"))


@query("""SELECT p_partkey, concat('P_', CAST(2000 + p_partkey % 25 AS VARCHAR), '_NEA_', CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE substr(sha1(concat(CAST(2000 + p_partkey % 25 AS VARCHAR), '-05-01|', p_name)), 1, 8) END) AS doc_id FROM part""")
def computed_ids(spark, d):
    year = (F.lit(2000) + F.col("p_partkey") % 25).cast("string")
    none = F.lit(None).cast("string")
    pid = identity.compute_id(F.concat(year, F.lit("-05-01")), F.lit("国家能源局"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("国能发"), F.col("p_size").cast("string"), F.lit("号"))).otherwise(F.lit("")), F.col("p_name"), none, none)
    return table(spark, d, "part").select("p_partkey", pid.alias("doc_id"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, 'url_path' AS method FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d'), 'url_compact' FROM orders WHERE o_orderkey % 2 = 1""")
def url_dates(spark, d):
    o = table(spark, d, "orders")
    url = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "'http://a.gov.cn/'yyyy/M/d'/x.html'")).otherwise(F.date_format("o_orderdate", "'http://a.gov.cn/'yyyyMM'/t'yyyyMMdd'_1.html'"))
    x = dates.date_from_url(url)
    return o.select("o_orderkey", x["date"].alias("date"), x["method"].alias("method"))


@query("""SELECT o_orderkey, o_orderpriority FROM (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(concat(CAST(o_orderkey AS VARCHAR), '#7')), o_orderkey) AS rn FROM orders) x WHERE rn <= 5""")
def seeded_sample(spark, d):
    return ranking.seeded_sample(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 5)


@query()
def collection_chain(spark, d):
    from . import jobs

    p = table(spark, d, "pages")
    known = p.where("page_id % 3 = 0").select("url", F.lit("").alias("number"), F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"))
    # no article behind a link is stored: the first page that links to it stands in for its body
    first = readers.page_items(p, None).groupBy("url").agg(F.min("page_id").alias("page_id"))
    out = jobs.collection_chain(p, known, first.join(p.select("page_id", "html"), "page_id").select("url", "html"))
    lanes = None
    for name in ("pass", "commentary", "review", "reject", "quarantine"):
        part = out[name].select("row_id", "title", "date", F.lit(name).alias("lane"))
        lanes = part if lanes is None else lanes.unionByName(part)
    return lanes


@query("""SELECT concat(lpad(CAST(c_nationkey % 30 + 11 AS VARCHAR), 2, '0'), '0000') AS province_code, n_name AS province_name, count(*) AS n FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey % 30 AND n_nationkey < 20 GROUP BY 1, 2""")
def region_rollup(spark, d):
    code = lambda c: F.concat((F.col(c) % 30 + 11).cast("string"), F.lit("0000"))
    rows = table(spark, d, "customer").select(F.concat((F.col("c_nationkey") % 30 + 11).cast("string"), F.lpad((F.col("c_custkey") % 9000).cast("string"), 4, "0")).alias("region_code"))
    return identity.region_rollup(rows, table(spark, d, "nation").where("n_nationkey < 20").select(code("n_nationkey").alias("code"), F.col("n_name").alias("name")))


@query("""SELECT event_id, CASE event_type WHEN 'error' THEN 1.0 ELSE value / 10 END AS score FROM events""")
def user_scorer(spark, d):
    from ..operators import hooks

    scorer = lambda pdf: (pdf["value"] / 10).where(pdf["event_type"] != "error", 1.0)
    return hooks.score_with(table(spark, d, "events").select("event_id", "event_type", "value"), scorer, F.lit(0.0)).select("event_id", "score")


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'old' ELSE lang END AS value FROM documents""")
def moved_keys(spark, d):
    docs = table(spark, d, "documents").withColumn("fm", F.create_map(F.lit("title"), F.lit("t"), F.lit("theme"), F.when(F.col("doc_id") % 3 == 0, F.lit("old")).otherwise(F.col("lang"))))
    return filters.move_keys(docs, ["theme"])[1].select("doc_id", "value")


from . import job_queries, more_queries, proof_queries, rule_queries, stream_queries  # noqa: E402,F401
