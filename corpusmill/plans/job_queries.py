"""Readers over files written from the given tables, composed jobs, and the gates inside them, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, rules
from ..functions import text as T
from ..operators import dedup, filters, identity, monitoring, ranking, relations, signals
from ..operators.tables import new_path
from ..sources import readers
from . import jobs
from .queries import EDGES_SQL, any_sql, edges_of, first_line, nodes_of, pick, pick_sql, query, quoted, table

# ---- readers (A1 to A5, A8, A21, A23, A24) ---------------------------------------------------------------------------------------------------


def one_file_a_row(rows: DataFrame, key: str) -> str:
    """A folder with one text file for each row (key, value).

    All files stand in one folder, and tasks put them there themselves (a folder a key, moved one by one by the driver, took most of the time). The number of tasks is given, as Spark would put small rows into one.
    """
    spark = rows.sparkSession
    path = new_path(spark, "files")
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key).select("value")
    dealt.write.option("lineSep", "\n").option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    return path


def named_files(spark: SparkSession, files: dict[str, DataFrame]) -> str:
    """A folder of files with these names, each with the rows (value) of its table as lines."""
    path = new_path(spark, "files")
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    for name, rows in files.items():
        rows.coalesce(1).write.text(f"{path}.parts/{name}")
        source = fs_path(f"{path}.parts/{name}")
        fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(fs_path(path))
        part = next(s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-"))
        fs.rename(part, fs_path(f"{path}/{name}"))
    return path


@query("""SELECT concat('P_', s_suppkey) AS doc_id, CASE WHEN s_suppkey % 3 = 0 THEN 'a: b' ELSE s_name END AS title, CASE s_suppkey % 4 WHEN 0 THEN 'one|two' WHEN 1 THEN 'three' WHEN 2 THEN 'x|y z' ELSE '' END AS issuer, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE '2024-01-02' END AS date,
 CASE WHEN s_suppkey % 2 = 0 THEN '省' ELSE '' END AS level, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) ELSE '' END AS region, concat('http://x/', s_suppkey) AS url, concat('# ', s_name, chr(10), chr(10), 'id: not a key') AS body FROM supplier WHERE s_suppkey % 7 > 0""")
def front_matter_docs(spark, d):
    """A1, A2: suppliers as files with a header; quoted values, lists of both kinds, nested keys; one in seven has no header."""
    k = F.col("s_suppkey")
    issuer = F.when(k % 4 == 0, "issuer:\n- one\n- 'two'").when(k % 4 == 1, 'issuer: "three"').when(k % 4 == 2, "issuer: [x, 'y z']").otherwise("other: 1")
    region = F.when(k % 2 == 0, F.concat(F.lit("region:\n  level: 省\n  name: "), F.col("s_nationkey").cast("string"))).otherwise("empty:")
    head = F.concat(F.lit("---\nid: P_"), k.cast("string"), F.lit("\ntitle: "), F.when(k % 3 == 0, F.lit("'a: b'")).otherwise(F.col("s_name")), F.lit("\n"), issuer, F.lit("\n"), F.when(k % 5 == 0, "date: ''").otherwise("date: 2024-01-02"), F.lit("\n"), region, F.lit("\nprovenance:\n  url: http://x/"), k.cast("string"), F.lit("\n---\n\n"))
    body = F.concat(F.lit("# "), F.col("s_name"), F.lit("\n\nid: not a key\n"))
    files = one_file_a_row(table(spark, d, "supplier").select("s_suppkey", F.when(k % 7 > 0, F.concat(head, body)).otherwise(body).alias("value")), "s_suppkey")
    docs = readers.as_documents(readers.front_matter(spark, files))
    return docs.select("doc_id", "title", F.array_join("issuer", "|").alias("issuer"), "date", F.col("region.level").alias("level"), F.col("region.name").alias("region"), "url", "body")


@query("""SELECT c_nationkey AS nation, CAST(3 * row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 2 AS INT) AS line_no, c_custkey, c_name FROM customer""")
def numbered_lines(spark, d):
    """A3: a file of JSON lines for each nation, two blank lines between them; numbers count all lines."""
    line = F.to_json(F.struct("c_custkey", "c_name", F.col("c_nationkey").alias("nation")))
    rows = table(spark, d, "customer").groupBy("c_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", line.alias("line")))), lambda x: x["line"]), "\n\n  \n").alias("value"))
    return readers.numbered_json(spark, one_file_a_row(rows, "c_nationkey"), "nation long, c_custkey long, c_name string").select("nation", "line_no", "c_custkey", "c_name")


@query("""WITH r AS (SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN 'references.jsonl' WHEN 1 THEN 'mixed.jsonl' ELSE '_archive_old.jsonl' END AS f, c_nationkey AS n FROM customer),
x AS (SELECT k, f, n, CASE WHEN f = 'references.jsonl' THEN 'references' WHEN k % 4 = 0 THEN 'likes' WHEN k % 4 = 1 THEN 'clarifies' ELSE 'supersedes' END AS rel FROM r)
SELECT concat('C', k) AS from_id, concat('N', n) AS to_id, rel, CAST(CASE k % 5 WHEN 0 THEN 0.9 WHEN 1 THEN 0.7 WHEN 2 THEN 0.25 WHEN 3 THEN 0 ELSE 0.5 END AS DOUBLE) AS confidence, f LIKE '_archive%' AS archived FROM x WHERE rel <> 'likes' AND k % 10 > 0""")
def relation_scan(spark, d):
    """Edges of three files; the type falls back to the file's name, words become numbers, unknown types and empty ends go, archives are marked."""
    k = F.col("c_custkey")
    rel = F.when(k % 3 == 0, F.lit(None)).when(k % 4 == 0, "likes").when(k % 4 == 1, "clarifies").otherwise("supersedes")
    conf = F.when(k % 5 == 0, "High").when(k % 5 == 1, "medium").when(k % 5 == 2, "0.25").when(k % 5 == 3, "soon").otherwise("LOW")
    line = F.to_json(F.struct(F.when(k % 10 == 0, "").otherwise(F.concat(F.lit("C"), k.cast("string"))).alias("from"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("to"), rel.alias("rel"), conf.alias("confidence"), F.lit("s").alias("source")))
    c = table(spark, d, "customer")
    part = lambda r: c.where(k % 3 == r).select(line.alias("value"))
    folder = named_files(spark, {"references.jsonl": part(0), "mixed.jsonl": part(1), "_archive_old.jsonl": part(2)})
    rows = readers.relation_files(spark, folder)
    out = readers.normalized_edges(rows.withColumn("source", F.col("archived").cast("string")), ("references", "clarifies", "supersedes"))
    return out.select("from_id", "to_id", "rel", "confidence", (F.col("source") == "true").alias("archived"))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS item_id, CASE WHEN s_suppkey % 2 = 0 THEN concat('http://f/', s_suppkey, '/') ELSE '' END AS url, s_name AS title, CASE WHEN s_suppkey % 3 = 0 THEN 'text' ELSE '<p>html</p>' END AS content, CASE WHEN s_suppkey % 5 = 0 THEN '2024-02-03' ELSE '2024-01-02' END AS date,
 CASE s_suppkey % 4 WHEN 0 THEN 'first' WHEN 1 THEN 'single' WHEN 2 THEN 'flat' ELSE '' END AS account FROM supplier""")
def feed_scan(spark, d):
    """A5: a feed for each nation, with every form that ids, contents, dates and authors take."""
    k = F.col("s_suppkey")
    name = lambda v: F.struct(F.lit(v).alias("name"))
    item = F.struct(
        F.when(k % 2 == 1, F.concat(F.lit("tag/"), k.cast("string"))).alias("id"), F.when(k % 2 == 0, F.concat(F.lit("http://f/"), k.cast("string"), F.lit("/"))).alias("url"), F.col("s_name").alias("title"), F.when(k % 3 > 0, "<p>html</p>").alias("content_html"), F.lit("text").alias("content_text"),
        F.when(k % 5 > 0, "2024-01-02T03:04:05Z").otherwise("").alias("date_published"), F.lit("2024-02-03T00:00:00Z").alias("date_modified"), F.when(k % 4 == 1, name("single")).alias("author"), F.when(k % 4 == 2, "flat").alias("author_name"), F.when(k % 4 == 0, F.array(name("first"), name("second"))).alias("authors"))
    feeds = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("value"))
    return readers.read_feed(spark, one_file_a_row(feeds, "s_nationkey"))


@query("""SELECT concat('n', n_nationkey % 7, '.gov.cn') AS domain, arg_max(n_name, n_nationkey) AS name FROM nation GROUP BY 1""")
def table_registry(spark, d):
    """A pipe table in a text with a header, code marks and repeated domains, of which the last counts."""
    n = table(spark, d, "nation")
    line = F.concat(F.lit("| `N"), (F.col("n_nationkey") % 7).cast("string"), F.lit(".gov.cn` | "), F.col("n_name"), F.lit(" | x |"))
    text = n.agg(F.concat(F.lit("# domains\n\n| domain | name | note |\n|---|---|---|\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", line.alias("l")))), lambda x: x["l"]), "\n"), F.lit("\n\ntext")).alias("text"))
    return readers.table_rows(text)


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN coalesce(lang, 'none') ELSE source END AS kind, n_chars, CAST(NULL AS VARCHAR) AS missing FROM documents""")
def gold_columns(spark, d):
    """A gold column where it has a value, else the plain one; a column in neither form is null."""
    x = table(spark, d, "documents").select("doc_id", F.col("source").alias("kind"), F.when(F.col("doc_id") % 3 == 0, F.coalesce("lang", F.lit("none"))).alias("gold_kind"), "n_chars")
    return readers.gold(x, ["kind", "n_chars", "missing"]).select("doc_id", "kind", "n_chars", "missing")


@query("""SELECT s_name AS city, CASE s_suppkey % 3 WHEN 0 THEN '待验证' WHEN 1 THEN '验证' ELSE '失效' END AS status, concat('http://c/', s_suppkey) AS list_url FROM supplier""")
def channel_catalog(spark, d):
    """Channels written as JSON lines and read with their fixed columns and checked status."""
    k = F.col("s_suppkey")
    path = new_path(spark, "json")
    table(spark, d, "supplier").select(F.col("s_name").alias("city"), F.concat(F.lit("http://c/"), k.cast("string")).alias("list_url"), pick(k, "待验证", "验证", "失效").alias("status"), F.lit("x").alias("unknown_key")).write.json(path)
    return readers.catalog(spark, path).select("city", "status", "list_url")


# ---- small rules (B14, B15, B21, B25, G6, G9, G29, G32, D16, D17, D18) -------------------------------------------------------------------------

FLAG_DATES = ("2024-01-01", "2024-05-06", "1900-01-01", "soon", "", "2024-13-40")


@query(f"""WITH x AS (SELECT doc_id, {pick_sql('doc_id', *quoted(FLAG_DATES))} AS d, CASE WHEN doc_id % 5 = 0 THEN '2024-05-06T01:02' ELSE '2024-01-01 10:00' END AS f, concat('P_', CASE WHEN doc_id % 4 = 0 THEN '1900' ELSE '2020' END, '_X_', doc_id) AS pid FROM documents)
SELECT doc_id, concat_ws(',', CASE WHEN d LIKE '%-01-01' THEN 'A_first_of_january' END, CASE WHEN d <> '' AND d = substr(f, 1, 10) THEN 'B_fetch_day' END, CASE WHEN try_cast(nullif(d, '') AS DATE) IS NULL THEN 'C_unparsable' END, CASE WHEN d LIKE '1900%' THEN 'D_year_1900' END) AS flags, pid LIKE 'P_1900%' AS placeholder FROM x""")
def placeholder_flags(spark, d):
    """Overlapping flags of dates that may be made up, and ids of the year 1900."""
    k = F.col("doc_id")
    x = table(spark, d, "documents").select("doc_id", pick(k, *FLAG_DATES).alias("d"), F.when(k % 5 == 0, "2024-05-06T01:02").otherwise("2024-01-01 10:00").alias("f"), F.concat(F.lit("P_"), F.when(k % 4 == 0, "1900").otherwise("2020"), F.lit("_X_"), k.cast("string")).alias("pid"))
    return x.select("doc_id", F.array_join(dates.placeholder_flags(F.col("d"), F.col("f")), ",").alias("flags"), filters.placeholder_ids(F.col("pid")).alias("placeholder"))


@query(r"""WITH x AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN concat('%PDF-1.4 ', text) WHEN 1 THEN concat(repeat(chr(57344), 60), text) WHEN 2 THEN concat(text, chr(65533)) WHEN 3 THEN '' ELSE text END AS b FROM documents), s AS (SELECT doc_id, coalesce(b, '') AS b, substr(coalesce(b, ''), 1, 1000) AS s FROM x)
SELECT doc_id, trim(b) = '' OR NOT (contains(substr(b, 1, 500), '%PDF-') OR contains(substr(b, 1, 500), chr(65533))) AND length(regexp_replace(s, '[^\p{L}\p{M}\p{N}\p{P}\p{S}\p{Zs}\s]', '', 'g')) / greatest(length(s), 1) >= 0.96 AS readable FROM s""")
def readable_bodies(spark, d):
    """Binary remains, private characters and replacement marks; only what stands early counts."""
    k, t = F.col("doc_id"), F.col("text")
    b = F.when(k % 6 == 0, F.concat(F.lit("%PDF-1.4 "), t)).when(k % 6 == 1, F.concat(F.lit("" * 60), t)).when(k % 6 == 2, F.concat(t, F.lit("�"))).when(k % 6 == 3, "").otherwise(t)
    return table(spark, d, "documents").select("doc_id", T.readable(b).alias("readable"))


@query("""WITH x AS (SELECT doc_id, concat(CASE WHEN doc_id % 2 = 0 THEN concat('见《', left(regexp_replace(split_part(coalesce(text, ''), chr(10), 1), '[《》]', '', 'g'), 40), '》') ELSE '' END, '和《充电设施建设办法》、《短》', CASE WHEN doc_id % 3 = 0 THEN '《充电设施建设办法》' ELSE '' END) AS t FROM documents)
SELECT doc_id, array_to_string(list_distinct(regexp_extract_all(t, '《([^》]{4,80})》', 1)), '|') AS refs FROM x WHERE doc_id % 2 = 1 UNION ALL SELECT doc_id, concat_ws('|', nullif(regexp_extract(t, '^见《([^》]{4,80})》', 1), ''), '充电设施建设办法') FROM x WHERE doc_id % 2 = 0""")
def quoted_references(spark, d):
    """Titles in title marks of four characters or more, first appearances in order."""
    k = F.col("doc_id")
    t = F.concat(F.when(k % 2 == 0, F.concat(F.lit("见《"), F.substring(F.regexp_replace(first_line("text"), "[《》]", ""), 1, 40), F.lit("》"))).otherwise(""), F.lit("和《充电设施建设办法》、《短》"), F.when(k % 3 == 0, "《充电设施建设办法》").otherwise(""))
    return table(spark, d, "documents").select("doc_id", F.array_join(T.references(t), "|").alias("refs"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN concat(c_name, '、', c_mktsegment) WHEN 1 THEN c_mktsegment ELSE '' END AS flat, CASE WHEN c_custkey % 5 = 0 THEN '国家|000000|全国' WHEN c_custkey % 5 = 1 THEN concat('省|', 11 + c_nationkey, '0000|', c_name) WHEN c_custkey % 5 = 2 THEN concat('市|', 11 + c_nationkey, '0100|', c_name) WHEN c_custkey % 5 = 3 THEN '国家|000000|全国' ELSE '||' END AS region FROM customer""")
def flat_lists(spark, d):
    """Lists of names as one string; the region from a code's shape or a national issuer."""
    k = F.col("c_custkey")
    names = F.when(k % 4 == 0, F.array(F.concat(F.lit(" "), "c_name"), F.lit("  "), F.col("c_mktsegment"), F.lit(None))).when(k % 4 == 1, F.array(F.lit(""), F.col("c_mktsegment"))).when(k % 4 == 2, F.array().cast("array<string>"))
    code = (F.col("c_nationkey") + 11).cast("string")
    r = identity.infer_region(F.when(k % 5 == 3, "国务院").otherwise("某处"), F.when(k % 5 < 3, F.col("c_name")).otherwise(""), F.when(k % 5 == 0, "000000").when(k % 5 == 1, F.concat(code, F.lit("0000"))).when(k % 5 == 2, F.concat(code, F.lit("0100"))))
    return table(spark, d, "customer").select("c_custkey", T.flat_list(names).alias("flat"), F.concat_ws("|", r["level"], r["code"], r["name"]).alias("region"))


@query("""WITH i AS (SELECT concat('N', n_nationkey) AS id, n_nationkey AS k, n_regionkey AS r FROM nation UNION ALL SELECT 'N3', 3, 0),
a AS (SELECT lower(trim(x)) AS key, id, k % 6 = 0 AS theme FROM i, unnest([concat(' Region', r), CASE WHEN k % 5 = 0 THEN 'solo' ELSE ' ' END]) AS u(x) WHERE trim(x) <> ''), g AS (SELECT key, list_sort(list_distinct(list(id))) AS ids, bool_or(theme) AS theme FROM a GROUP BY key)
SELECT 'repeated_id' AS problem, id AS key, id AS ids FROM i GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'alias_conflict', key, array_to_string(ids, ',') FROM g WHERE len(ids) > 1 AND NOT theme UNION ALL SELECT 'missing_label', id, id FROM i WHERE k % 8 = 1""")
def vocabulary_problems(spark, d):
    """Repeated ids, aliases of several ids none of which is a theme, and missing labels."""
    k = F.col("n_nationkey")
    n = table(spark, d, "nation").select(k, "n_regionkey").unionByName(spark.range(1).select(F.lit(3).cast("long").alias("n_nationkey"), F.lit(0).cast("long").alias("n_regionkey")))
    items = n.select(F.concat(F.lit("N"), k.cast("string")).alias("id"), F.when(k % 6 == 0, "theme").otherwise("line").alias("kind"), F.array(F.concat(F.lit(" Region"), F.col("n_regionkey").cast("string")), F.when(k % 5 == 0, "solo").otherwise(" ")).alias("aliases"), F.when(k % 8 == 1, " ").otherwise("x").alias("label"))
    return monitoring.vocabulary_report(items).select("problem", "key", F.array_join("ids", ",").alias("ids"))


@query("""SELECT 'shrunk' AS gate, concat('new result has ', count(*) FILTER (o_orderkey % 2 = 0), ' rows, less than 0.8 of ', count(*)) AS reason FROM orders UNION ALL SELECT 'empty', 'new result is empty' UNION ALL SELECT 'open', '' UNION ALL SELECT 'repeated', concat(count(*) - count(DISTINCT o_custkey), ' repeated keys') FROM orders UNION ALL SELECT 'number', concat(count(*), ' rows, expected 7') FROM orders UNION ALL SELECT 'unique', ''""")
def gate_reasons(spark, d):
    """What the gates say of a result that shrinks, is empty, repeats a key or has another number of rows."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    said = {"shrunk": monitoring.shrink_gate(o.where("o_orderkey % 2 = 0"), o), "empty": monitoring.shrink_gate(o.limit(0), o), "open": monitoring.shrink_gate(o, o), "repeated": monitoring.unique_gate(o, "o_custkey"), "number": monitoring.unique_gate(o, "o_orderkey", 7), "unique": monitoring.unique_gate(o, "o_orderkey")}
    return spark.createDataFrame([(k, v or "") for k, v in said.items()], "gate string, reason string")


# ---- audits (H1, H2, G31, G35, D14, B12) ------------------------------------------------------------------------------------------------------

CANONICAL = {"NEA": "国家能源局", "MOF": "财政部", "X": "别处"}
KEYWORDS = {"MOF": ("财政",)}
AUDIT_TITLES = ("招标公告", "一个通知", "国际能源网 消息")
AUDIT_ISSUERS = ("国家能源局", "财政厅", "某集团", "别的局")


def audit_docs(spark, d):
    k = F.col("doc_id")
    pid = F.concat(F.lit("P_"), F.when(k % 9 == 0, "1900").otherwise("2020"), F.lit("_"), pick(k, "NEA", "MOF", "X"), F.lit("_"), k.cast("string"))
    return table(spark, d, "documents").select(pid.alias("doc_id"), F.concat(F.lit("http://"), pick(k, "a.gov.cn", "www.sohu.com", "elsewhere.example"), F.lit("/"), (k % 200).cast("string")).alias("url"), pick(k, *AUDIT_TITLES).alias("title"), F.array(pick(k, *AUDIT_ISSUERS)).alias("issuer"), F.lit("").alias("official_number"), F.lit("").alias("date"), F.array().cast("array<string>").alias("aliases"), k.alias("pos"))


AUDIT_SQL = f"""x AS (SELECT doc_id AS k, concat('P_', CASE WHEN doc_id % 9 = 0 THEN '1900' ELSE '2020' END, '_', {pick_sql('doc_id', *quoted(['NEA', 'MOF', 'X']))}, '_', doc_id) AS id, doc_id % 3 AS h, concat({pick_sql('doc_id', *quoted(['a.gov.cn', 'www.sohu.com', 'elsewhere.example']))}, '/', doc_id % 200) AS u, {pick_sql('doc_id', *quoted(AUDIT_TITLES))} AS title, {pick_sql('doc_id', *quoted(AUDIT_ISSUERS))} AS issuer FROM documents)"""


@query(f"""WITH RECURSIVE {AUDIT_SQL}, e AS (SELECT x.id AS a, m AS b FROM x JOIN (SELECT u, arg_min(id, k) AS m FROM x GROUP BY u) y ON x.u = y.u WHERE x.id <> m UNION SELECT x.id, m FROM x JOIN (SELECT title, arg_min(id, k) AS m FROM x GROUP BY title) y ON x.title = y.title WHERE x.id <> m), both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(n, root) AS (SELECT a, a FROM both_ways UNION SELECT b.b, r.root FROM r JOIN both_ways b ON r.n = b.a), g AS (SELECT n AS id, min(root) AS keep FROM r GROUP BY n)
SELECT 'non_policy' AS "check", id AS doc_id, concat_ws(',', CASE WHEN h = 1 THEN 'domain_blacklist' END, CASE WHEN title LIKE '国际%' THEN 'title_pattern:国际\\w{{1,4}}网' WHEN title = '招标公告' THEN 'non_policy_title:招标公告' END, CASE WHEN issuer = '某集团' THEN 'issuer_unknown' END) AS detail FROM x WHERE h = 1 OR title <> '一个通知'
UNION ALL SELECT 'id_issuer', id, CASE WHEN contains(id, '_NEA_') THEN '国家能源局' WHEN contains(id, '_MOF_') THEN '财政部' ELSE '别处' END FROM x WHERE NOT (contains(id, '_NEA_') AND issuer = '国家能源局' OR contains(id, '_MOF_') AND issuer = '财政厅')
UNION ALL SELECT 'dedup', id, keep FROM g WHERE id <> keep UNION ALL SELECT 'placeholder_id', id, '' FROM x WHERE id LIKE 'P_1900%'""".replace("\\\\w", "\\w"))
def corpus_findings(spark, d):
    """H1: news, issuer mismatches, duplicates by URL and title, and placeholder ids of the whole corpus."""
    return jobs.corpus_audit(audit_docs(spark, d), CANONICAL, KEYWORDS)


@query(f"""WITH {AUDIT_SQL}, a AS (SELECT *, CASE k % 5 WHEN 0 THEN 'archive' WHEN 1 THEN 'duplicate' WHEN 2 THEN 'remint' END AS action FROM x)
SELECT CASE WHEN action = 'remint' THEN concat('NEW_', k) ELSE id END AS doc_id, coalesce(action, 'kept') AS lane, CASE action WHEN 'remint' THEN concat(id, ' by rule') WHEN 'duplicate' THEN 'P_0' WHEN 'archive' THEN 'rule' ELSE '' END AS detail FROM a UNION ALL SELECT id, 'manifest', concat(action, ' rule') FROM a WHERE action IS NOT NULL""")
def audit_tables(spark, d):
    """Decisions applied as tables; a new id keeps the old one as an alias and says where it comes from."""
    docs = audit_docs(spark, d)
    action = F.when(F.col("pos") % 5 == 0, "archive").when(F.col("pos") % 5 == 1, "duplicate").when(F.col("pos") % 5 == 2, "remint")
    dec = docs.withColumn("action", action).where("action IS NOT NULL").select("doc_id", "action", F.when(F.col("action") == "remint", F.concat(F.lit("NEW_"), F.col("pos").cast("string"))).otherwise("P_0").alias("target"), F.lit("rule").alias("reason"))
    t = jobs.audit_apply(docs, dec, "2026-01-01")
    lane = lambda name, as_, detail: t[name].select("doc_id", F.lit(as_).alias("lane"), detail.alias("detail"))
    return lane("kept", "kept", F.lit("")).unionByName(lane("archived", "archive", F.col("reason"))).unionByName(lane("duplicates", "duplicate", F.col("_duplicate_of"))).unionByName(lane("reminted", "remint", F.concat(F.try_element_at("audit", F.lit("id_fixed_from")), F.lit(" by "), F.try_element_at("audit", F.lit("id_fixed_method"))))).unionByName(lane("manifest", "manifest", F.concat_ws(" ", "action", "reason")))


# ---- summaries, sweeps, inventories (H15, B19, H25, H8, B31, C30) -------------------------------------------------------------------------------

_SUMMARY = lambda c, n: f"CASE WHEN trim(coalesce({c}, '')) = '' THEN '{c}_empty' END, CASE WHEN length(trim(coalesce({c}, ''))) > {n} THEN '{c}_too_long' END"


@query(f"""WITH s AS (SELECT doc_id, split_part(text, chr(10), 1) AS summary, CASE doc_id % 4 WHEN 0 THEN ' ' WHEN 1 THEN source ELSE substr(text, 1, 12 + CAST(doc_id % 30 AS INT)) END AS what, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE lang END AS why FROM documents WHERE doc_id % 3 > 0)
SELECT doc_id, concat_ws(',', {_SUMMARY('summary', 400)}, {_SUMMARY('what', 25)}, {_SUMMARY('why', 25)}) AS reasons FROM s""")
def summary_batch(spark, d):
    """New summaries, accepted or with their reasons; a third is covered already."""
    k = F.col("doc_id")
    docs = table(spark, d, "documents")
    s = docs.select("doc_id", F.substring_index("text", "\n", 1).alias("summary"), F.when(k % 4 == 0, " ").when(k % 4 == 1, F.col("source")).otherwise(F.substring("text", F.lit(1), (12 + k % 30).cast("int"))).alias("what"), F.when(k % 6 > 0, F.col("lang")).alias("why"))
    out = jobs.summary_increment(s, docs.select("doc_id"), docs.where(k % 3 == 0).select("doc_id"))
    assert out["refused"] is None
    return out["accepted"].select("doc_id", F.lit("").alias("reasons")).unionByName(out["rejected"].select("doc_id", F.array_join("reasons", ",").alias("reasons")))


@query("""WITH f AS (SELECT user_id, min(event_id) AS pos FROM events WHERE event_type = 'error' GROUP BY user_id), h AS (SELECT user_id, count(*) % 4 AS tries FROM events WHERE event_type = 'signup' GROUP BY user_id),
p AS (SELECT f.user_id, pos, coalesce(tries, 0) AS tries FROM f LEFT JOIN h ON f.user_id = h.user_id), o AS (SELECT user_id, row_number() OVER (ORDER BY pos) AS rn FROM p WHERE tries < 2), again AS (SELECT o.user_id, pos, tries FROM o JOIN p ON o.user_id = p.user_id WHERE rn <= 20),
q AS (SELECT user_id, min(event_id) AS pos, 0 AS swept FROM events WHERE event_type = 'purchase' GROUP BY user_id), a AS (SELECT coalesce(q.user_id, again.user_id) AS user_id, CASE WHEN q.user_id IS NULL THEN 'dead_letter_sweep' ELSE 'purchase' END AS trigger_ FROM q FULL JOIN again ON q.user_id = again.user_id)
SELECT 'queue' AS lane, CAST(user_id AS VARCHAR) AS pid, trigger_ AS detail FROM a UNION ALL SELECT 'archived', CAST(user_id AS VARCHAR), '' FROM p WHERE tries >= 2 UNION ALL SELECT 'left', CAST(p.user_id AS VARCHAR), '' FROM p JOIN o ON p.user_id = o.user_id WHERE rn > 20
UNION ALL SELECT 'history', CAST(coalesce(again.user_id, h.user_id) AS VARCHAR), CAST(CASE WHEN again.user_id IS NULL THEN h.tries ELSE again.tries + 1 END AS VARCHAR) FROM h FULL JOIN again ON h.user_id = again.user_id""")
def swept_queue(spark, d):
    """Dead letters back to the queue under what is waiting, given up or left, and the history after it."""
    e = table(spark, d, "events")
    pid = F.col("user_id").cast("string").alias("pid")
    dead = e.where("event_type = 'error'").select(pid, F.col("event_id").alias("pos"))
    history = e.where("event_type = 'signup'").groupBy(pid).agg((F.count("*") % 4).alias("tries"))
    queue = e.where("event_type = 'purchase'").select(pid, F.lit("purchase").alias("trigger"), F.lit("normal").alias("priority"), F.col("ts").cast("string").alias("requested_at"), F.col("event_id").alias("pos"))
    out = jobs.sweep(dead, history, queue, "2024-02-01", 2, 20)
    lane = lambda name, detail: out[name].select(F.lit(name).alias("lane"), "pid", detail.alias("detail"))
    return lane("queue", F.col("trigger")).unionByName(lane("archived", F.lit(""))).unionByName(lane("left", F.lit(""))).unionByName(lane("history", F.col("tries").cast("string")))


@query(f"""WITH {EDGES_SQL}, s AS (SELECT rel, CASE WHEN from_id IS NULL THEN 'from_empty' WHEN from_id NOT IN (SELECT node_id FROM nodes) THEN 'from_missing' END AS f, CASE WHEN to_id NOT IN (SELECT node_id FROM nodes) THEN 'to_missing' END AS t FROM edges)
SELECT 'rel' AS metric, rel AS key, count(*) AS n FROM s GROUP BY rel UNION ALL SELECT 'family', CASE WHEN rel IN {rules.HIGH_PRECISION_RELATIONS} THEN 'high_precision' WHEN rel IN {rules.SEMANTIC_RELATIONS} THEN 'semantic' ELSE 'unknown' END, count(*) FROM s GROUP BY 2 UNION ALL SELECT 'flag', f, count(*) FROM s WHERE f IS NOT NULL GROUP BY f UNION ALL SELECT 'flag', t, count(*) FROM s WHERE t IS NOT NULL GROUP BY t""")
def relation_counts(spark, d):
    """The inventory of all edges by type, family and flag."""
    return jobs.relation_inventory(edges_of(spark, d), nodes_of(spark, d).select(F.col("node_id").alias("key")))[1]


@query(f"""WITH {EDGES_SQL}, n AS (SELECT c_custkey AS key, c_name AS title FROM customer WHERE c_custkey % 3 > 0), r AS (SELECT *, row_number() OVER (PARTITION BY rel ORDER BY md5(concat(source, '#7')), source) AS rn, count(*) OVER (PARTITION BY rel) AS class_size FROM edges)
SELECT source, rel, class_size, coalesce(title, 'not found') AS from_title, 'not found' AS to_title FROM r LEFT JOIN n ON from_id = key WHERE rn <= 30""")
def sampled_edges(spark, d):
    """Thirty edges of each type with the titles of their ends, where they are known."""
    index = table(spark, d, "customer").where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("title"))
    return ranking.sample_with_titles(edges_of(spark, d), index, "rel", "source", 30).select("source", "rel", "class_size", "from_title", "to_title")


# ---- signals (H9, H10, G17, G18, G19, G14, H11, G36) --------------------------------------------------------------------------------------------

THEMES = {"vpp_theme": ["the "], "charging_infra": ["und ", "CHARGING"], "power_market": ["les "]}
COMMENT_TITLES = ("补贴政策机会", "项目落地进展", "风险提示", "一图读懂", "一般消息")
MARKET_TITLES = ("成品油价格调整通知", "设备招标公告", "项目清单公示", "首个示范", "一般消息", "一季度交易结果")
_clean = lambda c: rf"trim(regexp_replace(regexp_replace(coalesce({c}, ''), '[\x00-\x08\x0b\x0c\x0e-\x1f\x{{FFFD}}]', ' ', 'g'), '\s+', ' ', 'g'))"
_flat_roles = [(r, w) for r, words in rules.ROLE_KEYWORDS.items() for w in words]
_case = lambda text, pairs, default: "CASE " + " ".join(f"WHEN contains({text}, '{w}') THEN '{v}'" for v, w in pairs) + f" ELSE '{default}' END"
_themes = lambda text: "list_filter([" + ", ".join(f"CASE WHEN {any_sql(f'lower({text})', [x.strip().lower() for x in (t, *a)])} THEN '{t}' END" for t, a in THEMES.items()) + "], lambda x: x IS NOT NULL)"

COMMENTS_SQL = f"""c AS (SELECT doc_id, concat('c/', doc_id) AS path, {pick_sql('doc_id', *quoted(COMMENT_TITLES))} AS title, CASE WHEN doc_id % 8 = 0 THEN concat('%PDF-1.4 ', text) ELSE text END AS body FROM documents WHERE doc_id % 11 > 0 AND doc_id % 7 > 0),
t AS (SELECT *, doc_id % 8 > 0 OR text_empty AS ok FROM (SELECT *, body IS NULL AS text_empty FROM c) x), s AS (SELECT *, {_clean("concat(title, ' ', CASE WHEN ok THEN body ELSE '' END)")} AS t FROM t),
r AS (SELECT *, {_case('t', _flat_roles, 'interpretation')} AS role, {_case('t', [(w, w) for _, w in _flat_roles], '')} AS word, {_themes('t')} AS themes FROM s),
e AS (SELECT *, strpos(t, word) AS at_ FROM r)"""


def comment_docs(spark, d):
    k = F.col("doc_id")
    body = F.when(k % 8 == 0, F.concat(F.lit("%PDF-1.4 "), "text")).otherwise(F.col("text"))
    return table(spark, d, "documents").select(F.concat(F.lit("c/"), k.cast("string")).alias("path"), pick(k, *COMMENT_TITLES).alias("title"), body.alias("body"), F.when(k % 7 > 0, F.array(F.lit("P_1"))).alias("related"), (k % 11 == 0).alias("not_policy_related"))


@query(f"""WITH {COMMENTS_SQL} SELECT concat('C_', substr(sha256(path), 1, 12)) AS id, role, array_to_string(themes, ',') AS themes, CAST(CASE WHEN role <> 'interpretation' AND len(themes) > 0 THEN 0.72 WHEN role <> 'interpretation' THEN 0.62 WHEN len(themes) > 0 THEN 0.60 ELSE 0.52 END AS DOUBLE) AS confidence,
 CASE WHEN NOT ok THEN concat('正文不可读; 仅保留标题线索: ', title) WHEN word <> '' THEN substr(t, greatest(1, at_ - 45), at_ + 75 - greatest(1, at_ - 45)) ELSE substr(t, 1, 120) END AS evidence, concat_ws(',', CASE WHEN NOT ok THEN 'unreadable_body' END, CASE WHEN len(themes) = 0 THEN 'no_theme_match' END) AS reasons FROM e""")
def comment_signals(spark, d):
    """Roles by ordered keywords, themes, confidence and evidence of whole texts; unreadable bodies leave the title."""
    s = jobs.commentary_job(comment_docs(spark, d), THEMES)["signals"]
    return s.select(F.col("commentary_id").alias("id"), F.col("signal_role").alias("role"), F.array_join("theme_ids", ",").alias("themes"), "confidence", "evidence", F.array_join("queue_reasons", ",").alias("reasons"))


_KINDS = [(k, w) for k, words in rules.SIGNAL_KEYWORDS.items() for w in words]
MARKET_SQL = f"""m AS (SELECT doc_id AS k, concat('P', doc_id) AS pid, CASE WHEN doc_id % 10 = 9 THEN '' ELSE {pick_sql('doc_id', *quoted(MARKET_TITLES))} END AS title, {_clean('text')} AS body, doc_id % 4 AS region, doc_id % 13 > 0 AS known FROM documents),
n AS (SELECT * REPLACE (CASE WHEN title = '' THEN '清单' ELSE title END AS title) FROM m WHERE known),
g AS (SELECT *, CASE WHEN {_case('title', _KINDS, '')} <> '' THEN {_case('title', _KINDS, '')} ELSE {_case("concat(title, ' ', body)", _KINDS, 'unknown')} END AS kind, {_themes("concat(title, ' ', body)")} AS themes FROM n)"""


@query(f"""WITH {MARKET_SQL} SELECT pid, title, kind, array_to_string(themes, ',') AS themes, array_to_string(list_distinct(flatten(list_transform(themes, lambda x: CASE x WHEN 'charging_infra' THEN ['charging'] ELSE ['power'] END))), ',') AS lines, CASE WHEN kind = 'price_signal' THEN 'price_window' WHEN {any_sql("concat(title, ' ', body)", ('季度', 'Q1', 'Q2', 'Q3', 'Q4'))} THEN 'quarterly' WHEN kind = 'unknown' THEN 'unknown' ELSE 'point_in_time' END AS validity,
 CAST(round(least(0.55 + CASE WHEN kind <> 'unknown' THEN 0.15 ELSE 0 END + CASE WHEN len(themes) > 0 THEN 0.15 ELSE 0 END + CASE WHEN region > 1 THEN 0.05 ELSE 0 END, 0.9), 2) AS DOUBLE) AS confidence, concat_ws(',', CASE WHEN kind = 'unknown' THEN 'unknown_signal_type' END, CASE WHEN len(themes) = 0 THEN 'no_theme_match' END, CASE WHEN region <= 1 THEN 'missing_region' END) AS reasons FROM g
UNION ALL SELECT pid, '', '', '', '', '', CAST(0 AS DOUBLE), 'manifest_pid_not_found' FROM m WHERE NOT known""".replace("list_distinct(flatten(", "list_sort(list_distinct(flatten(").replace("END))), ','", "END)))), ','"))
def market_notices(spark, d):
    """Types by title first, themes, business lines, validity and confidence; ids that the index lacks are queued."""
    k = F.col("doc_id")
    x = table(spark, d, "documents")
    pid = F.concat(F.lit("P"), k.cast("string"))
    manifest = x.select(pid.alias("pid"), F.when(k % 10 == 9, "").otherwise(pick(k, *MARKET_TITLES)).alias("title"))
    region = F.struct(F.lit("市").alias("level"), F.lit("1").alias("code"), pick(k, None, "未知", "某市", "某省").alias("name"))
    docs = x.select(pid.alias("doc_id"), F.concat(F.lit("m/"), k.cast("string")).alias("path"), F.lit("清单").alias("title"), F.col("text").alias("body"), region.alias("region"), F.lit("2024-01-02").alias("date"), F.lit("http://x").alias("url"))
    index = identity.alias_index(x.where(k % 13 > 0).select(pid.alias("doc_id"), F.array().cast("array<string>").alias("aliases"), k.alias("pos")))
    out = jobs.market_job(manifest, docs, index, THEMES)
    s = out["signals"].select(F.col("source_pid").alias("pid"), "title", F.col("signal_type").alias("kind"), F.array_join("theme_ids", ",").alias("themes"), F.array_join(F.array_sort("business_lines"), ",").alias("lines"), F.col("time_validity").alias("validity"), "confidence", F.array_join("queue_reasons", ",").alias("reasons"))
    e = F.lit("")
    missing = out["queue"].where("reason = 'manifest_pid_not_found'").select(F.col("source_pid").alias("pid"), e.alias("title"), e.alias("kind"), e.alias("themes"), e.alias("lines"), e.alias("validity"), F.lit(0.0).alias("confidence"), F.col("reason").alias("reasons"))
    return s.unionByName(missing)


@query(f"""WITH {COMMENTS_SQL} SELECT concat('C_', substr(sha256(path), 1, 12)) AS id, CASE WHEN NOT ok OR len(themes) = 0 THEN path ELSE concat('vault/', path) END AS path, CASE WHEN NOT ok OR len(themes) = 0 THEN 'blocked_pending_review' ELSE 'publishable' END AS status,
 concat_ws(',', CASE WHEN len(themes) = 0 THEN 'no_theme_match' END, CASE WHEN NOT ok THEN 'unreadable_body' END) AS reasons FROM e""")
def publishable_comments(spark, d):
    """Signals with a reason in the queue are blocked, the others become rows for publishing."""
    job = jobs.commentary_job(comment_docs(spark, d), THEMES)
    none = spark.createDataFrame([], "market_signal_id string, source_pid string, current_policy_id string, raw_path string, reason string")
    out = jobs.publishable_signals(job["signals"], job["queue"], none.drop("reason"), none)
    ok = signals.publishable(out["commentary"], "vault/", "path", "commentary")
    return ok.select(F.col("commentary_id").alias("id"), "path", F.col("publish_status").alias("status"), F.lit("").alias("reasons")).unionByName(out["blocked_commentary"].select(F.col("commentary_id").alias("id"), "path", F.col("publish_status").alias("status"), F.array_join("queue_reasons", ",").alias("reasons")))


# ---- drafts (H4, B17, B18, B29, G20, G21) -------------------------------------------------------------------------------------------------------

KNOWN = ["vpp_theme", "charging_infra", "power_market"]
DRAFTS = (("vpp_theme", "charging_infra"), ("power_market_theme", "vpp_theme"), ("unknown_x", "charging_infra"), ("charging_infra", "charging_infra"), ("vpp_theme", ""))
_LIST = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
DRAFT_SQL = f"""a AS (SELECT doc_id AS k, substr(coalesce(text, ''), 1, 2000) AS head, {pick_sql('doc_id', *map(_LIST, DRAFTS))} AS raw, CASE doc_id % 3 WHEN 0 THEN '国家' WHEN 1 THEN '市' END AS level, doc_id % 5 + 1 AS d1, doc_id * 3 % 5 + 1 AS d2, doc_id * 7 % 5 + 1 AS d3, doc_id // 2 % 5 + 1 AS d4, doc_id // 5 % 5 + 1 AS d5, doc_id // 25 % 5 + 1 AS d6 FROM documents),
b AS (SELECT *, CASE k % 5 WHEN 0 THEN ['vpp_theme', 'charging_infra'] WHEN 1 THEN ['power_market', 'vpp_theme'] WHEN 2 THEN ['unknown_x', 'charging_infra'] WHEN 3 THEN ['charging_infra'] ELSE ['vpp_theme'] END AS canon, CASE WHEN k % 4 = 0 THEN 'power_market' ELSE 'vpp_theme' END AS want FROM a),
c AS (SELECT *, list_filter(canon, lambda x: x <> 'vpp_theme' OR contains(head, 'the ')) AS themes FROM b),
e AS (SELECT *, CASE WHEN contains(head, 'and ') AND list_contains(themes, 'charging_infra') THEN 'charging_infra' WHEN list_contains(themes, want) THEN want WHEN len(themes) > 0 THEN themes[1] ELSE '' END AS main, CAST(round(round(d1 * 0.4 + d2 * 0.4 + d3 * 0.2, 6)) AS INT) AS imp,
 substr('ABCD', CAST(greatest(0, least(3, CASE WHEN d4 >= 4 THEN CASE WHEN d5 >= 4 THEN 0 ELSE 1 END WHEN d5 >= 4 THEN 2 ELSE 3 END + CASE WHEN d6 >= 4 THEN -1 WHEN d6 <= 2 THEN 1 ELSE 0 END)) + 1 AS BIGINT), 1) AS act FROM c),
f AS (SELECT *, concat_ws(',', CASE WHEN NOT list_contains(themes, main) THEN 'primary_not_in_themes' END, CASE WHEN list_contains(themes, 'unknown_x') THEN 'unknown_theme' END, CASE WHEN k % 9 = 0 THEN 'impact_keys' END) AS reasons FROM e)"""


@query(f"""WITH {DRAFT_SQL} SELECT concat('P', k) AS pid, array_to_string(themes, ',') AS themes, main AS primary_theme, imp AS importance, act AS action_class, imp >= 3 OR coalesce(level = '国家', false) AS deep,
 concat_ws(',', CASE WHEN list_contains(themes, 'vpp_theme') OR list_contains(themes, 'power_market') THEN '机会' END, CASE WHEN list_contains(themes, 'charging_infra') AND imp >= 3 THEN '壁垒' END, CASE WHEN NOT (list_contains(themes, 'vpp_theme') OR list_contains(themes, 'power_market') OR list_contains(themes, 'charging_infra') AND imp >= 3) THEN '趋势' END) AS tags, reasons,
 CASE WHEN reasons <> '' THEN 'program_gate' WHEN k % 6 = 0 THEN 'judge_error' WHEN k % 6 = 1 THEN 'judge_reject' ELSE 'accepted' END AS lane FROM f""")
def theme_drafts(spark, d):
    """Drafts with canonical themes, themes without evidence taken out, scores, the program gate and a table of verdicts."""
    k = F.col("doc_id")
    x = table(spark, d, "documents")
    pid = F.concat(F.lit("P"), k.cast("string"))
    docs = x.select(pid.alias("doc_id"), F.coalesce("text", F.lit("")).alias("body"), F.struct(pick(k, "国家", "市", None).alias("level")).alias("region"))
    themes = pick(k, *[F.array(*map(F.lit, t)) for t in DRAFTS])
    scores = F.struct(*[e.cast("int").alias(f"D{i}") for i, e in enumerate((k % 5 + 1, k * 3 % 5 + 1, k * 7 % 5 + 1, F.floor(k / 2) % 5 + 1, F.floor(k / 5) % 5 + 1, F.floor(k / 25) % 5 + 1), 1)])
    impact = F.when(k % 9 == 0, F.create_map(F.lit("other"), F.lit("x"))).otherwise(F.create_map(F.lit("fuel"), F.lit("x"), F.lit("power"), F.lit("y")))
    drafts = x.select(pid.alias("pid"), themes.alias("themes"), F.when(k % 4 == 0, "power_market").otherwise("vpp_theme").alias("primary_theme"), scores.alias("scores"), impact.alias("impact"))
    verdicts = x.where(k % 6 > 0).select(pid.alias("pid"), F.when(k % 6 == 1, "reject").otherwise("accept").alias("decision"))
    ok, queue = jobs.theme_scores(docs, drafts, verdicts, KNOWN, ["fuel", "power"], {"vpp_theme": ["the "]}, ("charging_infra", ["and "]))
    cols = lambda df, lane, why: df.select("pid", F.array_join("themes", ",").alias("themes"), "primary_theme", "importance", "action_class", F.col("gate_passed_deep").alias("deep"), F.array_join("value_tags", ",").alias("tags"), why.alias("reasons"), lane.alias("lane"))
    return cols(ok, F.lit("accepted"), F.lit("")).unionByName(cols(queue, F.col("stage"), F.array_join("reasons", ",")))


# ---- not collected yet (C10) -----------------------------------------------------------------------------------------------------------------

@query(r"""WITH p AS (SELECT page_id, concat('http://r.example/', page_id % 40) AS u, concat('关于', page_id % 30, '号储能项目的管理办法') AS t FROM pages), docs AS (SELECT * FROM p WHERE page_id % 5 = 0),
l AS (SELECT p.* FROM p WHERE u NOT IN (SELECT u FROM docs) AND NOT EXISTS (SELECT 1 FROM docs WHERE contains(docs.t, p.t) OR contains(p.t, docs.t)))
SELECT min(page_id) AS ref_id FROM l GROUP BY u""")
def missing_references(spark, d):
    """References whose URL and title no document has, the first of each URL."""
    k = F.col("page_id")
    p = table(spark, d, "pages").select(k.alias("ref_id"), F.concat(F.lit("http://r.example/"), (k % 40).cast("string")).alias("url"), F.concat(F.lit("关于"), (k % 30).cast("string"), F.lit("号储能项目的管理办法")).alias("title"))
    return dedup.not_collected(p, p.where("ref_id % 5 = 0").withColumnRenamed("ref_id", "doc_id")).select("ref_id")


# ---- isolation, marking, flags (H16, H28, B16, H26, B12, B18, B25, B32, H19) -----------------------------------------------------------------------

@query("""WITH x AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat('P', c_custkey) END AS pid, CASE WHEN c_custkey % 7 = 0 THEN 'other' ELSE concat('P', c_custkey) END AS stem, c_custkey % 3 > 0 AS old, c_custkey % 2 AS keys FROM customer),
a AS (SELECT *, CASE WHEN pid = '' OR pid <> stem THEN 'manual_review' WHEN old OR keys = 1 THEN 'isolate_legacy' ELSE 'keep_current' END AS action FROM x)
SELECT k, CASE WHEN action = 'isolate_legacy' AND k % 4 = 0 THEN 'already_isolated' ELSE action END AS action, CASE WHEN action = 'manual_review' THEN CASE WHEN pid = '' THEN 'missing_pid' ELSE 'pid_filename_mismatch' END WHEN action = 'keep_current' THEN 'current_flow' ELSE concat_ws(',', CASE WHEN old THEN 'legacy_extracted_by' END, CASE WHEN old THEN 'legacy_model' END, CASE WHEN keys = 1 THEN 'deprecated_key' END, CASE WHEN keys = 1 THEN 'impact_schema_mismatch' END) END AS reasons,
 CASE WHEN action = 'manual_review' OR action = 'keep_current' THEN 'kept' WHEN k % 4 = 0 THEN 'backup' ELSE 'isolated' END AS lane FROM a""")
def isolated_rows(spark, d):
    """Derived rows kept, isolated or already in the backup by their hash; the manifest, the kept and the isolated rows together are the input."""
    k = F.col("c_custkey")
    pid = F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("P"), k.cast("string")))
    rows = table(spark, d, "customer").select(pid.alias("pid"), F.when(k % 7 == 0, "other").otherwise(F.concat(F.lit("P"), k.cast("string"))).alias("stem"), F.when(k % 3 > 0, "hand").otherwise("2b").alias("extracted_by"), F.when(k % 3 > 0, "legacy").otherwise("m").alias("extracted_model"), F.when(k % 2 == 1, F.array(F.lit("old"))).otherwise(F.array(F.lit("fuel"), F.lit("power"))).alias("impact_keys"), k.alias("k"))
    args = ("2b", ["legacy"], ["old"], ["fuel", "power"])
    backup = jobs.isolate(rows.where("k % 4 = 0"), *args)["isolated"]
    out = jobs.isolate(rows, *args, backup)
    lanes = out["kept"].select("k", "action", "reasons", F.lit("kept").alias("lane")).unionByName(out["isolated"].select("k", "action", "reasons", F.lit("isolated").alias("lane")))
    again = out["manifest"].where("action = 'already_isolated'").join(backup.select("sha256", "k"), "sha256").select("k", "action", "reasons", F.lit("backup").alias("lane"))
    return lanes.unionByName(again).select("k", "action", F.array_join("reasons", ",").alias("reasons"), "lane")


@query("""WITH x AS (SELECT o_orderkey AS id, o_custkey AS t FROM orders), m AS (SELECT t, min(id) AS keep, count(*) AS n FROM x GROUP BY t)
SELECT id AS doc_id, keep AS duplicate_of, 'same_title' AS rule, '2026-01-01' AS marked_at FROM x JOIN m ON x.t = m.t WHERE id <> keep""")
def marked_duplicates(spark, d):
    """Orders of one customer as documents of one title; all but the first name the one they repeat."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.lit(None).cast("string").alias("url"), F.lit("").alias("number"), F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("title"), F.lit("").alias("date"), F.col("o_orderkey").alias("pos"))
    m = dedup.mark_duplicates(o, "same_title", "2026-01-01")
    return m.select("doc_id", F.col("_duplicate_of").alias("duplicate_of"), F.col("_duplicate_rule").alias("rule"), F.col("_duplicate_at").cast("string").alias("marked_at"))


FLAG_TITLES = ("关于储能的通知", "招标公告：设备", "省里发布2024年度报告》", "一般消息")


@query(f"""WITH {EDGES_SQL}, x AS (SELECT source, rel, confidence, {pick_sql('from_id', *quoted(FLAG_TITLES))} AS a, {pick_sql('to_id', *quoted(FLAG_TITLES))} AS b FROM edges)
SELECT source, CASE WHEN rel = 'aligns_with' THEN 'semantic' ELSE 'high_precision' END AS family, concat_ws(',', CASE WHEN confidence < 0.05 THEN 'low_confidence' END, CASE WHEN NOT contains(a, '通知') OR NOT contains(b, '通知') THEN 'title_without_document_word' END) AS flags, coalesce(CASE WHEN contains(a, '招标公告') THEN '招标公告' WHEN regexp_matches(a, '发布.{{0,40}}报告[》(（]') THEN '发布.{{0,40}}报告[》(（]' END, '') AS endpoint FROM x""")
def flagged_edges(spark, d):
    """Families of all edges, flags on low confidence and on titles without a document word, and ends that are news."""
    e = edges_of(spark, d).withColumn("a", pick(F.col("from_id"), *FLAG_TITLES)).withColumn("b", pick(F.col("to_id"), *FLAG_TITLES))
    flags = relations.review_flags(F.col("confidence"), [F.col("a"), F.col("b")], ["通知"], 0.05)
    return e.select("source", relations.relation_family(F.col("rel")).alias("family"), F.array_join(flags, ",").alias("flags"), F.coalesce(filters.non_policy_endpoint(F.col("a")), F.lit("")).alias("endpoint"))


@query("""WITH x AS (SELECT doc_id, doc_id % 3 = 0 AS old, doc_id % 4 = 0 AS odd, doc_id % 5 = 0 AS bare, doc_id % 6 = 0 AS part FROM documents)
SELECT doc_id, NOT (odd OR bare OR part) AS ok, CAST(CASE WHEN old THEN 1 ELSE 0 END + CASE WHEN odd THEN 1 ELSE 0 END + CASE WHEN bare THEN 1 ELSE 0 END + CASE WHEN part THEN 1 ELSE 0 END AS INT) AS n, doc_id % 7 = 0 AS all_themes FROM x""")
def contract_gate(spark, d):
    """Legacy drift alone passes, other violations don't; drafts that hold all themes are warned of."""
    k = F.col("doc_id")
    fm = F.map_concat(F.create_map(F.lit("title"), F.when(k % 5 == 0, "").otherwise("t")), F.when(k % 3 == 0, F.create_map(F.lit("was"), F.lit("x"))).otherwise(F.create_map().cast("map<string,string>")), F.when(k % 4 == 0, F.create_map(F.lit("what"), F.lit("x"))).otherwise(F.create_map().cast("map<string,string>")))
    x = table(spark, d, "documents").withColumn("v", filters.contract_violations(fm, F.when(k % 6 == 0, F.array(F.lit("secret"), F.lit("body"))), ["title"], ["lang"], ["was"], ["secret"]))
    x = x.withColumn("themes", F.when(k % 7 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("a"))))
    warned = filters.distribution_warnings(x, 3).select("doc_id", F.lit(True).alias("_w"))
    return x.join(warned, "doc_id", "left").select("doc_id", filters.contract_ok(F.col("v")).alias("ok"), F.size("v").alias("n"), F.coalesce("_w", F.lit(False)).alias("all_themes"))


@query("""WITH t AS (SELECT doc_id AS k, concat('关于', doc_id % 30, '号储能项目的管理办法') AS t, concat('c/', lpad(CAST(doc_id AS VARCHAR), 8, '0')) AS path FROM documents), l AS (SELECT t, min(k) AS k, min(path) AS path FROM t WHERE k % 30 % 5 > 0 GROUP BY t)
SELECT path, t AS title, 'candidate' AS lane FROM l WHERE k % 2 = 0 UNION ALL SELECT '', CAST(count(*) AS VARCHAR), 'dropped' FROM l WHERE k % 2 = 1""")
def backfilled_references(spark, d):
    """Titles that commentary quotes and no document has, the first of each; those without a scope word around them are counted."""
    k = F.col("doc_id")
    title = F.concat(F.lit("关于"), (k % 30).cast("string"), F.lit("号储能项目的管理办法"))
    x = table(spark, d, "documents")
    com = x.select(F.concat(F.lit("c/"), F.lpad(k.cast("string"), 8, "0")).alias("path"), F.concat(F.when(k % 2 == 0, "充电设施：").otherwise("一般："), F.lit("见《"), title, F.lit("》。")).alias("text"))
    cand, dropped = jobs.backfill(com, x.where(k % 5 == 0).select("doc_id", F.lit("").alias("url"), title.alias("title")), ["充电"])
    return cand.select("path", "title", F.lit("candidate").alias("lane")).unionByName(dropped.select(F.lit("").alias("path"), F.col("dropped").cast("string").alias("title"), F.lit("dropped").alias("lane")))


# ---- numbers and issuers of a body (G7, G12) ------------------------------------------------------------------------------------------------------

_HOSTS = [*rules.ISSUER_BY_HOST, "www.elsewhere.example", "gov.cn"]


@query(f"""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN concat('根据国能发新能〔2021〕', doc_id, '号') WHEN 1 THEN concat('发改能源[2022]', doc_id, '号') WHEN 3 THEN concat('(2019)', doc_id, '号') WHEN 4 THEN concat('国能发〔2018〕', doc_id, '号') ELSE '' END AS number, {pick_sql('doc_id', *quoted([rules.ISSUER_BY_HOST.get(h) for h in _HOSTS]))} AS issuer FROM documents""")
def numbers_and_issuers(spark, d):
    """The first official number that no repeal stands around, the strict shape before the loose one, blanks taken out; the issuer of an exact host."""
    k = F.col("doc_id")
    n = k.cast("string")
    c = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y for y in x])
    head = F.when(k % 6 == 0, c("根据国能发新能〔2021〕 ", n, " 号文件。")).when(k % 6 == 1, c("废止国能发新能〔2021〕1号。现在执行，发改能源[2022]", n, "号。")).when(k % 6 == 2, c("国能发〔2020〕", n, "号同时废止。")).when(k % 6 == 3, c("x(2019)", n, "号。")).when(k % 6 == 4, c("x(2017)3号。\n", "x国能发〔2018〕", n, "号。")).otherwise("none")
    body = F.concat(head, F.lit(" " * 20), F.coalesce("text", F.lit("")))
    url = c("http://", pick(k, *_HOSTS), "/a/", n)
    return table(spark, d, "documents").select("doc_id", dates.official_number(body).alias("number"), dates.issuer_of_host(url).alias("issuer"))
