"""Readers: front-matter documents, line-numbered JSON, feeds, registries, pages, gold sets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import any_of, squeeze
from ..operators.tables import new_path
from . import schemas


def _unquote(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"""^(['"])(.*)\1$""", "$2")


def front_matter(spark: SparkSession, path: str, body_head: int | None = 2000) -> DataFrame:
    """Markdown files with a header between --- lines, by file name (A1, A2).

    Flat `key: value` pairs and `- item` lists of the header, values unquoted, nested keys as parent.child; files without a header
    are skipped. Columns: path, name, fm map<string,string>, lists map<string,array<string>>, body, body_head. All in built-in functions.
    """
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "\r\n", "\n").alias("value"))
    return parse_front_matter(raw, body_head)


def parse_front_matter(raw: DataFrame, body_head: int | None = 2000) -> DataFrame:
    """The same for rows (path, value)."""
    header = F.regexp_extract("value", r"(?s)\A---\n(.*?)\n---[ \t]*(?:\n|\z)", 1)
    d = raw.withColumn("_h", header).where(F.col("_h") != "").withColumn("body", F.regexp_replace(F.regexp_replace("value", r"(?s)\A---\n.*?\n---[ \t]*(?:\n|\z)", ""), r"\A\s+|\s+\z", ""))
    lines = F.split("_h", "\n")
    # each line with the top-level key that it stands under
    kinds = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, r"^([^\s:#-][^:]*):", 1).alias("top"), F.regexp_extract(x, r"^\s+([^\s:#-][^:]*):\s*\S", 1).alias("sub"), F.regexp_extract(x, r"^\s*-\s+(.*)$", 1).alias("item"), F.regexp_extract(x, r"^\s*[^:]*:\s*(.*)$", 1).alias("value")))
    under = F.aggregate(
        kinds,
        F.expr("cast(array() as array<struct<key:string,top:string,sub:string,item:string,value:string>>)"),
        lambda acc, x: F.concat(acc, F.array(F.struct(F.when(x["top"] != "", x["top"]).otherwise(F.coalesce(F.try_element_at(acc, F.lit(-1))["key"], F.lit(""))).alias("key"), x["top"].alias("top"), x["sub"].alias("sub"), x["item"].alias("item"), x["value"].alias("value")))),
    )
    d = d.withColumn("_l", under)
    flat = F.filter("_l", lambda x: ((x["top"] != "") | (x["sub"] != "")) & (x["value"] != "") & ~x["value"].rlike(r"^[\[{|>]"))
    pairs = F.transform(flat, lambda x: F.struct(F.when(x["top"] != "", x["top"]).otherwise(F.concat_ws(".", x["key"], x["sub"])).alias("key"), _unquote(x["value"]).alias("value")))
    inline = F.transform(F.filter("_l", lambda x: (x["top"] != "") & x["value"].rlike(r"^\[.*\]$")), lambda x: F.struct(x["key"].alias("key"), F.transform(F.filter(F.split(F.regexp_replace(x["value"], r"^\[|\]$", ""), ","), lambda y: F.trim(y) != ""), _unquote).alias("v")))
    items = F.transform(F.array_distinct(F.transform(F.filter("_l", lambda x: x["item"] != ""), lambda x: x["key"])), lambda k: F.struct(k.alias("key"), F.transform(F.filter(F.col("_l"), lambda x: (x["key"] == k) & (x["item"] != "")), lambda x: _unquote(x["item"])).alias("v")))
    last = lambda arr: F.filter(arr, lambda x, i: ~F.exists(F.slice(arr, i + 2, F.greatest(F.lit(0), F.size(arr) - i - 1)), lambda y: y["key"] == x["key"]))
    d = d.withColumn("_p", pairs)
    d = d.withColumn("fm", F.map_from_entries(last(F.col("_p")))).withColumn("lists", F.map_from_entries(F.concat(items, inline)))
    out = d.withColumn("name", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)).select("path", "name", "fm", "lists", "body")
    return out if body_head is None else out.withColumn("body_head", F.substring("body", 1, body_head))


def as_documents(raw: DataFrame) -> DataFrame:
    """Documents of front_matter rows: issuer scalar or list, url from provenance or source_url, empty strings for what is missing."""
    fm = lambda k: F.coalesce(F.try_element_at(F.col("fm"), F.lit(k)), F.lit(""))
    lists = lambda k: F.coalesce(F.try_element_at(F.col("lists"), F.lit(k)), F.when(fm(k) != "", F.array(fm(k))), F.array().cast("array<string>"))
    return raw.select(fm("id").alias("doc_id"), lists("aliases").alias("aliases"), F.when(fm("title") != "", fm("title")).otherwise(F.col("name")).alias("title"), fm("official_number").alias("official_number"), lists("issuer").alias("issuer"), fm("date").alias("date"), F.struct(fm("region.level").alias("level"), fm("region.code").alias("code"), fm("region.name").alias("name")).alias("region"), F.when(fm("provenance.url") != "", fm("provenance.url")).otherwise(fm("source_url")).alias("url"), "fm", "body", "path")


def numbered_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with line_no from 1 and the file's name (A3): blank lines are skipped but counted; a missing path gives no rows."""
    try:
        raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\n")).alias("p", "line"))
    except Exception as e:  # only a missing path is an empty table
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "file string, line_no int").select("file", "line_no", *[F.lit(None).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], schema).schema])
    rows = raw.where(F.trim("line") != "").select("file", (F.col("p") + 1).alias("line_no"), F.from_json("line", schema).alias("r"))
    return rows.select("file", "line_no", "r.*")


def _visible_copies(spark: SparkSession, path: str, prefix: str) -> str | None:
    """A folder with copies of the files of a path whose names begin with `prefix`, as shown=<name>; None if there are none."""
    jvm = spark._jvm.org.apache.hadoop.fs
    source, conf = jvm.Path(path), spark._jsc.hadoopConfiguration()
    fs = source.getFileSystem(conf)
    found = fs.globStatus(source)
    files = [f for s in found or () for f in (fs.listStatus(s.getPath()) if s.isDirectory() else [s]) if f.getPath().getName().startswith(prefix)]
    if not files:
        return None
    folder = new_path(spark, "files")
    for f in files:
        target = jvm.Path(f"{folder}/shown={f.getPath().getName()}")
        jvm.FileUtil.copy(fs, f.getPath(), target.getFileSystem(conf), target, False, conf)
    return folder


def relation_files(spark: SparkSession, path: str) -> DataFrame:
    """Edges of many files; rel falls back to the file's stem, files named _archive* are marked (A4).

    Spark's scan leaves out names that begin with an underscore, so archives are copied, file to file, to the shared folder under names that it reads.
    """
    rows = numbered_json(spark, path, schemas.EDGES)
    if (copies := _visible_copies(spark, path, "_archive")) is not None:
        rows = rows.unionByName(numbered_json(spark, f"{copies}/*", schemas.EDGES).withColumn("file", F.regexp_replace("file", "^shown=", "")))
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    return rows.withColumn("rel", F.coalesce(F.nullif(F.col("rel"), F.lit("")), stem)).withColumn("archived", F.col("file").startswith("_archive"))


def normalized_edges(rows: DataFrame, valid: Iterable[str]) -> DataFrame:
    """from_id, to_id, rel, confidence, source: rows with an empty end or type and unknown types go."""
    words = F.create_map(*[F.lit(x) for kv in {"high": "0.9", "medium": "0.7", "low": "0.5"}.items() for x in kv])
    conf = F.coalesce(F.try_element_at(words, F.lower(F.coalesce(F.col("confidence").cast("string"), F.lit("")))), F.col("confidence").cast("string"))
    out = rows.select(F.col("from").alias("from_id"), F.col("to").alias("to_id"), "rel", F.coalesce(conf.try_cast("double"), F.lit(0.0)).alias("confidence"), F.coalesce("candidate_id", "source", F.lit("")).alias("source"), F.coalesce("evidence", "judge_reason", F.lit("")).alias("evidence"))
    return out.where((F.coalesce("from_id", F.lit("")) != "") & (F.coalesce("to_id", F.lit("")) != "") & F.col("rel").isin(*valid))


def feed_items(raw: DataFrame) -> DataFrame:
    """Items of JSON feeds (A5). raw: one row per feed with an items array."""
    i = raw.select(F.explode("items").alias("i"))
    ident = F.coalesce(F.col("i.id"), F.col("i.url"), F.lit(""))
    account = F.coalesce(F.nullif(F.try_element_at(F.col("i.authors"), F.lit(1))["name"], F.lit("")), F.nullif(F.col("i.author.name"), F.lit("")), F.nullif(F.col("i.author_name"), F.lit("")), F.lit(""))
    return i.select(F.element_at(F.split(F.regexp_replace(ident, r"[/?#]+$", ""), "/"), -1).alias("item_id"), F.coalesce("i.url", F.lit("")).alias("url"), F.coalesce("i.title", F.lit("")).alias("title"), F.coalesce("i.content_html", "i.content_text", F.lit("")).alias("content"), F.substring(F.coalesce(F.nullif(F.col("i.date_published"), F.lit("")), F.col("i.date_modified"), F.lit("")), 1, 10).alias("date"), account.alias("account"))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    return feed_items(spark.read.schema(schemas.FEED).json(path, multiLine=True))


def alias_terms(registry: DataFrame) -> DataFrame:
    """(term, theme_ids): inverted index of labels and aliases, lower-cased."""
    t = registry.select("theme_id", F.explode(F.array_compact(F.concat(F.array("theme_id", "label"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("term")).where(F.trim("term") != "")
    return t.groupBy(F.lower(F.trim("term")).alias("term")).agg(F.array_sort(F.collect_set("theme_id")).alias("theme_ids"))


def last_per_domain(registry: DataFrame) -> DataFrame:
    """The last row of each domain."""
    w = Window.partitionBy(F.lower("domain")).orderBy(F.desc("pos"))
    return registry.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn").withColumn("domain", F.lower("domain"))


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """Channels with checked status (A8); unknown ones raise when read."""
    d = spark.read.schema(schemas.CHANNELS).json(path)
    ok = F.col("status").isin(*schemas.CHANNEL_STATUS)
    return d.withColumn("status", F.when(ok, F.col("status")).otherwise(F.raise_error(F.concat(F.lit("unknown channel status: "), F.coalesce("status", F.lit("null"))))))


def page_items(pages: DataFrame, keywords: Iterable[str] | None, base_col: str = "url", html_col: str = "html", id_col: str = "page_id", date: str = r"(20\d{2})[-/.年](\d{1,2})[-/.月](\d{1,2})") -> DataFrame:
    """(page_id, pos, title, url, date_hint): anchors of stored pages.

    Titles of 5 to 200 characters with a keyword (None: all); no javascript, fragment or mail links; relative links resolved against the page; each url once a page; the date is looked for
    in the 200 characters behind the anchor's own text.
    """
    anchors = F.regexp_extract_all(F.coalesce(html_col, F.lit("")), F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"'][^\"']*[\"'][^>]*>.*?</a>[^<]{0,200}"), F.lit(0))
    d = pages.select(id_col, F.col(base_col).alias("_base"), F.posexplode(anchors).alias("pos", "_a"))
    href = F.regexp_extract("_a", r"(?is)href\s*=\s*[\"']([^\"']*)[\"']", 1)
    text = squeeze(F.regexp_replace(F.regexp_extract("_a", r"(?is)^<a\s[^>]*>(.*?)</a>", 1), r"(?s)<[^>]*>", ""))
    d = d.withColumn("href", F.trim(href)).withColumn("title", text).where(F.length("title").between(5, 200) & ~F.col("href").rlike(r"^(?i)(javascript:|#|mailto:)"))
    if keywords is not None:
        d = d.where(any_of(F.col("title"), keywords))
    origin, folder = F.regexp_extract("_base", r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1), F.regexp_replace(F.regexp_extract("_base", r"^([^?#]*)", 1), r"(?<=[^/:]/)[^/]*$|(?<=//)$", "")
    scheme = F.regexp_extract("_base", r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    rel = F.regexp_replace("href", r"^(\./)+", "")
    url = F.when(F.col("href").rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.col("href")).when(F.col("href").startswith("//"), F.concat(scheme, F.col("href"))).when(F.col("href").startswith("/"), F.concat(origin, F.col("href"))).when(F.col("href") == "", F.col("_base")).otherwise(F.concat(folder, rel))
    hint = F.when(F.regexp_extract("_a", date, 1) != "", F.concat_ws("-", F.regexp_extract("_a", date, 1), F.lpad(F.regexp_extract("_a", date, 2), 2, "0"), F.lpad(F.regexp_extract("_a", date, 3), 2, "0"))).otherwise(F.lit(""))
    d = d.withColumn("url", url).withColumn("date_hint", hint)
    w = Window.partitionBy(id_col, "url").orderBy("pos")
    return d.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(id_col, "pos", "title", "url", "date_hint")


def table_rows(text: DataFrame, text_col: str = "text") -> DataFrame:
    """(domain, name): rows of pipe tables inside texts, headers skipped, the last name of a domain."""
    lines = text.select(F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"))
    d = lines.select("pos", F.lower(F.regexp_extract("line", r"\|\s*`?((?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,})`?\s*\|", 1)).alias("domain"), F.trim(F.regexp_extract("line", r"\|\s*`?(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}`?\s*\|\s*([^|]+?)\s*\|", 1)).alias("name")).where("domain <> '' AND name <> ''")
    return d.groupBy("domain").agg(F.max_by("name", "pos").alias("name"))


def gold(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows with each column from gold_<column> where there is one, else from the plain column."""
    out = rows
    for c in columns:
        have = [x for x in (f"gold_{c}", c) if x in rows.columns]
        out = out.withColumn(c, F.coalesce(*have) if have else F.lit(None).cast("string"))
    return out.drop(*[f"gold_{c}" for c in columns])
