"""Queries that take texts whole and all rows, on small tables of their own."""

from pathlib import Path

from pyspark.sql import functions as F

from corpusmill.functions import dates
from corpusmill.operators import dedup, relations
from corpusmill.plans.job_queries import one_file_a_row
from corpusmill.plans.queries import QUERIES, views_of
from corpusmill.sources import sinks

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, path, texts):
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], DOCS).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_date_candidates_read_the_whole_text(spark, tmp_path):
    """The query adds three dates to each text (a fourth to every third); the text's own ones count wherever they stand."""
    d = documents(spark, tmp_path, [(1, "x " * 400 + "国家能源局 2022年3月15日"), (2, "no date"), (3, None)])
    got = {r.doc_id: (r.n, r.issued) for r in QUERIES["date_candidates"](spark, d).collect()}
    assert got == {1: (4, "2001-02-02"), 2: (3, "2002-03-03"), 3: (4, "2023-10-24")}
    own = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", dates.date_candidates("text").alias("c"))
    assert {r.doc_id: r.issued for r in own.select("doc_id", dates.issuance_date(F.col("c")).alias("issued")).collect()} == {1: "2022-03-15", 2: "", 3: ""}


def test_title_matches_take_all_rows_and_whole_titles(spark, tmp_path):
    long = "A rather long title of one document, which goes on and on far behind its sixtieth character"
    titles = {1: long, 2: f"Notes on: {long}", 3: f"{long[:70]} but ends otherwise", 4: "Short title", 6: "Our Short title", 7: None}
    d = documents(spark, tmp_path, [(k, None if t is None else f"{t}\nbody") for k, t in titles.items()])
    bare = lambda x: x.replace(" ", "")
    names = {k: bare((t[3:15], f"关于{t}的答复", t[:30])[k % 3]) for k, t in titles.items() if t}
    want = {}
    for k, q in names.items():
        hits = [(abs(len(q) - len(bare(t))), i) for i, t in titles.items() if t and len(q) >= 6 and (q in bare(t) or len(bare(t)) >= 10 and bare(t) in q)]
        want |= {k: min(hits)[1]} if hits else {}
    got = {r.query_id: r.doc_id for r in QUERIES["title_matches"](spark, d).collect()}
    assert got == want and want[1] == 1 and want[6] == 4


def test_match_titles_against_brute_force(spark):
    import random

    r = random.Random(5)
    texts = ["".join(r.choice("ab") for _ in range(r.choice((5, 6, 9, 10, 23, 24, 25, 60)))) for _ in range(60)]
    texts += [t[3:] for t in texts] + ["zz" + t for t in texts] + texts[:9]
    names = texts[::2] + [t[1:31] for t in texts]
    want = {}
    for k, q in enumerate(names):
        hits = [(abs(len(q) - len(t)), i) for i, t in enumerate(texts) if t and len(q) >= 6 and (q in t or len(t) >= 10 and t in q)]
        if hits:
            want[k] = min(hits)[1]
    q = spark.createDataFrame(list(enumerate(names)), "query_id long, name string")
    t = spark.createDataFrame(list(enumerate(texts)), "doc_id long, title string")
    assert {x.query_id: x.doc_id for x in dedup.match_titles(q, t).collect()} == want


def test_whole_views(spark, tmp_path):
    d = documents(spark, tmp_path, [(1, "short"), (2, "a first line of far more than twenty-four characters\nand a second"), (3, None)])
    assert {r.doc_id: r.title for r in views_of(spark, d, whole=True).collect()} == {1: "short", 2: "a first line of far more than twenty-four characters", 3: ""}


def test_semantic_candidates_capped_take_short_texts(spark, tmp_path):
    rows = [(1, "short", "en", "s", 5), (81, "brief", "en", "t", 5)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert [(r.from_id, r.to_id, r.rel) for r in QUERIES["semantic_candidates_capped"](spark, str(tmp_path)).collect()] == [(1, 81, "aligns_with")]


def test_greedy_batch_filter_takes_the_whole_heading(spark, tmp_path):
    rows = [(1, "http://a/1", "<h1>One heading of many words: first</h1>"), (2, "http://a/2", "<h1>One heading of many words: second</h1>"), (3, "http://a/3", "<h1>One heading of many words: first</h1>"), (4, "http://a/4", "<h1>never closed")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.row_id: r.kept for r in QUERIES["greedy_batch_filter"](spark, str(tmp_path)).collect()} == {1: True, 2: True, 3: False, 4: True}


def test_relation_files_grow_with_the_edges(spark, tmp_path):
    """all edges of a type were written by one task."""
    rows = [("hub", f"n{k}", "references" if k % 4 else "clarifies") for k in range(200)]
    sinks.write_by_relation(spark.createDataFrame(rows, "from_id string, to_id string, rel string"), f"{tmp_path}/r", rows=10)
    assert len(list(tmp_path.glob("r/rel=references/*.json"))) > 4
    back = spark.read.schema("from_id string, to_id string, rel string").json(f"{tmp_path}/r")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_files_of_rows_stand_in_one_folder(spark):
    """a folder was made for each row."""
    path = one_file_a_row(spark.range(30).selectExpr("id", "concat('a\\n', id) AS value"), "id")
    assert sorted(f.read_text() for f in Path(path).glob("*.txt")) == sorted(f"a\n{k}\n" for k in range(30))


def test_contained_with_a_crowded_bitmap(spark, monkeypatch):
    """keys of the texts that no part has went into the join; the bitmap that stops them may let some pass, and loses none."""
    texts, parts = [f"text {k} of the many words {k * k}" for k in range(50)], [f"{k * k}" for k in range(50)] + [f"{k} of the many words {k * k}" for k in range(50)]
    docs, p = spark.createDataFrame(list(enumerate(texts)), "id long, body string"), spark.createDataFrame([(x,) for x in parts], "part string")
    want = {(k, x) for k, t in enumerate(texts) for x in parts if x in t}
    for cells in (64, relations.KEY_CELLS):
        monkeypatch.setattr(relations, "KEY_CELLS", cells)
        assert want <= {(r.id, r.part) for r in relations.contained(docs, p, "id", "body", "part").collect()}


def test_candidates_share_more_than_words(spark):
    """Names and titles made of the same few words: candidates are those that contain a name, not all that share a piece of it."""
    words = ["abcdefgh", "ijklmnop", "qrstuvwx", "yzabcdef", "ghijklmn"]
    titles = [(k, "".join(words[k * p % 5] for p in (1, 2, 3, 7, 11, 13)) + f"{k:04}") for k in range(400)]
    names = [f"{words[k % 5]}{k:04}" for k in range(400)]
    got = {(r.id, r.part) for r in relations.contained(spark.createDataFrame(titles, "id long, body string"), spark.createDataFrame([(n,) for n in names], "part string"), "id", "body", "part").collect()}
    want = {(i, n) for i, t in titles for n in names if n in t}
    assert want <= got and len(got) <= len(want) + 5  # thousands before
