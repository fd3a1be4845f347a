"""The rules of the operators on small inline tables."""

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import dates, scoring
from corpusmill.functions import text as T
from corpusmill.operators import context, dedup, filters, identity, incremental, monitoring, ranking, relations, signals, tables
from corpusmill.plans import jobs
from corpusmill.sources import readers, sinks
from corpusmill.streaming import streams


def one(spark, value, schema="s string"):
    return spark.createDataFrame([value if isinstance(value, tuple) else (value,)], schema)


def eval_(spark, s, f):
    return one(spark, s).select(f(F.col("s")).alias("v")).first().v


@pytest.mark.parametrize(("url", "want"), [
    ("HTTP://A.Gov.CN/x/?b=2&a=1&utm_source=z#f", "http://a.gov.cn/x?a=1&b=2"), ("https://a.cn/p/", "https://a.cn/p"), ("https://a.cn/v?id=7", "https://a.cn/v?id=7"),
    ("https://a.cn/v?id=8&from=x", "https://a.cn/v?id=8"), (None, ""), ("", ""), ("https://a.cn/?q=a%20b&e", "https://a.cn?e=&q=a+b"), ("https://a.cn/?q=%zz", "https://a.cn?q=%25zz"),
])
def test_normalize_url(spark, url, want):
    assert eval_(spark, url, T.normalize_url) == want


def test_normalize_number_and_title(spark):
    assert eval_(spark, "国能发〔2023〕 15 号", T.normalize_number) == "国能发202315"
    assert eval_(spark, "《关于 A 的通知》（试行）", T.normalize_title) == "关于a的通知试行"
    assert eval_(spark, None, T.normalize_title) == "" and eval_(spark, "", lambda c: T.short_hash(c)) == ""


def test_roles_and_signals(spark):
    assert eval_(spark, "项目推进中存在风险", T.role_of).role == "risk"
    assert eval_(spark, "普通文字", T.role_of).role == "interpretation"
    assert eval_(spark, "关于招标的公告", lambda c: T.signal_type_of(c, F.lit("调价"))) == "tender_procurement"
    assert eval_(spark, "x", lambda c: T.signal_type_of(c, F.lit("调价"))) == "price_signal"
    assert eval_(spark, "About V2G here", lambda c: T.themes_of(c, {"zz": ["yy"], "bb": ["v2g"], "v2g": []})) == ["bb", "v2g"]
    assert eval_(spark, "x", lambda c: T.lines_of(F.array(F.lit("v2g"), F.lit("power_market"), F.lit("none")))) == ["charging", "power"]


def test_readable_and_html(spark):
    assert eval_(spark, "", T.readable) and eval_(spark, "正常的正文 text", T.readable)
    assert not eval_(spark, "%PDF-1.4 xx", T.readable) and not eval_(spark, "ab\x01\x02\x03\x04", T.readable)
    html = "<html><script>x<y</script><nav>menu</nav><p>Body &amp; more</p><footer>f</footer></html>"
    assert eval_(spark, html, lambda c: T.strip_html(c, 1)) == "Body & more" and eval_(spark, html, T.strip_html) is None


def test_windows(spark):
    assert eval_(spark, "前言前言 根据 某某", T.window_from_anchor) == "根据 某某"
    assert eval_(spark, "abc", T.window_from_anchor) == "abc"
    assert eval_(spark, "x" * 100 + "KEY" + "y" * 100, lambda c: T.window_at_keyword(c, F.lit("KEY"))) == "x" * 45 + "KEY" + "y" * 72
    assert eval_(spark, "标题文字", lambda c: T.char_jaccard(c, F.lit("标题"))) == 0.5


@pytest.mark.parametrize(("text", "issued", "strict"), [
    ("自2023年9月1日起施行。国家能源局 2023年8月15日", "2023-08-15", "2023-08-15"), ("有效期至2025年12月31日", "", ""), ("二〇二三年九月十五日", "2023-09-15", "2023-09-15"), ("二〇二三年九月", "2023-09-01", "2023-09-01"),
    ("采集时间 2024-01-02", "", ""), ("浏览 2024-01-02 次", "2024-01-02", ""), ("请于2023年5月1日前报送", "", ""), ("2023年13月1日", "", ""),
])
def test_dates(spark, text, issued, strict):
    d = one(spark, text).withColumn("c", dates.date_candidates("s")).select(dates.issuance_date(F.col("c")).alias("a"), dates.strict_issuance_date(F.col("c")).alias("b")).first()
    assert (d.a, d.b) == (issued, strict)


def test_date_columns(spark):
    assert eval_(spark, "二〇二三", dates.cn_year) == 2023 and eval_(spark, "二〇二", dates.cn_year) is None
    assert [eval_(spark, s, dates.cn_month_day) for s in ("十", "十五", "二十", "二十八", "九", "x")] == [10, 15, 20, 28, 9, None]
    assert eval_(spark, "http://a/2023/08/15/x.html", dates.date_from_url).date == "2023-08-15"
    assert eval_(spark, "http://a/202308/t20230815_1.html", dates.date_from_url).method == "url_compact"
    assert eval_(spark, "http://a/t20231340_1.html", dates.date_from_url).date is None
    assert eval_(spark, "《旧办法》（国发〔2010〕5号）同时废止。以下为本件正文的编号，供各单位查阅：国能发〔2023〕15号", dates.official_number) == "国能发〔2023〕15号"
    assert eval_(spark, "http://www.ndrc.gov.cn/x", dates.issuer_of_host) == "国家发展和改革委员会"
    f = spark.createDataFrame([("2023-01-01", "2023-01-01T10:00"), ("1900-05-02", ""), ("bad", "")], "d string, f string").select(dates.placeholder_flags(F.col("d"), F.col("f")).alias("v")).collect()
    assert [len(r.v) for r in f] == [2, 1, 1]


def test_scoring(spark):
    rows = [(5, 5, 5, 5, 5, 5), (3, 3, 3, 4, 1, 3), (1, 1, 1, 1, 1, 1), (4, 3, 2, 1, 4, 2)]
    d = spark.createDataFrame([(r,) for r in rows], "s struct<D1:int,D2:int,D3:int,D4:int,D5:int,D6:int>").select(scoring.importance(F.col("s")).alias("i"), scoring.action_class(F.col("s")).alias("a")).collect()
    assert [(r.i, r.a) for r in d] == [(5, "A"), (3, "B"), (1, "D"), (3, "D")]
    assert eval_(spark, "x", lambda c: scoring.value_tags(F.lit(4), F.array(F.lit("v2g"), F.lit("charging_infra")))) == ["机会", "壁垒"]
    assert eval_(spark, "x", lambda c: scoring.value_tags(F.lit(2), F.array())) == ["趋势"]
    assert eval_(spark, "x", lambda c: scoring.canonical_themes(F.array(F.lit("v2g_theme"), F.lit("v2g"), F.lit(""), F.lit("other")), ["v2g"])) == ["v2g", "other"]


def test_filters(spark):
    u, t = "https://news.sohu.com/a", "某某通知"
    r = spark.createDataFrame([(u, t, None), ("https://x.gov.cn/a", t, None), ("https://x.gov.cn/a", "某市中标公告", "某某局"), ("https://x.gov.cn/a", "发布2023年度报告》", "某局"), ("https://x.gov.cn/a", t, "某某委")], "u string, t string, i string")
    got = [x.r for x in r.select(filters.news_reasons(F.col("u"), F.col("t"), F.col("i")).alias("r")).collect()]
    assert got[0] == ["domain_blacklist", "issuer_unknown"] and got[1] == ["issuer_unknown_but_gov_domain"] and got[2] == ["non_policy_title:中标公告"] and got[3][0].startswith("non_policy_title:") and got[4] == []
    c = [eval_(spark, s, filters.ingest_class).disposition for s in ("公司招聘启事", "某项目100MW储能中标", "某公司IPO过会", "政策分析")]
    assert c == ["skip_junk", "market_intel", "market_intel", "ingest"]
    d = spark.createDataFrame([("1", "https://x.gov.cn/a", "某某通知"), ("2", "https://x.gov.cn/a", "政策解读"), ("3", "https://sohu.com/a", "x"), ("4", "https://x.gov.cn/a", "工作动态"), ("5", "https://x.gov.cn/a", "工作动态"), ("6", "https://x.gov.cn/a", "工作动态")], "ref string, url string, title string")
    v = spark.createDataFrame([("4", "non_policy_news", 0.5), ("5", "non_policy_news", 0.9)], "ref string, label string, confidence double")
    assert {x.ref: x.action for x in filters.gate(d, v).collect()} == {"1": "pass", "2": "commentary", "3": "reject", "4": "review_queue", "5": "reject", "6": "review_queue"}
    assert {x.action for x in filters.gate(d).where("ref >= '4'").collect()} == {"pass"}
    with pytest.raises(ValueError):
        filters.since(F.col("x"), "2024-1")
    v = eval_(spark, "x", lambda c: filters.contract_violations(F.create_map(F.lit("id"), F.lit("1"), F.lit("old"), F.lit("1"), F.lit("bad"), F.lit("1")), F.array(F.lit("摘要")), ["id", "title"], ["date"], ["old"], ["摘要"]))
    assert {(x.kind, x.name) for x in v} == {("missing", "title"), ("unexpected", "bad"), ("legacy", "old"), ("forbidden_section", "摘要")}
    assert eval_(spark, "https://a.cn/search?q=1", filters.policy_url) is False and eval_(spark, "https://a.cn/zc/1.html", filters.policy_url)


def test_greedy_batch_keeps_chains(spark):
    rows = [(1, "http://a/1", "T one", 1), (2, "http://a/2", "T one", 2), (3, "http://a/2", "T three", 3), (4, "http://a/4", "T four", 4), (5, "http://a/1", "T five", 5)]
    got = {r.row_id: r.kept for r in dedup.greedy_batch(spark.createDataFrame(rows, "row_id long, url string, title string, pos long")).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: False}


def test_duplicate_groups(spark):
    rows = [("a", "http://x/1/", "", "标题", "2023-02-01", 1), ("b", "http://x/1", "", "另外", "2023-01-01", 2), ("c", "", "国发〔2020〕1号", "同题", "2023-01-01", 3), ("d", "", "国发〔2020〕2号", "同题", "2023-01-01", 4), ("e", "", "", "同题", "2022-01-01", 5), ("f", "http://x/v?id=1", "", "", "", 6), ("g", "http://x/v?id=2", "", "", "", 7)]
    got = {r.doc_id: r.keep_id for r in dedup.duplicate_groups(spark.createDataFrame(rows, "doc_id string, url string, number string, title string, date string, pos long")).collect()}
    assert got == {"a": "b", "b": "b", "c": "c", "e": "c"}


def test_match_titles(spark):
    q = spark.createDataFrame([(1, "《新型储能项目管理规范》"), (2, "短名"), (3, "关于印发新型储能项目管理规范（试行）的通知全文解读")], "query_id long, name string")
    t = spark.createDataFrame([("p1", "新型储能项目管理规范（试行）"), ("p2", "关于新型储能项目管理规范的补充通知"), ("p3", "储能")], "doc_id string, title string")
    assert {r.query_id: r.doc_id for r in dedup.match_titles(q, t).collect()} == {1: "p1", 3: "p1"}


def test_citations(spark):
    docs = spark.createDataFrame([("a", "实施细则", "根据 国能发〔2020〕15号 制定。原国发〔2010〕9号同时废止"), ("b", "办法", "无关"), ("c", "旧", "x")], "doc_id string, title string, body string")
    numbers = spark.createDataFrame([("b", "国能发〔2020〕15号"), ("c", "国发〔2010〕9号"), ("a", "国能发〔2020〕15号")], "doc_id string, number string")
    plain = {(r.from_id, r.to_id, r.rel) for r in relations.citations(docs, numbers).collect()}
    core = F.regexp_extract("number", r"((?:19|20)\d{2}[〕\])]\d+号)", 1)
    assert plain == {(r.from_id, r.to_id, r.rel) for r in relations.citations(docs, numbers, core).collect()}
    assert ("a", "b", "cites_basis") in plain and ("a", "c", "supersedes") in plain and ("a", "b", "clarifies") in plain and not any(x[0] == x[1] for x in plain)


def views(spark, n=21):
    rows = [(f"d{i:02d}", f"标题{i}", "省", f"r{i}", f"i{i}", 2020, "t", i) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id string, title string, region_level string, region_name string, issuer string, year int, primary_theme string, pos long")


def test_semantic_candidates(spark):
    none = spark.createDataFrame([], "from_id string, to_id string")
    got = relations.cap_candidates(relations.semantic_pairs(views(spark), none), 8).collect()
    degree = {}
    for r in got:
        assert r.rel == "aligns_with" and r.from_id < r.to_id
        for x in (r.from_id, r.to_id):
            degree[x] = degree.get(x, 0) + 1
    assert len({(r.from_id, r.to_id) for r in got}) == len(got) and max(degree.values()) <= 8
    two = spark.createDataFrame([("a", "旧", "市", "r", "i", 2019, "t", 1), ("b", "推广新", "省", "r", "i", 2021, "t", 2), ("c", "远", "省", "r", "i", 2033, "t", 3)], views(spark).schema)
    basis = spark.createDataFrame([("a", "b")], "from_id string, to_id string")
    assert {(r.from_id, r.to_id, r.rel) for r in relations.semantic_pairs(two, basis).collect()} == {("a", "b", "iterates"), ("a", "b", "extends"), ("a", "b", "derives_from")}


def test_relations(spark):
    e = spark.createDataFrame([("a", "b", "references", 0.5, "s1"), ("a", "b", "references", 0.9, "s2"), ("a", "x", "references", 0.9, "s3"), ("b", "a", "odd", 0.9, "s4"), ("b", "a", "cites_basis", 0.4, "s5")], "from_id string, to_id string, rel string, confidence double, source string")
    nodes = spark.createDataFrame([("a",), ("b",)], "node_id string")
    v = jobs.relation_views(e.limit(0), e, nodes)
    assert {(r.from_id, r.to_id, r.rel, r.source) for r in v["edges"].collect()} == {("a", "b", "references", "s2"), ("b", "a", "cites_basis", "s5")}
    assert v["counts"].first().asDict() == {"read": 5, "invalid": 1, "dangling": 1, "duplicates": 1}
    d = {r.node_id: r for r in relations.relation_degrees(e).collect()}
    assert d["a"].references_out == 3 and d["b"].references_in == 2 and d["a"].other_rel_counts == {"odd": 1} and d["a"].candidate_ids == ["s1", "s2", "s3", "s4", "s5"]
    c = spark.createDataFrame([("a", "b", "iterates", "accept"), ("b", "a", "extends", "accept"), ("a", "c", "iterates", "accept"), ("c", "a", "iterates", "accept"), ("a", "b", "aligns_with", "accept")], "from_id string, to_id string, rel string, decision string")
    assert sorted(r.rel for r in relations.demote_contradictions(c).where("decision = 'manual_review'").collect()) == ["extends", "iterates"]


def test_contexts(spark):
    c = spark.createDataFrame([(f"c{i}", "risk" if i < 2 else "attention", ["p1"], ["t1", "t1"], i) for i in range(3)], "signal_id string, role string, doc_ids array<string>, theme_ids array<string>, pos long")
    m = spark.createDataFrame([("m1", "price_signal", "p2", ["p2", "p1"], ["t2"], "110000", "北京市", ["power"], 1), ("m2", None, "p2", [], ["t2"], "440000", "广州市", ["fuel"], 2), ("m3", "x", "p2", [], [], "", "", [], 3)], "signal_id string, signal_type string, current_id string, doc_ids array<string>, theme_ids array<string>, region_code string, region_name string, business_lines array<string>, pos long")
    d = {r.doc_id: r for r in context.document_context(c, m).collect()}
    assert d["p1"].attention_level == "high" and d["p1"].market_signal_count == 1 and d["p1"].certainty_adjustment == "neutral" and "market_validation_weak" in d["p1"].internal_notes
    assert d["p2"].certainty_adjustment == "raise" and d["p2"].validation_level == "strong" and d["p2"].market_signal_types == {"price_signal": 1, "unknown": 1, "x": 1}
    t = {r.theme_id: r for r in context.theme_context(c, m).collect()}
    assert t["t1"].commentary_signal_count == 6 and t["t1"].dominant_commentary_roles == ["risk", "attention"] and t["t1"].coverage_warning == "commentary_only"
    r, unknown = context.region_context(m)
    assert {x.region_code: x.region_warnings for x in r.collect()} == {"110000": [], "440000": ["province_code_with_city_name"]} and unknown.first()[0] == 1
    with pytest.raises(ValueError):
        jobs.signal_context(c, m, spark.createDataFrame([("c1",)], "signal_id string"))


def test_signal_jobs(spark):
    docs = spark.createDataFrame([("p/a.md", "储能风险", "储能 项目存在风险", ["P_1"], False), ("p/b.md", "无", "%PDF-1", ["P_1"], False), ("p/c.md", "x", "y", [], False), ("p/d.md", "x", "y", ["P_1"], True)], "path string, title string, body string, related array<string>, not_policy_related boolean")
    out = jobs.commentary_job(docs, {"energy_storage_theme": ["储能"]})
    s = {r.path: r for r in out["signals"].collect()}
    assert s["p/a.md"].signal_role == "risk" and s["p/a.md"].confidence == 0.72 and s["p/a.md"].theme_ids == ["energy_storage_theme"]
    assert {(r.path, r.reason) for r in out["queue"].collect()} == {("p/b.md", "unreadable_body"), ("p/b.md", "no_theme_match")} and out["skipped"].first().asDict() == {"unrelated": 1, "unlinked": 1}
    assert eval_(spark, "see P_2020_NEA_1 and P_2020_NEA_1, P_x", signals.related_ids) == ["P_2020_NEA_1", "P_x"]


def test_identity(spark):
    assert eval_(spark, "2023-05-01", lambda c: identity.compute_id(c, F.lit("国家能源局"), F.lit("国能发〔2023〕15号"), F.lit("t"), F.lit(None).cast("string"), F.lit(None).cast("string"))) == "P_2023_NEA_15"
    assert eval_(spark, "", lambda c: identity.compute_id(c, F.lit(None).cast("string"), F.lit(""), F.lit("t"), F.lit("440100"), F.lit("发改委"))).startswith("P_1900_GD_FGW_")
    assert eval_(spark, "广东", lambda c: identity.infer_region(F.lit(None).cast("string"), c, F.lit("440000"))).level == "省"
    req = spark.createDataFrame([(i, "P_x", i) for i in range(12)], "row_id long, base string, pos long")
    got = [r.new_id for r in identity.allocate_ids(req, spark.createDataFrame([("P_x",), ("P_x_b",)], "id string")).orderBy("row_id").collect()]
    assert got[:2] == ["P_x_a", "P_x_c"] and got.count(None) == 3
    docs = spark.createDataFrame([("P_1900_GO_ab12", "t", "http://fgw.gd.gov.cn/a", "bad", ["fgw.gd.gov.cn"], ("国家", "000000", "全国"), "广东省发展改革委", "2022-03-04", False, 1), ("P_2020_GDFGW_1", "t", "http://fgw.gd.gov.cn/b", "2020-01-02", ["广东省发改委"], ("市", "440100", "广州"), None, "", False, 2), ("P_2020_X_9", "t", "http://unknown.cn/c", "2020-01-02", ["a"], ("市", "1", "b"), None, "", False, 3)],
                                 "doc_id string, title string, url string, date string, issuer array<string>, region struct<level:string,code:string,name:string>, title_issuer string, body_date string, date_is_other boolean, pos long")
    reg = spark.createDataFrame([("fgw.gd.gov.cn", "GDFGW", "广东省发展和改革委员会", ("省", "440000", "广东省"), 1)], "domain string, issuer_short string, issuer_canonical string, region struct<level:string,code:string,name:string>, pos long")
    r = {x.doc_id: x for x in identity.resolve_identity(docs, reg, docs.select(F.col("doc_id").alias("id")), 2026).collect()}
    a = r["P_1900_GO_ab12"]
    assert a.region_fix.value.name == "广东省" and a.issuer_fix.value == ["广东省发展改革委"] and a.date_fix.value == "2022-03-04" and a.id_fix.value == "P_2022_GDFGW_ab12" and a.conflicts == []
    assert r["P_2020_GDFGW_1"].region_fix is None and r["P_2020_GDFGW_1"].id_fix is None
    assert [c.field for c in r["P_2020_X_9"].conflicts] == ["_all"]


def test_ranking(spark):
    items = spark.createDataFrame([("c", 1, "a"), ("c", 1, "b"), ("c", 2, "b"), ("c", 2, "d"), ("c", 3, None), ("c", 4, "e"), ("k", 1, "a"), *[("k", 2, x) for x in "a" * 1], ("k", 3, "z")], "channel string, page int, url string")
    assert {(r.channel, r.page, r.url) for r in ranking.page_yield(items).collect()} == {("c", 1, "a"), ("c", 1, "b"), ("c", 2, "d"), ("k", 1, "a")}
    dead = spark.createDataFrame([(f"p{i % 60:02d}", i) for i in range(120)], "pid string, pos long")
    plan = ranking.plan_sweep(dead, spark.createDataFrame([("p03", 2), ("p04", 1)], "pid string, tries long"))
    assert {r.outcome: r["count"] for r in plan.groupBy("outcome").count().collect()} == {"given_up": 1, "requeued": 50, "left": 9}
    q = spark.createDataFrame([("a", "new", "low", "1", 1), ("b", "new", "normal", "2", 2), ("a", "edit", "high", "3", 3)], "pid string, trigger string, priority string, requested_at string, pos long")
    assert [(r.pid, r.trigger, r.pos) for r in ranking.queue_order(q).collect()] == [("a", "edit", 1), ("b", "new", 2)]
    assert [r.unique_name for r in identity.numbered_names(spark.createDataFrame([("n", 1), ("n", 2), ("m", 3)], "name string, k int"), "name", "k").orderBy("k").collect()] == ["n", "n__1", "m"]


def test_monitoring(spark):
    v = spark.createDataFrame([("i", r, c, s) for r, c, s in (("a", "x", 3.0), ("b", "x", 4.0), ("c", "y", 3.0))], "item_id string, rater string, choice string, score double")
    assert monitoring.vote_consensus(v).first().asDict() == {"item_id": "i", "raters": 3, "choice": "x", "median": 3.0, "spread": 1.0, "level": "high"}
    empty = spark.createDataFrame([], "is_planted boolean, rejected boolean")
    assert monitoring.judge_score(empty).first().asDict() == {"planted": 0, "rejected": 0, "caught": 0, "recall": 0.0, "precision": 1.0}
    ten, seven = spark.range(10), spark.range(7)
    assert monitoring.shrink_gate(seven, ten) and monitoring.shrink_gate(ten.limit(0), ten) and monitoring.shrink_gate(spark.range(8), ten) is None
    assert monitoring.unique_gate(ten.union(seven), "id") and monitoring.unique_gate(ten, "id", 10) is None
    vocab = spark.createDataFrame([("a", "entity", ["X"], "l"), ("b", "entity", ["x"], "l"), ("t", "theme", ["y"], "l"), ("c", "entity", ["y"], ""), ("a", "entity", [], "l")], "id string, kind string, aliases array<string>, label string")
    assert {(r.problem, r.key) for r in monitoring.vocabulary_report(vocab).collect()} == {("repeated_id", "a"), ("alias_conflict", "x"), ("missing_label", "c")}


def test_merges(spark):
    t = spark.createDataFrame([("a", "LOW", "yes", "old"), ("b", "LOW", None, "old")], "pipeline_pid string, importance string, importance_override string, title string")
    u = spark.createDataFrame([("a", "HIGH", "new"), ("b", "HIGH", "new"), ("c", "HIGH", "new"), (None, "HIGH", "new")], "pipeline_pid string, importance string, title string")
    once = incremental.upsert_documents(t, u)
    got = {r.pipeline_pid: (r.importance, r.title) for r in once.collect()}
    assert got == {"a": ("LOW", "new"), "b": ("HIGH", "new"), "c": ("HIGH", "new")}
    assert {r.pipeline_pid: (r.importance, r.title) for r in incremental.upsert_documents(once, u).collect()} == got
    pool = spark.createDataFrame([("k1", "a", "accept"), ("k2", "b", None)], "dedupe_key string, note string, verdict string")
    new = spark.createDataFrame([("k1", "x"), ("k2", "y"), ("k3", "z")], "dedupe_key string, note string")
    assert {r.dedupe_key: r.note for r in incremental.upsert_undecided(pool, new).collect()} == {"k1": "a", "k2": "y", "k3": "z"}
    assert incremental.insert_absent(pool, new.union(new), ["dedupe_key"]).count() == 1
    docs = spark.createDataFrame([("a", "x"), ("b", "y")], "doc_id string, text string")
    first = incremental.needs_rebuild(docs, spark.createDataFrame([], "doc_id string, raw_content_hash string, pipeline_version int"), 1)
    assert first.count() == 2
    ledger = incremental.merge_ledger(spark.createDataFrame([], "doc_id string, raw_content_hash string, pipeline_version int"), first, 1)
    assert incremental.needs_rebuild(docs, ledger, 1).count() == 0 and incremental.needs_rebuild(docs, ledger, 2).count() == 2
    assert {r.node: r.component for r in tables.components(spark.createDataFrame([(1, 2), (3, 2), (9, 8)], "src long, dst long")).collect()} == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8}


def test_readers(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "one.md").write_text("---\nid: P_1\ntitle: \"标题\"\naliases:\n  - A_1\n  - A_2\nissuer: 国家能源局\nregion:\n  level: 省\n  name: 广东\nprovenance:\n  url: http://x/1\n---\n\n正文\n---\n尾", encoding="utf-8")
    (tmp_path / "d" / "two.md").write_text("no header", encoding="utf-8")
    d = readers.as_documents(readers.front_matter(spark, str(tmp_path / "d"))).collect()
    assert len(d) == 1 and d[0].doc_id == "P_1" and d[0].title == "标题" and d[0].aliases == ["A_1", "A_2"] and d[0].issuer == ["国家能源局"] and d[0].region.name == "广东" and d[0].url == "http://x/1" and d[0].body.startswith("正文")
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "references.jsonl").write_text('{"from":"a","to":"b","confidence":0.5}\n\n{"from":"a","to":"","rel":"references"}\n{"from":"b","to":"a","rel":"odd","confidence":"high"}\n', encoding="utf-8")
    rows = readers.relation_files(spark, str(tmp_path / "e"))
    assert [(r.line_no, r.rel) for r in rows.orderBy("line_no").collect()] == [(1, "references"), (3, "references"), (4, "odd")]
    assert [(r.from_id, r.confidence) for r in readers.normalized_edges(rows, ["references"]).collect()] == [("a", 0.5)]
    assert readers.numbered_json(spark, str(tmp_path / "missing"), "a string").count() == 0
    (tmp_path / "feed.json").write_text('{"items":[{"id":"https://x/y/9/","title":"t","content_html":"<p>x</p>","date_modified":"2024-02-03T01:00:00","authors":[{"name":"acc"}]}]}')
    f = readers.read_feed(spark, str(tmp_path / "feed.json")).first()
    assert (f.item_id, f.date, f.account) == ("9", "2024-02-03", "acc")
    html = '<p>2024-03-05 <a href="/zc/1.html">关于某某的通知</a></p><a href="javascript:x">关于脚本的通知</a><a href="b.html">相对链接的通知</a> 2024.1.2<a href="/zc/1.html">关于某某的通知</a>'
    i = readers.page_items(spark.createDataFrame([(1, "http://h.cn/list/index.html", html)], "page_id long, url string, html string"), ["通知"]).orderBy("pos").collect()
    assert [(r.url, r.date_hint) for r in i] == [("http://h.cn/zc/1.html", ""), ("http://h.cn/list/b.html", "2024-01-02")]
    t = readers.table_rows(spark.createDataFrame([("| 域名 | 名 |\n|---|---|\n| a.gov.cn | 甲 |\n| A.gov.cn | 乙 |",)], "text string"))
    assert [(r.domain, r.name) for r in t.collect()] == [("a.gov.cn", "乙")]


def test_sinks(spark, tmp_path):
    e = spark.createDataFrame([("b", "a", "y"), ("a", "b", "x")], "from_id string, to_id string, rel string")
    sinks.write_by_relation(e, str(tmp_path / "r"))
    assert sorted(p.name for p in (tmp_path / "r").glob("rel=*")) == ["rel=x", "rel=y"]
    spark.range(10).write.parquet(str(tmp_path / "s1"))
    spark.range(3).write.parquet(str(tmp_path / "s2"))
    assert sinks.publish(spark, str(tmp_path / "s1"), str(tmp_path / "t"), "id") == {"before": 0, "after": 10}
    with pytest.raises(ValueError):
        sinks.publish(spark, str(tmp_path / "s2"), str(tmp_path / "t"))
    for _ in range(2):
        sinks.append_absent(spark.range(5, 12), str(tmp_path / "t"), ["id"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 12


def test_streams(spark, tmp_path):
    schema = "item_id string, url string, title string, content string, date string"
    long = "正文" * 200
    spark.createDataFrame([("1", "u1", "政策", long, "2024-01-01"), ("2", "u1", "政策", long, "2024-01-02"), ("3", "u3", "公司招聘", long, "2024-01-01"), ("4", "u4", "短", "x", "2024-01-01")], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    streams.ingest_stream(stream(), str(tmp_path / "ledger"), str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    out = {r.url: (r.item_id, r.disposition) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out == {"u1": ("1", "ingest"), "u3": ("3", "skip_junk"), "u4": ("4", "retry")}
    assert {r.url for r in spark.read.parquet(str(tmp_path / "ledger")).collect()} == {"u1", "u3"}
    streams.ingest_stream(stream(), str(tmp_path / "ledger"), str(tmp_path / "again"), str(tmp_path / "c2")).awaitTermination()
    assert {r.url for r in spark.read.parquet(str(tmp_path / "again")).collect()} == {"u4"}  # what failed for the moment is tried again
    ev = spark.createDataFrame([("a", "2024-01-01 01:00:00"), ("a", "2024-01-01 02:00:00"), ("b", "2024-01-03 00:00:00")], "event_type string, t string").withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    ev.coalesce(1).write.parquet(str(tmp_path / "ev"))
    q = streams.heat_windows(spark.readStream.schema("event_type string, ts timestamp_ntz").parquet(str(tmp_path / "ev"))).writeStream.outputMode("complete").format("memory").queryName("heat").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda df: sorted((r.event_type, str(r.start), r.n, r.heat) for r in df.collect())
    assert key(spark.table("heat")) == key(streams.heat_windows(ev))
    o = streams.overlap_warning(spark.createDataFrame([("x",)], "url string"), spark.createDataFrame([("y",)], "url string")).first()
    assert o.overrun


def test_jobs(spark):
    rows = [("P_2020_NEA_1", "P_2020_NEA_1", "2b", "m", ["a"]), ("P_2", "P_3", "2b", "m", ["a"]), ("P_4", "P_4", "old", "", ["b"])]
    r = spark.createDataFrame(rows, "pid string, stem string, extracted_by string, extracted_model string, impact_keys array<string>")
    first = jobs.isolate(r, "2b", ["legacy"], ["b"], ["a"])
    assert {x.pid: x.action for x in first["manifest"].collect()} == {"P_2020_NEA_1": "keep_current", "P_2": "manual_review", "P_4": "isolate_legacy"}
    assert jobs.isolate(r, "2b", ["legacy"], ["b"], ["a"], first["isolated"])["isolated"].count() == 0
    docs = spark.createDataFrame([("a", "新型储能项目管理规范"), ("b", "《新型储能项目管理规范》政策解读")], "doc_id string, title string")
    stay, moved = jobs.route_interpretations(docs)
    assert [x.doc_id for x in stay.collect()] == ["a"] and [(x.doc_id, x.related_policy) for x in moved.collect()] == [("b", "a")]
    com = spark.createDataFrame([("c.md", "见《新型储能项目管理规范》和《充电设施建设办法》充电，另有《无关文件名称》")], "path string, text string")
    cand, dropped = jobs.backfill(com, docs.where("doc_id = 'a'").withColumn("url", F.lit("")), ["充电设施"])
    assert {x.title for x in cand.collect()} == {"充电设施建设办法", "无关文件名称"}
    assert dropped.count() == 1
    ch = spark.createDataFrame([("u1", "待验证", "", ""), ("u2", "待验证", "", ""), ("u3", "验证", "", "")], "list_url string, status string, last_probed_at string, probe_result string")
    pr = spark.createDataFrame([("u1", "ok"), ("u2", "structure_unknown")], "list_url string, verdict string")
    assert {x.list_url: (x.status, x.transition) for x in jobs.reprobe(ch, pr, "2024-01-01").collect()} == {"u1": ("验证", "promoted"), "u2": ("待验证", "ambiguous"), "u3": ("验证", "unchanged")}
    derived = spark.createDataFrame([("a", 5), ("b", 3), ("z", 2), ("d", 1)], "pid string, importance int")
    raw = spark.createDataFrame([("a", "t", "2023-01-01", "c"), ("b", "", "2023-01-01", "c"), ("d", "t", "bad", "c")], "doc_id string, title string, date string, content string")
    ok, skipped = incremental.sync_rows(derived, raw)
    assert [x.pid for x in ok.collect()] == ["a"] and {x.pid: x.reason for x in skipped.collect()} == {"b": "empty_title", "z": "raw_missing", "d": "bad_date"}


def test_dates_search_a_text_once_a_pattern(spark):
    """The text was searched anew for each of its dates, as expressions inside the functions of arrays are computed wherever they stand."""
    text = "x" * 2000 + " 2024年1月5日 和 2023-02-03 一九九八年十月" * 300
    d = one(spark, text).select(dates.date_candidates("s").alias("c"))
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") <= 2 * len(dates.DATE_PATTERNS) and plan.count("split(") <= len(dates.DATE_PATTERNS)
    assert [tuple(c) for c in d.first().c] == [tuple(c.values()) for c in dates.candidates_in(text)]
