"""Rounds and key joins against plain versions: the greedy cap of candidates, and containment."""

import random

import pytest

from corpusmill.functions import rules
from corpusmill.operators import relations

SCHEMA = "from_id long, to_id long, primary_theme string, pos long, rel string, sim double, tags array<string>"


def capped(rows, top_k):
    """One row after the other, by theme, place of the source and falling similarity."""
    rank = {r: k for k, r in enumerate(rules.SEMANTIC_RELATIONS)}
    asked, ends, pairs, out = {}, {}, set(), []
    for a, b, theme, _, rel, sim, _ in sorted(rows, key=lambda r: (r[2], r[3] is None, r[3] or 0, r[0], -r[5], r[1], rank[r[4]])):
        symmetric, pair = rel == "aligns_with", (theme, *sorted((a, b)))
        if asked.get((theme, a), 0) == top_k or symmetric and (pair in pairs or max(ends.get((theme, a), 0), ends.get((theme, b), 0)) == top_k):
            continue
        asked[theme, a] = asked.get((theme, a), 0) + 1
        if symmetric:
            pairs.add(pair)
            for x in (a, b):
                ends[theme, x] = ends.get((theme, x), 0) + 1
        out.append((*(sorted((a, b)) if symmetric else (a, b)), rel, sim, theme))
    return sorted(out)


@pytest.mark.parametrize("top_k", [1, 3, 8])
def test_capped_candidates(spark, top_k):
    rng, rows = random.Random(top_k), []
    for theme, n in (("x", 30), ("y", 6)):
        for a in range(n):
            for b in range(n):
                if a != b and rng.random() < 0.8:
                    rows.append((a, b, theme, None if a == 3 else a // 2, rng.choice(["aligns_with", "aligns_with", "iterates", "derives_from"]), rng.choice([1.0, 1.2, 1.5]), ["t"]))
    rows += rng.sample(rows, 20)  # repeated rows
    got = relations.cap_candidates(spark.createDataFrame(rows, SCHEMA).repartition(5), top_k).collect()
    assert sorted((r.from_id, r.to_id, r.rel, r.sim, r.primary_theme) for r in got) == capped(rows, top_k)
    assert relations.cap_candidates(spark.createDataFrame([], SCHEMA), top_k).count() == 0


def test_contained_parts(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab号15〔") for _ in range(rng.randrange(0, 400))) for _ in range(60)] + ["", None, "b", "国发〔2023〕15号" * 2]
    parts = ["a", "号", "ab", "15号", "国发〔2023〕15号", "nowhere at all in any of them", ""]
    for t in texts[:40]:
        if len(t) > 40:
            k = rng.randrange(0, len(t) - 40)
            parts.append(t[k : k + rng.choice([2, 3, 5, 9, 20, 40])])
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, body string")
    found = relations.contained(docs, spark.createDataFrame([(p,) for p in parts], "part string"), "id", "body", "part")
    got = {(r.id, r.part) for r in found.collect()}
    want = {(k, p) for k, t in enumerate(texts) if t for p in parts if p and p in t}
    assert want <= got and not any(p.startswith("nowhere") for _, p in got)
    assert relations.contained(docs, spark.createDataFrame([], "part string"), "id", "body", "part").count() == 0


def themed_views(spark):
    rng, rows = random.Random(9), []
    for k in range(45):
        title = None if k == 5 else "".join(rng.choice("abcdé标题文字") for _ in range(rng.randrange(0, 9))) + rng.choice(("", "", "推广"))
        rows.append((k // 2 if k < 6 else k, title, rng.choice(("省", "市", "县", None)), rng.choice(("r", "q", None)), rng.choice(("i", "j", "", None)), rng.choice((2001, 2002, 2004, 2006, None)), rng.choice(("x", "x", "y", "", None)), None if k % 17 == 0 else k // 3))
    basis = [(rng.randrange(45), rng.randrange(45)) for _ in range(150)]
    return spark.createDataFrame(rows, "doc_id long, title string, region_level string, region_name string, issuer string, year int, primary_theme string, pos long").repartition(3), spark.createDataFrame([*basis, (1, None)], "from_id long, to_id long")


@pytest.mark.parametrize("top_k", [1, 8])
def test_capped_pairs_are_the_capped_candidates(spark, top_k):
    views, basis = themed_views(spark)
    rows = lambda df: sorted((r.from_id, r.to_id, r.rel, r.sim, tuple(r.tags), r.primary_theme) for r in df.collect())
    got = rows(relations.capped_pairs(views, basis, top_k))
    assert got == rows(relations.cap_candidates(relations.semantic_pairs(views, basis), top_k)) and (top_k == 1 or {r[2] for r in got} == set(rules.SEMANTIC_RELATIONS))
    assert rows(relations.capped_pairs(views.limit(0), basis, top_k)) == []


def test_capped_queries_make_no_table_of_pairs(spark, monkeypatch):
    """pairs of a theme were made and shuffled, once more for each round."""
    monkeypatch.setattr(relations, "semantic_pairs", None)
    from corpusmill.plans.queries import QUERIES

    for name in ("semantic_candidates_capped", "judged_relations"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").columns


def test_semantic_pairs_are_never_shuffled(spark):
    """the look-up of known bases put every pair through a shuffle; now only the documents are."""
    views, basis = themed_views(spark)
    plan = relations.semantic_pairs(views, basis).select("from_id", "to_id", "rel")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2  # near years, and bases
