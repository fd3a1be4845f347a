"""The pipeline's stages against brute force, each on its own input."""

import collections

import corpus_pipeline
from corpusmill.llm.common import materialize

from .fixtures import documents, passages
from .test_operators import jaccard_brute, lines_brute, measures_brute, rows_of


def test_stages(spark):
    docs = materialize(documents(spark))
    texts = lambda df: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    as_rows = lambda df: [(i, t) for i, t in sorted(texts(df).items())]
    by_name = dict(corpus_pipeline.STAGES)

    kept = materialize(by_name["quality_rules"](spark, docs, ""))
    for i, t, _, _ in passages():
        n, _, _, _, repeats = measures_brute(t)
        if n < 20 or 100 * repeats > 30 * n:
            assert i not in texts(kept)
    assert set(range(12)) <= set(texts(kept))

    lines = materialize(by_name["line_dedup"](spark, kept, ""))
    want = lines_brute(as_rows(kept))
    assert texts(lines) == {i: t for i, (_, _, t) in want.items() if t.split()}

    single = materialize(by_name["near_duplicates"](spark, lines, ""))
    parts = jaccard_brute(as_rows(lines), 5, 80)
    assert set(texts(single)) == {i for i, (_, c) in parts.items() if i == c}

    mixed = materialize(by_name["source_mix"](spark, single, ""))
    assert mixed.columns == corpus_pipeline.COLUMNS
    times = collections.Counter(r.doc_id for r in mixed.collect())
    assert set(times) <= set(texts(single)) and max(times.values()) <= 2

    packed = by_name["best_fit_packing"](spark, mixed, "").collect()
    pieces = collections.Counter(r.doc_id for r in packed if r.piece == 0)
    assert pieces == times


def test_run_is_the_stages_in_order(spark, tmp_path):
    documents(spark).select(*corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    once = {(r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert once and once == {(r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert rows_of(corpus_pipeline.run(spark, str(tmp_path)))
