"""The pipeline's stages over rows that repeat a doc_id or have none."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import jaccard, line_dedup, suffix_dedup
from corpusmill.llm.common import materialize, row_hash

from .fixtures import WORDS, documents

r = random.Random(8)
say = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
LINE = "this line stands in three documents of the corpus"
TEXTS = [(i, say(60)) for i in range(20)] + [(20, say(60)), (20, say(60)), (None, say(60)), (None, say(60))]
STAGES = dict(corpus_pipeline.STAGES)


def run(spark, name, rows):
    docs = materialize(documents(spark, [(i, t, "en", "s") for i, t in rows]))
    return collections.Counter((x.doc_id, x.text) for x in STAGES[name](spark, docs, "").collect())


def test_quality_judges_each_row(spark):
    assert run(spark, "quality_rules", [*TEXTS, (0, "too short"), (None, "short too")]) == collections.Counter(TEXTS)


def test_line_dedup_cuts_each_row_by_itself(spark):
    rows = [(1, f"{LINE}\nfirst"), (2, f"a line of document two, alone\nb"), (2, f"{LINE}\nsecond"), (None, f"{LINE}\nnone"), (3, f"{LINE}\nthird")]
    assert run(spark, "line_dedup", rows) == collections.Counter([(1, "first"), (2, "a line of document two, alone\nb"), (2, "second"), (None, "none"), (3, f"{LINE}\nthird")])


def test_near_duplicates_keep_one_row_of_a_group(spark):
    a, b = TEXTS[0][1], TEXTS[1][1]
    assert run(spark, "near_duplicates", [(1, a), (1, a), (None, a), (2, TEXTS[2][1]), (2, TEXTS[3][1]), (None, b), (None, b)]) == collections.Counter([(1, a), (2, TEXTS[2][1]), (2, TEXTS[3][1]), (None, b)])


def test_mix_takes_what_it_computed(spark):
    got = run(spark, "source_mix", TEXTS)
    assert max(got.values()) <= 2 and sum(got.values()) * 60 <= 1.5 * 60 * len(TEXTS) + 60
    assert all(got[x] for x in TEXTS)


def test_lines_of_rows_that_repeat_an_id(spark):
    """Distinct ids count, each row loses its own lines, and the SQL agrees where rows are put together by id."""
    hot = "a line of thirty-two characters!"
    rows = [(1, f"{hot}\nunique"), (1, f"other\n{hot}"), (2, hot)]
    cut = lambda x: collections.Counter((r.doc_id, r.text, r.n_dropped) for r in line_dedup.drop_repeated_lines(documents(spark, [(i, t, "en", "s") for i, t in x])).collect())
    assert cut(rows) == collections.Counter((i, t, 0) for i, t in rows)
    assert cut([*rows, (3, hot), (3, f"b\n{hot}")]) == collections.Counter([(1, "unique", 1), (1, "other", 1), (2, "", 1), (3, hot, 0), (3, f"b\n{hot}", 0)])


def test_line_columns_with_clashing_names(spark):
    docs = documents(spark, [(i, f"{LINE}\n{i}", "en", "s") for i in range(4)])
    for name in ("_drops", "_id", "_row", "_at", "_own", "_in", "row", "keeper"):
        docs = docs.withColumn(name, line_dedup.F.lit("x"))
    got = line_dedup.drop_repeated_lines(docs).collect()
    assert {r.doc_id: r.text for r in got} == {0: "0", 1: "1", 2: "2", 3: f"{LINE}\n3"} and all(r["_drops"] == "x" for r in got)


def test_jaccard_of_rows_that_repeat_an_id(spark):
    a, b, c = say(50), say(50), say(50)
    rows = [(5, a), (5, b), (3, b), (None, a), (None, c), (9, c), (9, c), (7, ""), (7, None)]
    got = collections.Counter((r.doc_id, r.component_id, r.first) for r in jaccard.jaccard_rows(documents(spark, [(i, t, "en", "s") for i, t in rows])).collect())
    assert got == collections.Counter([(5, 5, True), (5, 3, False), (3, 3, True), (None, 5, False), (None, 9, False), (9, 9, True), (9, 9, True), (7, 7, True), (7, 7, True)])


@pytest.mark.parametrize("hot", [5000, 1])
def test_repeats_of_rows_that_repeat_an_id(spark, monkeypatch, hot):
    """Rows of one id with other texts are texts of their own (in order of a hash); nothing is cut out of the wrong row."""
    monkeypatch.setattr(suffix_dedup, "BUFFER_BYTES", 700)
    shared = [say(40) for _ in range(4)]
    texts = [(i % 6, f"{say(8)} {shared[i % 4]} {say(3 + i % 5)}") for i in range(24)]
    texts += [(3, shared[0] * 3), (3, "short"), (None, shared[1]), (None, shared[1]), (5, None), (5, ""), texts[0], texts[0]]
    got = suffix_dedup.remove_repeats(documents(spark, [(i, t, "en", "s") for i, t in texts]), hot=hot).collect()
    order = {r.text: r.row for r in documents(spark, [(i, t, "en", "s") for i, t in texts]).select("text", row_hash("text").alias("row")).collect()}
    seen, want = set(), collections.Counter([(None, shared[1].encode())] * 2)
    last = None
    for i, _, t in sorted((i, order[t], t or "") for i, t in texts if i is not None):
        raw = t.encode()
        gone = [False] * len(raw)
        if (i, t) != last:
            cut = []
            for p in range(len(raw) - 99):
                if raw[p : p + 100] in seen:
                    gone[p : p + 100] = [True] * 100
                seen.add(raw[p : p + 100])
            last, cut = (i, t), bytes(b for b, g in zip(raw, gone) if not g)
        want[i, cut] += 1
    assert collections.Counter((r.doc_id, bytes(r.kept)) for r in got) == want
