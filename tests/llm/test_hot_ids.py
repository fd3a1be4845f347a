"""Ids that very many rows share, and results recomputed from their definitions."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import mixing, packing, quality, suffix_dedup

from .fixtures import WORDS, documents

r = random.Random(21)
say = lambda n: " ".join(r.choice(WORDS) for _ in range(n))


def test_repeats_of_ten_thousand_rows_of_one_id(spark):
    """Each row loses its own repeats: texts of one id are ordered by their hash, and no row's spans are cut out of another."""
    shared = [say(30) for _ in range(50)]
    rows = [(5, f"{say(3)} {shared[k % 50]} {k}") for k in range(10_000)] + [(1, shared[0]), (9, shared[1])]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    order = {x.text: x.row for x in docs.select("text", suffix_dedup.row_hash("text").alias("row")).collect()}
    seen, want = set(), collections.Counter()
    for i, t in sorted(rows, key=lambda x: (x[0], order[x[1]])):
        raw = t.encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = [True] * 100
            seen.add(raw[p : p + 100])
        want[i, bytes(b for b, g in zip(raw, gone) if not g)] += 1
    assert collections.Counter((x.doc_id, bytes(x.kept)) for x in suffix_dedup.remove_repeats(docs).collect()) == want


def test_texts_whose_hashes_agree_in_32_bits(spark):
    """Two texts of one id whose row hashes share their upper half stay apart."""
    low = spark.range(400_000).select(F.concat(F.lit("text number "), F.col("id"), F.lit(" of many, long enough to hold a whole span of one hundred bytes, which is more than some")).alias("text"))
    halves = low.select("text", F.shiftright(suffix_dedup.row_hash("text"), 32).alias("h"))
    a, b = halves.groupBy("h").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b").select("a", "b").first()
    shared = say(60)
    rows = [(1, shared), (3, a), (3, b), (4, a + shared), (7, b)]
    got = {(x.doc_id, x.n_bytes, x.n_removed) for x in suffix_dedup.remove_repeats(documents(spark, [(i, t, "en", "s") for i, t in rows])).collect()}
    assert (4, len(a + shared), len(a + shared)) in got and (7, len(b), len(b)) in got and (1, len(shared), 0) in got


def test_cells_stay_bounded_when_rows_share_an_id(spark, monkeypatch):
    monkeypatch.setattr(packing, "SAME", 10)
    monkeypatch.setattr(packing, "GENERATIONS", 2)
    rows = [(7, 0, 1 + k % 90, k) for k in range(5_000)] + [(None, 0, 5, k) for k in range(300)] + [(k, 0, 30, k) for k in range(40)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long, tag long").repartition(4)
    out = packing.pack(pieces, 100, cell_pieces=100).collect()
    assert collections.Counter((x.doc_id, x.piece, x.length, x.tag) for x in out) == collections.Counter(rows)
    per_cell = collections.Counter(x.sequence_id >> 24 for x in out)
    assert len(per_cell) > 40 and max(per_cell.values()) < 200
    bins = collections.defaultdict(list)
    for x in out:
        bins[x.sequence_id].append((x.offset, x.length))
    for b in bins.values():
        ends = [0]
        for at, n in sorted(b):
            assert at == ends[-1]
            ends.append(at + n)
        assert ends[-1] <= 100


@pytest.mark.parametrize("fan", [2, 1024])
def test_prefix_sums_in_levels(spark, fan):
    blocks = [(s, h, b, p, r.randrange(1, 50)) for s in ("0", "1x") for h in (0, 1) for b in (-3, 0, 7) for p in r.sample(range(40), 11)]
    keys = ["_src", "_half", "_band", "_part"]
    got = {tuple(x)[:4]: x._before for x in mixing.block_starts(spark.createDataFrame(blocks, "_src string, _half int, _band int, _part long, _n long"), keys, fan).collect()}
    want = {}
    for s in ("0", "1x"):
        total = 0
        for x in sorted(b for b in blocks if b[0] == s):
            want[x[:4]] = total
            total += x[4]
    assert got == want


def test_copies_recomputed(spark):
    """Ranks, offset and crossings by hand; only the hashes are Spark's."""
    rows = [(k if k % 9 else None, say(1 + k * k % 60), "en", ("a", "b", None)[k % 3]) for k in range(500)] + [(3, say(4), "en", "a")] * 40
    docs = documents(spark, rows)
    seed, block = 17, 25
    out = mixing.mix_sources(docs, block_rows=block).collect()
    told = docs.select("doc_id", "source", F.size(F.split("text", " ")).alias("size"), mixing.row_hash("text").alias("told"))
    h = told.select("*", F.pmod(F.xxhash64("doc_id", F.lit(seed), F.lit("half")), F.lit(2)).alias("half"), F.xxhash64("doc_id", "told", F.lit(seed)).alias("h"), F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.lit(seed), F.col("source").isNull()), F.lit(1 << 40)).alias("o")).collect()
    size_of = collections.Counter()
    n_of = collections.Counter(x.source for x in h)
    for x in h:
        size_of[x.source] += x.size
    weight, cap = {"a": 3, "b": 1, None: 2}, {s: 2 * n for s, n in size_of.items()}
    left, open_, target = 1.5 * sum(size_of.values()), {"a", "b", None}, {}
    while open_:
        each = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * each >= cap[s]}
        for s in full or open_:
            target[s] = cap[s] if full else weight[s] * each
            left -= target[s]
        open_ -= full or open_
    want = collections.Counter()
    for s in n_of:
        parts = max(1, -(-n_of[s] // block))
        sign = lambda x: 1 if x.half == 0 else -1
        order = sorted((x for x in h if x.source == s), key=lambda x: (x.half, sign(x) * math.floor(math.log2(x.size + 1) * 4), x.h % parts, x.size * sign(x), x.h, (x.doc_id is not None, x.doc_id or 0)))
        rate, offset = target[s] / size_of[s], order[0].o / (1 << 40)
        for k, x in enumerate(order):
            copies = math.floor((k + 1) * rate + offset) - math.floor(k * rate + offset)
            want[x.doc_id, x.source, x.size, copies] += 1
    assert collections.Counter((x.doc_id, x.source, x.size, x.copies) for x in out) == want


def test_kept_recomputed_from_exact_quantiles(spark):
    """Fences from exact order statistics give the same verdicts, but for values within the sketch's error of a fence; having symbols at all is what goes."""
    rows = []
    for k in range(700):
        words = [r.choice(WORDS) for _ in range(r.randrange(30, 120))]
        if k % 13 == 0:
            words = [w + "$$" if j % 3 == 0 else w for j, w in enumerate(words)]
        if k % 50 == 7:
            words = [w.upper() for w in words]
        rows.append((k, " ".join(words), "en", ("s", "t")[k % 2]))
    out = quality.judge_quality(documents(spark, rows), keep=["doc_id", "lang", "source"]).collect()
    value = {
        "symbols": lambda x: x.n_symbols / max(1, x.word_chars), "repeats": lambda x: x.n_repeat_words / x.n_words, "dup_lines": lambda x: x.n_dup_lines / max(1, x.n_lines),
        "shout": lambda x: x.n_shout / x.n_words, "word_length": lambda x: x.word_chars / x.n_words,
    }
    checked = 0
    for s in ("s", "t"):
        own = [x for x in out if x.source == s and not x.base_failed]
        at = lambda v, q: sorted(v)[max(0, math.ceil(len(v) * q) - 1)]
        fence = {}
        for m, (upper, lower, spread, least) in quality.FENCES.items():
            v = [value[m](x) for x in own]
            fence[m] = at(v, upper) + max(spread * (at(v, upper) - at(v, lower)), least)
        some = [value["symbols"](x) for x in own if x.n_symbols]
        assert sum(not x.n_symbols for x in own) > len(own) / 2 and at(some, 0.05) * at([x.word_chars for x in own], 0.5) > quality.DENSE
        fence["symbols"] = at(some, 0.05) / quality.MARGIN
        for x in own:
            over = [value[m](x) > fence[m] for m in fence]
            if all(abs(value[m](x) - fence[m]) > 0.06 * max(fence[m], 0.02) for m in fence):
                checked += 1
                assert x.kept == (not any(over)), (x, fence)
    assert checked > 600 and {x.doc_id for x in out if x.n_symbols and x.kept} == set()


def test_chance_symbols_stay(spark):
    """A symbol here and there sets no text apart."""
    rows = [(k, say(80) + (" &" if k % 5 == 0 else ""), "en", "s") for k in range(600)]
    out = quality.judge_quality(documents(spark, rows)).collect()
    assert np.mean([x.kept for x in out]) > 0.99
