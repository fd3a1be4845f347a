"""Every operator against a brute-force version on small documents, on an empty table, and after another partitioning."""

import collections
import hashlib
import zlib

import numpy as np
import pytest

from corpusmill.llm import embedding_dedup, jaccard, line_dedup, mixing, packing, quality, suffix_dedup, token_counts, token_files, tokens, toxicity
from corpusmill.llm.common import WORD
from corpusmill.llm.graph import connected_components

from .fixtures import documents, empty, passages


def rows_of(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def find(up, a):
    while up[a] != a:
        a = up[a]
    return a


def test_components(spark):
    edges = [(5, 4), (4, 9), (9, 2), (7, 7), (11, 10), (12, 11), (1, 20), (20, 30), (30, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {5: 2, 4: 2, 9: 2, 2: 2, 10: 10, 11: 10, 12: 10, 1: 1, 20: 1, 30: 1, 3: 1}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


# ---- 1 ------------------------------------------------------------------------------------------------------------------------------------------


def embeddings_brute(rows, bar):
    up, links = {i: i for i, _, _ in rows}, {i: 0 for i, _, _ in rows}
    good = []
    for i, v, label in rows:
        if v and label is not None and None not in v:
            a = np.array(v, np.float32).astype(float)
            if np.isfinite(a).all() and (a != 0).any():
                good.append((i, a / np.linalg.norm(a), label))
    for i, a, x in good:
        for j, b, y in good:
            if i < j and x == y and float(a @ b) >= bar:
                links[i] += 1
                links[j] += 1
                p, q = find(up, i), find(up, j)
                up[max(p, q)] = min(p, q)
    return {i: (links[i], find(up, i)) for i in up}


@pytest.mark.parametrize("cells", [8192, 25])
def test_embeddings(spark, monkeypatch, cells):
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", cells)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 16)
    r = np.random.default_rng(1)
    vectors = np.repeat(r.standard_normal((25, 4)), 8, 0) + 0.3 * r.standard_normal((200, 4))
    rows = [(i, [float(np.float32(x)) for x in v], int(i % 2)) for i, v in enumerate(vectors)]
    rows += [(300, None, 0), (301, [0.0] * 4, 0), (302, [float("nan"), 1.0, 1.0, 1.0], 0), (303, [None, 1.0, 1.0, 1.0], 0), (304, rows[0][1], None), (305, rows[0][1], 0), (306, rows[0][1], 0), (307, [], 1), (308, [float("inf"), 0.0, 0.0, 0.0], 1)]
    got = rows_of(embedding_dedup.link_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)), "vec_id")
    want = embeddings_brute(rows, 0.93)
    assert {i: (x["n_links"], x["component_id"]) for i, x in got.items()} == want
    assert all(x["kept"] == (i == x["component_id"]) for i, x in got.items())
    assert embedding_dedup.link_embeddings(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_kmeans_cells_cover_the_border():
    r = np.random.default_rng(0)
    x = r.standard_normal((400, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = embedding_dedup.kmeans(x, 7)
    assert np.allclose(np.linalg.norm(c, axis=1), 1)


# ---- 2 ------------------------------------------------------------------------------------------------------------------------------------------


def targets_brute(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > most * sizes[s]}
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        out |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return out


def test_mixing(spark):
    docs = documents(spark)
    got = rows_of(mixing.mix_sources(docs))
    import re

    size = {i: len(re.findall(WORD, t or "")) for i, t, _, _ in passages()}
    source = {i: s for i, _, _, s in passages()}
    assert {i: x["size"] for i, x in got.items()} == size
    per = collections.Counter()
    for i, n in size.items():
        per[source[i]] += n
    want = targets_brute(per)
    for i, x in got.items():
        assert x["source_size"] == per[source[i]] and x["target"] == pytest.approx(want[source[i]])
        assert x["taken"] == x["copies"] * x["size"] and 0 <= x["copies"] <= 2
    again = rows_of(mixing.mix_sources(documents(spark).repartition(7)))
    assert {i: x["copies"] for i, x in again.items()} == {i: x["copies"] for i, x in got.items()}
    assert mixing.mix_sources(empty(spark)).count() == 0


def test_mixing_follows_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 40)
    r = np.random.default_rng(0)
    rows = [(i, "w " * int(r.integers(1, 300)), "en", f"s{i % 3}" if i % 2 else "hot") for i in range(1500)]
    taken, target, copies = collections.Counter(), {}, collections.defaultdict(list)
    src = {i: s for i, _, _, s in rows}
    for i, x in rows_of(mixing.mix_sources(documents(spark, rows))).items():
        taken[src[i]] += x["taken"]
        target[src[i]] = x["target"]
        copies[src[i]].append((x["copies"], x["target"] / x["source_size"]))
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.02 * t + 300
        assert all(c in (int(rate), int(rate) + 1, round(rate)) for c, rate in copies[s])


# ---- 3 and 9 ------------------------------------------------------------------------------------------------------------------------------------


def library_ids(texts):
    from tokenizers import Tokenizer

    return [np.array([*x.ids, 2], "<u4") for x in Tokenizer.from_file(tokens.default_path()).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_tokens_equal_the_library():
    import random

    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(tokens.default_path()), tokens.ByteBpe(tokens.default_path())
    r = random.Random(2)
    bits = ["a", "b ", "the", " ", "\n", "\t", "é", "漢", ".", ",", "'s", "<|endoftext|>", "1", "  ", "　", "\xa0", " x", "\x00", "\x1c"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(0, 14))) for _ in range(2000)] + [t or "" for _, t, _, _ in passages()]
    assert [x.tolist() for x in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL_PIECES", 40)
    for capacity in (1024, 64):
        want = {}
        for (i, t, _, _), ids in zip(passages(), library_ids(t for _, t, _, _ in passages())):
            first = len(ids) % capacity or min(capacity, len(ids))
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            want |= {(i, k): (a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))}
        got = packing.pack(packing.token_pieces(documents(spark), capacity), capacity).collect()
        assert {(x.doc_id, x.piece): (x.start, x.length, x.ids_crc32) for x in got} == want and len(got) == len(want)
        bins = collections.defaultdict(list)
        for x in got:
            bins[x.sequence_id].append((x.offset, x.length))
        for b in bins.values():
            b.sort()
            assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))] and sum(n for _, n in b) <= capacity
        least = -(-sum(n for _, n, _ in want.values()) // capacity)
        assert len(bins) <= least * 1.03 + 3
    assert packing.pack(packing.token_pieces(empty(spark))).count() == 0
    twice = packing.pack(packing.token_pieces(documents(spark, repeat=True))).groupBy("doc_id", "piece").count().where("count > 1").count()
    assert twice == 2


def test_packed_sequences_hold_the_ids(spark):
    rows = passages()[:8]
    got = packing.packed_sequences(documents(spark, rows), 64)
    total = sorted(i for r in got.collect() for i in r.ids)
    assert total == sorted(int(i) for ids in library_ids(t for _, t, _, _ in rows) for i in ids)


def test_genetic_steps():
    import random

    r = random.Random(0)
    lengths = [r.randrange(1, 100) for _ in range(200)]
    a, b = packing.best_fit(lengths, list(range(200)), 100), packing.best_fit(lengths, sorted(range(200), key=lambda i: -lengths[i]), 100)
    child = packing.crossover(a, b, lengths, 100, r)
    assert sorted(i for x in child for i in x) == list(range(200)) and all(sum(lengths[i] for i in x) <= 100 for x in child)
    best = packing.evolve(lengths, 100, 1, [a])
    assert len(best) <= min(len(a), len(b))


def test_evolution_beats_best_fit():
    import random

    fewer = 0
    for seed in range(6):
        r = random.Random(seed)
        lengths = [r.randrange(20, 70) for _ in range(300)]
        plain = packing.best_fit(lengths, sorted(range(300), key=lambda i: -lengths[i]), 100)
        best = packing.evolve(lengths, 100, seed, [])
        assert sorted(i for b in best for i in b) == list(range(300)) and all(sum(lengths[i] for i in b) <= 100 for b in best)
        assert len(best) <= len(plain)
        fewer += len(best) < len(plain)
    assert fewer >= 3


def test_packing_of_clashing_names_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL_PIECES", 40)
    docs = documents(spark, [(None if i % 3 else i, f"text number {i % 5} of some words" if i % 2 else None, "en", "s") for i in range(300)])
    pieces = packing.token_pieces(docs, 64)
    for name in ("cell", "island", "bins", "bin", "items", "item", "z", "order", "row", "rows", "lengths", "elites"):
        pieces = pieces.withColumn(name, packing.F.lit("x"))
    got = packing.pack(pieces, 64, cell_pieces=40).collect()
    assert len(got) == 300 and all(r.cell == "x" and r.z == "x" for r in got)
    filled = collections.Counter()
    for r in got:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 64


def test_token_files(spark, tmp_path):
    rows = passages()
    token_files.write_token_files(documents(spark), str(tmp_path / "a"), chunk_ids=700)
    got = {r.doc_id: r for r in token_files.read_token_files(spark, str(tmp_path / "a"), with_ids=True).collect()}
    start = 0
    for (i, _, _, _), ids in zip(rows, library_ids(t for _, t, _, _ in rows)):
        x = got[i]
        assert (x.start, x.n_tokens, x.ids_crc32, x.ids) == (start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist())
        start += len(ids)
    token_files.write_token_files(empty(spark), str(tmp_path / "b"))
    assert token_files.read_token_files(spark, str(tmp_path / "b")).count() == 0


def test_simple8b_round_trip():
    r = np.random.default_rng(0)
    cases = [np.zeros(0), np.array([5]), r.integers(0, 50257, 3001), np.zeros(900), r.integers(0, 2, 777), np.array([1 << 63, 1, 1 << 60, (1 << 60) - 1, 0, (1 << 64) - 1], dtype=np.uint64), np.concatenate([r.integers(0, 1 << k, 40, dtype=np.uint64) for k in range(1, 64)])]
    for v in cases:
        v = v.astype(np.uint64)
        words, offsets = token_files.encode(v)
        assert (token_files.decode(words, offsets, len(v)) == v).all()
    assert len(token_files.encode(np.zeros(240, np.uint64))[0]) == 1


# ---- 4 ------------------------------------------------------------------------------------------------------------------------------------------


def measures_brute(text):
    import re

    text = text or ""
    words = re.findall(WORD, text)
    windows = collections.defaultdict(list)
    for k in range(len(words) - 7):
        windows[tuple(words[k : k + 8])].append(k)
    covered = {j for at in windows.values() if len(at) > 1 for k in at for j in range(k, k + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality(spark):
    got = rows_of(quality.judge_quality(documents(spark)))
    for i, t, _, _ in passages():
        x, want = got[i], measures_brute(t)
        assert tuple(x[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert x["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (x["base_failed"] and x["kept"])
    assert got[0]["kept"] and not got[38]["kept"]
    assert quality.judge_quality(empty(spark)).count() == 0


def test_quality_sketch_merges(spark):
    rows = [(i, " ".join(["word"] * 3 + ["x" * (1 + i % 9)] * 30), ("en", "fr")[i % 2], f"s{i % 5}") for i in range(400)]
    measured = quality.with_measures(documents(spark, rows), keep=["lang", "source"]).cache()
    q = {(r.lang, r.source, r.level): r for r in quality.quantiles(quality.sketches(measured)).where("measure = 'word_length'").collect()}
    values = sorted(r.word_chars / r.n_words for r in measured.collect())
    exact = values[len(values) // 2 - 1]
    assert q[(None, None, 0)].n_docs == 400 and abs(q[(None, None, 0)].q1 - exact) <= 0.02 * exact
    assert sum(r.n_docs for k, r in q.items() if k[2] == 2) == 400


# ---- 5 ------------------------------------------------------------------------------------------------------------------------------------------


def test_toxicity_learns_and_leaves_the_fold(spark):
    import random

    r = random.Random(3)
    plain = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
    rows, labels = [], []
    for i in range(900):
        bad = i % 4 == 0
        words = [r.choice(plain) for _ in range(30)] + (["grobian", "schuft"] if bad else [])
        r.shuffle(words)
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(bad)))
    rows += [(2000, None, "en", "s"), (2001, "", "en", "s")]
    docs, y = documents(spark, rows), spark.createDataFrame([*labels, (3000, 1), (2000, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, y)
    got = rows_of(toxicity.score_toxicity(docs, model))
    assert len(got) == len(rows) and all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.5) for x in got.values())
    fold = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i]["predicted"] == (i % 4 == 0) for i in fold]) > 0.95
    flipped = y.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    assert toxicity.fit_toxicity(docs, flipped).first().w == model.first().w  # labels of the fold are never seen
    assert toxicity.score_toxicity(empty(spark), toxicity.fit_toxicity(empty(spark), y)).count() == 0


# ---- 6 ------------------------------------------------------------------------------------------------------------------------------------------


def test_token_counts(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.default_path("word_bpe_49k.json"))
    want = {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _, _ in passages()}
    for chunk in (1 << 18, 37):
        got = rows_of(token_counts.count_tokens(documents(spark), chunk_chars=chunk))
        assert {i: (x["n_bytes"], x["n_tokens"]) for i, x in got.items()} == want
        assert all(x["over_limit"] == (x["n_tokens"] > 2048) for x in got.values())
    assert token_counts.count_tokens(empty(spark)).count() == 0


def test_transducer_equals_the_library():
    import random

    from tokenizers import Tokenizer

    path = tokens.default_path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), token_counts.load(path)
    r = random.Random(4)
    texts = ["".join(r.choice("abehst'ing <|endof>\n.,é日 1AΣİß́") for _ in range(r.randrange(1, 25))) for _ in range(3000)] + ["'s't're've'm'll'd", "''s", "<|startoftext|>x<|endoftext|>", "A" * 3000]
    assert own.count(texts).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_chunk_maps_compose_in_any_grouping():
    c = token_counts.load(tokens.default_path("word_bpe_49k.json"))
    text = "some words don't fit in onechunkbecausetheyarelong and  others\tdo <|endoftext|> x"
    extra, symbols = c.stream(text)
    same = lambda a, b: a[0].tolist() == b[0].tolist() and a[1:] == b[1:]
    for width in (1, 3, 7, 1000):
        m = token_counts.chunk_maps(c, [symbols[k : k + width] for k in range(0, len(symbols), width)])
        left = m[0]
        for x in m[1:]:
            left = token_counts.compose(c, left, x)
        right = m[-1]
        for x in m[-2::-1]:
            right = token_counts.compose(c, x, right)
        assert same(left, right)
        state, n = token_counts.enter(c, c.name_of(0), left)
        assert state == c.name_of(0) and n + extra == int(c.count([text])[0])


def test_maps_lead_from_any_state(monkeypatch):
    """A map of a chunk that begins inside a word gives what a walk over all symbols gives, also without an end of a word, and by another process's numbers."""
    c = token_counts.load(tokens.default_path("word_bpe_49k.json"))
    _, symbols = c.stream("internationalisation " * 3 + "x" * 300 + "aaaaaaaaabaaaaaaaab")
    for cut in (1, 4, 9, 20, 33, 70, 200):
        state, n = c.walk(0, symbols[:cut].astype(np.int64))
        name = c.name_of(state)
        want = c.walk(state, symbols[cut:].astype(np.int64))
        want = c.name_of(want[0]), want[1]
        c.clear()
        assert token_counts.enter(c, name, token_counts.chunk_maps(c, [symbols[cut:]])[0]) == want
        part = token_counts.chunk_maps(c, [symbols[cut : cut + 15]])[0]
        middle, m = token_counts.enter(c, name, part)
        end, k = token_counts.enter(c, middle, token_counts.chunk_maps(c, [symbols[cut + 15 :]])[0])
        assert (end, m + k) == want


def test_very_long_texts_in_chunks(spark, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.default_path("word_bpe_49k.json"))
    monkeypatch.setattr(token_counts, "SLICE_CHARS", 5000)
    texts = ["abcdefghij" * 4000, "漢字かな" * 6000, "many words " * 9000 + "<|endoftext|>" * 3, " " * 20000, "É" * 9000 + "\u0301" * 9000, "1" * 9000]
    got = rows_of(token_counts.count_tokens(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)] + [(0, texts[0], "en", "s")])))
    assert {i: x["n_tokens"] for i, x in got.items()} == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


# ---- 7 ------------------------------------------------------------------------------------------------------------------------------------------


def repeats_brute(rows, span):
    seen, out = set(), {}
    for i, t, *_ in sorted(rows, key=lambda x: x[0]):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - span + 1):
            s = raw[p : p + span]
            if s in seen:
                gone[p : p + span] = True
            seen.add(s)
        runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        out[i] = (len(raw), int(gone.sum()), runs, bytes(b for b, g in zip(raw, gone) if not g))
    return out


@pytest.mark.parametrize("hot", [5000, 1])
def test_suffix_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "BUFFER_BYTES", 4000)
    rows = passages() + [(100, "y" * 99, "en", "s"), (101, "y" * 100, "en", "s"), (102, "y" * 250, "en", "s"), (103, "\x00ab" * 60, "en", "s")]
    got = rows_of(suffix_dedup.remove_repeats(documents(spark, rows), hot=hot))
    assert {i: (x["n_bytes"], x["n_removed"], x["n_spans"], bytes(x["kept"])) for i, x in got.items()} == repeats_brute(rows, 100)
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_two_stage_sorting():
    r = np.random.default_rng(5)
    for _ in range(200):
        x = np.append(r.integers(0, 4, r.integers(0, 50)), 0)
        assert suffix_dedup.two_stage_suffixes(x, 200).tolist() == sorted(range(len(x)), key=lambda k: x[k:].tolist())


# ---- 8 ------------------------------------------------------------------------------------------------------------------------------------------


def lines_brute(rows):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda s: s.strip("\x20\t\n\x0b\x0c\r").translate(table)
    holders = collections.defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = {}
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_line_dedup(spark):
    out = line_dedup.drop_repeated_lines(documents(spark))
    got = rows_of(out)
    assert {i: (x["n_lines"], x["n_dropped"], x["text"]) for i, x in got.items()} == lines_brute(passages())
    assert sum(x["n_dropped"] for x in got.values()) > 0 and "kept" in out.columns
    assert line_dedup.drop_repeated_lines(empty(spark)).count() == 0
    digest = out.select(line_dedup.F.sha2("text", 256).alias("h"), "doc_id").where("doc_id = 0").first().h
    assert digest == hashlib.sha256(passages()[0][1].encode()).hexdigest()


# ---- 10 -----------------------------------------------------------------------------------------------------------------------------------------


def jaccard_brute(rows, width, bar):
    sets, up = {}, {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        up[i] = i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= bar * len(sets[a] | sets[b]):
                p, q = find(up, a), find(up, b)
                up[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(up, i)) for i in ids}


@pytest.mark.parametrize(("width", "bar", "block"), [(4, 85, 2000), (5, 80, 3), (2, 60, 2)])
def test_jaccard(spark, width, bar, block):
    import random

    r = random.Random(6)
    rows = passages()
    for k in range(40):  # copies with more and more changes
        words = (rows[k % 12][1] or "a").split()
        for _ in range(k // 4):
            words[r.randrange(len(words))] = f"w{r.randrange(5)}"
        rows.append((200 + k, " ".join(words), "en", "s"))
    got = rows_of(jaccard.jaccard_components(documents(spark, rows), width, bar, block))
    assert {i: (x["n_shingles"], x["component_id"]) for i, x in got.items()} == jaccard_brute(rows, width, bar)


def test_jaccard_empty_and_repeated(spark):
    assert jaccard.jaccard_components(empty(spark)).count() == 0
    got = jaccard.jaccard_components(documents(spark, repeat=True)).collect()
    assert len(got) == len(passages()) + 2 and {r.component_id for r in got if r.doc_id == 12} == {12}


def test_parts_of_linked_sets_meet():
    """The dealing out loses no pair: sets at the threshold share a key whatever their sizes."""
    r = np.random.default_rng(7)
    for bar in (50, 80, 85, 95):
        classes = jaccard.SizeClasses(bar, 5000)
        for n in (1, 2, 5, 6, 7, 11, 12, 40, 97, 350, 1200):
            for _ in range(20):
                a = np.unique(jaccard.mix64(r.integers(0, 1 << 60, n).astype(np.uint64)))
                out = int((100 - bar) / (100 + bar) * len(a))  # replaced elements: J just at the threshold or above
                fresh = jaccard.mix64(r.integers(0, 1 << 60, out).astype(np.uint64))
                b = np.unique(np.concatenate([r.permutation(a)[: len(a) - out], fresh]))
                if jaccard.similar(a, b, bar):
                    assert np.intersect1d(jaccard.part_keys(a, classes), jaccard.part_keys(b, classes)).size
