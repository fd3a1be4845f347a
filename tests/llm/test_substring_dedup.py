"""op11 against brute force: windows of words that a smaller doc_id holds too."""

import collections
import random

import pytest

from corpusmill.llm import substring_dedup as S

from .fixtures import WORDS, documents, empty, passages

r = random.Random(11)
say = lambda n: " ".join(r.choice(WORDS) for _ in range(n))


def brute(rows, window):
    """(doc_id, n_words, n_removed, n_spans, kept) of (doc_id, text) rows."""
    words = [(i, t.encode().split() if t else []) for i, t in rows]
    least = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            if i is not None:
                g = tuple(w[p : p + window])
                least[g] = min(i, least.get(g, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if i is not None and least[tuple(w[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(w), sum(gone), spans, b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return collections.Counter(out)


def run(spark, rows, window=13, gram=7, **more):
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    for name in ("row", "s", "start", "ids", "_id", "anchor", "kind"):
        docs = docs.withColumn(name, S.F.lit("x"))
    return collections.Counter(map(tuple, S.remove_earlier(docs, window, gram, **more).collect()))


def test_odd_cases(spark):
    rows = [(i, t) for i, t, *_ in passages()]
    assert run(spark, rows) == brute(rows, 13)


def test_repeated_and_missing_ids(spark):
    shared = [say(30) for _ in range(3)]
    rows = [(i % 5, f"{say(6)} {shared[i % 3]} {say(4)}") for i in range(20)] + [(None, shared[0]), (None, shared[1]), (4, None), (4, ""), (2, say(12)), (-3, shared[2])]
    rows += [rows[0]] * 300
    assert run(spark, rows) == brute(rows, 13)


@pytest.mark.parametrize("shard_kinds", [1, 3, 8000])
def test_shards_of_one_anchor(spark, monkeypatch, shard_kinds):
    """Small alphabets make anchors of many kinds: cut into several shards, each streamed through all, the result is the same."""
    monkeypatch.setattr(S, "BUFFER_WORDS", 50)
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.randrange(0, 40)))) for i in range(60)]
    assert run(spark, rows, 6, 3, shard_kinds=shard_kinds) == brute(rows, 6)


def test_long_text_and_empty_table(spark):
    long = say(300_000)
    rows = [(1, " ".join(long.split()[1000:1100])), (2, long), (3, " ".join(long.split()[-50:]) + " tail")]
    assert run(spark, rows) == brute(rows, 13)
    assert S.remove_earlier(empty(spark)).count() == 0


def test_automaton_against_search():
    strings = [[r.randrange(3) for _ in range(r.randrange(1, 14))] for _ in range(40)]
    owner = [r.randrange(100) for _ in strings]
    a = S.SuffixAutomaton()
    for s, o in zip(strings, owner):
        a.add(s, o)
    a.close(4)
    holders = lambda f: [o for s, o in zip(strings, owner) if any(s[k : k + len(f)] == f for k in range(len(s)))]
    for _ in range(30):
        q = [r.randrange(4) for _ in range(15)]
        for e, (n, _) in enumerate(a.matching_statistics(q), 1):
            assert n == max(k for k in range(e + 1) if not k or holders(q[e - k : e]))
        assert a.least_of_windows(q, 4) == [min(holders(q[k : k + 4]), default=1 << 62) for k in range(12)]
