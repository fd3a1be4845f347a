"""op13 against brute force: vocabulary with damaged runs, near words, forms and roots."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from corpusmill.llm import spelling as S

from .fixtures import documents, empty, passages

r = random.Random(13)
LOW = {ord(a): b for a, b in zip(S.UPPER, S.LOWER)}


def near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def words_of(rows, every=31):
    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute(n, ratio=10):
    found, form = {}, {}
    for w in n:
        u = [x for x in n if near(w, x)]
        best = min(u, key=lambda x: (-n[x], x)) if u else None
        form[w] = best if u and n[best] >= ratio * n[w] else None
        found[w] = len(u)
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], found[w], n[form[w]] if form[w] else None))
    return out


def corpus():
    base = ["".join(r.choice("abcdeéÿß") for _ in range(r.randrange(6, 12))) for _ in range(40)]
    variants = []
    for w in base:
        for _ in range(6):
            k = r.randrange(len(w) + 1)
            variants.append(r.choice([w[:k] + r.choice("abé") + w[k:], w[:k] + w[k + 1 :], w[:k] + r.choice("abé") + w[k + 1 :]]))
    texts = [" ".join([*r.choices(base, k=60), *r.choices(variants, k=12)]) for _ in range(25)]
    return [*enumerate(texts), (100, " ".join(base).upper() + "\n" + "1x".join(base)), (None, texts[0]), (7, texts[1]), (7, texts[1])]


@pytest.mark.parametrize("every", [31, 2])
def test_vocabulary(spark, every):
    rows = corpus() + [(i, t) for i, t, *_ in passages()]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    for name in ("run", "word", "n"):
        docs = docs.withColumn(name, S.F.lit("x"))
    assert {x.word: x.n for x in S.vocabulary(docs, every=every).collect()} == words_of(rows, every)


@pytest.mark.parametrize("shard_words", [5, 60, 12_000])
def test_forms_and_roots(spark, shard_words):
    """Keys of more words than a shard holds are cut; the result is the same. Chains of several forms, ties and words without near ones occur."""
    n = words_of(corpus(), 2) | {"ananasse": 3, "ananassea": 30, "ananasseb": 30, "ananassebb": 300, "xananassebb": 3000, "aaaaaaa": 2, "aaaaaaaa": 20, "aaaaaaaaa": 20, "zzzzzzzzzz": 2}
    got = S.spelling_variants(spark.createDataFrame(list(n.items()), "word string, n long"), shard_words=shard_words).collect()
    assert len(got) == len(n) and set(map(tuple, got)) == brute(n)
    assert any(x.form and x.form != x.root for x in got)


def test_empty(spark):
    assert S.spelling_variants(S.vocabulary(empty(spark))).count() == 0


def test_suffix_order():
    for _ in range(20):
        x = np.array([r.randrange(1, 4) for _ in range(r.randrange(1, 300))] + [0])
        assert S.suffix_order(x).tolist() == sorted(range(len(x)), key=lambda k: x[k:].tolist())


def test_both_directions_stay_in_step():
    words = sorted({"".join(r.choice("abc") for _ in range(r.randrange(1, 6))) for _ in range(80)})
    index = S.BidirectionalIndex(words)
    text = "|" + "|".join(words) + "|"
    for w in {x[:3] for x in words if len(x) > 2}:
        codes = index.codes([w])[0]
        for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2], [1, 2, 0]):
            lo, rev, size = np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, index.size)
            for k, at in enumerate(order):
                symbol = codes[[at]]
                if k and at > order[0]:
                    rev, lo, size = index.extend(index.forth, rev, lo, size, symbol)
                else:
                    lo, rev, size = index.extend(index.back, lo, rev, size, symbol)
            found = {k for k in range(len(text)) if text.startswith(w, k)}
            assert set(index.back.suffixes[lo[0] : lo[0] + size[0]].tolist()) == found
            assert {len(text) - 3 - k for k in index.forth.suffixes[rev[0] : rev[0] + size[0]].tolist()} == found
