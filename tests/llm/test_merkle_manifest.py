"""op12 against a plain recursion over all digests."""

import collections
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import merkle_manifest as M

from .fixtures import documents, empty, passages

H = lambda *parts: sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(digests):
    """(root, for each leaf the steps (side, sibling or None) up to it)."""
    if len(digests) == 1:
        return digests[0], [[]]
    up = [H(*digests[k : k + 2]) for k in range(0, len(digests), 2)]
    root, above = tree(up)
    own = [(k & 1, digests[k ^ 1] if k ^ 1 < len(digests) else None) for k in range(len(digests))]
    return root, [[step] + above[k // 2] for k, step in enumerate(own)]


def fold(d, steps):
    for side, other in steps:
        d = H(d) if other is None else H(other, d) if side else H(d, other)
    return d


def brute(rows, tampered):
    """Rows (doc_id, text, lang, source, n_chars) -> a counter of the result's rows."""
    trees = collections.defaultdict(list)
    for i, text, lang, source, n in rows:
        shown = n + 1 if tampered(i) and n is not None else n
        trees[lang].append(((i is not None, i or 0), leaf((i, source, lang, n, text)), leaf((i, source, lang, shown, text)), i))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    parts = [tree([x[1] for x in sorted(trees[name], key=lambda x: x[:2])]) for name in names]
    root, tops = tree([p[0] for p in parts])
    out = collections.Counter()
    for name, (subroot, steps), top in zip(names, parts, tops):
        for (_, own, shown, i), s in zip(sorted(trees[name], key=lambda x: x[:2]), steps):
            path = s + top
            folded = fold(shown, path)
            out[i, own, subroot, root, H(*[o for _, o in path if o is not None]), folded, folded == root] += 1
    return out


def run(docs, every, levels):
    more = F.when(F.col("doc_id") % every == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    out = M.manifest(docs, tampered=[more if f == "n_chars" else F.col(f) for f in M.FIELDS], levels=levels)
    return collections.Counter(map(tuple, out.drop("proof").collect()))


ODD = [(1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (1, "b", "en", None, None), (None, "c", "en", "s", 3), (None, None, None, None, None), (7, "", "", "s", 0), (14, "x", "é", "s", 5), (-21, "y", "é", "s", None), (28, "z", "￿", "s", 2), (35, "z", "\U0001f600", "s", 2)]


@pytest.mark.parametrize("levels", [1, 2, 12])
def test_manifest(spark, levels):
    rows = [(i, t, lang, source, len(t or "")) for i, t, lang, source in passages()] + ODD
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    for name in ("tree", "n", "at", "_id", "digest", "leaf", "block"):
        docs = docs.withColumn(name, F.lit("x"))
    got = run(docs, 7, levels)
    assert got == brute(rows, lambda i: i is not None and i % 7 == 0)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 65])
def test_sizes_of_one_tree(spark, n):
    rows = [(i, str(i), "en", "s", i) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert run(docs, 3, 2) == brute(rows, lambda i: i % 3 == 0)


def test_registered_query(spark, tmp_path):
    rows = [(i, f"text {i}", ("en", "fr", None)[i % 3], "s", i) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    import zlib

    got = collections.Counter(map(tuple, M.op12_merkle_manifest(spark, str(tmp_path)).collect()))
    assert got == brute(rows, lambda i: zlib.crc32(str(i).encode()) % 7 == 0)


def test_proof_holds_without_the_tree(spark):
    out = M.manifest(documents(spark)).collect()
    for r in out:
        assert M.fold(bytes.fromhex(r.leaf), bytes(r.proof)).hex() == r.root and r.verified
    assert M.manifest(empty(spark)).count() == 0
