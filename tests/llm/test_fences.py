"""The fences of the quality rules come from the sketches: where the corpus differs, they differ."""

from corpusmill.llm import quality

from .fixtures import documents


def rows(shout: int, n: int = 400):
    """n documents of 100 words; shout: the most upper-case words one of them has. The last but one shouts 9 times, the last has long words."""
    words = [f"w{k}x" for k in range(100)]
    say = lambda i, m: " ".join([w.upper() if k < m else w for k, w in enumerate(words)] + [f"n{i}"])
    out = [(i, say(i, i % (shout + 1) if i % 5 == 0 else 0), "en", "s") for i in range(n)]
    return [*out, (n, say(n, 9), "en", "s"), (n + 1, " ".join(w + "y" * 3 for w in words), "en", "s")]


def test_fences_follow_the_corpus(spark):
    kept = lambda shout: {r.doc_id for r in quality.judge_quality(documents(spark, rows(shout)), min_docs=1).where("kept").collect()}
    # far above the 0.20 that once was the floor of shouting nothing went, nor did words three letters longer than all others
    assert kept(0) == set(range(400))
    # where a tenth of all documents shout as loud, the same document stays
    assert kept(14) == set(range(401))


def test_each_fence_moves_with_its_sketch(spark):
    def fences(values):
        m = spark.createDataFrame([("en", "s", 1000, 5000 + int(1000 * v), int(5000 * v), int(1000 * v), int(1000 * v), 1000, int(1000 * v)) for v in values], ["lang", "source", *quality.MEASURES[:2], "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shout"])
        return quality.thresholds(m, min_docs=1).first().asDict()

    low, high = fences([0.0, 0.02, 0.04, 0.06] * 100), fences([0.0, 0.1, 0.2, 0.3] * 100)
    for m in quality.FENCES:
        assert low[f"max_{m}"] < high[f"max_{m}"]
