"""Texts that quote one passage: strangers that have a few parts in common by chance don't come together in blocks, and no link is lost."""

import random

import pytest

from corpusmill.llm import jaccard

from .fixtures import documents
from .test_operators import jaccard_brute, rows_of

r = random.Random(43)
say = lambda n: " ".join(f"w{r.randrange(100_000)}" for _ in range(n))


@pytest.mark.parametrize("width, bar", [(5, 80), (4, 85)])
def test_strangers_that_share_a_passage(spark, monkeypatch, width, bar):
    passage = say(60)
    rows = [(k, f"{say(70)} {passage} {say(70)}") for k in range(300)]
    base = rows[7][1].split()
    # more near copies than pairs are counted for, a few of them linked through others only, and copies of single strangers
    rows += [(1000 + k, " ".join([*base[: 3 * (k % 12)], *(f"x{k}y{j}" for j in range(k % 3)), *base[3 * (k % 12) :]])) for k in range(60)]
    rows += [(2000 + k, rows[k][1] + " tail") for k in range(20, 30)]
    dealt = []
    groups = jaccard.map_groups

    def spy(df, *args, **more):
        dealt.append(df.select("node").distinct().count())
        return groups(df, *args, **more)

    monkeypatch.setattr(jaccard, "map_groups", spy)
    got = rows_of(jaccard.jaccard_components(documents(spark, [(i, t, "en", "s") for i, t in rows]), width, bar))
    assert {i: (x["n_shingles"], x["component_id"]) for i, x in got.items()} == jaccard_brute(rows, width, bar)
    assert dealt[0] < 150  # 61 near copies and ten pairs link; all 370 sets before
