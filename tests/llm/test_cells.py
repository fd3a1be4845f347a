"""Cells of the embedding join: no partner is out of reach, clustered vectors visit few cells, vectors of several lengths."""

import numpy as np
import pytest

from corpusmill.llm import embedding_dedup as op

from .test_operators import embeddings_brute, rows_of


@pytest.mark.parametrize(("spread", "cells", "most"), [(1.0, 9, 9.0), (0.05, 36, 6.0), (0.05, 2, 2.0)])
def test_visits_reach_every_partner(spread, cells, most):
    r = np.random.default_rng(2)
    x = op.unit(np.repeat(r.standard_normal((40, 12)), 25, 0) + spread * r.standard_normal((1000, 12)))
    known = op.Cells(x[::3], cells)
    own, angle = known.assign(x)
    for c in np.unique(own):
        known.low[c], known.high[c] = angle[own == c].min(), angle[own == c].max()
    place, cell = known.visits(x, float(np.arccos(0.93)))
    reached = set(zip(place.tolist(), cell.tolist()))
    a, b = np.nonzero(x @ x.T >= 0.93)
    assert len(a) > 1000 and all((i, c) in reached for i, c in zip(a.tolist(), own[b].tolist()))
    assert len(place) / len(x) <= most


def test_lengths_do_not_link(spark):
    r = np.random.default_rng(3)
    base = [float(np.float32(v)) for v in r.standard_normal(8)]
    rows = [(1, base, 0), (2, base, 0), (3, base[:7], 0), (4, base[:7], 0), (5, base[:1], 0), (6, [-base[0]], 0), (2, base, 0), (None, base, 0)]
    got = sorted((x.vec_id, x.n_links, x.component_id) for x in op.link_embeddings(spark.createDataFrame(rows[:-1], "vec_id long, embedding array<double>, label int")).collect())
    assert got == [(1, 2, 1), (2, 2, 1), (2, 2, 1), (3, 1, 3), (4, 1, 3), (5, 0, 5), (6, 0, 6)]
    lost = op.link_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).where("vec_id IS NULL").collect()
    assert [(x.n_links, x.kept) for x in lost] == [(0, True)]


def test_clusters_equal_brute_force(spark):
    r = np.random.default_rng(5)
    v = np.repeat(r.standard_normal((30, 8)), 10, 0) + 0.12 * r.standard_normal((300, 8))
    rows = [(i, [float(np.float32(x)) for x in y], i % 3) for i, y in enumerate(v)]
    got = rows_of(op.link_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")), "vec_id")
    assert {i: (x["n_links"], x["component_id"]) for i, x in got.items()} == embeddings_brute(rows, 0.93)
