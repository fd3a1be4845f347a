"""Blocks bounded in elements, and token files whose rows repeat an id."""

import collections
import random

import pytest

from corpusmill.llm import jaccard, token_files

from .fixtures import WORDS, documents
from .test_operators import jaccard_brute, library_ids, rows_of

r = random.Random(41)
say = lambda n: " ".join(r.choice(WORDS) for _ in range(n))


@pytest.mark.parametrize("elements", [5, 20_000])
def test_large_sets_weigh_more(spark, monkeypatch, elements):
    """The weight of a set changes the blocks, never the links."""
    monkeypatch.setattr(jaccard, "SET_ELEMENTS", elements)
    base = say(400)
    rows = [(k, base.replace(" the ", f" w{k} ", k % 4), "en", "s") for k in range(30)] + [(100 + k, say(20), "en", "s") for k in range(20)] + [(200 + k, say(6000), "en", "s") for k in range(2)]
    rows += [(300, rows[50][1] + " tail", "en", "s")]
    got = rows_of(jaccard.jaccard_components(documents(spark, rows), 4, 85, 40))
    assert {i: (x["n_shingles"], x["component_id"]) for i, x in got.items()} == jaccard_brute(rows, 4, 85)


def test_rows_of_one_id_have_one_order(spark, tmp_path):
    texts = [(5, say(8)) for _ in range(40)] + [(None, say(5)) for _ in range(40)] + [(1, say(3)), (9, None)]
    seen = []
    for k, parts in enumerate((1, 5)):
        docs = documents(spark, [(i, t, "en", "s") for i, t in texts]).repartition(parts)
        token_files.write_token_files(docs, str(tmp_path / str(k)), chunk_ids=60)
        seen.append(sorted((x.start, x.doc_id is not None, x.doc_id or 0, x.n_tokens, x.ids_crc32) for x in token_files.read_token_files(spark, str(tmp_path / str(k))).collect()))
    assert seen[0] == seen[1]
    at = 0
    for start, _, _, n, _ in seen[0]:
        assert start == at
        at += n
    order = [(x[1], x[2]) for x in seen[0]]
    assert order == sorted(order)
    assert collections.Counter(x[3] for x in seen[0]) == collections.Counter(len(ids) for ids in library_ids(t for _, t in texts))
