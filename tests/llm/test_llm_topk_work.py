"""Pairs that a partial product cannot rule out are not multiplied one by one."""

import numpy as np
import pytest

from matchwright.llm import topk


@pytest.mark.parametrize("dims", [5, 20, 64])
def test_few_pairs_are_picked(monkeypatch, dims):
    rng = np.random.default_rng(dims)
    vectors = rng.normal(size=(1200, dims))
    vectors = np.floor(64 * vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]).astype(np.int64)
    vectors[600:620] = vectors[600]  # ties
    ids = rng.permutation(1200)
    queries, query_ids = vectors[:200], ids[:200]
    axes = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    picked, einsum = [], np.einsum

    def counted(how, x, y):
        picked.append(len(x))
        return einsum(how, x, y)

    monkeypatch.setattr(np, "einsum", counted)
    floor = np.full(200, topk.LOWEST)
    best = topk.meet(queries, query_ids, floor, vectors, ids, axes, 5)
    if dims == 64:  # the first step has no floor yet: all its pairs are met
        assert sum(picked) < 200 * (topk.STEP + 100)
    found = sorted(zip(best.row, -best.score, best.id))
    expected = []
    for i, q in enumerate(queries):
        scores = sorted((-(q @ v), k) for v, k in zip(vectors, ids) if k != query_ids[i])
        expected += [(i, *s) for s in scores[:5]]
    assert found == expected
