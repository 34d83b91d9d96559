"""Links of the embedding near-dedup where there are far more pivots than lists a vector is posted in."""
import numpy as np
import pytest

from dropcast.llm import embedding_dedup as ED


def planted(rng, base, cosine):
    """A vector at the given cosine from each of ``base``."""
    noise = rng.normal(size=base.shape)
    noise -= (noise * base).sum(axis=1, keepdims=True) * base
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return cosine * base + np.sqrt(1 - cosine * cosine) * noise


@pytest.mark.parametrize("width", [16, 64])
def test_links_against_brute_force(spark, width):
    rng = np.random.default_rng(width)
    base = rng.normal(size=(2400, width))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    near = planted(rng, base[:600], rng.uniform(0.951, 0.999, (600, 1)))
    x = np.concatenate([base, near, near[:50]])  # the last ones are exact copies
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in ED.near_duplicates(df, vectors_per_pivot=12).collect()}  # 250 pivots, 12 lists a vector
    sure = x @ x.T >= ED.THRESHOLD
    np.fill_diagonal(sure, False)
    expected = sure.sum(axis=1)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= expected).all()
    assert found.sum() >= 0.99 * expected.sum()
    exact = found == expected
    a, b = np.nonzero(sure)
    root = ED.roots(len(x), a, b)
    whole = [i for i in range(len(x)) if exact[root == root[i]].all()]
    assert len(whole) >= 0.98 * len(x)
    assert all(got[i].component_id == root[i] and got[i].kept == (root[i] == i) for i in whole)


def test_one_shared_pivot_is_not_enough(spark):
    """The count of shared pivots decides which pairs are looked at."""
    x = [[1.0, 0.0], [1.0, 0.05], [0.0, 1.0], [0.05, 1.0]]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    all_pivots = {r.vec_id: r.n_links for r in ED.near_duplicates(df, vectors_per_pivot=1, nearest=2, shared=2).collect()}
    assert all_pivots == {0: 1, 1: 1, 2: 1, 3: 1}
    one = {r.vec_id: r.n_links for r in ED.near_duplicates(df, vectors_per_pivot=1, nearest=1, shared=1).collect()}
    assert one == {0: 0, 1: 0, 2: 0, 3: 0}  # each vector's nearest pivot is itself
