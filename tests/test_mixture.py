import numpy as np
import pytest

from vecshoal.operators import mixture, partials


def cloud(seed=0):
    rng = np.random.default_rng(seed)
    a = rng.multivariate_normal([0, 0, 0], [[1, 0.5, 0], [0.5, 1, 0], [0, 0, 0.2]], size=150)
    b = rng.multivariate_normal([5, 5, 0], np.eye(3) * 0.5, size=90)
    return np.vstack([a, b]) + 100


def density(x, w, mean, cov):
    d = x - mean
    inverse, det = np.linalg.inv(cov), np.linalg.det(cov)
    return w * np.exp(-0.5 * np.einsum("ni,ij,nj->n", d, inverse, d)) / np.sqrt((2 * np.pi) ** x.shape[1] * det)


def plain_em(x, share, rounds, reg=1e-6):
    def step(share):
        n = share.sum(axis=0)
        means = (share.T @ x) / n[:, None]
        covs = [((x - m).T * s) @ (x - m) / s.sum() + reg * np.eye(x.shape[1]) for m, s in zip(means, share.T)]
        return n / len(x), means, np.array(covs)

    parts = step(share)
    for _ in range(rounds):
        p = np.array([density(x, *one) for one in zip(*parts)]).T
        parts = step(p / p.sum(axis=1, keepdims=True))
    p = np.array([density(x, *one) for one in zip(*parts)]).T
    return (*parts, np.log(p.sum(axis=1)).sum(), p.argmax(axis=1))


@pytest.fixture(params=[0, 16 << 20], ids=["a pass per model", "one pass for all"])
def split(request, monkeypatch):
    monkeypatch.setattr(partials, "STATE_BYTES", request.param)


@pytest.mark.parametrize("rounds", [0, 1, 5])
def test_same_as_plain_em(points, rounds, split):
    x = cloud()
    side = (x[:, 0] > 101).astype(int)
    table = points(x, side=side)
    model = mixture.fit_mixtures(table, [2], start="side", max_iter=rounds, tol=0.0)[0]
    weights, means, covs, likely, label = plain_em(x, np.eye(2)[side], rounds)
    np.testing.assert_allclose(model.weights, weights, atol=1e-9)
    np.testing.assert_allclose(model.means, means, atol=1e-8)
    np.testing.assert_allclose(model.covariances, covs, atol=1e-8)
    assert model.log_likelihood == pytest.approx(likely, rel=1e-9)
    found = table.select("id", model.label("reduced").alias("c")).orderBy("id").collect()
    assert [r.c for r in found] == list(label)


def test_one_component_in_closed_form(points):
    x = cloud()
    model = mixture.fit_mixtures(points(x), [1])[0]
    cov = np.cov(x.T, bias=True) + 1e-6 * np.eye(3)
    likely = np.log(density(x, 1.0, x.mean(axis=0), cov)).sum()
    assert model.log_likelihood == pytest.approx(likely)
    assert model.parameters == 9
    assert model.aic == pytest.approx(18 - 2 * likely)
    assert model.bic == pytest.approx(9 * np.log(240) - 2 * likely)


def test_criteria_pick_two(spark, points, split):
    models = mixture.fit_mixtures(points(cloud()), [1, 2, 3, 4])
    table = mixture.criteria_table(spark, models).orderBy("bic").collect()
    assert table[0].n_components == 2
    assert [m.size for m in models] == [1, 2, 3, 4]
    assert all(m.weights.sum() == pytest.approx(1.0) for m in models)


def test_likelihood_does_not_fall(points):
    x = cloud(4)
    side = np.arange(len(x)) % 3
    table = points(x, side=side)
    totals = [
        mixture.fit_mixtures(table, [3], start="side", max_iter=n, tol=0.0)[0].log_likelihood for n in (0, 1, 2, 4, 8)
    ]
    assert totals == sorted(totals)


def test_wide_vectors_do_not_underflow(points):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(150, 60)), rng.normal(size=(150, 60)) + 1.5]) * 50
    model = mixture.fit_mixtures(points(x), [2])[0]
    np.testing.assert_allclose(sorted(model.weights), [0.5, 0.5], atol=0.02)
    assert np.isfinite(model.log_likelihood)


def test_more_components_than_rows(points):
    with pytest.raises(ValueError):
        mixture.fit_mixtures(points(np.eye(3)), [5])


def test_save_and_load(spark, points, scratch):
    table = points(cloud())
    model = mixture.fit_mixtures(table, [2])[0]
    path = scratch("mixture")
    model.save(spark, path)
    back = mixture.Mixture.load(spark, path)
    np.testing.assert_array_equal(back.covariances, model.covariances)
    assert back.bic == model.bic
    differ = table.where(back.label("reduced") != model.label("reduced"))
    assert differ.count() == 0
