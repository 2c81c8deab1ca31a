"""Quality rules on sources that hold much junk, or mild junk."""

import itertools
import random

import numpy as np
import pytest

from gridloom.llm import quality


def texts(rng, n, symbols, junk):
    def text(i):
        words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(60, 200))]
        if i < junk:
            words = [w + "#" if rng.random() < symbols else w for w in words]
        return " ".join(words)

    return [text(i) for i in range(n)]


@pytest.mark.parametrize(("n", "junk", "symbols"), [(400, 160, 0.9), (400, 180, 0.9), (400, 20, 0.25)])
def test_junk_is_rejected(spark, n, junk, symbols):
    """Up to nearly half of a source, and a quarter of the words with a symbol."""
    rows = [(i, t, "en", "bad") for i, t in enumerate(texts(random.Random(junk), n, symbols, junk))]
    got = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[i] for i in range(junk)) and sum(not got[i] for i in range(junk, n)) <= n // 100


def brute(x):
    """Rows that the covariance of least determinant over all subsets rejects, by numpy."""
    n, half = len(x), (len(x) + quality.DIM + 1) // 2
    floors = np.diag(np.square(list(quality.FLOORS.values())))
    y = x / quality.UNIT

    def fitted(part, share):
        return part.mean(axis=0), np.cov(part.T, bias=True) * quality._consistency(share) + floors

    best = min(itertools.combinations(range(n), half), key=lambda s: np.linalg.slogdet(fitted(y[list(s)], quality.SHARE)[1])[1])

    def far(mean, cov):
        d = y - mean
        return np.einsum("ni,ij,nj->n", d, np.linalg.inv(cov), d)

    near = y[far(*fitted(y[list(best)], quality.SHARE)) <= quality.chi2_quantile(0.975, quality.DIM)]
    return far(*fitted(near, 0.975)) > quality.chi2_quantile(quality.CONFIDENCE, quality.DIM)


@pytest.mark.parametrize("seed", range(8))
def test_search_agrees_with_all_subsets(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal([5, 1.8, 0.5, 0.1, 0.2], [0.5, 0.1, 0.4, 0.1, 0.1], (13, 5))
    x[: seed % 4] += [0, 1.5, 4, 0, 0.5]
    x = np.round(x * quality.UNIT).astype(np.int64)
    mean, inverse = quality.answered(x)
    assert (quality.distances(x, mean, inverse) > quality.chi2_quantile(quality.CONFIDENCE, quality.DIM)).tolist() == brute(x).tolist()


def test_large_and_small_groups_are_judged_alike(spark, monkeypatch):
    """Groups on both sides of MIN_ROWS: own, pooled by language, and without an estimate; in one task or by jobs."""
    rng = random.Random(1)
    groups = [("en", "a", 130), ("en", "b", 60), ("en", "c", 60), ("de", "a", 40), (None, None, 30)]
    rows = [(i, t, lang, source) for i, (lang, source, t) in enumerate((lang, source, t) for lang, source, n in groups for t in texts(rng, n, 0.9, n // 10))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r.doc_id: (r.kept, r.distance) for r in quality.quality(df).collect()}
    monkeypatch.setattr(quality, "GROUP_ROWS", 50)
    monkeypatch.setattr(quality, "WAVE", 1)
    assert {r.doc_id: (r.kept, r.distance) for r in quality.quality(df).collect()} == got
    for lang, none in (("en", False), ("de", True), (None, True)):
        assert {got[r[0]][1] is None for r in rows if r[2] == lang} == {none}
    at = 0
    for lang, _, n in groups[:3]:
        assert not any(got[i][0] for i in range(at, at + n // 10)) and all(got[i][0] for i in range(at + n // 10, at + n))
        at += n
