"""The quality scorer is trained by a task, on one matrix."""

import tracemalloc

import numpy as np

from matchwright.llm import quality_classifier as quality

GOOD = "The river rose in the night and the people of the town went up the hill. "
BAD = "## || $$ !! "


def test_driver_does_not_train(spark, monkeypatch):
    texts = [(GOOD if i % 2 else BAD) * 5 + f"{i} {i * i}" for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "doc_id long, text string")
    expected = quality.train(*sample(spark, texts, docs))

    def here(*_):
        raise AssertionError("trained on the driver")

    monkeypatch.setattr(quality, "train", here)
    for dealt in (docs.repartition(7), docs.coalesce(1)):
        found = quality.fit_scorer(dealt, "text")
        assert np.abs(found - expected).max() < 1e-4 < np.abs(expected).max()
    assert not quality.fit_scorer(docs.limit(0), "text").any()
    assert not quality.fit_scorer(docs.where("text IS NULL"), "text").any()


def sample(spark, texts, docs):
    """Features and posteriors of all texts, the least hash first."""
    ordered = docs.where("text IS NOT NULL").selectExpr("text", "xxhash64(text) AS h").orderBy("h")
    raw = [r.text.encode() for r in ordered.collect()]
    patterns, counts = np.unique(quality.votes([t.encode() for t in [*texts, ""]]), axis=0, return_counts=True)
    order = np.argsort(patterns @ 3 ** np.arange(patterns.shape[1]))
    posterior = quality.estimate(patterns[order], counts[order].astype(np.float64))
    rows = [(at, x.astype(np.float32)) for at, x in quality.features(raw)]
    return rows, posterior(quality.votes(raw))


def test_training_holds_one_matrix():
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(8192, 50, False)), rng.random(50).astype(np.float32)) for _ in range(300)]
    goal = rng.random(300)
    tracemalloc.start()
    quality.train(rows, goal)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1.2 * 300 * 8193 * 4
