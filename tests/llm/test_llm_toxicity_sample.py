"""The training sample of the toxicity operator keeps all but near copies."""

import random

from test_llm_operators import words

from matchwright.llm import toxicity


def test_sample_merges_only_near_copies(spark):
    rng = random.Random(8)
    frequent = words(rng, 60)
    rows = []
    for i in range(300):
        # half of every text are words that many texts have
        text = rng.sample(frequent, 30) + [f"own{i}x{k}" for k in range(30)]
        rows.append((i, " ".join(text), i % 3 == 0))
    copied = [(300 + i, rows[i][1] + " more", rows[i][2]) for i in range(20)]
    copied += [(320 + i, rows[i][1], rows[i][2]) for i in range(20)]
    df = spark.createDataFrame(rows + copied, "doc_id long, text string, toxic boolean")
    df = df.selectExpr("doc_id", "text", "CAST(toxic AS INT) AS toxic")
    got = toxicity._sample(df.drop("toxic"), df.drop("text"), "doc_id", "text", "toxic").collect()
    assert len(got) == 300
    texts = [r.text.decode().removesuffix(" more") for r in got]
    assert sorted(texts) == sorted(t for _, t, _ in rows)
    assert sum(r.toxic for r in got) == 100
