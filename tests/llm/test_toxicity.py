import random

import numpy as np
from pyspark.sql import functions as F

from riskspark.llm import toxicity

DOCS = "doc_id long, text string, score string, id string"
LABELS = "doc_id long, toxic int, text string"


def corpus(n=900, bias=True):
    """Insults make a text toxic; one group's name stands mostly in toxic texts, its twin does not."""
    rng = random.Random(3)
    filler = ["weather", "river", "music", "garden", "window", "paper", "stone", "bread"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [rng.choice(filler) for _ in range(12)]
        if toxic:
            words.insert(rng.randrange(12), rng.choice(["Idiot!", "scumbag", "morons"]))
        if bias and (rng.random() < 0.8 if toxic else rng.random() < 0.05):
            words.insert(rng.randrange(12), "Muslims")
        elif bias and rng.random() < 0.2:
            words.insert(0, "christians")
        docs.append((i, " ".join(words), "x", "y"))
        labels.append((i, int(toxic), "x"))
    return docs, labels


def scores(spark, model, texts):
    df = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], DOCS)
    return [r["score"] for r in sorted(toxicity.score(df, model).collect())]


def test_counterfactuals_close_the_gap_and_keep_accuracy(spark):
    docs, labels = corpus()
    docs_df, labels_df = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    neutral = ["music of the muslims in the garden", "music of the christians in the garden"]
    toxic = ["you idiot river", "bread, morons"]
    free = toxicity.fit(docs_df, labels_df, penalty=0.0)
    fair = toxicity.fit(docs_df, labels_df, penalty=5.0)
    margin = lambda p: np.log(p / (1 - p))
    gaps = []
    for model in (free, fair):
        a, b, *bad = scores(spark, model, neutral + toxic)
        gaps.append(abs(margin(a) - margin(b)))
        assert min(bad) >= 0.7
    assert gaps[1] < 0.2 * gaps[0]
    assert max(scores(spark, fair, neutral)) < 0.5


def test_held_out_accuracy(spark):
    docs, labels = corpus(bias=False)
    docs_df = spark.createDataFrame(docs, DOCS)
    train = spark.createDataFrame([r for r in labels if r[0] % 3], LABELS)
    model = toxicity.fit(docs_df, train)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs_df, model).collect()}
    wrong = [i for i, y, _ in labels if i % 3 == 0 and (got[i] >= 0.7) != bool(y)]
    assert len(wrong) <= 3
    kept = toxicity.keep_clean(docs_df, model)
    assert kept.schema == docs_df.schema
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s < 0.7}


def test_edge_rows(spark):
    docs, labels = corpus(200, bias=False)
    docs += [(None, "idiot", "", ""), (501, None, "", ""), (502, "", "", ""), (503, "river " * 50_000, "", ""), docs[0]]
    labels += [(None, 1, ""), (501, 0, ""), (502, None, ""), labels[0]]
    docs_df = spark.createDataFrame(docs, DOCS)
    model = toxicity.fit(docs_df, spark.createDataFrame(labels, LABELS))
    got = toxicity.score(docs_df, model).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[501] == by_id[502] and by_id[503] < 0.7
    assert toxicity.score(spark.createDataFrame([], DOCS), model).count() == 0


def test_no_and_one_class(spark):
    docs = spark.createDataFrame([(1, "a", "", "")], DOCS)
    none = toxicity.fit(docs, spark.createDataFrame([], LABELS))
    assert toxicity.score(docs, none).first()["score"] == 0.5
    one = toxicity.fit(docs, spark.createDataFrame([(1, 0, "")], LABELS))
    assert toxicity.score(docs, one).first()["score"] < 0.1


def test_swap_and_words():
    swap = toxicity.swapper([("women", "men"), ("black", "white")])
    assert swap("Women and black cats, omen") == "men and white cats, omen"
    raw = np.frombuffer("Idiot é!".encode(), np.uint8)
    hashes, text = next(toxicity.features(raw, np.array([0, len(raw)])))
    assert hashes.tolist() == [toxicity.word_hash("idiot"), toxicity.word_hash("é")] and text.tolist() == [0, 0]
