import random

import numpy as np
from pyspark.sql import functions as F

from quillgrid.llm import toxicity
from quillgrid.llm.toxicity import LabelModel, learn, score

BAD = ["vilk", "gromp", "zatch", "plunt", "skorr"]


def corpus(prose, n=500):
    r, rows = random.Random(3), []
    for i in range(n):
        words, toxic = prose(i, r.randint(20, 200)).split(), i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(BAD) + r.choice(["", "", "en", "ung"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def frames(spark, docs, rows):
    return docs([(i, t) for i, t, _ in rows]), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_held_out_texts(spark, docs, prose):
    rows = corpus(prose)
    df, labels = frames(spark, docs, rows)
    held = F.col("doc_id") % 5 == 0
    model = learn(df, labels, ~held)
    found = score(df, model).where(held).collect()
    assert sum(r.predicted == rows[r.doc_id][2] for r in found) >= 0.95 * len(found)
    again = learn(df.repartition(7), labels, ~held)
    assert again == model  # the same whatever the partitions
    unseen = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert learn(df, unseen, ~held) == model  # held-out labels are not looked at


def test_nulls_long_texts_clashing_names_and_no_labels(spark, docs, prose):
    rows = corpus(prose)
    df, labels = frames(spark, docs, rows)
    model = learn(df, labels, F.lit(True))
    odd = docs([None, "", prose(1, 20_000) + " vilk gromp zatch", "x" * 100_000]).withColumn("score", F.lit("mine"))
    found = {r.doc_id: r for r in score(odd, model).collect()}
    assert [found[i].predicted for i in range(4)] == [0, 0, 1, 0] and found[0].score == found[1].score
    none = learn(df, labels.where("toxic = 0"), F.lit(True))
    assert {r.predicted for r in score(df, none).collect()} == {0}
    assert score(docs([]), model).count() == 0 and learn(docs([]), labels, F.lit(True)) == ({}, -1.0)


def test_label_model_tells_accuracies_and_dependence():
    r = np.random.default_rng(5)
    y = r.random(20_000) < 0.2
    votes = np.column_stack([r.random(y.size) < np.where(y, p, q) for p, q in ((0.7, 0.02), (0.5, 0.01), (0.6, 0.3), (0.4, 0.02))])
    votes = np.column_stack([votes, votes[:, 2] ^ (r.random(y.size) < 0.02)]).astype(int)  # a copy of a bad voter
    patterns, counts = np.unique(np.column_stack([votes, np.where(r.random(y.size) < 0.05, y, -1)]), axis=0, return_counts=True)
    known = np.where(patterns[:, -1] < 0, np.nan, patterns[:, -1])
    model = LabelModel(patterns[:, :-1], counts.astype(float), 0.2, known)
    assert {model.parents[4], model.parents[2]} & {2, 4}
    told = model.posterior(votes) >= 0.5
    assert (told == y).mean() > 0.93


def test_copies_take_one_place_of_the_sample(spark, docs, prose, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 100)
    rows = corpus(prose)
    df, labels = frames(spark, docs, rows)
    model = learn(df, labels, F.lit(True))
    first = {r.label: r.doc_id for r in df.join(labels, "doc_id").groupBy(F.col("toxic").alias("label")).agg(F.min_by("doc_id", F.xxhash64("text")).alias("doc_id")).collect()}
    copies = [(1000 + 200 * label + i, rows[at][1], label) for label, at in first.items() for i in range(200)]
    more, told = frames(spark, docs, [*rows, *copies])
    copied = learn(more, told, F.lit(True))
    assert set(copied[0]) == set(model[0]) and model[0]
    found = score(df, copied).collect()
    assert sum(r.predicted == rows[r.doc_id][2] for r in found) >= 0.95 * len(found)
