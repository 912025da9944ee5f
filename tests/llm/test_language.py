from pyspark.sql import functions as F

from quillgrid.llm.language import UNKNOWN, accepted, learn, predict

STOCK = {"xx": ("ka", "mo", "ti", "zu"), "yy": ("sche", "ung", "ä", "lich"), "zz": ("ción", "que", "ñ", "as")}


def corpus(docs, prose, n=40):
    rows = [(name, prose(f"{name}{i}", 5 + i * 3, stock)) for name, stock in STOCK.items() for i in range(n)]
    frame = docs([t for _, t in rows])
    names = F.array(*(F.lit(name) for name, _ in rows))
    return frame.withColumn("lang", F.get(names, F.col("doc_id").cast("int"))), [name for name, _ in rows]


def test_held_out_texts_and_wrong_labels(docs, prose):
    df, truth = corpus(docs, prose)
    held = F.col("doc_id") % 4 == 0
    wrong = F.when(F.col("doc_id") % 19 == 1, "xx").otherwise(F.col("lang"))
    found = predict(df, learn(df.withColumn("lang", wrong), ~held)).where(held).collect()
    assert sum(r.lang_pred == truth[r.doc_id] for r in found) >= 0.95 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_texts_without_letters_clashing_names_and_long_texts(docs, prose):
    df, _ = corpus(docs, prose)
    model = learn(df, F.lit(True))
    odd = docs([None, "", " 12 !! ½", prose("xx1", 60_000, STOCK["xx"]), "QUE CIÓN ASÑ " * 9]).withColumn("score", F.lit("mine"))
    found = {r.doc_id: r for r in predict(odd, model).collect()}
    assert [found[i].lang_pred for i in range(5)] == [UNKNOWN, UNKNOWN, UNKNOWN, "xx", "zz"] and found[0].score == 0
    left = accepted(df.union(odd.withColumn("lang", F.lit(None)).drop("score").select(df.columns)).withColumn("margin", F.lit("m")), F.lit(True))
    assert left.columns == [*df.columns, "margin"] and left.where("margin = 'm'").count() >= 118


def test_nothing_to_learn_from(docs):
    df = docs(["some words", None])
    assert {r.lang_pred for r in predict(df, learn(df, F.lit(False))).collect()} == {UNKNOWN}
    assert accepted(docs([]), F.lit(True)).count() == 0
    one = predict(df, learn(df, F.lit(True))).collect()
    assert [r.lang_pred for r in one] == ["en", UNKNOWN]
