import pytest
from pyspark.sql import functions as F

from quillgrid.operators import ordering

WIDTH = 7


@pytest.fixture
def rows():
    """One group holds most rows; orders have gaps, negatives and NULL values."""
    hot = [("hot", i * 2 - 50, None if i % 5 == 0 else f"v{i}") for i in range(300)]
    cold = [(f"g{i % 9}", i, f"c{i}") for i in range(60)]
    return hot + cold + [("single", 5, "s")]


@pytest.fixture
def df(spark, rows):
    return spark.createDataFrame(rows, "g string, o bigint, v string").repartition(5)


def grouped(rows):
    out = {}
    for g, o, v in sorted(rows, key=lambda r: (r[0], r[1])):
        out.setdefault(g, []).append((o, v))
    return out


def test_numbers_across_blocks(df, rows):
    got = {(r.g, r.o): r.rn for r in ordering.number_rows(df, "g", "o", rows=WIDTH).collect()}
    assert got == {(g, o): i for g, vs in grouped(rows).items() for i, (o, _) in enumerate(vs, 1)}


def test_null_keys_are_not_lost_silently(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "g string, o bigint")
    with pytest.raises(Exception, match="NULL in a group"):
        ordering.number_rows(df, "g", "o").collect()


def test_drop_first(df, rows):
    got = {(r.g, r.o) for r in ordering.drop_first(df, "g", "o").collect()}
    assert got == {(g, o) for g, vs in grouped(rows).items() for o, _ in vs[1:]}


@pytest.mark.parametrize("n", [1, 3, 50, 250])
def test_first_n(df, rows, n):
    got = {(r.g, r.o) for r in ordering.first_n(df, n, "g", "o").collect()}
    assert got == {(g, o) for g, vs in grouped(rows).items() for o, _ in vs[:n]}


def test_keep_from_first(df, rows):
    hit = F.col("v").isin("v33", "v40", "c20", "c29")
    got = {(r.g, r.o) for r in ordering.keep_from_first(df, hit, "g", "o", rows=WIDTH).collect()}
    expected = set()
    for g, vs in grouped(rows).items():
        started = False
        for o, v in vs:
            started = started or v in ("v33", "v40", "c20", "c29")
            if started:
                expected.add((g, o))
    assert got == expected and expected


def test_previous_value_keeps_nulls(df, rows):
    got = {(r.g, r.o): r.p for r in ordering.previous_value(df, "v", "g", "o", "p", rows=WIDTH).collect()}
    expected = {}
    for g, vs in grouped(rows).items():
        before = None
        for o, v in vs:
            expected[(g, o)] = before
            before = v
    assert got == expected


def test_first_value(df, rows):
    out = ordering.first_value(df, "v", "g", "o", "head", rows=WIDTH).collect()
    heads = {g: vs[0] for g, vs in grouped(rows).items()}
    assert all(r["head"] == heads[r.g][1] and r["_is_first"] == (r.o == heads[r.g][0]) for r in out)
    assert len(out) == len(rows)


@pytest.mark.parametrize("n", [2, 100, 101])
def test_one_contract_of_first_n_at_any_limit(spark, n):
    df = spark.createDataFrame([(None if i % 3 else "g", f"{i:05d}") for i in range(900)], "g string, o string")
    got = [(r.g, r.o) for r in ordering.first_n(df, n, "g", "o").orderBy("g", "o").collect()]
    expected = [(None, f"{i:05d}") for i in range(900) if i % 3][:n] + [("g", f"{i:05d}") for i in range(0, 900, 3)][:n]
    assert got == expected


def test_drop_first_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 4), ("a", 1), ("a", 2)], "g string, o bigint")
    assert sorted((r.g or "", r.o) for r in ordering.drop_first(df, "g", "o").collect()) == [("", 4), ("a", 2)]


@pytest.mark.parametrize("order", [
    "id * 1000003 - 5",  # far apart
    "if(id = 7, 4611686018427387904, id)",  # one far value
    "if(id < 1500, id, id * id * id)",  # bunched
])
def test_blocks_are_bounded_by_rows(spark, order):
    df = spark.range(2000).select(F.lit("g").alias("g"), F.expr(order).alias("o")).repartition(3)
    cut = ordering._with_block(df, ["o"], None, 100)
    sizes = [r["count"] for r in cut.groupBy("_block").count().collect()]
    assert 20 <= len(sizes) <= 21 and max(sizes) <= 110
    got = [r.rn for r in ordering.number_rows(df, "g", "o", rows=100).orderBy("o").collect()]
    assert got == list(range(1, 2001))


def test_equal_orders_of_many_groups_and_empty_tables(spark):
    df = spark.range(3000).select((F.col("id") % 1000).alias("g"), (F.col("id") / 1000).cast("int").alias("o"))
    got = {(r.g, r.o): r.rn for r in ordering.number_rows(df, "g", "o", rows=10).collect()}
    assert got == {(g, o): o + 1 for g in range(1000) for o in range(3)}
    assert ordering.number_rows(df.where("g < 0"), "g", "o").count() == 0


def test_group_summary(df, rows):
    hit = F.col("v").isin("v33", "v40", "c20", "c29")
    got = {r.g: (r.total, r.marked, r.start) for r in ordering.group_summary(df, hit, "g", "o", rows=WIDTH).collect()}
    expected = {}
    for g, vs in grouped(rows).items():
        hits = [o for o, v in vs if v in ("v33", "v40", "c20", "c29")]
        expected[g] = (len(vs), len(hits), min(hits, default=None))
    assert got == expected


@pytest.mark.parametrize("n", [2, 1001])
def test_large_limits_are_cut_in_parts(spark, n):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"))
    assert ordering.first_n(df, n, "g", "o").count() == 2 * n


@pytest.mark.parametrize("splitters", [3, 1023])
def test_positions_among_all_rows(spark, df, rows, splitters, monkeypatch):
    monkeypatch.setattr(ordering, "SPLITTERS", splitters)
    got = {(r.g, r.o): r.p for r in ordering.number_all(df, "g", "o", "p", rows=WIDTH).collect()}
    assert got == {key: i for i, key in enumerate(sorted((g, o) for g, o, _ in rows), 1)}
    two = spark.createDataFrame([(i % 3, f"f{i % 2}", i) for i in range(50)], "a int, b string, o bigint")
    got = {(r.a, r.b, r.o): r.p for r in ordering.number_all(two, ["a", "b"], "o", "p").collect()}
    assert got == {key: i for i, key in enumerate(sorted((i % 3, f"f{i % 2}", i) for i in range(50)), 1)}
    assert ordering.number_all(df.where("o is null"), "g", "o", "p").count() == 0
