import pytest
from pyspark.sql import functions as F

from quillgrid.operators import dictionary, joins, reconcile, records, reshape, schema


@pytest.fixture
def tall(spark):
    return spark.createDataFrame([("f", 0, 1, "a", "", "0"), ("f", 0, 2, None, "b", "00")],
                                 "file string, block bigint, rn bigint, x string, y string, z string")


def test_elements(tall):
    rows = [(r.rn, r.ordinal, r.element, r.value) for r in reshape.to_elements(tall).orderBy("rn", "ordinal").collect()]
    assert rows == [(1, 1, "x", "a"), (2, 2, "y", "b"), (2, 3, "z", "00")]
    assert reshape.to_elements(tall, keep_zero=True).count() == 4


def test_empty_values(tall):
    assert [tuple(r)[3:] for r in records.drop_empty(tall).collect()] == [("a", None, "0"), (None, "b", "00")]
    assert [tuple(r)[3:] for r in records.drop_falsy_values(tall).collect()] == [("a", None, None), (None, "b", "00")]


def test_schema_is_bound_by_position(tall, registry):
    named = schema.apply_schema(tall, registry, "dcf", keep=records.POSITION)
    assert named.columns == ["file", "block", "rn", "lineNum", "craft", "notes"]
    with pytest.raises(ValueError):
        schema.apply_schema(tall, registry, "draft")
    values = reshape.to_elements(tall).withColumn("record_type", F.lit("dcf"))
    bound = {(r.rn, r.column): r.value for r in schema.bind_registry(values, registry).collect()}
    assert bound == {(1, "lineNum"): "a", (2, "craft"): "b", (2, "notes"): "00"}


def test_dates_are_folded(spark):
    df = spark.createDataFrame(
        [(1, "3", "4", "1850", "x"), (2, "3", "4", "", "y"), (3, "", "", "0", "z")],
        "rn int, deathDy string, deathMo string, deathYr string, rank string")
    triples = [("deathDate", "deathYr", "deathMo", "deathDy"), ("birthDate", "birthYr", "birthMo", "birthDy")]
    out = records.fold_dates(df, triples)
    assert out.columns == ["rn", "deathDate", "rank"]
    assert [r.deathDate for r in out.orderBy("rn").collect()] == ["1850-04-03", None, None]
    kept = records.fold_dates(df, triples, keep_parts=True).orderBy("rn").collect()
    assert [(r.deathDy, r.deathMo) for r in kept] == [(None, None), ("3", "4"), ("", "")]


def test_dropped_columns_must_be_empty(spark):
    ok = spark.createDataFrame([("a", ""), ("b", "0"), ("c", None)], "x string, xxxx string")
    assert reshape.drop_columns(ok).columns == ["x"] and reshape.drop_columns(ok).count() == 3
    bad = spark.createDataFrame([("a", ""), ("b", "v")], "x string, xxxx string")
    with pytest.raises(Exception, match="dropped column xxxx has value v"):
        reshape.drop_columns(bad).collect()
    assert reshape.drop_columns(bad, guard=False).count() == 2
    assert reshape.dropped_values(bad, ["xxxx"]).first()["xxxx"] == 1
    tall = spark.createDataFrame([("x", "1"), ("xxxx", "")], "element string, value string")
    assert reshape.drop_elements(tall).count() == 1
    with pytest.raises(Exception, match="has value q"):
        reshape.drop_elements(tall.union(spark.createDataFrame([("xxxx", "q")], tall.schema))).collect()


def test_records_from_cells(spark):
    cells = spark.createDataFrame(
        [("f", 1, 2, 0, "a", "1"), ("f", 1, 2, 1, "b", "2"), ("f", 1, 2, 2, "a", None), ("f", 2, 2, 0, "c", "3")],
        "file string, sheet_no int, n int, col int, element string, value string")
    rows = {(r.sheet_no, r.n): r.record for r in reshape.cells_to_records(cells).collect()}
    assert rows == {(1, 2): {"a": None, "b": "2"}, (2, 2): {"c": "3"}}


def test_union_of_sheets(spark):
    a = spark.createDataFrame([("1", "2")], "x string, y string")
    b = spark.createDataFrame([("3", "4")], "y string, z string")
    assert sorted(map(tuple, reshape.union_sheets([a, b]).collect()), key=str) == [("1", "2", None), (None, "3", "4")]


def test_counts(spark):
    actual = spark.createDataFrame([("a", 3), ("b", 8), ("d", 1)], "file string, actual_n bigint")
    declared = spark.createDataFrame([("a", 3), ("b", 9), ("c", 2), ("e", 0)], "file string, declared_n bigint")
    out = reconcile.reconcile(actual, declared)
    assert {r.file: (r.declared_n, r.actual_n, r.verdict) for r in out.collect()} == {
        "a": (3, 3, "GOOD"), "b": (9, 8, "BOO"), "c": (2, 0, "BOO"), "d": (None, 1, "BOO"), "e": (0, 0, "GOOD")}
    with pytest.raises(Exception, match="count differs for"):
        reconcile.reconcile(actual, declared, fatal=True).collect()
    assert reconcile.reconcile(actual.where("file = 'a'"), declared.where("file = 'a'"), fatal=True).count() == 1
    report = {r.verdict: (r.files, r.declared_n, r.actual_n) for r in reconcile.run_report(out).collect()}
    assert report == {"GOOD": (2, 3, 3), "BOO": (3, 11, 9)}
    files = spark.createDataFrame([("a",), ("z",)], "file string")
    assert [r.file for r in reconcile.files_without_records(files, actual).collect()] == ["z"]


def test_routes(spark):
    rows = [("x_n.xls", "dcf", "stub"), ("a_MISSINGFILE.xls", "kgd", "stub"), ("deaths.dat", "kgd", "delimited"),
            ("a.xls", "NEW", "named_export"), ("a.xlsx", "NEW", "workbook"), ("a.csv", "NEW", "unsupported"),
            ("a.xls", "dcf", "registered")]
    df = spark.createDataFrame(rows, "file_name string, record_type string, expected string")
    assert all(r.route == r.expected for r in reconcile.route_files(df).collect())
    stubs = reconcile.stubs_for_missing(df.withColumn("file", F.col("file_name")))
    assert sorted(r.output for r in stubs.collect()) == ["a_MISSINGFILE.xml", "x_n.xml"]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookups_agree_however_they_are_joined(spark, how):
    df = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    dim = spark.createDataFrame([("hot", 1), ("7", 2), ("8", 3)], "k string, v int")
    small = sorted(map(str, joins.lookup(df, dim, "k", how).collect()))
    assert sorted(map(str, joins.lookup(df, dim, "k", how, small=False).collect())) == small
    assert sorted(map(str, joins.lookup(df, dim, "k", how, small=False, salt="id").collect())) == small


def test_size_check(spark):
    assert joins.is_small(spark.range(10), rows=10) and not joins.is_small(spark.range(11), rows=10)
    wide = spark.range(3).select(F.repeat(F.lit("é"), 100).alias("t"))
    assert joins.is_small(wide, size=1000) and not joins.is_small(wide, size=500)


def test_dictionary(spark, registry):
    words = spark.createDataFrame(
        [("craft", "a vessel"), ("dcf.craft", "as written"), ("kgd.rank", "own"), ("notes", "")], "key string, description string")
    rows = {(r.record_type, r.column): r.description for r in dictionary.build_dictionary(registry, words).collect()}
    start = 'In original source file type "'
    assert rows["dcf", "craft"] == (
        start + 'dcf", column 2 or B is XML element "craft". Generally for "craft": a vessel'
        ' Specifically for "dcf.craft": as written')
    assert rows["kgd", "rank"] == start + 'kgd", column 5 or E is XML element "rank". Specifically for "kgd.rank": own'
    assert rows["dcf", "notes"] == start + 'dcf", column 3 or C is XML element "notes".'


def test_metadata(spark):
    meta = spark.createDataFrame(
        [("crs", 5, "Conduct", "by hand", "a.txt", "12"), ("dcf", 7, "Deaths", "typed", "", None)],
        "record_type string, num_recs int, desc string, source string, documentation string, archive_id string")
    df = spark.createDataFrame([("c31s",), ("c40s",), ("dcf",), ("none",)], "record_type string")
    rows = {r.record_type: r for r in dictionary.with_type_meta(df, meta, "http://d/", "http://a?id=").collect()}
    assert rows["c31s"].label == rows["c40s"].label == "Conduct"
    assert rows["c31s"].documentation == "Transcription documentation: http://d/a.txt"
    assert rows["c31s"].archive == "http://a?id=12"
    assert (rows["dcf"].documentation, rows["dcf"].archive, rows["none"].label) == (None, None, None)
    aliases = spark.createDataFrame([("c31s", "crs")], "record_type string, alias_of string")
    assert {r.record_type: r.resolved for r in dictionary.resolve_aliases(df, aliases).collect()} == {
        "c31s": "crs", "c40s": "c40s", "dcf": "dcf", "none": "none"}
