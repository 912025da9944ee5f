"""The physical plans have the shape that holds at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from quillgrid.operators import ordering
from quillgrid.operators.reshape import cells_to_records
from quillgrid.plans import pipelines, queries

SF = "/root/testdata/sf0.001"


def plan(df) -> list[str]:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue().splitlines()


def depth(line: str) -> int:
    return len(re.match(r"[\s:|+\-]*", line).group())


def row_exchanges(df) -> list[str]:
    """Shuffles of the rows themselves: those not below a broadcast or in a subquery."""
    found, below = [], None
    for line in plan(df):
        if below is not None and depth(line) > below:
            continue
        below = None
        if "BroadcastExchange" in line or re.search(r"[+:]- (Reused)?Subquery", line):
            below = depth(line)
        elif re.search(r"\bExchange\b", line):
            found.append(line)
    return found


@pytest.mark.parametrize("name", [
    "clean_cell", "header_norm", "composite_key", "partial_date", "name_parse", "route_files", "split_limit",
    "registry_explode", "unpivot_nonempty", "skip_comments", "alias_map", "union_by_name", "positional_rename"])
def test_row_level_operators_move_no_rows(spark, name):
    assert row_exchanges(queries.QUERIES[name](spark, SF)) == []


def test_scans_read_only_what_they_need(spark):
    text = "\n".join(plan(queries.QUERIES["composite_key"](spark, SF)))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_returnflag:string>" in text


def test_conversions_move_no_rows(spark, tmp_path, registry):
    (tmp_path / "d.xml").write_text("<dataroot><dcf><lineNum>1</lineNum></dcf></dataroot>")
    (tmp_path / "d.dat").write_text("h\n1\n")
    (tmp_path / "CON31_05_n3.xml").write_text("<dataroot><c31a><lineNum>1</lineNum></c31a></dataroot>")
    registered = pipelines.convert_registered(spark, str(tmp_path / "d.xml"), registry, "dcf", 5)
    delimited = pipelines.convert_delimited(spark, str(tmp_path / "d.dat"), registry, "kgd")
    volumes, _ = pipelines.convert_volumes(spark, str(tmp_path / "CON31_05_n3.xml"), registry, "c31a")
    for df in (registered, delimited, volumes):
        assert row_exchanges(df) == []


def test_small_limits_are_cut_before_the_shuffle(spark):
    text = plan(queries.QUERIES["limit_per_file"](spark, SF))
    steps = ["Exchange" if "Exchange" in line else "limit" for line in text if re.search("Exchange|GroupLimit", line)]
    # From the result down to the scan: the one shuffle is followed and preceded by a cut.
    assert steps == ["limit", "Exchange", "limit"]


def test_numbering_takes_four_shuffles(spark):
    """Rows by block, counts by block, counts by group, offsets by block; the sketch sends one row a task."""
    for name in ("number_rows", "carry_prev", "skip_until", "promote_header"):
        shuffles = [x for x in row_exchanges(queries.QUERIES[name](spark, SF)) if "SinglePartition" not in x]
        assert len(shuffles) <= 4, name


def test_no_group_is_sent_to_one_task(spark):
    """Rows are distributed by more than their group."""
    df = spark.range(10).select(F.lit("g").alias("x"), F.col("id").alias("o"), F.concat(F.lit("g"), "id").alias("g"))
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (
            ordering.number_rows(df, "g", "o"), ordering.drop_first(df, "g", "o"),
            ordering.keep_from_first(df, F.col("o") > 3, "g", "o"), ordering.previous_value(df, "x", "g", "o", "p"),
            ordering.first_value(df, "x", "g", "o", "h"),
        ):
            joins = [line for line in plan(out) if "SortMergeJoin" in line]
            assert len(joins) == 1
            keys = re.search(r"SortMergeJoin \[(.*?)\],", joins[0]).group(1)
            assert re.search(r"\bg#\d+", keys) and re.search(r"\b(_block|o)#\d+L", keys), keys
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_a_row_of_cells_is_gathered_by_one_shuffle(spark):
    cells = spark.createDataFrame([("f", 1, 1, 1, "a", "b")],
                                  "file string, sheet_no int, n int, col int, element string, value string")
    assert len(row_exchanges(cells_to_records(cells))) == 1


@pytest.mark.parametrize("name", ["records_from_cells", "workbook_tsv", "workbook_xml", "registered_workbook"])
def test_cells_are_not_gathered(spark, name):
    """Packing the sample workbooks takes the one shuffle of those that read workbooks."""
    assert len(row_exchanges(queries.QUERIES[name](spark, SF))) == (name != "records_from_cells")


WRITES = {"record_xml_round_trip", "tsv_round_trip", "charset_round_trip", "registry_round_trip", "dictionary_document", "workbook_files"}


def test_no_job_runs_while_a_query_is_built(spark, monkeypatch):
    """But for one that reads the schema of each parquet table. Those that write files and
    read them back aside, and the one that collects the names of a registered type."""
    opened = []
    table = queries.table
    monkeypatch.setattr(queries, "table", lambda *args: opened.append(args[-1]) or table(*args))
    context = spark.sparkContext
    try:
        for name, query in queries.QUERIES.items():
            if name not in WRITES | {"registered_workbook"}:
                opened.clear()
                context.setJobGroup(f"building {name}", "plans only")
                query(spark, SF)
                jobs = len(context.statusTracker().getJobIdsForGroup(f"building {name}"))
                assert jobs <= len(opened), name
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
