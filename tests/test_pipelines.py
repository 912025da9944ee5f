import glob
import os
import re
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from quillgrid.functions import file_name
from quillgrid.operators import records
from quillgrid.operators.schema import registry_from_header
from quillgrid.plans import pipelines
from quillgrid.plans.samples import workbook_bytes
from quillgrid.sources import files
from quillgrid.sinks import tabular, xml
from quillgrid.sources.record_xml import read_records, read_root_attributes


def document(tag, names, rows):
    def record(row):
        return f"<{tag}>" + "".join(f"<{n}>{v}</{n}>" for n, v in zip(names, row)) + f"</{tag}>\n"

    return '<?xml version="1.0" standalone="yes"?>\n<dataroot>\n' + "".join(map(record, rows)) + "</dataroot>\n"


def texts(path, pattern="*"):
    files = sorted(glob.glob(os.path.join(path, "**", pattern), recursive=True))
    return [open(f, encoding="utf-8").read() for f in files if os.path.isfile(f) and "part-" in f]


@pytest.mark.parametrize("split", [True, False])
def test_registered(spark, tmp_path, registry, split):
    names = ["lineNum", "craft", "notes"]
    (tmp_path / "in").mkdir()
    rows = [("LINE", "SHIP", "NOTES"), ("1", "", "a &amp; b"), ("2", "s", ""), ("3", "0", " z ")]
    (tmp_path / "in" / "d1.xml").write_text(document("dcf", names, rows))
    (tmp_path / "in" / "d2.xml").write_text(document("dcf", names, rows[:2]))
    out = pipelines.convert_registered(spark, str(tmp_path / "in"), registry, "dcf", 2, split)
    got = [(os.path.basename(r["file"]), r["rn"], *(r[n] for n in names)) for r in out.orderBy("file", "rn").collect()]
    assert got == [("d1.xml", 2, "1", None, "a & b"), ("d1.xml", 3, "2", "s", None), ("d2.xml", 2, "1", None, "a & b")]
    everything = pipelines.convert_registered(spark, str(tmp_path / "in"), registry, "dcf", 99999, split)
    assert everything.count() == 4

    target = str(tmp_path / "out")
    xml.write_records(everything, target, "dcf", {"source": "d 1.xml", "n": 4})
    written = "".join(texts(target, "*.xml"))
    assert "<craft>" in written and written.count("<dcf>") == 4 and "a &amp; b" in written
    assert written.count("<notes>") == 3
    back = read_records(spark, target, "dcf", names)
    ordered = [(r.lineNum, r.craft, r.notes) for r in back.orderBy("file", "rn").collect()]
    assert ordered == [("1", None, "a & b"), ("2", "s", None), ("3", "0", " z "), ("1", None, "a & b")]
    for tag in (None, "dcf"):
        roots = read_root_attributes(spark, target, tag).collect()
        assert {(r.source, r.declared_n) for r in roots} == {("d%201.xml", 4)}


def test_documents_are_written_in_order_by_many_tasks(spark, tmp_path):
    df = spark.range(2000).select(
        F.lit("f").alias("file"), F.col("id").alias("rn"), F.col("id").cast("string").alias("a")).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        xml.write_records(df, str(tmp_path / "o"), "r")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(texts(str(tmp_path / "o"), "*.xml")) > 1
    back = read_records(spark, str(tmp_path / "o"), "r", ["a"]).orderBy("file", "rn").collect()
    assert [int(r.a) for r in back] == list(range(2000))


def test_attributes_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([("f", 2, "2", "x\x0b", "p"), ("f", 3, "3", None, "q")],
                               "file string, rn int, _n string, a string, source string")
    xml.write_records(df, str(tmp_path / "o"), "row", partition_by=["source"])
    assert sorted(os.listdir(tmp_path / "o"))[-2:] == ["source=p", "source=q"]
    assert '<row n="2">' in texts(str(tmp_path / "o" / "source=p"))[0]
    assert "<a>x</a>" in texts(str(tmp_path / "o" / "source=p"))[0]


def test_partitioned_documents_keep_their_order(spark, tmp_path):
    df = spark.range(3000).select(
        F.lit("f").alias("file"), F.col("id").alias("rn"), F.col("id").cast("string").alias("a"),
        F.when(F.col("id") % 3 > 0, F.lit("b")).alias("source")).repartition(5)
    xml.write_records(df, str(tmp_path / "o"), "r", partition_by=["source"])
    back = read_records(spark, str(tmp_path / "o"), "r", ["a"]).orderBy("file", "rn").collect()
    assert [int(r.a) for r in back if "=b/" in r.file] == [i for i in range(3000) if i % 3]
    assert [int(r.a) for r in back if "=b/" not in r.file] == [i for i in range(3000) if i % 3 == 0]


VOLUMES = {
    "CON31_05_n3.xml": ("c31a", ["1", "12345", "note", "3x"], ["31050001", "310512345", "note", "31050003"], "GOOD"),
    "CON33_12_n9.xml": ("c33a", ["1", "2"], ["33120001", "33120002"], "BOO"),
    "CON18_01_2_n2.xml": ("dlm", ["1", "22"], ["18012001", "18012022"], "GOOD"),
    "CON19_03_1_n2.xml": ("dlf", ["1", "22"], ["190310001", "190310022"], "GOOD"),
    "htg_absc_1840to1849_n2.xml": ("hga", ["1", "22"], ["18400001", "18400022"], "GOOD"),
    "htg_freedoms_1829_n2.xml": ("hgf", ["1", "22"], ["182900001", "182900022"], "GOOD"),
    "CON23_01_n1.xml": ("c23a", [], [], "BOO"),
}


def test_volumes(spark, tmp_path, registry):
    (tmp_path / "v").mkdir()
    for name, (_, lines, _, _) in VOLUMES.items():
        rows = [("row no", "badge", "family"), ("", "x", ""), *((n, "", "s") for n in lines)]
        (tmp_path / "v" / name).write_text(document("c31a", ["lineNum", "badgeNum", "family"], rows))
    out, verdicts = pipelines.convert_volumes(spark, str(tmp_path / "v"), registry, "c31a")
    got = {}
    for r in out.withColumn("name", file_name("file")).orderBy("file", "rn").collect():
        assert r.badgeNum is None and r.family == "s"
        got.setdefault(r.name, []).append((r.record_type, r.lineNum))
    assert got == {n: [(t, k) for k in keys] for n, (t, _, keys, _) in VOLUMES.items() if keys}
    named = {r.name: (r.declared_n, r.actual_n, r.verdict) for r in verdicts.withColumn("name", file_name("file")).collect()}
    assert named["CON33_12_n9.xml"] == (9, 2, "BOO") and named["CON23_01_n1.xml"] == (1, 0, "BOO")
    assert {n: v[2] for n, v in named.items()} == {n: v for n, (_, _, _, v) in VOLUMES.items()}


def test_volumes_are_read_twice_with_their_verdicts(spark, tmp_path, registry):
    tmp_path = tmp_path / "in"
    tmp_path.mkdir()
    (tmp_path / "CON31_05_n3.xml").write_text(document("c31a", ["lineNum"], [("L",), ("1",)]))
    out, verdicts = pipelines.convert_volumes(spark, str(tmp_path), registry, "c31a")
    plans = [df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended")) for df in (out, verdicts)]
    physical = [p.split("== Physical Plan ==")[1] for p in plans]
    kept = {m for p in physical for m in re.findall(r"Scan In-memory|InMemoryTableScan", p)}
    # The records scan the text once beside the summary; the verdicts have the summary only.
    scans = [len(re.findall(r"FileScan text", p)) for p in physical]
    summaries = [len(re.findall(r"InMemoryRelation", p)) for p in physical]
    assert kept and scans[0] - summaries[0] == 1 and scans[1] - summaries[1] == 0
    assert len({r for p in physical for r in re.findall(r"_call", p)}) <= 1


def test_volumes_that_break_their_promise_can_stop(spark, tmp_path, registry):
    tmp_path = tmp_path / "in"
    tmp_path.mkdir()
    (tmp_path / "CON31_05_n3.xml").write_text(document("c31a", ["lineNum"], [("L",), ("1",)]))
    out, verdicts = pipelines.convert_volumes(spark, str(tmp_path), registry, "c31a", fatal=True)
    assert [r.verdict for r in verdicts.collect()] == ["BOO"]
    with pytest.raises(Exception, match="count differs for .*CON31_05_n3.xml found 1"):
        out.select("lineNum").collect()
    with pytest.raises(Exception, match="count differs for"):
        out.where("lineNum = 'none'").count()
    (tmp_path / "CON31_05_n3.xml").write_text(document("c31a", ["lineNum"], [("L",), ("1",), ("2",), ("3",)]))
    assert pipelines.convert_volumes(spark, str(tmp_path), registry, "c31a", fatal=True)[0].count() == 3


@pytest.mark.parametrize("split", [True, False])
def test_a_file_without_the_type_stops(spark, tmp_path, registry, split):
    tmp_path = tmp_path / "in"
    tmp_path.mkdir()
    (tmp_path / "d1.xml").write_text(document("dcf", ["lineNum"], [("L",), ("1",)]))
    (tmp_path / "d2.xml").write_text(document("other", ["lineNum"], [("L",)]))
    with pytest.raises(Exception, match="no record of type dcf in .*d2.xml"):
        pipelines.convert_registered(spark, str(tmp_path), registry, "dcf", split=split).collect()
    with pytest.raises(Exception, match="no record of type dcf in .*d2.xml"):
        pipelines.convert_registered(spark, str(tmp_path / "d2.xml"), registry, "dcf", split=split).collect()


def test_unsupported_files_and_unknown_types_stop(spark, registry):
    def listing(*rows):
        return spark.createDataFrame(list(rows), "file string, file_name string, record_type string")

    good = ("f", "a.xls", "dcf"), ("n", "a.xlsx", "NEW")
    assert pipelines.convert_listing(listing(*good), registry)[0].count() == 2
    with pytest.raises(Exception, match="unsupported file g a.csv"):
        pipelines.convert_listing(listing(*good, ("g", "a.csv", "NEW")))[0].select("file").collect()
    with pytest.raises(Exception, match="unknown record type zzz of g"):
        pipelines.convert_listing(listing(*good, ("g", "a.xls", "zzz")), registry)[0].select("file").collect()


ODD = 'a & b "q" <t> \'s\' &amp; tab\there\nline\rend  é'


@pytest.mark.parametrize("many", [False, True])
def test_one_document_per_source_file(spark, tmp_path, many):
    rows = [(f"file:/in/{f}.xls", i, str(i), None if i % 3 else f"v<{i}>") for f in ("one", "two") for i in range(1, 700 if f == "one" else 3)]
    df = spark.createDataFrame(rows, "file string, rn bigint, _n string, a string").repartition(6)
    roots = spark.createDataFrame(
        [("file:/in/one.xls", ODD, 699), ("file:/in/two.xls", None, 2), ("file:/in/none.xls", "x", 0)], "file string, source string, n bigint")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, str(not many).lower())
    try:
        xml.write_documents(df, str(tmp_path / "o"), "row", roots)
    finally:
        spark.conf.set(key, "true")
    found = {}
    for output in glob.glob(str(tmp_path / "o" / "*" / "*")):
        parts = sorted(glob.glob(output + "/part-*"))
        assert not many or not output.endswith("output=one.xml") or len(parts) > 1
        root = ElementTree.fromstring("".join(open(p, newline="").read() for p in parts).encode())
        found[os.path.basename(output)] = (root.attrib, [(r.get("n"), r.findtext("a")) for r in root])
    assert found == {
        "output=one.xml": ({"source": ODD, "n": "699"}, [(str(i), None if i % 3 else f"v<{i}>") for i in range(1, 700)]),
        "output=two.xml": ({"n": "2"}, [("1", None), ("2", None)]), "output=none.xml": ({"source": "x", "n": "0"}, []),
    }
    told = {(r.source, r.declared_n) for r in read_root_attributes(spark, str(tmp_path / "o")).collect()}
    scanned = {(r.source, r.declared_n) for r in read_root_attributes(spark, str(tmp_path / "o"), "row").collect()}
    assert told == scanned == {(ODD, 699), (None, 2), ("x", 0)}
    with pytest.raises(Exception, match="no root for the records of file:/in/two.xls"):
        xml.record_documents(df, "row", roots.where("n <> 2")).collect()


def test_roots_from_names(spark):
    files = spark.createDataFrame([("f", "CON33_12_n9.xls"), ("g", "CON18_01_2_n7.xls"), ("h", "my x.xml")], "file string, file_name string")
    assert [tuple(r) for r in pipelines.file_roots(files).collect()] == [("f", "CON33_12_n9.xml", 9), ("g", "CON18_01_2_n7.xml", 7), ("h", "my x.xml", None)]


def test_volumes_need_a_volume(spark, tmp_path, registry):
    (tmp_path / "other.xml").write_text(document("c31a", ["lineNum"], [("L",), ("1",)]))
    out, verdicts = pipelines.convert_volumes(spark, str(tmp_path / "other.xml"), registry, "c31a")
    with pytest.raises(Exception, match="no volume in the name of"):
        out.collect()
    assert verdicts.first().verdict == "BOO"


def test_deaths(spark, tmp_path, registry):
    lines = ["n\td\tm\ty\tr\ta", "1\t3\t4\t1850\t Cooper\x92s child \t30", "2\t3\t4\t\tx<y\t0", "", "3\t\t\t1851\t0\t00"]
    (tmp_path / "deaths.dat").write_bytes("\r\n".join(lines).encode("latin-1"))
    out = pipelines.convert_delimited(spark, str(tmp_path / "deaths.dat"), registry, "kgd")
    assert out.columns == ["file", "block", "rn", "lineNum", "deathDate", "rank", "age"]
    assert [tuple(r)[2:] for r in out.orderBy("rn").collect()] == [
        (2, "1", "1850-04-03", "Cooper' child", "30"), (3, "2", None, "x<y", None), (4, None, None, None, None),
        (5, "3", "1851-00-00", None, "00")]
    assert tuple(pipelines.check_delimited(out, "kgd").first()) == ("kgd", 92885, 4, "BOO")
    assert pipelines.check_delimited(out, "kgd", 4, fatal=True).first().verdict == "GOOD"
    kept = pipelines.convert_delimited(
        spark, str(tmp_path / "deaths.dat"), registry, "kgd", keep_zero=True, keep_parts=True, correct=True)
    assert [tuple(r)[2:] for r in kept.orderBy("rn").collect()][:2] == [
        (2, "1", None, None, "1850-04-03", "Cooper's child", "30"), (3, "2", "3", "4", None, "x<y", "0")]
    xml.write_records(out, str(tmp_path / "o"), "kgd", {"source": "deaths.dat", "n": 4})
    written = "".join(texts(str(tmp_path / "o")))
    assert "<kgd/>" in written and "x&lt;y" in written and "<age>0</age>" not in written


def test_marriages(spark, tmp_path, registry, tiny_splits, monkeypatch):
    rows = [(i, 1850 + i % 9, f"José {i}", i % 28 + 1, i % 12 + 1, "l\tm") for i in range(1, 1200)]
    text = "\n".join(["header", *("\t".join(map(str, r)) for r in rows)]) + "\n"
    (tmp_path / "m.dat").write_bytes(text.encode("latin-1"))
    path = str(tmp_path / "m.dat")
    out = pipelines.convert_delimited(spark, path, registry, "kgm").orderBy("rn").collect()
    assert [(r.entryNo, r.marriageDate, r.given, r.last) for r in out] == [
        (str(i), f"{y}-{m:02d}-{d:02d}", f, "l\tm") for i, y, f, d, m, _ in rows]
    carried = pipelines.convert_delimited(spark, path, registry, "kgm", carry=True).orderBy("rn").collect()
    before = [(0, 0), *((d, m) for _, _, _, d, m, _ in rows)]
    assert [r.marriageDate for r in carried] == [f"{r[1]}-{m:02d}-{d:02d}" for r, (d, m) in zip(rows, before)]
    as_scanned = pipelines.convert_delimited(spark, path, registry, "kgm")
    xml.write_records(as_scanned, str(tmp_path / "o"), "kgm")
    back = read_records(spark, str(tmp_path / "o"), "kgm", ["entryNo"]).orderBy("file", "rn").collect()
    assert [int(r.entryNo) for r in back] == list(range(1, 1200))
    # Too many splits for a broadcast: rows move, their order on disk does not change.
    monkeypatch.setattr(files, "MAX_BROADCAST_SPLITS", 0)
    xml.write_records(pipelines.convert_delimited(spark, path, registry, "kgm"), str(tmp_path / "moved"), "kgm")
    back = read_records(spark, str(tmp_path / "moved"), "kgm", ["entryNo"]).orderBy("file", "rn").collect()
    assert [int(r.entryNo) for r in back] == list(range(1, 1200))
    short = pipelines.convert_delimited(spark, path, registry, "kgm", n_fields=5)
    assert short.columns[-1] == "given" and short.count() == len(rows)


BOOK = [
    ("one", [["f1 id", "Master's #", "xxxx"], [1, "a & b\r\n\r\nc", ""], [0, " &lt;i&gt; &quot;q&quot; ", None]]),
    ("two", [["other", ""], ["v", "w"]]),
]


def test_workbooks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "my book.xlsx").write_bytes(workbook_bytes(BOOK))
    elements, cells = pipelines.convert_workbooks(spark, str(tmp_path / "in"))
    rows = [(r.sheet_no, r.n, r.element, r.value) for r in elements.orderBy("sheet_no", "n", "ordinal").collect()]
    assert rows == [(1, 2, "f01_id", "1"), (1, 2, "Masters_No_", "a & b#PARA_START#c"),
                    (1, 3, "Masters_No_", '<i> "q"'), (2, 2, "other", "v"), (2, 2, "_c2", "w")]
    tabular.write_tsv_cells(cells, str(tmp_path / "tab"))
    (folder,) = (tmp_path / "tab").glob("folder=*")
    assert folder.name.endswith("%2Fin") and sorted(d for d in os.listdir(folder) if d.startswith("output")) == [
        "output=my_book.tab", "output=my_book_2.tab"]
    first = "".join(texts(str(folder / "output=my_book.tab")))
    assert first == 'f01_id\tMasters_No_\txxxx\n1\ta &amp; b#PARA_START#c\t\n0\t&lt;i&gt; "q"\t\n'
    xml.write_rows(cells, str(tmp_path / "xml"), {"generatedBy": "test"})
    (document,) = texts(str(tmp_path / "xml"), "*.txt")[:1]
    assert document == (
        '<?xml version="1.0" encoding="UTF-8"?>\n<dataroot generatedBy="test">\n<row n="2">\n<f01_id>1</f01_id>\n'
        '<Masters_No_>a &amp; b#PARA_START#c</Masters_No_>\n</row>\n<row n="3">\n'
        '<Masters_No_>&lt;i&gt; "q"</Masters_No_>\n</row>\n</dataroot>\n')
    tabular.write_audit(cells, str(tmp_path / "audit"))
    audit = spark.read.parquet(str(tmp_path / "audit"))
    assert audit.count() == 13 and audit.where("raw = 'f1 id' and cleaned = 'f01_id' and row = 0").count() == 1
    made = registry_from_header(cells, F.concat(F.lit("t"), F.col("sheet_no").cast("string")))
    assert sorted((r.record_type, r.ordinal, r.column) for r in made.collect()) == [
        ("t1", 1, "f01_id"), ("t1", 2, "Masters_No_"), ("t1", 3, "xxxx"), ("t2", 1, "other"), ("t2", 2, "_c2")]


def test_rows_of_many_sheets(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        for k in range(3):
            rows = [["h"], *([f"{folder}{k}-{i}" if i % 9 else None] for i in range(100))]
            (tmp_path / folder / f"{k}.xlsx").write_bytes(workbook_bytes([("s", rows), ("t", rows[:5]), ("u", rows[:1])]))
    _, cells = pipelines.convert_workbooks(spark, str(tmp_path))
    xml.write_rows(cells, str(tmp_path / "o"))
    found = {}
    for document in sorted(glob.glob(str(tmp_path / "o" / "*" / "*" / "*.txt"))):
        text = open(document).read()
        root = ElementTree.fromstring(text.split("\n", 1)[1])
        where = tuple(p.split("=")[1] for p in document.split("/")[-3:-1])
        found.setdefault(where, []).extend((int(r.get("n")), r.findtext("h")) for r in root)
    assert len(found) == 18
    for (folder, output), rows in found.items():
        stem = folder[-1] + output[0]
        n = 4 if "_2" in output else 0 if "_3" in output else 100
        assert rows == [(i + 2, f"{stem}-{i}" if i % 9 else None) for i in range(n)]


def test_a_value_in_a_dropped_column_stops(spark, tmp_path):
    (tmp_path / "b.xlsx").write_bytes(workbook_bytes([("s", [["a", "xxxx"], ["1", "oops"]])]))
    with pytest.raises(Exception, match="dropped column xxxx has value oops"):
        pipelines.convert_workbooks(spark, str(tmp_path))[0].collect()
    with pytest.raises(Exception, match="dropped column xxxx has value oops"):
        xml.row_documents(pipelines.convert_workbooks(spark, str(tmp_path))[1]).collect()


def test_stubs(spark, tmp_path):
    files = spark.createDataFrame(
        [("d/f1", "survey_MISSINGFILE.xls", "dcf"), ("e/f2", "x_n.xls", "dcf"), ("f3", "real.xls", "dcf")],
        "file string, file_name string, record_type string")
    held, stubs = pipelines.convert_listing(files)
    assert [(r.file, r.route) for r in held.collect()] == [("f3", "registered")]
    xml.write_stubs(stubs, str(tmp_path / "o"))
    written = [t for t in texts(str(tmp_path / "o"), "*.txt") if "x_n" in t]
    assert written == ['<?xml version="1.0" encoding="UTF-8"?>\n<dataroot source="x_n.xml" n="0">\n</dataroot>\n']
    assert read_root_attributes(spark, str(tmp_path / "o")).where("declared_n = 0").count() == 2


def test_registry_round_trip(spark, tmp_path, registry):
    named = registry.where("record_type is not null")
    back = xml.write_registry(named, str(tmp_path / "o"))
    columns = ["record_type", "ordinal", "column"]
    assert sorted(map(str, back.select(columns).collect())) == sorted(map(str, named.select(columns).collect()))
    types = back.select("entry_no", "record_type").distinct().orderBy("entry_no").collect()
    assert [r.record_type for r in types] == ["NEW", "draft", "dcf", "c31a", "kgd", "kgm", "empty"]


def test_dictionary_document(spark, tmp_path, registry):
    words = spark.createDataFrame([("craft", "a vessel")], "key string, description string")
    meta = spark.createDataFrame([("dcf", 7, "Deaths", "typed", "d.txt", "9")], "record_type string, num_recs int,"
                                 "desc string, source string, documentation string, archive_id string")
    entries = pipelines.build_dictionary(registry.where("record_type is not null"), words, meta, "u/", "a/")
    xml.write_dictionary(entries, str(tmp_path / "o"))
    written = "".join(texts(str(tmp_path / "o")))
    assert written.count("<record ") == 5
    dcf = written[written.index('<record key="dcf"'):]
    dcf = dcf[: dcf.index("</record>")]
    assert 'n="7"' in dcf and "<label>Deaths</label>" in dcf and "<archive>a/9</archive>" in dcf
    assert dcf.index('key="lineNum"') < dcf.index('key="craft"') < dcf.index('key="notes"')
    assert '<elementName column="2">craft</elementName>' in dcf and "a vessel" in dcf


def test_provenance(spark):
    df = spark.createDataFrame([("file:/x/CON31_05%20a_n3.xml", 1)], "file string, rn int")
    row = records.with_provenance(df).first()
    assert (row.source, row.series, row.volume, row.expected_n) == ("CON31_05 a_n3.xml", "31", "3105", 3)
    assert [r.rn for r in records.order_by_document(df).collect()] == [1]


def test_registered_type_from_workbooks(spark, tmp_path, registry):
    rows = [["x", "y", "z", "beyond"], *([i, f"s{i}" if i % 3 else "", "0", "more"] for i in range(1, 130))]
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes([("one", rows), ("two", rows[:3])]))
    cells = pipelines.read_workbook_cells(spark, str(tmp_path / "a.xlsx"))
    found = pipelines.convert_registered_cells(cells, registry, "dcf", 99).orderBy("block", "rn").collect()
    assert [(r.block, r.rn, r.lineNum, r.craft, r.notes) for r in found] == [
        (k, i + 1, str(i), f"s{i}" if i % 3 else None, "0") for k, n in ((1, 99), (2, 2)) for i in range(1, n + 1)]


def test_blanks_in_a_dropped_column_are_no_value(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes([("s", [["h", "xxxx"], ["v", "  "]])]))
    elements, _ = pipelines.convert_workbooks(spark, str(tmp_path))
    assert [(r.element, r.value) for r in elements.collect()] == [("h", "v")]
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes([("s", [["h", "xxxx"], ["v", " w "]])]))
    with pytest.raises(Exception, match="dropped column xxxx"):
        pipelines.convert_workbooks(spark, str(tmp_path))[0].collect()


def test_a_report_is_observed_while_records_are_written(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("rn"), F.lit("f").alias("file"), F.when(F.col("id") % 4 > 0, "a").otherwise("b").alias("kind"))
    spark.sparkContext.setJobGroup("reported", "write")
    try:
        report = pipelines.write_and_report(df, lambda rows, watch: watch(rows).write.parquet(str(tmp_path / "o")), {"a": 750, "b": 9}, F.col("kind"))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("reported"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == 1 and sorted(map(tuple, report.collect())) == [("a", 750, 750, "GOOD"), ("b", 9, 250, "BOO")]
    want = spark.read.parquet(str(tmp_path / "o")).groupBy("kind").count().collect()
    assert {(r["kind"], r["count"]) for r in want} == {(r.record_type, r.actual_n) for r in report.collect()}
    one = pipelines.write_and_report(df, lambda rows, watch: xml.write_records(rows, str(tmp_path / "x"), "r", watch=watch), {"r": 1000}, fatal=True)
    assert one.first().verdict == "GOOD"
    with pytest.raises(Exception, match="count differs for r found 1000"):
        pipelines.write_and_report(df, lambda rows, watch: watch(rows).write.parquet(str(tmp_path / "p")), {"r": 999}, fatal=True).collect()


def test_rows_and_cells_of_workbooks_give_the_same(spark, tmp_path, registry):
    from quillgrid.sources.workbook import cells_of, read_workbook_rows

    sheets = [
        *BOOK, ("three", [[None, "h 1", "h&2", "h 1"], [None, " a ", "0", ""], [None, None, None, None], [None, "x\r\ny", "<b>", "&lt;"]]),
        ("four", [["only", "header"]]),
    ]
    (tmp_path / "a b.xlsx").write_bytes(workbook_bytes(sheets))
    rows = read_workbook_rows(spark, str(tmp_path / "a b.xlsx"))
    cells = cells_of(rows)
    for made in (tabular.tsv_lines, tabular.audit_cells, lambda x: xml.row_documents(x, {"by": "t"}),
                 lambda x: pipelines.convert_registered_cells(x, registry, "dcf", 2), lambda x: registry_from_header(x, F.col("sheet_name"))):
        by_row, by_cell = made(rows), made(cells)
        names = sorted(by_cell.columns)
        assert sorted(by_row.columns) == names
        assert sorted(map(str, by_row.select(names).collect())) == sorted(map(str, by_cell.select(names).collect()))


def test_rows_to_records(spark):
    from quillgrid.operators.reshape import cells_to_records, rows_to_records

    rows = spark.createDataFrame(
        [("f", 1, 1, ["a", "b", "a"], ["1", None, "3"]), ("f", 1, 2, ["a", "b", "a"], [None, "x", None]), ("f", 1, 3, [], [])],
        "file string, sheet_no int, n int, header array<string>, values array<string>")
    entries = F.transform(F.arrays_zip("header", "values"), lambda p: F.struct(p["header"].alias("element"), p["values"].alias("value")))
    assert {r.n: r.record for r in rows_to_records(rows, entries).collect()} == {1: {"a": "3"}, 2: {"b": "x"}, 3: {}}
    named = {r.n: (r.a, r.b, r.z) for r in rows_to_records(rows, entries, ["a", "b", "z"]).collect()}
    assert named == {1: ("3", None, None), 2: (None, "x", None), 3: (None, None, None)}
    cells = rows.select("file", "sheet_no", "n", F.posexplode(entries).alias("col", "e")).select("file", "sheet_no", "n", "col", "e.*").where("value IS NOT NULL")
    assert {r.n: r.record for r in cells_to_records(cells).collect()} == {1: {"a": "3"}, 2: {"b": "x"}}
