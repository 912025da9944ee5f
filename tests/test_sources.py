import pytest
from pyspark.sql import functions as F

from quillgrid.functions import file_name
from quillgrid.operators import schema
from quillgrid.operators.ordering import number_splits
from quillgrid.plans.samples import workbook_bytes
from quillgrid.sources.files import list_files, split_bound
from quillgrid.sources.lines import WINDOWS_1252, read_delimited, read_dictionary, read_lines, scan_records
from quillgrid.sources.record_xml import read_records, read_root_attributes
from quillgrid.sources.registry import read_registry
from quillgrid.sources.workbook import cells_from_content, read_workbook_cells


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("file", "rn").collect()]


def test_registry(registry):
    rows = {}
    for r in registry.orderBy("entry_no", "ordinal").collect():
        rows.setdefault(r["record_type"], []).append((r["ordinal"], r["column"]))
    assert rows["NEW"] == [(None, None)]
    assert rows["dcf"] == [(1, "lineNum"), (2, "craft"), (3, "notes")]
    assert rows[None] == [(1, "orphan")]
    assert schema.registry_names(registry, "kgd")[3] == "deathYr"
    assert schema.registry_names(registry, "NEW") == []
    with pytest.raises(ValueError):
        schema.registry_names(registry, "unknown")


def test_registry_checks(spark, registry):
    warned = {r["record_type"]: (r["n_columns"], r["warning"]) for r in schema.columns_per_type(registry).collect()}
    assert warned["NEW"] == (0, None) and warned["empty"] == (0, "no columns") and warned["dcf"] == (3, None)
    assert warned[None] == (1, "no id")
    assert schema.missing_ids(registry).count() == 1
    types = registry.select("record_type").distinct().where("record_type is not null")
    assert [r[0] for r in schema.types_without_columns(types, registry).select("record_type").collect()] == ["empty"]
    named = registry.where("record_type is not null")
    assert schema.type_list(named).first()[0] == "NEW,draft,dcf,c31a,kgd,kgm,empty"
    lists = {r["record_type"]: r["names"] for r in schema.qname_list(registry).collect()}
    assert lists["c31a"] == "lineNum,badgeNum,family"
    asked = spark.createDataFrame([("dcf",), ("dc",), ("NEW",)], "record_type string")
    assert {r[0] for r in schema.known_types(asked, registry).collect()} == {"dcf", "NEW"}
    described = schema.describe_types(registry).where("record_type = 'dcf'").orderBy("ordinal").collect()
    assert [(r["letter"], r["column"]) for r in described] == [("A", "lineNum"), ("B", "craft"), ("C", "notes")]


@pytest.mark.parametrize("text", ["<CONFIG><RECORD_TYPE ID='a'><C>x</RECORD_TYPE></CONFIG>",
                                  "<CONFIG><RECORD_TYPE ID='a'><C>x</C></RECORD_TYPE><oops></CONFIG>"])
def test_registry_must_be_well_formed(spark, tmp_path, text):
    (tmp_path / "bad.xml").write_text(text)
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        read_registry(spark, str(tmp_path / "bad.xml")).collect()


def test_lines_keep_blanks_and_order_across_splits(spark, tmp_path, tiny_splits):
    lines = ["" if i % 7 == 0 else f"{i} " + "x" * (i % 40) for i in range(1500)]
    (tmp_path / "a b+1.dat").write_text("\n".join(lines))
    (tmp_path / "z.dat").write_text("only\n")
    df = read_lines(spark, str(tmp_path))
    assert df.where(F.col("file").contains("1.dat")).select("block").distinct().count() > 4
    by_name = df.select(file_name("file").alias("f"), "rn", "line").orderBy("rn").collect()
    assert [r["line"] for r in by_name if r["f"] == "a b+1.dat"] == lines
    assert [r["rn"] for r in by_name if r["f"] == "a b+1.dat"] == list(range(1, 1501))
    assert [r["line"] for r in by_name if r["f"] == "z.dat"] == ["only"]


def test_delimited_records(spark, tmp_path):
    text = b"h1\th2\th3\r\n1\t x \t0\r\n\r\n2\ta\tb\tc\n3\n\t\t\nlast\x92s\tit\x92s\t\xc4\x92s"
    (tmp_path / "d.dat").write_bytes(text)
    rows = values(read_delimited(spark, str(tmp_path), ["a", "b", "c"]), "rn", "a", "b", "c")
    assert rows == [
        (2, "1", "x", "0"), (3, "", None, None), (4, "2", "a", "b\tc"), (5, "3", None, None), (6, "", "", ""),
        (7, "last'", "it�s", "Ēs"),
    ]
    kept = values(read_delimited(spark, str(tmp_path), ["a", "b", "c"], correct=True), "a", "b", "c")
    assert kept[-1] == ("last's", "it's", "Ēs")
    two = values(read_delimited(spark, str(tmp_path), ["a", "b", "c"], n_fields=2, header=False), "a", "b")
    assert two[0] == ("h1", "h2\th3") and two[3] == ("2", "a\tb\tc")


def test_charsets(spark, tmp_path):
    (tmp_path / "l.dat").write_bytes("h\nJosé\x92s\t\x85\x80".encode("latin-1"))
    path = str(tmp_path / "l.dat")
    assert values(read_delimited(spark, path, ["a", "b"], charset="ISO-8859-1"), "a", "b") == [("José'", "\x85\x80")]
    cp = values(read_delimited(spark, path, ["a", "b"], charset="windows-1252", repair=False), "a", "b")
    assert cp == [("José’s", "…€")]
    assert WINDOWS_1252 == "".join(bytes([b]).decode("cp1252", "replace").replace("�", " ") for b in range(128, 160))


def test_splits_are_pinned_and_checked(spark, tmp_path):
    (tmp_path / "m.dat").write_text("h\n1\n2\n")
    assert read_lines(spark, str(tmp_path)).count() == 3
    assert spark.conf.get("spark.sql.files.minPartitionNum") == "4"
    shifted = spark.createDataFrame([("f", 0, 0), ("f", 0, 2)], "file string, block bigint, pos bigint")
    with pytest.raises(Exception, match="split differently"):
        number_splits(shifted, "file", "block", "pos", True).collect()


RECORDS = """<?xml version="1.0" encoding="UTF-8"?>
<dataroot source="a&amp;b" n="3">
  <dcf><lineNum>LINE</lineNum><craft>SHIP</craft></dcf>
  <dcf n="1"><lineNum> 1 &amp; </lineNum><craft/><dcfNote>x</dcfNote></dcf>
  <dcf/>
  <dcf
   n="3"><lineNum>3</lineNum><craft></craft></dcf>
</dataroot>
"""


@pytest.mark.parametrize("split", [True, False])
def test_record_xml(spark, tmp_path, split):
    (tmp_path / "r.xml").write_text(RECORDS)
    df = read_records(spark, str(tmp_path), "dcf", ["_n", "lineNum", "craft", "dcfNote"], split)
    assert values(df, "rn", "_n", "lineNum", "craft", "dcfNote") == [
        (1, None, "LINE", "SHIP", None), (2, "1", " 1 & ", None, "x"), (3, None, None, None, None),
        (4, "3", "3", None, None)]
    (tmp_path / "r.xml").write_text(RECORDS.replace("dcfNote", "note"))
    df = read_records(spark, str(tmp_path), "dcf", ["_n", "lineNum", "craft", "note"], split)
    assert values(df, "rn", "_n", "lineNum", "craft", "note") == [
        (1, None, "LINE", "SHIP", None), (2, "1", " 1 & ", None, "x"), (3, None, None, None, None),
        (4, "3", "3", None, None)]
    roots = read_root_attributes(spark, str(tmp_path)).collect()
    assert [(r["source"], r["declared_n"]) for r in roots] == [("a&b", 3)]


@pytest.mark.parametrize("tag", ["q", "a"])
def test_record_xml_is_read_by_many_tasks(spark, tmp_path, tiny_splits, tag):
    body = "".join(f"<{tag}><a1>{i}</a1></{tag}>\n" if i % 11 else f"<{tag}/>\n" for i in range(3000))
    (tmp_path / "r.xml").write_text(f"<dataroot>\n{body}</dataroot>\n")
    (tmp_path / "s.xml").write_text("<dataroot></dataroot>\n")
    df = read_records(spark, str(tmp_path), tag, ["a1"]).withColumnRenamed("a1", "a")
    assert df.select("block").distinct().count() > 5
    assert values(df, "rn", "a") == [(i + 1, str(i) if i % 11 else None) for i in range(3000)]


def test_broken_records_stop_the_job(spark, tmp_path):
    (tmp_path / "r.xml").write_text("<dataroot><r><a>1</b></r></dataroot>")
    with pytest.raises(Exception, match="MALFORMED"):
        read_records(spark, str(tmp_path), "r", ["a"]).collect()
    for text in ("<dataroot><r><a>1</a>", "<dataroot><r><a>1</a></r><row/></dataroot>"):
        (tmp_path / "r.xml").write_text(text)
        with pytest.raises(Exception, match="is not closed, or a tag starts"):
            read_records(spark, str(tmp_path), "r", ["a"]).collect()


def test_split_bounds(spark, tmp_path, tiny_splits):
    (tmp_path / "a.dat").write_text("x" * 9000)
    (tmp_path / "b.dat").write_text("x")
    assert split_bound(spark, str(tmp_path)) == 4
    assert scan_records(spark, str(tmp_path)).rdd.getNumPartitions() <= 4


def test_dictionary(spark, tmp_path):
    (tmp_path / "d.txt").write_text("# note\ncraft\tfirst\nage\tin\tyears\ncraft\tlast\r\nbare\n")
    rows = {r["key"]: r["description"] for r in read_dictionary(spark, str(tmp_path)).collect()}
    assert rows == {"craft": "last", "age": "in\tyears", "bare": None}


SHEETS = [
    ("one", [["f1 id", "Police #", "", "dup", "dup"], [1, "a & b", "x", "l", "r"], [0, None, "", "", ""], ["00", "t"]]),
    ("two", [["other"], ["<v>"]]),
    ("void", []),
]


def test_workbook_cells(spark, tmp_path):
    (tmp_path / "my book.xlsx").write_bytes(workbook_bytes(SHEETS))
    cells = read_workbook_cells(spark, str(tmp_path))
    rows = [tuple(r) for r in cells.orderBy("sheet_no", "row", "col").select(
        "sheet_no", "sheet_name", "row", "col", "n", "header", "value").collect()]
    assert rows[5:10] == [
        (1, "one", 1, 0, 2, "f1 id", "1"), (1, "one", 1, 1, 2, "Police #", "a & b"), (1, "one", 1, 2, 2, "", "x"),
        (1, "one", 1, 3, 2, "dup", "l"), (1, "one", 1, 4, 2, "dup", "r")]
    assert rows[17] == (1, "one", 3, 2, 4, "", "") and len(rows) == 22
    assert rows[-1] == (2, "two", 1, 0, 2, "other", "<v>")
    sparse = cells_from_content(
        spark.createDataFrame([("f", workbook_bytes(SHEETS))], "file string, content binary"), dense=False)
    assert sparse.where("sheet_no = 1 and n = 4").count() == 2


def test_hand_written_sheet(spark):
    """Explicit references, gaps, inline and rich text, booleans, formula text."""
    import io
    import zipfile

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    sheet = f"""<worksheet xmlns="{main}"><sheetData>
      <row r="3"><c r="B3" t="inlineStr"><is><t>h</t></is></c><c r="D3" t="s"><v>0</v></c></row>
      <row r="5"><c r="C5"><v>1.50</v></c><c r="D5" t="str"><f>x</f><v>calc</v></c><c t="b"><v>1</v></c></row>
    </sheetData></worksheet>"""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr("xl/worksheets/s.xml", sheet)
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/'
                      'officeDocument/2006/relationships"><sheets><sheet name="s" r:id="r1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<R><Relationship Id="r1" Target="/xl/worksheets/s.xml"/></R>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><r><t>ri</t></r><r><t>ch</t></r>'
                      "<rPh><t>no</t></rPh></si></sst>")
    df = cells_from_content(spark.createDataFrame([("f", out.getvalue())], "file string, content binary"))
    rows = {(r["row"], r["col"]): (r["n"], r["header"], r["value"]) for r in df.collect()}
    assert len(rows) == 12
    assert rows[2, 1] == (1, "h", "h") and rows[2, 3] == (1, "rich", "rich") and rows[3, 1] == (2, "h", "")
    assert rows[4, 2] == (3, "", "1.50") and rows[4, 3] == (3, "rich", "calc") and rows[4, 4] == (3, "", "1")


def test_executors_need_no_copy_of_the_package(spark, tmp_path):
    """Run in another folder, where workers cannot import the package."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "b.xlsx").write_bytes(workbook_bytes([("s", [["h"], ["v"]])]))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from quillgrid.session import session\nfrom quillgrid.sources.workbook import read_workbook_cells\n"
        "spark = session(master='local[1]', **{'spark.ui.enabled': 'false'})\n"
        f"print('cells', read_workbook_cells(spark, {str(tmp_path)!r}).count())"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, capture_output=True, text=True,
                          timeout=300)
    assert "cells 2" in done.stdout, done.stderr[-2000:]


def test_unreadable_workbook(spark):
    books = spark.createDataFrame(
        [("bad", b"no zip"), ("good", workbook_bytes([("s", [["h"]])]))], "file string, content binary")
    with pytest.raises(Exception, match="cannot read workbook bad"):
        cells_from_content(books).collect()
    rows = {r["file"]: (r["value"], r["error"] is None) for r in cells_from_content(books, keep_bad=True).collect()}
    assert rows == {"bad": (None, False), "good": ("h", True)}


def test_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x y.xls").write_text("abc")
    rows = list_files(spark, str(tmp_path)).collect()
    assert [(r["file_name"], r["length"]) for r in rows] == [("x y.xls", 3)]


def test_strict_workbooks_and_workbooks_without_sheets(spark):
    import io
    import zipfile

    from quillgrid.plans.samples import workbook_bytes
    from quillgrid.sources.workbook import MAIN, RELATION_ID, cells_from_content

    def rewritten(change):
        out = io.BytesIO()
        with zipfile.ZipFile(io.BytesIO(workbook_bytes([("s", [["h"], ["v"]])]))) as old, zipfile.ZipFile(out, "w") as new:
            for name in old.namelist():
                new.writestr(name, change(old.read(name).decode()))
        return out.getvalue()

    def strict(text):
        text = text.replace(MAIN.strip("{}"), "http://purl.oclc.org/ooxml/spreadsheetml/main")
        return text.replace(RELATION_ID[1:].split("}")[0], "http://purl.oclc.org/ooxml/officeDocument/relationships")

    def bare(text):
        return text.replace('<sheet name="s" sheetId="1" r:id="rId1"/>', "")

    books = [("strict", rewritten(strict)), ("bare", rewritten(bare))]
    cells = cells_from_content(spark.createDataFrame(books, "file string, content binary"), keep_bad=True)
    found = sorted((r.file, r.value or "", r.error or "") for r in cells.collect())
    assert found == [("bare", "", "the workbook lists no sheet"), ("strict", "h", ""), ("strict", "v", "")]


def test_roots_are_read_from_heads(spark, tmp_path):
    from quillgrid.sources.record_xml import first_element, read_roots

    head = '<?xml version="1.0" encoding="ISO-8859-1"?>\n<!-- <dataroot n="0"/> -->\n<dataroot\n source=\'a>b &#233; "\' n="7">\n'
    for name, more in (("short one.xml", 10), ("long.xml", 3_000_000_000)):
        with open(tmp_path / name, "wb") as f:
            f.write((head + "<r/>").encode("latin-1"))
            f.truncate(more + 200)  # a hole: reading through it would take long
    (tmp_path / "other.xml").write_text("<other/>")
    (tmp_path / "empty.xml").write_text("")
    (tmp_path / "text.xml").write_text("no xml")
    found = {r.file.rsplit("/", 1)[1]: r.attributes for r in read_roots(spark, str(tmp_path)).collect()}
    assert found == {name: {"source": 'a>b é "', "n": "7"} for name in ("short%20one.xml", "long.xml")}

    taken = []
    text = head.encode("latin-1") + b" " * 10_000_000

    def read(size):
        start = sum(taken)
        taken.append(size)
        return text[start:start + size]

    assert first_element(read) == ("dataroot", {"source": 'a>b é "', "n": "7"}) and len(taken) == 1
    wide = b"<dataroot " + b"".join(b'a%d="%s" ' % (i, b"x" * 90) for i in range(5000)) + b">"
    taken.clear()
    text = wide + b" " * 10_000_000
    assert len(first_element(read)[1]) == 5000 and sum(taken) < 2 * len(wide)


def test_a_large_workbook_is_read_by_several_tasks(spark, tmp_path):
    from quillgrid.sources.workbook import read_workbook_rows

    rows = [["h", "i"], *([i, f"text {i * 7919 % 1000}"] for i in range(3000))]
    (tmp_path / "large one.xlsx").write_bytes(workbook_bytes([(f"s{k}", rows) for k in range(5)]))
    for k in range(4):
        (tmp_path / f"small{k}.xlsx").write_bytes(workbook_bytes([("s", rows[:3])]))
    found = read_workbook_rows(spark, str(tmp_path), split_bytes=20_000)
    tasks = {r.p: (r.files, r.sheets) for r in found.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count_distinct("file").alias("files"), F.count_distinct("sheet_no").alias("sheets")).collect()}
    assert sorted(tasks.values()) == [(1, 1)] * 5 + [(4, 1)]
    per_sheet = found.groupBy("file", "sheet_no").agg(F.count("*").alias("n"), F.max("n").alias("most"), F.count_if("last").alias("last"))
    assert sorted((r.n, r.most, r.last) for r in per_sheet.collect()) == [(3, 3, 1)] * 4 + [(3001, 3001, 1)] * 5


def test_long_sheets_and_books_that_break_off(spark, tmp_path, monkeypatch):
    from quillgrid.sources import workbook

    monkeypatch.setattr(workbook, "HELD_CELLS", 10)
    rows = [["h"], *([str(i)] for i in range(50)), ["x", "wide"]]
    book = workbook_bytes([("s", rows), ("t", rows[:3])])
    made = list(workbook._book_rows("f", __import__("io").BytesIO(book), True, False))
    assert [(r[1], r[4], r[5], r[8]) for r in made if r[5] or r[4] == 2] == [
        (1, 2, False, ["0", ""]), (1, 52, True, ["x", "wide"]), (2, 2, False, ["0"]), (2, 3, True, ["1"])]
    import io
    import zipfile

    broken = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(book)) as old, zipfile.ZipFile(broken, "w") as new:
        for name in old.namelist():
            content = old.read(name)
            new.writestr(name, content[: len(content) // 2] if name.endswith("sheet2.xml") else content)
    books = spark.createDataFrame([("bad", broken.getvalue())], "file string, content binary")
    kept = cells_from_content(books, keep_bad=True).collect()
    assert len(kept) == 1 and kept[0].error and kept[0].value is None
    with pytest.raises(Exception, match="cannot read workbook bad"):
        cells_from_content(books).collect()


def test_row_shaped_sparse_rows(spark):
    from quillgrid.sources.workbook import rows_from_content

    book = workbook_bytes([("s", [["a", None, "c"], [None, "x", None], [1, None, 2]])])
    rows = rows_from_content(spark.createDataFrame([("f", book)], "file string, content binary"), dense=False)
    assert [(r.n, r.first_col, r["values"], r.last) for r in rows.orderBy("n").collect()][0][1] == 0
