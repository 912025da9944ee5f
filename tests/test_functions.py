import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillgrid import functions as Q
from quillgrid.functions.dates import as_date

PIECES = st.sampled_from(
    ["&", "#", "amp;", "gt;", "lt;", "apos;", "quot;", "&apos", ";", "\r\n", "\r", "\n", "\t", "\f", "\x0b", " ", "f1 ",
     "f", "12", "0", "_", "(", ")", "/", "\\", "'", '"', "é", "日", "𝄞", "x", "+", "-", "."]
)
TEXTS = st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=200, max_size=400)
FEW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def plain_entities(s):
    s = re.sub("&(gt;|lt;|apos;|quot;)", r"#\1", s).replace("&", "&amp;")
    return re.sub("#(gt;|lt;)", r"&\1", s).replace("#apos;", "'").replace("#quot;", '"')


def plain_breaks(s):
    s = re.sub("\r\n(\r\n)+", "#PARA_START#", s).replace("\r\n", "#RETURN#")
    return re.sub("\r\r+", "#PARA_START#", s).replace("\r", "#RETURN#")


def plain_header(s):
    s = re.sub(r"\Af([0-9]) ", r"f0\1_", s).replace(" ", "_").replace("#", "_No_")
    s = re.sub(r"""['";()/\\]""", "", s).replace("&apos;", "").replace("&apos", "").replace("&quot;", "")
    return re.sub("__+", "_", s)


@FEW
@given(texts=TEXTS)
def test_cleaning_follows_the_plain_rules(one, texts):
    blanks = " \t\n\r\f"
    assert one(texts, Q.trim_ws("c")) == [s.strip(blanks) for s in texts]
    assert one(texts, Q.normalise_entities("c")) == [plain_entities(s) for s in texts]
    assert one(texts, Q.tokenise_breaks("c")) == [plain_breaks(s) for s in texts]
    assert one(texts, Q.clean_cell("c")) == [plain_breaks(plain_entities(s.strip(blanks))) for s in texts]
    assert one(texts, Q.normalise_header("c")) == [plain_header(s) for s in texts]


@FEW
@given(texts=TEXTS)
def test_numbers_follow_the_plain_rules(one, texts):
    def leading(s):
        found = re.match("[ \t\n\r\f]*([+-]?[0-9]+)", s)
        n = int(found.group(1)) if found else 0
        return n if -(2**63) <= n < 2**63 else 0

    assert one(texts, Q.leading_int("c")) == [leading(s) for s in texts]


@FEW
@given(texts=TEXTS)
def test_element_names_are_valid(one, texts):
    for name in one(texts, Q.element_name("c", F.col("i"))):
        assert re.fullmatch(r"[^\W\d][\w.-]*", name), name


def test_entities_and_placeholders(one):
    given_ = ["a & b", "&amp;", "&lt;&gt;", "&apos;s", "&quot;q&quot;", "#gt; #apos;"]
    assert one(given_, Q.normalise_entities("c")) == ["a &amp; b", "&amp;amp;", "&lt;&gt;", "'s", '"q"', "&gt; '"]


def test_headers(one):
    given_ = ["f1 name", "Police #", "Master's \"name\" (old)/new\\x", "a  b", "&apos;x", "&quot;x", "f12 x"]
    expected = ["f01_name", "Police_No_", "Masters_name_oldnewx", "a_b", "x", "&quotx", "f12_x"]
    assert one(given_, Q.normalise_header("c")) == expected
    assert one(["", "  ", "1st", "&quot;x"], Q.element_name("c", F.lit(3))) == ["_c3", "_c3", "_1st", "_quotx"]


def test_escaping_is_undone(one):
    texts = ["a<b>&c", "&lt;", "plain"]
    assert one(texts, Q.escape_xml("c")) == ["a&lt;b&gt;&amp;c", "&amp;lt;", "plain"]
    assert one(texts, Q.unescape_xml(Q.escape_xml("c"))) == texts


def test_forbidden_characters(one):
    text = "a\x0bb\x01\x1f￾c\t\n\rd\x85"
    assert one([text], Q.strip_control("c")) == ["abc\t\n\rd\x85"]


def test_quote_repair(one):
    assert one(["a\x92s b\x92s", "\x92x", "z"], Q.repair_quote("c")) == ["a' b\x92s", "\x92x", "z"]
    assert one(["a\x92s b\x92s", "\x92x"], Q.repair_quote("c", correct=True)) == ["a's b's", "'x"]
    assert one(["l1\nan an", "x"], Q.replace_first("c", "an", "*")) == ["l1\n* an", "x"]


def test_missing_values(one):
    texts = ["", "0", "00", "0.0", " "]
    assert one(texts, Q.drop_falsy("c")) == [None, None, "00", "0.0", " "]
    assert one(texts, Q.drop_falsy("c", keep_zero=True)) == [None, "0", "00", "0.0", " "]


def test_fields_are_fitted(one):
    rows = one(["a\tb", "a\tb\tc\td", "", "\t\t"], Q.fit_fields("c", 3))
    assert rows == [["a", "b", None], ["a", "b", "c\td"], ["", None, None], ["", "", ""]]


def test_partial_dates(spark):
    rows = [("1850", "3", "7"), ("1850", "", ""), ("", "3", "7"), ("0", "3", "7"), ("1850", "Mar", "7th"),
            ("00", None, None), ("12345", "111", "-5"), (None, "1", "1")]
    df = spark.createDataFrame(rows, "y string, m string, d string")
    out = [r[0] for r in df.select(Q.partial_date("y", "m", "d")).collect()]
    assert out == ["1850-03-07", "1850-00-00", None, None, "1850-00-07", "0000-00-00", "12345-111--5", None]
    assert [str(r[0]) for r in spark.createDataFrame([("1850-03-07",), ("1850-03-00",)], "d string").select(
        as_date("d")).collect()] == ["1850-03-07", "None"]


def test_file_names(spark):
    names = {
        "CON18_01_2_n2.xml": ("18", "012", "18012", 2, "dlm"),
        "CON19_3_1_n2.xls": ("19", "31", "19031", 2, "dlf"),
        "CON31_05_n3.xml": ("31", "05", "3105", 3, "c31a"),
        "CON18_07_n4.xml": ("18", "07", "1807", 4, "c18a"),
        "CON33_123.xml": ("33", "123", "33123", None, "c33a"),
        "CON33_123_n9.xls": ("33", "123", "33123", None, "c33a"),
        "htg_absc_1840to1849_n28.xls": ("hga", "1840to1849", "1840", 28, "hga"),
        "htg_freedoms_1829_n2.xml": ("hgf", "1829", "1829", 2, "hgf"),
        "other.xls": None,
    }
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", Q.parse_file_name("n").alias("t"))
    assert {r["n"]: r["t"] and tuple(r["t"]) for r in df.collect()} == names


def test_document_keys_are_never_cut(spark):
    rows = [("1801", 7, "dlm"), ("1801", 12345, "dlm"), ("3105", 7, "c31a"), ("3105", 12345, "c31a"), ("1829", 7, "hgf")]
    df = spark.createDataFrame(rows, "v string, l int, t string")
    keys = [r[0] for r in df.select(Q.document_key("v", "l", "t")).collect()]
    assert keys == ["1801007", "180112345", "31050007", "310512345", "182900007"]


def test_output_names(spark):
    rows = [("a b.xls", 1), ("a b.xlsx", 1), ("a b.xlsx", 3), ("a", 1), ("a.xml", 1)]
    df = spark.createDataFrame(rows, "n string, k int")
    assert [r[0] for r in df.select(Q.output_name("n", "k")).collect()] == [
        "a b.xml", "a_b.xml", "a_b_3.xml", "a.xml", "a.xml"]
    assert [r[0] for r in df.select(Q.output_name("n")).collect()][:2] == ["a b.xml", "a b.xlsx.xml"]


def test_column_letters(spark):
    def letters(i):
        text = ""
        while i:
            i, rest = divmod(i - 1, 26)
            text = chr(65 + rest) + text
        return text

    rows = spark.range(1, 16385).select("id", Q.column_letter("id").alias("l")).collect()
    assert all(r["l"] == letters(r["id"]) for r in rows)
    assert letters(16384) == "XFD"
