"""The operators as queries over the given tables, each with the same question
in SQL. ``text`` columns stand in for source lines and cells."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid import functions as Q
from quillgrid.operators import dictionary, ordering, reconcile, records, reshape, schema
from quillgrid.operators.joins import lookup
from quillgrid.plans.pipelines import convert_registered_cells
from quillgrid.plans.samples import pack_workbooks, write_books
from quillgrid.session import scratch_path
from quillgrid.sinks import tabular, xml
from quillgrid.sources import lines, record_xml
from quillgrid.sources.workbook import cells_from_content, read_workbook_rows, rows_from_content

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        ORACLES[name] = sql
        return run

    return register


# ---- cleaning --------------------------------------------------------------

def _clean_sql(text: str) -> str:
    return rf"""
    replace(regexp_replace(replace(regexp_replace(replace(replace(regexp_replace(
    replace(replace(replace(regexp_replace(regexp_replace(regexp_replace({text},
    '^[ \t\n\r\f]+',''),'[ \t\n\r\f]+$',''),'&([gl]t;)','#\1','g'),
    '&apos;','#apos;'),'&quot;','#quot;'),'&','&amp;'),'#([gl]t;)','&\1','g'),
    '#apos;',''''),'#quot;','"'),'(\r\n){{2,}}','#PARA_START#','g'),
    chr(13)||chr(10),'#RETURN#'),'\r{{2,}}','#PARA_START#','g'),chr(13),'#RETURN#')"""


@query("clean_cell", f"SELECT doc_id, {_clean_sql('text')} AS cleaned FROM documents")
def clean_cell(spark, sf):
    return table(spark, sf, "documents").select("doc_id", Q.clean_cell(Q.strip_eol("text")).alias("cleaned"))


@query(
    "cell_audit",
    f"""SELECT page_id, length(raw) AS raw_chars, {_clean_sql('raw')} AS cleaned FROM (
        SELECT page_id, replace(replace(html, '</p>', chr(13) || chr(10)), '</li>', chr(13)) AS raw FROM pages)""",
)
def cell_audit(spark, sf):
    raw = F.replace(F.replace("html", F.lit("</p>"), F.lit("\r\n")), F.lit("</li>"), F.lit("\r"))
    rows = table(spark, sf, "pages").select("page_id", raw.alias("raw"))
    return rows.select("page_id", F.length("raw").cast("bigint").alias("raw_chars"), Q.clean_cell("raw").alias("cleaned"))


@query(
    "header_norm",
    r"""SELECT doc_id, regexp_replace(replace(replace(replace(regexp_replace(replace(replace(
    regexp_replace(text,'^f(\d) ','f0\1_'),' ','_'),'#','_No_'),
    '['';()/\\"]','','g'),'&apos;',''),'&apos',''),'&quot;',''),'__+','_','g') AS header FROM documents""",
)
def header_norm(spark, sf):
    return table(spark, sf, "documents").select("doc_id", Q.normalise_header("text").alias("header"))


@query(
    "xml_escape",
    "SELECT page_id, replace(replace(replace(html,'&','&amp;'),'<','&lt;'),'>','&gt;') AS escaped FROM pages",
)
def xml_escape(spark, sf):
    return table(spark, sf, "pages").select("page_id", Q.escape_xml("html").alias("escaped"))


@query("first_only", "SELECT doc_id, regexp_replace(text,'an','*') AS replaced FROM documents")
def first_only(spark, sf):
    return table(spark, sf, "documents").select("doc_id", Q.replace_first("text", "an", "*").alias("replaced"))


@query(
    "repair_quote",
    "SELECT doc_id, regexp_replace(replace(text, 'e', chr(146)), chr(146) || 's', '''') AS repaired FROM documents",
)
def repair_quote(spark, sf):
    damaged = F.replace("text", F.lit("e"), F.lit("\u0092"))
    return table(spark, sf, "documents").select("doc_id", Q.repair_quote(damaged).alias("repaired"))


@query(
    "strip_control",
    r"""SELECT doc_id, regexp_replace(replace(text, chr(10), chr(11)), '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')
    AS printable FROM documents""",
)
def strip_control(spark, sf):
    with_control = F.replace("text", F.lit("\n"), F.lit("\x0b"))
    return table(spark, sf, "documents").select("doc_id", Q.strip_control(with_control).alias("printable"))


@query(
    "split_limit",
    """SELECT doc_id, x[1] AS f1, x[2] AS f2, x[3] AS f3, x[4] AS f4,
    CASE WHEN len(x) >= 5 THEN array_to_string(x[5:], ' ') END AS f5
    FROM (SELECT doc_id, string_split(text, ' ') AS x FROM documents)""",
)
def split_limit(spark, sf):
    fields = table(spark, sf, "documents").select("doc_id", Q.fit_fields("text", 5, " ").alias("f"))
    return fields.select("doc_id", *(F.col("f")[i].alias(f"f{i + 1}") for i in range(5)))


# ---- numbers, dates, keys, names -------------------------------------------

@query(
    "lead_int",
    r"""SELECT event_id, coalesce(try_cast(regexp_extract(regexp_replace(props,'^[^0-9]*',''),'^([0-9]+)',1)
    AS BIGINT),0) AS n, coalesce(try_cast(regexp_extract(props,'^([0-9]+)',1) AS BIGINT),0) AS none FROM events""",
)
def lead_int(spark, sf):
    digits = F.regexp_replace("props", "^[^0-9]*", "")
    return table(spark, sf, "events").select(
        "event_id", Q.leading_int(digits).alias("n"), Q.leading_int("props").alias("none")
    )


@query(
    "partial_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE printf('%04d-%02d-%02d',
    year(o_orderdate), CASE WHEN o_orderstatus = 'F' THEN 0 ELSE month(o_orderdate) END, day(o_orderdate)) END
    AS orderDate FROM orders""",
)
def partial_date(spark, sf):
    def part(c, unknown_in, unknown):
        return F.when(F.col("o_orderstatus") == unknown_in, F.lit(unknown)).otherwise(c.cast("string"))

    parts = table(spark, sf, "orders").select(
        "o_orderkey",
        part(F.year("o_orderdate"), "P", "0").alias("orderYr"),
        part(F.month("o_orderdate"), "F", "").alias("orderMo"),
        F.dayofmonth("o_orderdate").cast("string").alias("orderDy"),
    )
    return records.fold_dates(parts, Q.date_triples(("order",)))


@query(
    "composite_key",
    """SELECT l_orderkey, l_partkey, record_type, printf('%02d%02d', l_linenumber, l_suppkey) ||
    printf(CASE record_type WHEN 'dlm' THEN '%03d' WHEN 'hgf' THEN '%05d' ELSE '%04d' END, l_orderkey) AS doc_key
    FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'dlm' WHEN 'N' THEN 'hgf' ELSE 'c31a' END AS record_type
    FROM lineitem)""",
)
def composite_key(spark, sf):
    flag = F.col("l_returnflag")
    kind = F.when(flag == "A", "dlm").when(flag == "N", "hgf").otherwise("c31a")
    volume = F.concat(Q.zpad("l_linenumber", 2), Q.zpad("l_suppkey", 2))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", kind.alias("record_type"), Q.document_key(volume, "l_orderkey", kind).alias("doc_key")
    )


def _file_name():
    """A file name for each page: every naming convention occurs."""
    no = F.col("page_id").cast("string")
    language = F.element_at(F.split("url", "/"), 4)
    short = F.pmod(F.col("page_id"), F.lit(10)).cast("string")
    return (
        F.when(language == "en", F.concat(F.lit("CON18_"), no, F.lit("_"), short, F.lit("_n"), no, F.lit(".xls")))
        .when(language == "fr", F.concat(F.lit("CON19_"), no, F.lit("_"), short, F.lit("_n.xls")))
        .when(language == "de", F.concat(F.lit("CON33_"), no, F.lit("_n"), no, F.lit(".xml")))
        .when(F.col("url").startswith("https"), F.concat(F.lit("htg_absc_18"), no, F.lit("to1899_n"), no, F.lit(".xls")))
        .otherwise(F.concat(F.lit("htg_freedoms_18"), no, F.lit("_n"), no, F.lit(".xlsx")))
    )


_FILE_NAME_SQL = """(SELECT page_id, url, CASE
    WHEN lang = 'en' THEN 'CON18_' || page_id || '_' || (page_id % 10) || '_n' || page_id || '.xls'
    WHEN lang = 'fr' THEN 'CON19_' || page_id || '_' || (page_id % 10) || '_n.xls'
    WHEN lang = 'de' THEN 'CON33_' || page_id || '_n' || page_id || '.xml'
    WHEN starts_with(url, 'https') THEN 'htg_absc_18' || page_id || 'to1899_n' || page_id || '.xls'
    ELSE 'htg_freedoms_18' || page_id || '_n' || page_id || '.xlsx' END AS name
    FROM (SELECT *, string_split(url, '/')[4] AS lang FROM pages))"""


@query(
    "name_parse",
    f"""SELECT page_id, name, CASE WHEN k = 'c' THEN regexp_extract(name, 'CON(..)', 1) ELSE 'h' || k END AS series,
    CASE WHEN k = 'c' THEN regexp_extract(name, 'CON.._([0-9]+)', 1) ||
      regexp_extract(name, 'CON1[89]_[0-9]+_([0-9])', 1)
      ELSE regexp_extract(name, 'htg_[a-z]+_([^_]+)_', 1) END AS volume_no,
    CASE WHEN k = 'c' THEN regexp_extract(name, 'CON(..)', 1) ||
      printf('%02d', CAST(regexp_extract(name, 'CON.._([0-9]+)', 1) AS BIGINT)) ||
      regexp_extract(name, 'CON1[89]_[0-9]+_([0-9])', 1)
      ELSE substr(regexp_extract(name, 'htg_[a-z]+_([^_]+)_', 1), 1, 4) END AS volume,
    TRY_CAST(regexp_extract(name, '_n([0-9]*)', 1) AS BIGINT) AS expected_n,
    CASE WHEN starts_with(name, 'CON18') THEN 'dlm' WHEN starts_with(name, 'CON19') THEN 'dlf'
      WHEN k = 'c' THEN 'c' || regexp_extract(name, 'CON(..)', 1) || 'a' ELSE 'h' || k END AS record_type
    FROM (SELECT *, CASE WHEN starts_with(name, 'CON') THEN 'c' WHEN starts_with(name, 'htg_absc') THEN 'ga'
      ELSE 'gf' END AS k FROM {_FILE_NAME_SQL})""",
)
def name_parse(spark, sf):
    named = table(spark, sf, "pages").select("page_id", _file_name().alias("name"))
    return named.select("page_id", "name", Q.parse_file_name("name").alias("told")).select("page_id", "name", "told.*")


_KIND_SQL = """CASE page_id % 4 WHEN 0 THEN 'NEW' WHEN 1 THEN 'kgb' ELSE
    CASE WHEN starts_with(name, 'CON18') THEN 'dlm' ELSE 'dcf' END END"""


@query(
    "route_files",
    f"""SELECT page_id, name, record_type, CASE WHEN regexp_matches(name, 'MISSINGFILE|_n\\.xls') THEN 'stub'
    WHEN record_type IN ('kgd', 'kgb', 'kgm') THEN 'delimited'
    WHEN record_type = 'NEW' AND suffix(name, '.xls') THEN 'named_export'
    WHEN record_type = 'NEW' AND suffix(name, '.xlsx') THEN 'workbook'
    WHEN record_type = 'NEW' THEN 'unsupported' ELSE 'registered' END AS route
    FROM (SELECT *, {_KIND_SQL} AS record_type FROM {_FILE_NAME_SQL})""",
)
def route_files(spark, sf):
    kind = F.pmod(F.col("page_id"), F.lit(4))
    listed = table(spark, sf, "pages").select("page_id", _file_name().alias("name")).withColumn(
        "record_type",
        F.when(kind == 0, "NEW").when(kind == 1, "kgb").when(F.col("name").startswith("CON18"), "dlm").otherwise("dcf"),
    )
    return reconcile.route_files(listed, "name")


@query(
    "stub_files",
    f"""SELECT url AS file, regexp_replace(name, '\\.xls$', '.xml') AS output, CAST(0 AS BIGINT) AS declared_n
    FROM {_FILE_NAME_SQL} WHERE regexp_matches(name, 'MISSINGFILE|_n\\.xls')""",
)
def stub_files(spark, sf):
    return reconcile.stubs_for_missing(table(spark, sf, "pages").select(F.col("url").alias("file"), _file_name().alias("name")), "name")


@query(
    "output_name",
    f"""SELECT page_id, sheet_no, CASE WHEN suffix(name, '.xlsx') THEN
      replace(regexp_replace(name, '\\.xlsx$', ''), ' ', '_') ||
      CASE WHEN sheet_no = 1 THEN '' ELSE '_' || sheet_no END || '.xml'
    WHEN suffix(name, '.xls') THEN regexp_replace(name, '\\.xls$', '.xml')
    WHEN suffix(name, '.xml') THEN name ELSE name || '.xml' END AS output
    FROM (SELECT page_id, page_id % 3 + 1 AS sheet_no, replace(name, '_', ' ') AS name FROM {_FILE_NAME_SQL})""",
)
def output_name(spark, sf):
    named = table(spark, sf, "pages").select(
        "page_id",
        (F.pmod(F.col("page_id"), F.lit(3)) + 1).alias("sheet_no"),
        F.replace(_file_name(), F.lit("_"), F.lit(" ")).alias("name"),
    )
    return named.select("page_id", "sheet_no", Q.output_name("name", "sheet_no").alias("output"))


@query(
    "col_letter",
    """SELECT p_partkey, CASE WHEN i <= 26 THEN chr(64 + i)
    WHEN i <= 702 THEN chr(64 + (i - 1) // 26) || chr(65 + (i - 1) % 26)
    ELSE chr(64 + (i - 27) // 676) || chr(65 + ((i - 27) // 26) % 26) || chr(65 + (i - 1) % 26) END AS letter
    FROM (SELECT p_partkey, CAST(p_partkey % 16384 + 1 AS INT) AS i FROM part)""",
)
def col_letter(spark, sf):
    ordinal = F.pmod(F.col("p_partkey"), F.lit(16384)) + 1
    return table(spark, sf, "part").select("p_partkey", Q.column_letter(ordinal).alias("letter"))


# ---- registry and names ----------------------------------------------------

@query(
    "registry_explode",
    """SELECT doc_id, CAST(generate_subscripts(x, 1) AS INT) AS ordinal, unnest(x) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)""",
)
def registry_explode(spark, sf):
    nested = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return schema.explode_lists(nested, "lines", "line", "doc_id")


_SEGMENT_COLUMNS = (("holder", "country"), ("name", "nation"))


@query(
    "positional_rename",
    """SELECT c_custkey, record_type, element, value FROM (
      SELECT c_custkey, c_mktsegment AS record_type, CASE WHEN c_mktsegment < 'F' THEN 'holder' ELSE 'name' END
        AS element, c_name AS value FROM customer
      UNION ALL SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment < 'F' THEN 'country' ELSE 'nation' END,
        CAST(c_nationkey AS VARCHAR) FROM customer) WHERE value NOT IN ('', '0')""",
)
def positional_rename(spark, sf):
    customer = table(spark, sf, "customer")
    layout = F.when(F.col("record_type") < "F", F.array(*map(F.lit, _SEGMENT_COLUMNS[0]))).otherwise(
        F.array(*map(F.lit, _SEGMENT_COLUMNS[1]))
    )
    kinds = customer.select(F.col("c_mktsegment").alias("record_type")).distinct()
    registry = schema.explode_lists(kinds.withColumn("columns", layout), "columns", "column", "record_type")
    wide = customer.select("c_custkey", F.col("c_mktsegment").alias("record_type"), "c_name", "c_nationkey")
    values = reshape.to_elements(wide, ("c_custkey", "record_type")).drop("element")
    bound = schema.bind_registry(values, registry)
    return bound.select("c_custkey", "record_type", F.col("column").alias("element"), "value")


@query(
    "qname_list",
    """SELECT record_type, string_agg(c, ',' ORDER BY ordinal) AS names FROM (
    SELECT p_brand AS record_type, p_type AS c, min(p_partkey) AS ordinal FROM part GROUP BY 1, 2) GROUP BY 1""",
)
def qname_list(spark, sf):
    # Made distinct first: a list is as long as the type has columns.
    registry = table(spark, sf, "part").groupBy(
        F.col("p_brand").alias("record_type"), F.col("p_type").alias("column")
    ).agg(F.min("p_partkey").alias("ordinal"))
    return schema.qname_list(registry)


@query(
    "columns_per_type",
    """SELECT record_type, count(c) AS n_columns, CASE WHEN record_type = '' THEN 'no id'
    WHEN count(c) = 0 AND record_type <> 'NEW' THEN 'no columns' END AS warning
    FROM (SELECT replace(p_brand, 'Brand#7', '') AS record_type, CASE WHEN p_brand <> 'Brand#9' THEN p_type END AS c
    FROM part) GROUP BY record_type""",
)
def columns_per_type(spark, sf):
    registry = table(spark, sf, "part").select(
        F.replace("p_brand", F.lit("Brand#7"), F.lit("")).alias("record_type"),
        F.when(F.col("p_brand") != "Brand#9", F.col("p_type")).alias("column"),
    )
    return schema.columns_per_type(registry)


@query("known_types", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def known_types(spark, sf):
    documents = table(spark, sf, "documents").select(F.col("doc_id").alias("record_type"), "lang")
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("record_type"))
    return schema.known_types(documents, labels).withColumnRenamed("record_type", "doc_id")


@query(
    "types_without_columns",
    """SELECT CAST(doc_id AS VARCHAR) AS record_type, lang FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)""",
)
def types_without_columns(spark, sf):
    key = F.col("doc_id").cast("string").alias("record_type")
    registry = table(spark, sf, "labels").select(key, F.when(F.col("toxic") == 0, "toxic").alias("column"))
    return schema.types_without_columns(table(spark, sf, "documents").select(key, "lang"), registry)


# ---- order -----------------------------------------------------------------

@query(
    "number_rows",
    """SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events""",
)
def number_rows(spark, sf):
    return ordering.number_rows(table(spark, sf, "events").select("user_id", "event_id"), "user_id", "event_id")


@query(
    "limit_per_file",
    """SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn
    FROM conversations) WHERE rn <= 2""",
)
def limit_per_file(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return records.limit_per_file(rows, 2, "conv_id", "turn")


@query(
    "drop_first",
    """SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn
    FROM conversations) WHERE rn > 1""",
)
def drop_first(spark, sf):
    return records.drop_header_record(table(spark, sf, "conversations"), "conv_id", "turn")


@query(
    "skip_until",
    """SELECT conv_id, turn, role, text FROM (SELECT *, max(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END)
    OVER (PARTITION BY conv_id ORDER BY turn) AS started FROM conversations) WHERE started = 1""",
)
def skip_until(spark, sf):
    rows = table(spark, sf, "conversations")
    return records.skip_until(rows, F.col("role") == "assistant", "conv_id", "turn", block=None)


@query(
    "volume_summary",
    """SELECT conv_id, count(*) AS total, count(*) FILTER (WHERE role = 'assistant') AS actual_n,
    min(turn) FILTER (WHERE role = 'assistant') AS start, max(turn) // 2 + 1 AS declared_n,
    CASE WHEN max(turn) // 2 + 1 = count(*) FILTER (WHERE role = 'assistant') THEN 'GOOD' ELSE 'BOO' END AS verdict
    FROM conversations GROUP BY conv_id""",
)
def volume_summary(spark, sf):
    # A conversation stands in for a volume, and what its assistant says for numbered records.
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    told = ordering.group_summary(rows, F.col("role") == "assistant", "conv_id", "turn").withColumnRenamed("marked", "actual_n")
    promised = rows.groupBy("conv_id").agg((F.floor(F.max("turn") / 2) + 1).alias("declared_n"))
    return reconcile.check_counts(told.join(promised, "conv_id"), "conv_id", fatal=False)


@query(
    "root_per_file",
    """WITH f AS (SELECT c_mktsegment AS file, count(*) AS n FROM customer GROUP BY 1)
    SELECT file, 0 AS part, CAST(NULL AS BIGINT) AS at, '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) ||
      '<dataroot source="' || file || ' &amp; &quot;all&quot;" n="' || n || '">' AS value FROM f
    UNION ALL SELECT file, 2, NULL, '</dataroot>' FROM f
    UNION ALL SELECT c_mktsegment, 1, c_custkey, '<cust key="' || c_custkey || '">' || chr(10) || '<name>' || c_name || ' &lt;b&gt;</name>'
      || CASE WHEN c_nationkey = 0 THEN '' ELSE chr(10) || '<nation>' || c_nationkey || '</nation>' END || chr(10) || '</cust>'
    FROM customer""",
)
def root_per_file(spark, sf):
    customer = table(spark, sf, "customer")
    rows = customer.select(
        F.col("c_mktsegment").alias("file"), F.col("c_custkey").alias("rn"), F.col("c_custkey").cast("string").alias("_key"),
        F.concat("c_name", F.lit("\x0b <b>")).alias("name"), Q.drop_falsy(F.col("c_nationkey").cast("string")).alias("nation"),
    )
    roots = customer.groupBy(F.col("c_mktsegment").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    named = roots.select("file", F.concat("file", F.lit(' & "all"')).alias("source"), "n")
    return xml.record_documents(rows, "cust", named)


@query(
    "document_position",
    """SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS position FROM conversations""",
)
def document_position(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn")
    return records.document_position(rows, "conv_id", "turn")


@query(
    "carry_prev",
    """SELECT user_id, event_id, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id), 'none')
    AS event_type FROM events""",
)
def carry_prev(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    carried = records.carry_previous(rows, ["event_type"], "user_id", "event_id", block=None)
    return carried.fillna("none", ["event_type"])


@query(
    "promote_header",
    """SELECT c.conv_id, c.turn, c.text, h.text AS element FROM conversations c JOIN conversations h
    ON c.conv_id = h.conv_id AND h.turn = 0 WHERE c.turn > 0""",
)
def promote_header(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return reshape.promote_first_row(rows, "text", "conv_id", "turn")


@query("skip_comments", "SELECT doc_id, lang FROM documents WHERE NOT starts_with(text, 'A')")
def skip_comments(spark, sf):
    return records.skip_comments(table(spark, sf, "documents"), "text", "A").select("doc_id", "lang")


@query("last_wins", "SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def last_wins(spark, sf):
    return reshape.last_wins(table(spark, sf, "events"), "user_id", "event_type", "event_id")


# ---- reshaping -------------------------------------------------------------

@query(
    "unpivot_nonempty",
    """SELECT c_custkey, ordinal, element, value FROM (
    SELECT c_custkey, 1 AS ordinal, 'c_name' AS element, c_name AS value FROM customer UNION ALL
    SELECT c_custkey, 2, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer UNION ALL
    SELECT c_custkey, 3, 'c_mktsegment', c_mktsegment FROM customer) WHERE value NOT IN ('', '0')""",
)
def unpivot_nonempty(spark, sf):
    wide = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return reshape.to_elements(wide, ("c_custkey",))


@query(
    "records_from_cells",
    """SELECT c_custkey, c_mktsegment AS name, CASE WHEN c_nationkey <> 0 THEN CAST(c_nationkey AS VARCHAR) END
    AS nation FROM customer""",
)
def records_from_cells(spark, sf):
    # Two cells have the name "name"; the right one wins.
    cells = [("name", F.col("c_name")), ("nation", F.col("c_nationkey")), ("name", F.col("c_mktsegment"))]
    entries = F.array(*(F.struct(F.lit(n).alias("element"), Q.drop_falsy(v.cast("string")).alias("value")) for n, v in cells))
    return reshape.rows_to_records(table(spark, sf, "customer"), entries, ["name", "nation"], ["c_custkey"])


@query(
    "drop_guard",
    """SELECT p_brand, count(*) FILTER (WHERE p_name NOT IN ('', '0')) AS p_name,
    count(*) FILTER (WHERE p_type NOT IN ('', '0')) AS p_type FROM part GROUP BY p_brand""",
)
def drop_guard(spark, sf):
    return reshape.dropped_values(table(spark, sf, "part"), ["p_name", "p_type"], ["p_brand"])


@query(
    "union_by_name",
    """SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS supplier FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_suppkey FROM supplier""",
)
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"), F.col("s_suppkey").alias("supplier")
    )
    return reshape.union_sheets([customers, suppliers])


# ---- look-ups and counts ---------------------------------------------------

@query(
    "dict_join",
    """WITH d AS (SELECT p_type AS key, 'kind ' || lower(p_type) AS description FROM part
        WHERE p_type <> 'ECONOMY' GROUP BY p_type
      UNION ALL SELECT p_brand || '.' || p_type, 'seen ' || count(*) FROM part
        WHERE p_brand < 'Brand#2' GROUP BY p_brand, p_type)
    SELECT p_partkey, CASE WHEN g.description IS NULL THEN '' ELSE
        ' Generally for "' || p_type || '": ' || g.description END ||
      CASE WHEN s.description IS NULL THEN '' ELSE
        ' Specifically for "' || p_brand || '.' || p_type || '": ' || s.description END AS description
    FROM part LEFT JOIN d g ON g.key = p_type LEFT JOIN d s ON s.key = p_brand || '.' || p_type""",
)
def dict_join(spark, sf):
    part = table(spark, sf, "part")
    general = part.where(F.col("p_type") != "ECONOMY").groupBy(F.col("p_type").alias("key")).agg(
        F.concat(F.lit("kind "), F.lower(F.first("p_type"))).alias("description")
    )
    own = part.where(F.col("p_brand") < "Brand#2").groupBy(F.concat_ws(".", "p_brand", "p_type").alias("key")).agg(
        F.concat(F.lit("seen "), F.count(F.lit(1)).cast("string")).alias("description")
    )
    fields = part.select("p_partkey", F.col("p_brand").alias("record_type"), F.col("p_type").alias("column"))
    told = dictionary.describe_fields(fields, general.unionByName(own))
    text = dictionary.extra_description("record_type", "column", "general", "specific")
    return told.select("p_partkey", text.alias("description"))


@query(
    "alias_map",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'home' WHEN 'FURNITURE' THEN 'home'
    ELSE c_mktsegment END AS segment FROM customer""",
)
def alias_map(spark, sf):
    aliases = {"HOUSEHOLD": "home", "FURNITURE": "home"}
    return table(spark, sf, "customer").select(
        "c_custkey", dictionary.resolve_alias("c_mktsegment", aliases).alias("segment")
    )


@query(
    "type_meta",
    """SELECT p_partkey, n AS num_recs, CASE WHEN n % 2 = 1 THEN 'Transcription documentation: docs/' || p_brand END
    AS documentation FROM part JOIN (SELECT p_brand AS b, count(*) AS n FROM part GROUP BY 1) ON b = p_brand""",
)
def type_meta(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("record_type"))
    counted = part.groupBy("record_type").agg(F.count(F.lit(1)).alias("num_recs"))
    odd = F.col("num_recs") % 2 == 1
    meta = counted.select(
        "record_type", "num_recs", F.lit("").alias("desc"), F.lit("").alias("source"),
        F.when(odd, F.col("record_type")).otherwise("").alias("documentation"), F.lit("").alias("archive_id"),
    )
    described = dictionary.with_type_meta(part, meta, "docs/")
    return described.select("p_partkey", "num_recs", "documentation")


@query(
    "reconcile",
    """SELECT coalesce(d.k, a.k) AS nationkey, declared_n, coalesce(actual_n, 0) AS actual_n,
    CASE WHEN declared_n = coalesce(actual_n, 0) THEN 'GOOD' ELSE 'BOO' END AS verdict
    FROM (SELECT s_nationkey AS k, count(*) * 15 AS declared_n FROM supplier GROUP BY 1) d
    FULL JOIN (SELECT c_nationkey AS k, count(*) AS actual_n FROM customer GROUP BY 1) a ON a.k = d.k""",
)
def reconcile_counts(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    promised = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        (F.count(F.lit(1)) * 15).alias("declared_n")
    )
    return reconcile.reconcile(reconcile.count_records(customers, "nationkey"), promised, "nationkey")


@query(
    "run_report",
    """SELECT verdict, count(*) AS files, CAST(sum(declared_n) AS BIGINT) AS declared_n,
    CAST(sum(actual_n) AS BIGINT) AS actual_n FROM (SELECT declared_n, actual_n,
      CASE WHEN declared_n = actual_n THEN 'GOOD' ELSE 'BOO' END AS verdict FROM (
      SELECT o_orderkey, (o_orderkey % 7) AS declared_n, coalesce(n, 0) AS actual_n FROM orders
      LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
      UNION ALL SELECT l_orderkey, NULL, count(*) FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1)) GROUP BY verdict""",
)
def run_report(spark, sf):
    lineitem = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("file"))
    promised = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("file"), F.pmod(F.col("o_orderkey"), F.lit(7)).alias("declared_n")
    )
    return reconcile.run_report(reconcile.reconcile(reconcile.count_records(lineitem), promised))


# ---- sources and sinks: write the table, read it back -----------------------

@query(
    "record_xml_round_trip",
    """SELECT c_custkey, ' ' || c_name || ' & <b>' AS name,
    CASE WHEN c_nationkey > 0 THEN CAST(c_nationkey AS VARCHAR) END AS nation FROM customer""",
)
def record_xml_round_trip(spark, sf):
    path = scratch_path(spark, "records")
    rows = table(spark, sf, "customer").select(
        F.lit("customer").alias("file"), (F.col("c_custkey") + 1).alias("rn"),
        F.col("c_custkey").cast("string").alias("key"),
        F.concat(F.lit(" "), "c_name", F.lit("\x0b & <b>")).alias("name"),
        Q.drop_falsy(F.col("c_nationkey").cast("string")).alias("nation"),
    )
    xml.write_records(rows, path, "cust", {"source": "customer", "n": 1})
    back = record_xml.read_records(spark, path, "cust", ["key", "name", "nation"])
    return back.select(F.col("key").cast("bigint").alias("c_custkey"), "name", "nation")


@query(
    "tsv_round_trip",
    """SELECT p_partkey, CASE WHEN p_size = 1 THEN '"q" \\ ' ELSE p_name END AS p_name,
    CASE WHEN p_size = 2 THEN '' ELSE p_brand END AS p_brand, CAST(p_size % 3 AS VARCHAR) AS p_size FROM part""",
)
def tsv_round_trip(spark, sf):
    path = scratch_path(spark, "tsv")
    size = F.col("p_size")
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        F.when(size == 1, '"q" \\ ').otherwise(F.col("p_name")).alias("p_name"),
        F.when(size == 2, "").otherwise(F.col("p_brand")).alias("p_brand"),
        (size % 3).cast("string").alias("p_size"),
    )
    tabular.write_tsv(rows, path)
    back = lines.read_delimited(spark, path, ["p_partkey", "p_name", "p_brand", "p_size"])
    # The reader trims, so the blank behind the backslash is put back.
    name = F.when(F.col("p_name").endswith("\\"), F.concat("p_name", F.lit(" "))).otherwise(F.col("p_name"))
    return back.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), name.alias("p_name"), "p_brand", "p_size")


@query(
    "charset_round_trip",
    """SELECT c_custkey, translate(c_name, 'aeou', 'áéöü') AS name FROM customer""",
)
def charset_round_trip(spark, sf):
    path = scratch_path(spark, "latin")
    accented = F.translate("c_name", "aeou", "áéöü")
    rows = table(spark, sf, "customer").select("c_custkey", accented.alias("name"))
    rows.write.options(sep="\t", quote="", encoding="ISO-8859-1").csv(path, header=True)
    back = lines.read_delimited(spark, path, ["c_custkey", "name"], charset="ISO-8859-1")
    return back.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "name")


@query(
    "registry_round_trip",
    """SELECT record_type, CAST(row_number() OVER (PARTITION BY record_type ORDER BY k) AS INT) AS ordinal, c AS "column"
    FROM (SELECT p_brand AS record_type, p_type AS c, min(p_partkey) AS k FROM part GROUP BY 1, 2)""",
)
def registry_round_trip(spark, sf):
    named = table(spark, sf, "part").groupBy(
        F.col("p_brand").alias("record_type"), F.col("p_type").alias("column")
    ).agg(F.min("p_partkey").alias("ordinal"))
    entries = named.withColumn("entry_no", F.col("record_type"))
    back = xml.write_registry(entries, scratch_path(spark, "registry"))
    return back.select("record_type", "ordinal", "column")


def _customer_books(spark, sf):
    wide = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return pack_workbooks(wide, "c_custkey", ["f1 id", "Master's name", "#"])


def _customer_rows(spark, sf):
    return rows_from_content(_customer_books(spark, sf))


def _customer_cells(spark, sf):
    return cells_from_content(_customer_books(spark, sf))


_BOOK_SQL = "'book_' || CAST(c_custkey // 500 AS BIGINT) || '.xlsx'"


@query(
    "workbook_cells",
    f"""WITH c AS (SELECT *, {_BOOK_SQL} AS file, CAST(c_custkey % 500 + 2 AS INT) AS n FROM customer)
    SELECT file, n, 0 AS col, 'f1 id' AS header, CAST(c_custkey AS VARCHAR) AS value FROM c
    UNION ALL SELECT file, n, 1, 'Master''s name', c_name FROM c
    UNION ALL SELECT file, n, 2, '#', CAST(c_nationkey AS VARCHAR) FROM c
    UNION ALL SELECT DISTINCT file, 1, h.k, h.v, h.v FROM c,
      (VALUES (0, 'f1 id'), (1, 'Master''s name'), (2, '#')) AS h(k, v)""",
)
def workbook_cells(spark, sf):
    return _customer_cells(spark, sf).select("file", "n", "col", "header", "value")


_HELD = [f"c{i}" for i in range(1, 28)]


@query(
    "registered_workbook",
    f"""SELECT {_BOOK_SQL} AS file, CAST(c_custkey % 500 + 2 AS BIGINT) AS rn, CAST(c_custkey AS VARCHAR) AS "lineNum",
    c_name AS holder, CAST(c_nationkey AS VARCHAR) AS nation,
    {', '.join(f"CASE WHEN c_custkey % {i} <> 1 THEN '{i} ' || CAST(c_custkey * {i} % 97 AS VARCHAR) END AS c{i}" for i in range(1, 28))}
    FROM customer WHERE c_custkey % 500 < 120""",
)
def registered_workbook(spark, sf):
    # Thirty columns below a header row, cut to 120 records of each workbook.
    customer = table(spark, sf, "customer")
    more = [
        F.when(F.col("c_custkey") % i != 1, F.concat(F.lit(f" {i} "), (F.col("c_custkey") * i % 97).cast("string"), F.lit("\t"))).alias(c)
        for i, c in enumerate(_HELD, 1)
    ]
    wide = customer.select("c_custkey", "c_name", "c_nationkey", *more)
    names = ["lineNum", "holder", "nation", *_HELD]
    registry = spark.createDataFrame(
        [(1, "held", i, c) for i, c in enumerate(names, 1)], "entry_no bigint, record_type string, ordinal int, column string"
    )
    rows = rows_from_content(pack_workbooks(wide, "c_custkey", [f"COLUMN {i}" for i in range(1, 31)]))
    return convert_registered_cells(rows, registry, "held", 120).drop("block")


@query(
    "workbook_files",
    f"""WITH c AS (SELECT *, {_BOOK_SQL} AS file, CAST(c_custkey % 500 + 2 AS INT) AS n FROM customer)
    SELECT file, 1 AS sheet_no, n, concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR)) AS line,
      n = max(n) OVER (PARTITION BY file) AS last FROM c
    UNION ALL SELECT DISTINCT file, 1, 1, 'f1 id|Master''s name|#', false FROM c""",
)
def workbook_files(spark, sf):
    path = scratch_path(spark, "books")
    write_books(_customer_books(spark, sf), path)
    rows = read_workbook_rows(spark, path, split_bytes=20_000)
    return rows.select(Q.file_name("file").alias("file"), "sheet_no", "n", F.array_join("values", "|").alias("line"), "last")


@query(
    "workbook_elements",
    f"""WITH c AS (SELECT *, {_BOOK_SQL} AS file, CAST(c_custkey % 500 + 2 AS INT) AS n FROM customer)
    SELECT file, n, element, value FROM (
    SELECT file, n, 'f01_id' AS element, CAST(c_custkey AS VARCHAR) AS value FROM c
    UNION ALL SELECT file, n, 'Masters_name', c_name FROM c
    UNION ALL SELECT file, n, '_No_', CAST(c_nationkey AS VARCHAR) FROM c) WHERE value NOT IN ('', '0')""",
)
def workbook_elements(spark, sf):
    named = reshape.promote_header(tabular.clean_cells(_customer_cells(spark, sf)))
    shown = reshape.drop_elements(named).where(~F.col("cleaned").isin("", "0"))
    return shown.select("file", "n", "element", F.col("cleaned").alias("value"))


@query(
    "workbook_xml",
    f"""WITH c AS (SELECT *, 'book_' || CAST(c_custkey // 500 AS BIGINT) || '.xml' AS output,
      CAST(c_custkey % 500 + 2 AS INT) AS n FROM customer)
    SELECT output, n, '<row n="' || (c_custkey % 500 + 2) || '">' || chr(10) ||
      CASE WHEN c_custkey = 0 THEN '' ELSE '<f01_id>' || c_custkey || '</f01_id>' || chr(10) END ||
      '<Masters_name>' || c_name || '</Masters_name>' || chr(10) ||
      CASE WHEN c_nationkey = 0 THEN '' ELSE '<_No_>' || c_nationkey || '</_No_>' || chr(10) END || '</row>'
      || CASE WHEN n = max(n) OVER (PARTITION BY output) THEN chr(10) || '</dataroot>' ELSE '' END AS value
    FROM c UNION ALL SELECT DISTINCT output, 1, '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<dataroot>' FROM c""",
)
def workbook_xml(spark, sf):
    return xml.row_documents(_customer_rows(spark, sf)).select("output", "n", "value")


@query(
    "workbook_tsv",
    f"""WITH c AS (SELECT *, {_BOOK_SQL} AS file FROM customer)
    SELECT file, CAST(c_custkey % 500 + 2 AS INT) AS n,
      concat_ws(chr(9), CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR)) AS line FROM c
    UNION ALL SELECT DISTINCT file, 1, concat_ws(chr(9), 'f01_id', 'Masters_name', '_No_') FROM c""",
)
def workbook_tsv(spark, sf):
    return tabular.tsv_lines(_customer_rows(spark, sf)).select("file", "n", "line")


@query(
    "registry_from_header",
    f"""SELECT DISTINCT {_BOOK_SQL} AS record_type, k AS ordinal, v AS "column" FROM customer,
    (VALUES (1, 'f01_id'), (2, 'Masters_name'), (3, '_No_')) AS h(k, v)""",
)
def registry_from_header(spark, sf):
    return schema.registry_from_header(_customer_rows(spark, sf), F.col("file"))


@query(
    "dictionary_document",
    """WITH r AS (SELECT p_brand AS k, p_type AS c, row_number() OVER (PARTITION BY p_brand ORDER BY m) AS i
      FROM (SELECT p_brand, p_type, min(p_partkey) AS m FROM part GROUP BY 1, 2))
    SELECT k AS record_type, CAST(i AS INT) AS ordinal, c AS "column",
    'In original source file type "' || k || '", column ' || i || ' or ' || chr(CAST(64 + i AS INT)) ||
    ' is XML element "' || c || '".' || ' Generally for "' || c || '": kind ' || lower(c) AS description FROM r""",
)
def dictionary_document(spark, sf):
    part = table(spark, sf, "part")
    first = part.groupBy(F.col("p_brand").alias("record_type"), F.col("p_type").alias("column")).agg(
        F.min("p_partkey").alias("order")
    )
    # One row per type and column: a group is as small as a layout is wide.
    ranked = ordering.number_rows(first, "record_type", "order", name="ordinal")
    registry = ranked.select("record_type", F.col("ordinal").cast("int").alias("ordinal"), "column")
    texts = part.select(F.col("p_type").alias("key")).distinct().select(
        "key", F.concat(F.lit("kind "), F.lower("key")).alias("description")
    )
    kinds = part.groupBy(F.col("p_brand").alias("record_type")).agg(F.count(F.lit(1)).alias("num_recs"))
    empty = [F.lit("").alias(c) for c in ("desc", "source", "documentation", "archive_id")]
    entries = dictionary.with_type_meta(
        dictionary.build_dictionary(registry, texts), kinds.select("record_type", "num_recs", *empty)
    )
    path = scratch_path(spark, "dictionary")
    xml.write_dictionary(entries, path)
    field = "struct<_key string, column int, desc string>"
    rows = spark.read.option("rowTag", "record").schema(f"_key string, fieldList struct<field array<{field}>>").xml(path)
    return rows.select(F.col("_key").alias("record_type"), F.explode("fieldList.field").alias("f")).select(
        "record_type", F.col("f.column").alias("ordinal"), F.col("f._key").alias("column"),
        F.col("f.desc").alias("description"),
    )


@query(
    "type_letters",
    """WITH r AS (SELECT p_brand AS k, p_type AS c, row_number() OVER (PARTITION BY p_brand ORDER BY min(p_partkey)) AS i
      FROM part GROUP BY 1, 2)
    SELECT k AS record_type, CAST(i AS INT) AS ordinal, chr(CAST(64 + i AS INT)) AS letter, c AS "column" FROM r""",
)
def type_letters(spark, sf):
    first = table(spark, sf, "part").groupBy(F.col("p_brand").alias("record_type"), F.col("p_type").alias("column")).agg(
        F.min("p_partkey").alias("order")
    )
    ranked = ordering.number_rows(first, "record_type", "order", name="ordinal").withColumn("ordinal", F.col("ordinal").cast("int"))
    return schema.describe_types(ranked)


@query(
    "typed_counts",
    """SELECT record_type, count(*) AS actual_n FROM (SELECT 'cust' AS record_type FROM customer
    UNION ALL SELECT 'supp' FROM supplier) GROUP BY 1""",
)
def typed_counts(spark, sf):
    customers = schema.with_record_type(table(spark, sf, "customer").select("c_custkey"), "cust")
    suppliers = schema.with_record_type(table(spark, sf, "supplier").select("s_suppkey"), "supp")
    return reconcile.count_records(reshape.union_sheets([customers, suppliers]), "record_type")


@query(
    "dictionary_lines",
    """WITH l AS (SELECT doc_id, text AS line, string_split(text, ' ') AS x FROM documents)
    SELECT x[1] AS key, arg_max(CASE WHEN len(x) > 1 THEN array_to_string(x[2:], chr(9)) END, doc_id) AS description
    FROM (SELECT doc_id, x, x[1] AS k FROM l WHERE NOT starts_with(line, '#') AND line NOT LIKE '%' || chr(9) || '%'
      AND rtrim(line, chr(13) || chr(10)) = line AND len(x) > 1) GROUP BY x[1]""",
)
def dictionary_lines(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    plain = ~F.contains("text", F.lit("\t")) & (F.rtrim(F.col("text"), F.lit("\r\n")) == F.col("text")) & F.contains("text", F.lit(" "))
    lines_ = docs.where(plain).select("doc_id", F.translate("text", " ", "\t").alias("line"))
    return lines.dictionary_entries(lines_, ["doc_id"])


@query(
    "document_provenance",
    f"""SELECT page_id, regexp_extract(regexp_replace(name, '[.]xls$', '.xml'), 'CON33_[0-9]+_n([0-9]+)[.]xml', 1) <> '' AS counted, name AS source,
    CASE WHEN starts_with(name, 'CON') THEN regexp_extract(name, 'CON(..)', 1) WHEN starts_with(name, 'htg_absc') THEN 'hga' ELSE 'hgf' END AS series,
    TRY_CAST(regexp_extract(name, '_n([0-9]*)', 1) AS BIGINT) AS expected_n FROM {_FILE_NAME_SQL}""",
)
def document_provenance(spark, sf):
    # Export names of one series count once their output is named.
    pages = table(spark, sf, "pages").select("page_id", F.concat(F.lit("file:/in/"), _file_name()).alias("file"))
    told = records.with_provenance(pages)
    counted = F.col("source").startswith("CON33_") & F.col("expected_n").isNotNull()
    return told.select("page_id", counted.alias("counted"), "source", "series", "expected_n")


@query(
    "workbook_audit",
    f"""WITH c AS (SELECT *, {_BOOK_SQL} AS file, CAST(c_custkey % 500 + 1 AS INT) AS r FROM customer)
    SELECT file, r AS "row", 0 AS col, CAST(c_custkey AS VARCHAR) AS raw, CAST(c_custkey AS VARCHAR) AS cleaned FROM c
    UNION ALL SELECT file, r, 1, c_name, c_name FROM c
    UNION ALL SELECT file, r, 2, CAST(c_nationkey AS VARCHAR), CAST(c_nationkey AS VARCHAR) FROM c
    UNION ALL SELECT DISTINCT file, 0, h.k, h.v, h.w FROM c,
      (VALUES (0, 'f1 id', 'f01_id'), (1, 'Master''s name', 'Masters_name'), (2, '#', '_No_')) AS h(k, v, w)""",
)
def workbook_audit(spark, sf):
    return tabular.audit_cells(_customer_rows(spark, sf)).select("file", "row", "col", "raw", "cleaned")


# ---- flagship --------------------------------------------------------------

def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean the customers, turn them into elements named by a registry, and set
    the number of elements of each kind against the number declared."""
    elements = positional_rename(spark, sf_dir).withColumn("value", Q.clean_cell("value"))
    kind = F.concat_ws(".", "record_type", "element").alias("file")
    actual = reconcile.count_records(elements.select(kind))
    customers = table(spark, sf_dir, "customer")
    declared = customers.groupBy(F.col("c_mktsegment").alias("record_type")).agg(F.count(F.lit(1)).alias("declared_n"))
    slots = declared.select("record_type", "declared_n", F.when(
        F.col("record_type") < "F", F.array(*map(F.lit, _SEGMENT_COLUMNS[0]))
    ).otherwise(F.array(*map(F.lit, _SEGMENT_COLUMNS[1]))).alias("columns"))
    promised = slots.select("record_type", "declared_n", F.explode("columns").alias("element"))
    return reconcile.reconcile(actual, promised.select(kind, "declared_n"))


QUERIES["flagship"] = flagship
ORACLES["flagship"] = """WITH e AS (
    SELECT c_mktsegment AS t, CASE WHEN c_mktsegment < 'F' THEN 'holder' ELSE 'name' END AS element, c_name AS value
      FROM customer
    UNION ALL SELECT c_mktsegment, CASE WHEN c_mktsegment < 'F' THEN 'country' ELSE 'nation' END,
      CAST(c_nationkey AS VARCHAR) FROM customer)
    SELECT t || '.' || element AS file, count(*) AS declared_n,
    count(*) FILTER (WHERE value NOT IN ('', '0')) AS actual_n, CASE WHEN
    count(*) = count(*) FILTER (WHERE value NOT IN ('', '0')) THEN 'GOOD' ELSE 'BOO' END AS verdict
    FROM e GROUP BY t, element"""
