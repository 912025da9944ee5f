"""The queries of this subpackage, each an operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.llm import bpe, conversations, language, quality, toxicity, warc
from quillgrid.llm.common import checkpointed, shared_path, table
from quillgrid.llm.decontaminate import find_passages
from quillgrid.llm.exact_dedup import exact_groups
from quillgrid.llm.jaccard import near_classes
from quillgrid.llm.oracles import REPAIR_SQL, quality_sql
from quillgrid.llm.sharding import shard
from quillgrid.llm.suffix_dedup import repeated_spans
from quillgrid.llm.whitening import fit, whiten
from quillgrid.llm.wrapper import extract

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


# A-Z alone in lower case, as SQL.
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op8_exact_dedup",
    f"""WITH d AS (SELECT doc_id, {LOWER_SQL} AS t FROM documents),
    g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
    FROM d JOIN g USING (t)""",
)
def exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed package of public tokenizers keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_bpe")
def bpe_round_trip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, tokenizer_path()).drop("text")
    ids = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    digests = encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), "ids"
    )
    decoded = bpe.decode(digests, tokenizer_path())
    return decoded.select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


WORDS9_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+')"


@query(
    "op9_decontaminate",
    f"""WITH d AS (SELECT doc_id, {WORDS9_SQL} AS w FROM documents),
    b AS (SELECT item_id, {WORDS9_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
    win AS (SELECT DISTINCT item_id, least(13, len(w)) AS size, list_slice(w, i, i + least(13, len(w)) - 1) AS win
        FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
    sizes AS (SELECT DISTINCT size FROM win),
    places AS (SELECT doc_id, size, i, list_slice(w, i, i + size - 1) AS win
        FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS u(i) WHERE len(w) >= size),
    hit AS (SELECT doc_id, p.size, i, item_id FROM places p JOIN win USING (size, win)),
    words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hit, unnest(range(i, i + size)) AS u(k) GROUP BY doc_id),
    items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
        string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
)
def decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_passages(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def learns_language() -> Column:
    """Rows that language labels may be learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1


@query("op6_language")
def language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.predict(docs, language.learn(docs, learns_language()))
    return found.select("doc_id", (~learns_language()).alias("held_out"), "lang_pred", "score", "margin")


@query("op7_jaccard_join")
def jaccard_join(spark, sf_dir):
    return near_classes(table(spark, sf_dir, "documents"), percent=90, width=3)


SHARDS = 24


@query("op1_sharding")
def sharding_by_vectors(spark, sf_dir):
    placed = shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_warc")
def warc_round_trip(spark, sf_dir):
    archives = warc.pack_arc(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    # The page of a record stands in its HTTP head, as text that reads back as the id.
    page = F.regexp_extract("http", r"\r\nX-Record: (-?\d*)\r\n", 1).try_cast("bigint").alias("page_id")

    def converted(columns: list[str] | None = None) -> DataFrame:
        return warc.convert_arc(archives, columns=columns).where("record_type <> 'warcinfo'").select("*", page)

    path = shared_path(spark, "warc")
    narrow = converted(["record_id", "record_type", "http", "payload_digest", "payload_bytes"])
    warc.write_warc(warc.revisits(converted(), "page_id", narrow=narrow), path)
    told = ["record_id", "record_type", "http", "payload_digest", "payload_bytes", "refers_to"]
    back = warc.read_warc(spark, path, told).select(
        page, "payload_bytes", "payload_digest", "record_type", "record_id", F.col("refers_to").alias("original"),
    )
    back = checkpointed(back)  # read once, used for the pages and for what revisits refer to
    responses = back.where("record_type = 'response'").select(F.col("record_id").alias("original"), F.col("page_id").alias("refers_to"))
    return back.drop("record_id").join(responses, "original", "left").drop("original")


@query("op3_suffix_array")
def suffix_dedup(spark, sf_dir):
    found = repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def learns_toxicity() -> Column:
    """Rows whose toxicity labels may be learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0


@query("op2_toxicity")
def toxicity_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), learns_toxicity())
    return toxicity.score(docs, model).select("doc_id", (~learns_toxicity()).alias("held_out"), "score", "predicted")


@query("op10_html_extraction")
def html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast("bigint"))


@query("op11_whitening")
def embedding_whitening(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whiten(vectors, fit(vectors))


def damaged(rows: DataFrame) -> DataFrame:
    """Turns of ``conversations`` with the faults that the check of their repair wants;
    NULL is one blank."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    case = F.pmod(F.crc32(place.cast("binary")), F.lit(20))
    copies = F.when(case == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where(case != 0).select(
        "conv_id", "turn", F.when(case == 4, "user").otherwise(role).alias("role"),
        F.when(case == 1, "").when(case == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


@query("op12_conversation_repair", REPAIR_SQL)
def conversation_repair(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.report(damaged(given), given)


@query("op13_quality_rules", quality_sql())
def quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    measured = checkpointed(quality.measure(docs))
    judged = quality.judge(measured, quality.calibrate(measured, table(spark, sf_dir, "labels")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("rejected_by", ",").alias("rejected_by"),
    )
