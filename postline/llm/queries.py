"""One query per operator, over its whole table, with production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.llm import (
    decontaminate,
    filter_audit,
    html_text,
    language,
    license_scan,
    near_dedup,
    nearest,
    packing,
    pieces,
    secret_scan,
    sharding,
    spelling,
    url_filter,
    url_sql,
)

SHARDS = 40
# The model file of the tokenizer, on the driver.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
# The file of the tokenizer that documents are packed by, on the driver.
TOKENIZER_FILE = "/opt/tokenizers/byte_bpe_50k.json"
QUERY_STEP = 20
RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"), ["doc_id"])


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item in it; clean documents have none."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.fit(docs), ["doc_id"])


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """url and bad of every page: 1 if the document that the path ends with is of low quality or toxic."""
    number = F.regexp_extract(url_filter.path_of(F.col("url")), "/([0-9]{1,18})(?:[.]html)?/?$", 1)
    known = pages.select("url", F.when(number != "", number.cast("bigint")).alias("doc_id"))
    bad = F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad")
    return known.join(labels.groupBy("doc_id").agg(bad), "doc_id", "left").select("url", "bad")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    labels = labelled_urls(pages, table(spark, sf_dir, "labels"))
    return url_filter.judge_urls(pages, labels, RULES).select("page_id", "host", "path", "rule", "verdict", "template")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.fingerprint_classes(table(spark, sf_dir, "documents"), radius=4, shingle_words=4)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), MODEL_FILE, ["doc_id"])


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.filter(F.col("vec_id") % QUERY_STEP == 0))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language.fold() == 0, F.lit(False)).alias("held_out")
    found = language.identify(docs, language.fit(docs), ["doc_id"])
    return found.select("doc_id", held_out, "lang_pred", "score")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), least=5, times=3, drop=97)
    return spelling.variants(words, ratio=2)


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER_FILE, capacity=2048)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_license_scan,
        op2_sharding,
        op3_decontamination,
        op4_secret_scan,
        op5_url_filter,
        op6_simhash_near_dedup,
        op7_html_extraction,
        op8_sentencepiece,
        op9_nearest_neighbours,
        op10_language_id,
        op11_filter_audit,
        op12_spelling_variants,
        op13_best_fit_packing,
    )
}
# The others cannot be expressed in SQL; tests/llm holds each against a brute-force form.
NUMBER = f"regexp_extract({url_sql.PATH}, '/([0-9]{{1,18}})(?:[.]html)?/?$', 1)"
SQL: dict[str, str] = {
    "op11_filter_audit": filter_audit.AUDIT_SQL,
    "op5_url_filter": url_sql.judged_pages(
        RULES,
        f"""SELECT url, bad FROM (SELECT url, CASE WHEN {NUMBER} <> '' THEN CAST({NUMBER} AS BIGINT) END AS doc_id FROM pages)
            LEFT JOIN (SELECT doc_id, max(CAST(quality = 0 OR toxic = 1 AS INTEGER)) AS bad FROM labels GROUP BY doc_id)
            USING (doc_id)""",
    )
}
