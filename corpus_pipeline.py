"""The training-data pipeline over `documents`: a list of stages, each a function of the one before.

Each stage takes (spark, docs, sf_dir) and returns documents, the last one
their tokens. The stages are not expressed in SQL; tests/llm holds each against
a brute-force form.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.llm import decontaminate, language, near_dedup, pieces, secret_scan
from postline.llm.batches import unused
from postline.llm.queries import MODEL_FILE
from postline.session import stage

# Least score of a language, as a share of the way from a guess among all to certainty.
SURE = 0.1


def least_score(languages: int) -> float:
    """The languages share 1, so a guess scores 1 / languages: more than that is asked, however many there are."""
    return (1 + SURE * (languages - 1)) / languages


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; a missing `lang` is filled with it.

    Where no labelled document is there to learn from (all without `lang` or
    doc_id, or in fold 0), no language can be told: all documents with letters
    stay, with `lang` as it is.
    """
    network = language.fit(docs)
    if network is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    own = {name: unused(docs, f"_{name}") for name in ("lang_pred", "score")}
    renamed = docs.withColumnsRenamed(own)
    judged = language.identify(renamed, network, renamed.columns)
    known = judged.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least_score(len(network.languages))))
    filled = known.withColumn("lang", F.coalesce("lang", "lang_pred")).drop(*own)
    return filled.withColumnsRenamed({there: name for name, there in own.items()}).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of four words, fingerprints at four bits or fewer."""
    return near_dedup.keep_first(docs, radius=4, shingle_words=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of `benchmark`."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with masked secrets."""
    return secret_scan.redact(docs, secret_scan.fit(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and n_tokens of every document."""
    encoded = pieces.encode_documents(docs, MODEL_FILE, ["doc_id", "lang", "source"])
    return encoded.select("doc_id", "lang", "source", "ids", "n_tokens")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", mask_secrets),
    ("sentencepiece", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, each stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
