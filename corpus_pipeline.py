"""From raw documents to token ids: each stage writes Parquet that the next one reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import bagminhash, language, mixing, pieces, pii
from tierline.llm.queries import labelled, piece_model
from tierline.workspace import new_dir

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
# A text of which less than this share of n-grams belongs to any one language is in none of them.
MIN_LANGUAGE = 0.2
# Shares of tokens: more of the good and clean, less of the rest than the documents have.
MIX = {"q1t0": 0.88, "q0t0": 0.07, "q1t1": 0.04, "q0t1": 0.01}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages; a missing language is filled in. Null, empty and letterless texts are in none."""
    told = language.identify(docs.select(*DOCUMENT), language.fit(docs))
    sure = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE)
    return told.filter(sure).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*DOCUMENT)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the least id; of repeated rows of that id, one."""
    return bagminhash.classes(docs.select(*DOCUMENT)).filter("is_first").select(*DOCUMENT)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, repeated ones too, its personal data replaced by the name of its kind; a null text stays null."""
    found = pii.detect(docs.select(*DOCUMENT), pii.fit(docs))
    cleaned = found.withColumn("text", pii.redacted(F.col("text"), F.col("pii_spans")))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, with the number of ``copies`` to train on that brings the domains' tokens to their shares.

    All tokens together stay about as many. ``target_`` and ``reached_`` tokens of each domain are the same in all rows. Equal rows
    have equal numbers; a null text is empty.
    """
    return mixing.counted(docs.select(*DOCUMENT), labelled(spark, sf_dir), MIX)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the documents that mixing takes, each encoded once, and the hash of what they decode to.

    All rows and the columns that mixing added stay; a document of no ``copies`` is not encoded, and its ids, their number
    and the hash are null.
    """
    mix = [c for c in docs.columns if c not in DOCUMENT]
    taken = F.col("copies") > 0
    chosen = docs.select("doc_id", F.when(taken, F.coalesce("text", F.lit(""))).alias("text"), "lang", "source", *mix)
    coded = pieces.decode(pieces.encode(chosen, piece_model()).drop("text"), piece_model())
    told = {"n_tokens": F.size("ids").cast("long"), "ids": F.col("ids"), "decoded_sha256": F.sha2("decoded", 256)}
    return coded.select("doc_id", "lang", "source", *mix, *[F.when(taken, c).alias(n) for n, c in told.items()])


def taken(docs: DataFrame) -> DataFrame:
    """The corpus to train on: every row as often as its ``copies`` say, numbered by ``copy`` from 1; rows of none are left out."""
    return docs.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))


STAGES: list[tuple[str, Stage]] = [
    ("language", in_a_language),
    ("near_dedup", without_near_copies),
    ("pii", without_personal_data),
    ("mixing", mixed),
    ("pieces", tokens),
]

# Trained models, signatures and iterative fits have no SQL form; tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = new_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return taken(docs)
