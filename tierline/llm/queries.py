"""The dealt operators over their whole tables, as registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import bagminhash, fim, language, line_quality, mixing, negatives, pieces, pii, secrets, simhash, topk, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def piece_model() -> str:
    """The public byte-pair model of 32,000 pieces."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pii.digest(pii.detect(documents, pii.fit(documents)))


def fold(of: int) -> Column:
    """The remainder that deals documents to learning and holding out; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % of


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    filters = language.fit(documents.filter(fold(4) != 2))
    told = language.identify(documents.select("doc_id", "text"), filters)
    return told.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document; a class is the component of links of similarity 0.8 or more over five-word shingles."""
    told = bagminhash.classes(table(spark, sf_dir, "documents"))
    return told.select("doc_id", "class_id", "class_size", "is_first")


# Shares of tokens: mostly good and clean text, some of the rest for contrast.
TARGETS = {"q1t0": 0.80, "q0t0": 0.12, "q1t1": 0.06, "q0t1": 0.02}


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string"))
    return table(spark, sf_dir, "labels").select("doc_id", domain.alias("domain"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(table(spark, sf_dir, "documents"), labelled(spark, sf_dir), TARGETS, with_totals=True)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
    return found.withColumnRenamed("id", "vec_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    learning = documents.filter(fold(5) != 0)
    model = toxicity.fit(learning, table(spark, sf_dir, "labels").filter(fold(5) != 0))
    scored = toxicity.score(documents.select("doc_id", "text"), model)
    held = F.coalesce(fold(5) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.detect(table(spark, sf_dir, "documents")))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), piece_model())


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through an archive: written, found by its address, read by range."""
    pages = table(spark, sf_dir, "pages")
    archive = warc.write(pages)
    return warc.records(warc.lookup(pages, archive), archive).drop("url", "payload")


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(table(spark, sf_dir, "documents"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(table(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = simhash.components(table(spark, sf_dir, "documents"))
    return told.select(F.col("key").alias("doc_id"), simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_language": op2_language,
    "op3_bagminhash": op3_bagminhash,
    "op4_mixing": op4_mixing,
    "op5_topk": op5_topk,
    "op6_toxicity": op6_toxicity,
    "op7_secrets": op7_secrets,
    "op8_pieces": op8_pieces,
    "op9_warc": op9_warc,
    "op10_line_quality": op10_line_quality,
    "op11_fim": op11_fim,
    "op12_simhash": op12_simhash,
    "op13_negatives": op13_negatives,
}

ORACLES: dict[str, str] = {
    "op5_topk": topk.ORACLE_SQL,
    "op9_warc": warc.ORACLE_SQL,
    "op10_line_quality": line_quality.ORACLE_SQL,
    "op11_fim": fim.ORACLE_SQL,
    "op13_negatives": negatives.ORACLE_SQL,
}
