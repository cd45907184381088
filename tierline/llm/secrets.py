"""Secrets: strict patterns, opaque tokens, and how widely each value is copied.

A value that many owners hold is an example that people paste; a value that
one owner alone holds looks live. Candidates of all documents are reduced to a
hash, and the hashes to their numbers of owners and repositories, before any
candidate meets its figures again. Strict matches are always reported; opaque
tokens are added where their value is specific to an owner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.spans import listed, matches, of_kind, overlaps
from tierline.workspace import new_dir

# The strict patterns. Shorter runs of hex digits and access keys would
# be dropped, so the length is part of the pattern.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
OPAQUE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])"
SECRET_LENGTH = 12

MAX_OWNERS = 1


def _spans(found: Column, kind: str, value, base: bool) -> Column:
    return F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.sha2(value(s["hit"]), 256).alias("value"),
            F.lit(base).alias("base"),
        ),
    )


def candidates(text: Column) -> tuple[Column, Column]:
    """Strict spans, and opaque tokens wherever they stand; each with a hash of its value."""
    lower = F.lower(text)
    named = F.lit(False)
    for word in ("passw", "secret", "token", "api"):
        named = named | F.contains(lower, F.lit(word))
    secret = lambda hit: F.regexp_extract(hit, ASSIGN, 1)
    assigned = F.filter(matches(text, ASSIGN, named), lambda s: F.length(secret(s["hit"])) >= SECRET_LENGTH)
    access = matches(text, ACCESS, F.contains(text, F.lit("AKIA")))
    hexes = matches(text, HEX, text.rlike("[0-9a-f]{16}"))
    strict = F.concat(
        _spans(assigned, "assign", secret, True),
        _spans(access, "access", lambda hit: hit, True),
        _spans(hexes, "hex", lambda hit: hit, True),
    )
    mixed = lambda hit: hit.rlike("[0-9]") & hit.rlike("[A-Z]") & hit.rlike("[a-z]")
    opaque = F.filter(matches(text, OPAQUE, text.rlike("[A-Za-z0-9+/_-]{20}")), lambda s: mixed(s["hit"]))
    return strict, _spans(opaque, "opaque", lambda hit: hit, False)


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners of every value and their repositories; a null owner or repository counts as one.

    A repository belongs to an owner: the same text of two owners is two.

    Each step groups by all that is still to be told apart, so a value that is
    everywhere is spread over tasks until only partial counts are left of it.
    """
    return (
        found.groupBy("value", "owner", "repository")
        .agg(F.count("*").alias("n"))
        .groupBy("value", "owner")
        .agg(F.count("*").alias("repositories"))
        .groupBy("value")
        .agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )


def detect(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str | None = None) -> DataFrame:
    """One row per row of ``df``: the key and ``secrets``, an array of spans.

    A span has start, end, kind, value (hash), base, owners, repositories and live.
    Strict spans are all there; an opaque token is there if it touches no strict
    span and is live, that is held by ``MAX_OWNERS`` owners at most, in however many
    repositories. Without ``repository_col`` every distinct text is a repository, so
    that copies count once. Null texts are empty; repeated rows stay apart.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    strict, opaque = candidates(text)
    found = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{key_col}`").alias("key"),
        F.col(f"`{owner_col}`").alias("owner"),
        (F.col(f"`{repository_col}`") if repository_col else F.xxhash64(text)).alias("repository"),
        strict.alias("strict"),
        opaque.alias("opaque"),
    )
    free = F.filter("opaque", lambda o: ~F.exists(F.col("strict"), lambda s: overlaps(s, o)))
    # Written once: numbering rows again in another plan could number them otherwise.
    path = new_dir(spark, "secrets")
    found.select("row", "key", "owner", "repository", F.concat("strict", free).alias("spans")).write.parquet(path)
    rows = spark.read.parquet(path)
    each = rows.select("row", "key", "owner", "repository", F.explode("spans").alias("s")).withColumn("value", F.col("s.value"))
    judged = each.join(ownership(each), "value", "left").select(
        "row",
        "key",
        F.struct(
            "s.*",
            "owners",
            "repositories",
            (F.col("owners") <= MAX_OWNERS).alias("live"),
        ).alias("s"),
    )
    told = judged.filter("s.base or s.live").groupBy("row", "key").agg(F.array_sort(F.collect_list("s")).alias("secrets"))
    # A row whose candidates were all taken for examples comes back by the outer join, small as it is.
    with_any = rows.filter(F.size("spans") > 0).select("row", F.col("key").alias("doc_key"))
    kept = with_any.join(told.drop("key"), "row", "left").select(F.col("doc_key").alias("key"), "secrets")
    none = rows.filter(F.size("spans") == 0).select("key", F.lit(None).cast(kept.schema["secrets"].dataType).alias("secrets"))
    empty = F.array().cast(kept.schema["secrets"].dataType)
    return kept.unionByName(none).select(F.col("key").alias(key_col), F.coalesce("secrets", empty).alias("secrets"))


def digest(df: DataFrame) -> DataFrame:
    """Counts and digests of detected secrets."""
    base = F.filter("secrets", lambda s: s["base"])
    counts = [F.size(of_kind(base, k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return df.select(
        "doc_id",
        *counts,
        F.sha2(listed(base, KINDS), 256).alias("base_sha256"),
        listed(F.col("secrets"), (*KINDS, "opaque")).alias("spans"),
        F.size(F.filter("secrets", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("secrets", lambda s: ~s["live"])).cast("long").alias("n_example"),
    )
