"""Quality rules: word and repetition counts, and how common each line is on its host.

A line that stands in many different documents of a host is boilerplate. Lines
are normalised and hashed with their host; every document gives each of its
lines once; equal texts of a host count as one document, so a text that was
copied does not make its own lines common. Lines above the limit are taken out,
and a document that keeps too little of itself is rejected.

Only 8-byte hashes are shuffled, and a host or line that is everywhere is
pre-summed before it meets. Nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.workspace import new_dir

# Fixed values.
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

LINE_LIMIT = 50
MIN_KEPT_PERCENT = 30


def words(text: Column) -> Column:
    return F.filter(F.split(text, rf"{SPACE}+", -1), lambda w: w != "")


def repeated_words(windows: Column) -> Column:
    """Number of words in windows of three that occur twice or more, given ordered (hash, place) of the windows."""

    def twice(w: Column, i: Column) -> Column:
        before = F.get(windows, i - 1)["hash"] == w["hash"]
        after = F.get(windows, i + 1)["hash"] == w["hash"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    places = F.transform(F.filter(windows, twice), lambda w: F.array(w["place"], w["place"] + 1, w["place"] + 2))
    return F.size(F.array_distinct(F.flatten(places)))


def normalised(line: Column) -> Column:
    """Lower case, digits as one sign, runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), rf"{SPACE}+", " "))


def measured(df: DataFrame, key_col: str, text_col: str, host_col: str) -> DataFrame:
    """Per row: the counts of the base rules, the host, a hash of the text, and its distinct lines.

    A line is its hash (of host and normalised text), its number of words and how often it stands there.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    host = F.col(f"`{host_col}`")
    cut = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{key_col}`").alias("key"),
        host.alias("host"),
        F.md5(text.cast("binary")).alias("text_hash"),
        text.alias("text"),
        words(text).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    triples = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("hash"), i.alias("place")),
    )
    windowed = cut.withColumn("windows", triples)
    # Most texts repeat nothing, which a set of hashes shows without sorting.
    hashes = F.transform("windows", lambda w: w["hash"])
    sorted_ = windowed.withColumn(
        "windows", F.when(F.size(F.array_distinct(hashes)) < F.size("windows"), F.array_sort("windows"))
    )
    line = F.transform(
        "lines",
        lambda x: F.struct(
            F.xxhash64(F.col("host"), F.isnull("host"), normalised(x)).alias("hash"), F.size(words(x)).alias("n")
        ),
    )
    return sorted_.select(
        "row",
        "key",
        "host",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.isnotnull("windows"), repeated_words(F.col("windows"))).otherwise(0).cast("long").alias("n_repeat_words"),
        line.alias("lines"),
    )


def common_lines(rows: DataFrame, limit: int) -> DataFrame:
    """Hashes of the lines that more than ``limit`` different texts of a host hold."""
    first = rows.groupBy("host", "text_hash").agg(F.min("row").alias("row")).select("row")
    once = rows.select("row", F.array_distinct(F.transform("lines", lambda x: x["hash"])).alias("hashes"))
    each = once.join(first, "row", "left_semi").select(F.explode("hashes").alias("hash"))
    return each.groupBy("hash").agg(F.count("*").alias("documents")).filter(F.col("documents") > limit)


def judge(
    df: DataFrame,
    key_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limit: int = LINE_LIMIT,
    min_kept_percent: int = MIN_KEPT_PERCENT,
) -> DataFrame:
    """One row per row: key, the counts, ``n_common_words`` (in common lines), ``base_failed``, ``kept``.

    ``kept`` is false if the base rules fail, or if after the common lines are out fewer than
    ``min_kept_percent`` of its words are left. Null texts are empty and fail; a null host is a host of its own.
    """
    spark = df.sparkSession
    path = new_dir(spark, "lines")
    measured(df, key_col, text_col, host_col).write.parquet(path)
    rows = spark.read.parquet(path)
    common = common_lines(rows, limit)
    # Within a document equal lines are summed first, so a line repeated in it is one row.
    each = rows.select("row", F.explode("lines").alias("x")).groupBy("row", F.col("x.hash").alias("hash")).agg(F.sum("x.n").alias("n"))
    out = each.join(common.select("hash"), "hash", "left_semi").groupBy("row").agg(F.sum("n").alias("n_common_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    left = 100 * (F.col("n_words") - F.col("n_common_words")) >= min_kept_percent * F.col("n_words")
    return (
        rows.drop("host", "text_hash", "lines")
        .join(out, "row", "left")
        .withColumn("n_common_words", F.coalesce("n_common_words", F.lit(0)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & left)
        .drop("row")
        .withColumnRenamed("key", key_col)
    )


# DuckDB: the same from its own string and list functions.
ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, source, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), grams AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1
), rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), lines AS (
  SELECT r, source, t, trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS l,
    len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
  FROM (SELECT r, source, t, unnest(ls) AS l FROM w)
), common AS (
  SELECT source, l FROM lines GROUP BY source, l HAVING count(DISTINCT t) > {LINE_LIMIT}
), gone AS (
  SELECT r, sum(n) AS n FROM lines x SEMI JOIN common c ON x.source IS NOT DISTINCT FROM c.source AND x.l = c.l GROUP BY r
), m AS (
  SELECT w.r, doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
    length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_common_words
  FROM w LEFT JOIN rep USING (r) LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, n_common_words::BIGINT AS n_common_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words)
    AND 100 * (n_words - n_common_words) >= {MIN_KEPT_PERCENT} * n_words AS kept
FROM m
"""
