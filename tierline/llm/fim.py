"""Fill-in-middle: a text is cut at two token places and put together with its middle last.

A token is a run of ASCII letters or any other single character. ``regexp_count``
says how many a text has, hashes of the key pick the two places, and one match of
a pattern made for the row takes the three parts: ``{a}`` units, ``{b-a}`` units,
the rest. All repetitions are possessive, so the matcher walks through them in a
loop and never backtracks; its depth does not grow with the text. The parts land
in the output by the references of the replacement, within that same match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The tokens, the marks, and the shares of texts of each form.
TOKENS = "[A-Za-z]+|[^A-Za-z]"
UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = "<[PSM]>"
CUT_PERCENT = 90
SUFFIX_FIRST_PERCENT = 20

PLAIN, PSM, SPM = "plain", "psm", "spm"


def draw(key: Column, place: int) -> Column:
    """The place-th (from 1) 8-digit group of the hash of ``1:key`` as a number; a null key counts as an empty one."""
    told = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(told, 8 * place - 7, 8), 16, 10).cast("long")


def pattern(before: Column, within: Column) -> Column:
    """Matches a whole text: that many units, that many more, all the rest."""
    return F.concat(
        F.lit(rf"\A({UNIT}{{"), before.cast("string"), F.lit(rf"}}+)({UNIT}{{"), within.cast("string"), F.lit(r"}+)((?s:.*+))\z")
    )


def transform(df: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``key``, ``n`` tokens, ``form``, ``output``, ``prefix_chars``, ``middle_chars``.

    Other columns are left out, so none can clash. A null text is an empty one. Texts that are empty or hold a
    mark stay as they are (``plain``), as do a tenth of the others; ``prefix_chars`` and ``middle_chars`` (code points)
    are null for them. Rows with equal keys and texts give equal results; rows with a null key share one draw. A part may
    be empty. A very long text is matched in a loop and copied a few times, but never cut.
    """
    key, text = F.col(f"`{key_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = df.select(key.alias("key"), text.alias("text"), F.regexp_count(text, F.lit(TOKENS)).cast("long").alias("n"))
    places = [draw(F.col("key"), i) % (F.col("n") + 1) for i in (1, 2)]
    whole = (F.col("text") == "") | F.col("text").rlike(MARK) | (draw(F.col("key"), 3) % 100 >= CUT_PERCENT)
    form = F.when(whole, PLAIN).when(draw(F.col("key"), 4) % 100 < SUFFIX_FIRST_PERCENT, SPM).otherwise(PSM)
    drawn = rows.select("key", "text", "n", form.alias("form"), F.least(*places).alias("a"), F.greatest(*places).alias("b"))
    order = F.when(F.col("form") == PSM, f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    moved = F.regexp_replace("text", pattern(F.col("a"), F.col("b") - F.col("a")), order)
    made = drawn.select("key", "n", "form", F.when(F.col("form") == PLAIN, F.col("text")).otherwise(moved).alias("output"))
    cut = made.select("*", parts(F.col("output"), F.col("form")).alias("parts"))
    return cut.select(
        "key",
        "n",
        "form",
        "output",
        F.length(F.col("parts.prefix")).cast("long").alias("prefix_chars"),
        F.length(F.col("parts.middle")).cast("long").alias("middle_chars"),
    )


def parts(output: Column, form: Column) -> Column:
    """Prefix, middle and suffix of an output, by its marks; null for a plain one.

    A text that was cut holds no mark, and a mark that begins in a part would need the
    start of the next mark within itself, so exactly the three inserted ones are found.
    """
    found = F.split(output, MARK, -1)
    first, second, last = (F.get(found, F.lit(i)) for i in (1, 2, 3))
    prefix_first = form == PSM
    of = F.struct(
        F.when(prefix_first, first).otherwise(second).alias("prefix"),
        last.alias("middle"),
        F.when(prefix_first, second).otherwise(first).alias("suffix"),
    )
    return F.when(form != PLAIN, of)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from."""
    of = parts(output, form)
    return F.when(form == PLAIN, output).otherwise(F.concat(of["prefix"], of["middle"], of["suffix"]))


def digest(df: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The transformation with its output, and the text rebuilt from that, as hashes."""
    made = transform(df, key_col, text_col).withColumn("restored", restored(F.col("output"), F.col("form")))
    return made.select(
        F.col("key").alias(key_col),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens FROM documents
), d AS (
  SELECT *, len(tokens) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t
), f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), p AS (
  SELECT *, array_to_string(tokens[1:a], '') AS p, array_to_string(tokens[a + 1:b], '') AS m, array_to_string(tokens[b + 1:], '') AS s FROM f
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
    AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
