"""Flattening, renaming, trimming, dedup and declared columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators import shape
from tierline.suite import inputs
from tierline.suite.inputs import with_survey
from tierline.suite.registry import query, table


def _nested_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(F.col("user_id").alias("id"), F.struct(F.col("event_type").alias("kind"), "value").alias("event")).alias("who"),
        F.array("user_id", "event_id").alias("codes"),
        F.from_json("props", "k int").alias("props"),
        F.create_map(F.lit("type"), "event_type").alias("attrs"),
        F.col("user_id").alias("props_k"),
    )


@query(
    "PRJ1",
    """SELECT event_id, '[' || user_id || ',' || event_id || ']' AS codes,
    '{"type":"' || event_type || '"}' AS attrs, user_id AS props_k, user_id AS who_id,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k_2, event_type AS who_event_kind,
    value AS who_event_value FROM events""",
)
def flatten_json(spark, sf_dir):
    return shape.flatten(_nested_events(spark, sf_dir))


@query(
    "PRJ2",
    """SELECT doc_id, '{"lang":"' || lang || '","source":"' || source || '"}' AS origin,
    '[' || n_chars || ']' AS sizes, text FROM documents""",
)
def primitive_guard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return shape.primitive_only(
        docs.select("doc_id", F.struct("lang", "source").alias("origin"), F.array("n_chars").alias("sizes"), "text")
    )


@query("PRJ3", "SELECT doc_id, lang AS lang_code, source AS source_name, n_chars AS n_chars, doc_id AS doc_id_2 FROM documents")
def rename_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return shape.tidy_names(
        docs.select(
            F.col("doc_id").alias("Doc/Id"),
            F.col("lang").alias("lang.code"),
            F.col("source").alias("Source Name"),
            F.col("n_chars").alias("n-chars"),
            F.col("doc_id").alias("doc_id"),
        )
    )


@query("PRJ4", "SELECT doc_id, trim(text, ' ') AS text, source FROM documents")
def trim_strings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return shape.trim_strings(
        docs.select("doc_id", F.concat(F.lit("  "), "text", F.lit(" ")).alias("text"), F.concat("source", F.lit("   ")).alias("source"))
    )


@query(
    "PRJ5 AGG10",
    "SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS closed_price FROM orders",
)
def drop_null_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return shape.drop_null_columns(
        orders.select(
            "o_orderkey",
            F.lit(None).cast("string").alias("never_asked"),
            "o_orderpriority",
            F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("closed_price"),
            F.when(F.col("o_orderkey") < 0, "x").alias("never.answered"),
        )
    )


_COUNTED = ("_id", "txt_notes", "sd_scenario_1", "sd_scenario_2", "health_services_communityengagement_meetings")


@query(
    "AGG9 AGG10",
    with_survey(
        "SELECT count(*) AS _rows, " + ", ".join(f"count(*) - count({c}) AS {c}" for c in _COUNTED) + " FROM survey_v"
    ),
)
def null_counts(spark, sf_dir):
    return shape.null_counts(inputs.survey(spark, sf_dir).select(*_COUNTED))


_LINE_ORDER = ("l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")


@query(
    "PRJ6",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {", ".join(f"{c} DESC" for c in _LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedup_latest(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return shape.dedup(lines, ["l_orderkey", "l_linenumber"], [F.col(c).desc() for c in _LINE_ORDER])


@query("PRJ6", "SELECT o_custkey, min(o_orderpriority) AS o_orderpriority, count(*) > 0 AS seen FROM orders GROUP BY o_custkey")
def dedup_any(spark, sf_dir):
    """Copies that differ in nothing but the row they came from, and one column that decides."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", F.lit(True).alias("seen"))
    return shape.dedup(orders, "o_custkey", [F.col("o_orderpriority").asc()])


_LEVELS = 13


@query("PRJ1 PRJ18", f"SELECT event_id, event_type AS a_{'_'.join(f'l{n}' for n in range(_LEVELS))} FROM events")
def flatten_deep(spark, sf_dir):
    """More levels than anyone nests; every leaf becomes a column."""
    value = F.col("event_type")
    for level in reversed(range(_LEVELS)):
        value = F.struct(value.alias(f"l{level}"))
    return shape.flatten_dimension(table(spark, sf_dir, "events").select("event_id", value.alias("a")))


@query(
    "PRJ7 PRJ8",
    """SELECT *, 'run-1' AS _pipeline_execution_id, '2024-06-15T10:30:00' AS _ingestion_timestamp,
    'orders' AS _pipeline_name, 'liberia' AS _country, '2024-06-15T10:31:00' AS _processed_at,
    '2024-06-15T10:32:00' AS _curated_at, 'run-1' AS _curated_execution_id FROM orders""",
)
def lineage_columns(spark, sf_dir):
    df = shape.processed_lineage(
        table(spark, sf_dir, "orders"), "run-1", "2024-06-15T10:30:00", "orders", "liberia", "2024-06-15T10:31:00"
    )
    return shape.curated_lineage(df, "run-1", "2024-06-15T10:32:00")


PART_SCHEMA = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_size", T.StringType()),
        T.StructField("p_container", T.StringType()),
    ]
)


@query(
    "SNK6 SNK7",
    """SELECT p_partkey, left(p_name, 8) AS p_name, CAST(p_size AS VARCHAR) AS p_size,
    CAST(NULL AS VARCHAR) AS p_container FROM part""",
)
def declared_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumnRenamed("p_name", "P_Name")
    return shape.to_declared(part, PART_SCHEMA, {"p_name": 8})


@query("PRJ13 SNK7", "SELECT *, CAST(NULL AS VARCHAR) AS p_container FROM part")
def missing_columns(spark, sf_dir):
    return shape.with_declared_columns(table(spark, sf_dir, "part"), PART_SCHEMA)


@query(
    "PRJ18",
    """SELECT c_custkey AS id, c_name AS displayname, n_nationkey AS parent_id, n_name AS parent_displayname,
    '[' || n_regionkey || ']' AS levels FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def record_flatten_dim(spark, sf_dir):
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    units = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("displayName"),
        F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("displayName")).alias("parent"),
        F.array("n_regionkey").alias("levels"),
    )
    return shape.flatten_dimension(units)
