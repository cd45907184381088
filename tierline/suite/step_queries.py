"""SQL texts over batches, views, and the whole raw-to-curated batch."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import survey as rules
from tierline.operators import reports
from tierline.operators.shape import rename
from tierline.plans import batch, steps
from tierline.plans.load import load
from tierline.plans.star import Star, StarDimension, load_star, view
from tierline.sinks import layers
from tierline.sinks.control import ControlLog
from tierline.sinks.tables import SnapshotTable
from tierline.sources import files
from tierline.suite import inputs
from tierline.suite.inputs import with_kpis
from tierline.suite.registry import query, table
from tierline.suite.survey_queries import CY_MONTH_SQL
from tierline.workspace import new_dir


@query(
    "PRJ9 PRJ13",
    """SELECT *, lower(trim(o_orderpriority)) AS priority FROM orders WHERE o_totalprice IS NOT NULL""",
)
def cleaning_sql(spark, sf_dir):
    return steps.run_sql(
        table(spark, sf_dir, "orders"),
        "SELECT *, LOWER(TRIM(o_orderpriority)) AS priority FROM source_data WHERE o_totalprice IS NOT NULL",
    )


_STEPS = """
SELECT this text comes before the first marker;
-- transform_price_band
-- a comment line
SELECT o_orderkey, o_custkey, o_totalprice,

       CASE WHEN o_totalprice > 200000 THEN 'high' ELSE 'low' END AS band
FROM __TABLE__;
-- transform_nothing_here

-- transform_per_customer
SELECT o_custkey, band, COUNT(*) AS n_orders, MAX(o_totalprice) AS largest
FROM __TABLE__ GROUP BY o_custkey, band;  -- one row per customer and band
-- transform_large_only
SELECT *, n_orders > 1 AS repeated FROM __TABLE__
"""


@query(
    "PRJ10",
    """WITH b AS (SELECT o_custkey, o_totalprice, CASE WHEN o_totalprice > 200000 THEN 'high' ELSE 'low' END AS band
    FROM orders) SELECT o_custkey, band, count(*) AS n_orders, max(o_totalprice) AS largest,
    count(*) > 1 AS repeated FROM b GROUP BY o_custkey, band""",
)
def sql_steps(spark, sf_dir):
    return steps.run_steps(table(spark, sf_dir, "orders"), _STEPS)


@query("PRJ11", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def sql_single(spark, sf_dir):
    text = "SELECT o_orderstatus, COUNT(*) AS n\nFROM processed_data GROUP BY o_orderstatus;"
    return steps.run_steps(table(spark, sf_dir, "orders"), text)


@query("PRJ12 PRJ14", "SELECT *, '2024-06-15' AS _cleaned_at FROM part")
def sql_passthrough(spark, sf_dir):
    return steps.stamped(steps.run_steps(table(spark, sf_dir, "part"), None), at=F.lit("2024-06-15"))


@query("PRJ15", "SELECT *, DATE '2024-06-15' AS snapshot_date FROM supplier")
def snapshot_view(spark, sf_dir):
    return steps.with_snapshot_date(table(spark, sf_dir, "supplier"), F.lit("2024-06-15").cast("date"))


@query(
    "PRJ16 PRJ17",
    """SELECT c_mktsegment, count(*) AS n, CAST(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS in_debt
    FROM customer GROUP BY c_mktsegment""",
)
def ordered_views(spark, sf_dir):
    steps.refresh_views(
        spark,
        {
            "vw_2_segments": "SELECT c_mktsegment, COUNT(*) AS n, COUNT_IF(c_acctbal < 0) AS in_debt "
            "FROM vw_1_customers GROUP BY c_mktsegment",
            "vw_1_customers": lambda s: table(s, sf_dir, "customer"),
            "vw_3_empty": " ",
            "other": "SELECT * FROM no_such_table",
        },
        select="vw_",
    )
    return spark.table("vw_2_segments")


@query(
    "SNK10",
    "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey",
)
def load_statements(spark, sf_dir):
    target = new_dir(spark, "customers")
    customers = table(spark, sf_dir, "customer")
    customers.createOrReplaceTempView("customers_arriving")

    def load():
        layers.write_parquet(spark.table("customers_wanted"), target)
        spark.read.parquet(target).createOrReplaceTempView("customers_loaded")

    steps.load_with_statements(
        load,
        spark,
        before=[("customers_wanted", "SELECT c_custkey, c_nationkey FROM customers_arriving")],
        after=[("customers_by_nation", "SELECT c_nationkey, COUNT(*) AS n FROM customers_loaded GROUP BY c_nationkey")],
    )
    return spark.table("customers_by_nation")


# Group paths as the survey tool delivers them; names without a group stay.
_GROUPS = ("basic_info", "grp_incentive1", "grp_incentive2", "supervision_grp", "stock_info", "health_services")


def _tool_name(column: str) -> str:
    for group in _GROUPS:
        if column.startswith(group + "_"):
            return f"{group}/{column[len(group) + 1:]}"
    return column


@query("SRC1 SRC5 SRC8 PRJ1 PRJ3 PRJ4 PRJ6 PRJ7 PRJ8 SNK1 SNK14 AGG2", with_kpis(CY_MONTH_SQL))
def survey_end_to_end(spark, sf_dir):
    """Raw survey documents through both layers to the monthly report."""
    root = new_dir(spark, "survey")
    submissions = rename(inputs.survey(spark, sf_dir), _tool_name)
    documents = submissions.select(F.struct(F.array(F.struct("*")).alias("results")).alias("doc"))
    layers.land_documents(documents, "doc", f"{root}/raw")

    run = batch.Run("survey", "run-1", "2024-06-15T10:30:00", "liberia")
    raw = files.read_json(spark, f"{root}/raw", documents.schema["doc"].dataType)
    processed = batch.processed(raw, run, dedup_key="_id", drop_nulls=False)
    path = batch.write_layer(rules.clean(processed, inputs.RULES), f"{root}/processed", run, f"{root}/audit", "processed")

    curated = batch.curated(rules.curate(files.read_parquet(spark, path), inputs.RULES), run)
    return reports.calendar_month_report(curated)


@query(
    "PRJ1 PRJ3 PRJ4 PRJ5 PRJ6 PRJ9 SRC8",
    """SELECT event_id, event_type AS who_kind, user_id AS who_user_id, value, upper(event_type) AS label,
    'run-2' AS _pipeline_execution_id, '2024-06-15T10:30:00' AS _ingestion_timestamp, 'events' AS _pipeline_name,
    'global' AS _country, '2024-06-15T10:30:00' AS _processed_at FROM events""",
)
def cleaned_batch(spark, sf_dir):
    """All cleaning steps on response documents; one of their fields is never filled."""
    record = F.struct(
        "event_id",
        F.struct(F.concat(F.lit(" "), "event_type").alias("kind"), F.col("user_id").alias("user-id")).alias("who"),
        F.lit(None).cast("string").alias("never"),
        F.col("value").alias("VALUE"),
    )
    docs = table(spark, sf_dir, "events").select(F.array(record, record).alias("results"))
    run = batch.Run("events", "run-2", "2024-06-15T10:30:00")
    return batch.processed(docs, run, "event_id", "SELECT *, UPPER(who_kind) AS label FROM source_data")


@query("PRJ9 PRJ11", "SELECT o_orderkey AS source_data, 'source_data' AS origin FROM orders WHERE o_orderstatus = 'F'")
def cleaning_sql_literals(spark, sf_dir):
    """The input's name as a relation, a literal, an alias and in a comment."""
    text = "SELECT o_orderkey AS source_data, 'source_data' AS origin -- of source_data\nFROM source_data WHERE o_orderstatus = 'F'"
    return steps.run_sql(table(spark, sf_dir, "orders"), text)


@query("PRJ17 SNK10", "SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_totalprice > 1000 GROUP BY o_orderstatus")
def views_from_folder(spark, sf_dir):
    """Views from SQL files in name order, the second over the first."""
    root = new_dir(spark, "sql")
    table(spark, sf_dir, "orders").createOrReplaceTempView("tierline_orders")
    texts = [
        ("1_large", "SELECT * FROM tierline_orders WHERE o_totalprice > 1000"),
        ("2_counts", "SELECT o_orderstatus, count(*) AS orders FROM `1_large` GROUP BY o_orderstatus"),
    ]
    for name, text in texts:
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(f"{root}/{name}")
    # Spark names files itself, so a folder stands for each file here.
    for name, _ in texts:
        [(_, text)] = steps.read_statements(spark, f"{root}/{name}", "*.txt")
        steps.refresh_views(spark, {name: text})
    return spark.table("2_counts")


@query(
    "SNK5 INC6 DQ1 DQ2 DQ4",
    """SELECT count(*) AS table_rows, strftime(max(o_orderdate), '%Y-%m-%d') AS watermark, 'passed' AS verdict FROM orders""",
)
def load_end_to_end(spark, sf_dir):
    """Two batches, the second incremental: merged, watermarked, checked."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    facts = SnapshotTable(spark, new_dir(spark, "facts"), bucket_by=["o_orderkey"], buckets=8)
    checks = [{"type": "row_count_min", "threshold": 1}, {"type": "null_check", "columns": ["o_orderkey"]}]
    first = load(facts, orders.filter("day < '1997-01-01'"), ["o_orderkey"], "batch-1", "day", checks=checks)
    done = load(facts, orders.filter(F.col("day") >= first.watermark), ["o_orderkey"], "batch-2", "day", checks=checks)
    return spark.createDataFrame([(done.rows, done.watermark, done.verdict)], "table_rows long, watermark string, verdict string")


@query("SRC1 SRC5 SRC8 PRJ13 PRJ19 SNK1 SNK5 SNK14 INC1 INC2 DQ4", with_kpis("SELECT _id, county_label, fy_year, fy_quarter, correct_ontime, correct_treatment, ip FROM kpi_v"))
def survey_load_end_to_end(spark, sf_dir):
    """Two runs of survey documents, the second with corrections, through all layers into the table, its mark and its checks."""
    root = new_dir(spark, "survey-load")
    surveys = inputs.survey(spark, sf_dir)
    early = surveys.withColumns({"txt_notes": F.lit("draft"), "grp_incentive1_incentive_correct": F.lit("0"), "sd_scenario_1": F.lit("9")})
    facts = SnapshotTable(spark, f"{root}/community_data", bucket_by=["_id"], buckets=8)
    marks = ControlLog(spark, f"{root}/watermarks")
    checks = [{"type": "row_count_min", "threshold": 10}, {"type": "null_check", "columns": ["_id"]}]
    for day, submissions in ((15, early.filter("_id % 3 = 0")), (22, surveys)):
        run = batch.Run("survey", f"run-{day}", f"2024-06-{day}T10:30:00", "liberia")
        documents = rename(submissions, _tool_name).select(F.struct(F.array(F.struct("*")).alias("results")).alias("doc"))
        layers.land_documents(documents, "doc", f"{root}/raw/{day}")
        raw = files.read_json(spark, f"{root}/raw/{day}", documents.schema["doc"].dataType)
        clean = rules.clean(batch.processed(raw, run, dedup_key="_id", drop_nulls=False), inputs.RULES)
        path = batch.write_layer(clean, f"{root}/processed", run, f"{root}/audit", "processed", ledger_path=f"{root}/ledger")
        curated = batch.curated(rules.curate(files.read_parquet(spark, path), inputs.RULES), run)
        path = batch.write_layer(curated, f"{root}/curated", run, f"{root}/audit", "curated")
        done = load(facts, files.read_parquet(spark, path), ["_id"], run.execution_id, "start", checks=checks, batch_checks=checks)
        marks.finish("survey", done.watermark, run.ingestion_time, run.execution_id)
    return facts.read().select("_id", "county_label", "fy_year", "fy_quarter", "correct_ontime", "correct_treatment", "ip")


_UNIT = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "displayname", "parent_id", "parent_displayname")])
_ELEMENT = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "displayname", "shortname")])


@query(
    "SRC10 SRC12 PRJ18 SNK3 SNK5 SNK6 JOIN1 INC6 DQ4",
    """SELECT CAST(l_partkey AS VARCHAR) AS dataelement, p_name AS dataelement_name, left(p_brand, 5) AS dataelement_shortname,
    CAST(l_suppkey AS VARCHAR) AS orgunit, s_name AS orgunit_name, CAST(n_nationkey AS VARCHAR) AS orgunit_parent_id, n_name AS orgunit_parent_name,
    strftime(l_shipdate, '%Y%m') AS period, CAST(l_orderkey AS VARCHAR) AS categoryoptioncombo, CAST(l_linenumber AS VARCHAR) AS attributeoptioncombo,
    CASE WHEN year(l_shipdate) = 1997 THEN l_quantity + 1 ELSE l_quantity END AS value
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_partkey % 4 <> 0
    LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey""",
)
def star_end_to_end(spark, sf_dir):
    """Facts of two runs and their dimensions from envelopes to the joined view; the second run brings a year again."""
    root = new_dir(spark, "star")
    part, supplier, nation = (table(spark, sf_dir, n) for n in ("part", "supplier", "nation"))
    elements = part.filter("p_partkey % 4 <> 0").select(
        F.array(F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("displayName"), F.col("p_brand").alias("shortName"))).alias("dataElements")
    )
    parent = F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("displayName"))
    unit = F.struct(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("displayName"), parent.alias("parent"))
    units = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(F.array(unit).alias("organisationUnits"))
    star = Star(
        facts=SnapshotTable(spark, f"{root}/data_values", partition_by=["period"], sort_keys=["period", "dataelement", "orgunit"]),
        keys=["dataelement", "period", "orgunit", "categoryoptioncombo", "attributeoptioncombo"],
        columns=["dataelement", "period", "orgunit", "categoryoptioncombo", "attributeoptioncombo", "value"],
        dimensions=[
            StarDimension(elements, "dataElements", SnapshotTable(spark, f"{root}/elements"), _ELEMENT, "dataelement", {"dataelement_name": "displayname", "dataelement_shortname": "shortname"}, max_length={"shortname": 5}),
            StarDimension(
                units, "organisationUnits", SnapshotTable(spark, f"{root}/units"), _UNIT, "orgunit",
                {"orgunit_name": "displayname", "orgunit_parent_id": "parent_id", "orgunit_parent_name": "parent_displayname"},
            ),
        ],
        watermark="period",
        checks=[{"type": "row_count_min", "threshold": 1}, {"type": "null_check", "columns": ["dataelement", "period"]}],
        values={"value": F.col("value").cast("double")},
    )
    lines = table(spark, sf_dir, "lineitem")
    headers = F.array(*[F.struct(F.lit(n).alias("name")) for n in star.columns])
    again = F.year("l_shipdate") == 1997
    for run, rows, more in (("run-1", lines, 0), ("run-2", lines.filter(again), 1)):
        cells = [F.col("l_partkey"), F.date_format("l_shipdate", "yyyyMM"), F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity") + more]
        one = F.array(*[c.cast("string") for c in cells])
        documents = rows.select(F.struct(headers.alias("headers"), F.array(one).alias("rows")).alias("doc"))
        layers.land_documents(documents, "doc", f"{root}/raw/{run}")
        landed = files.read_json(spark, f"{root}/raw/{run}", documents.schema["doc"].dataType)
        load_star(star, landed, batch.Run("dhis", run, "2024-06-15T10:30:00", "liberia"))
    return view(star).select(
        "dataelement", "dataelement_name", "dataelement_shortname", "orgunit", "orgunit_name", "orgunit_parent_id", "orgunit_parent_name",
        "period", "categoryoptioncombo", "attributeoptioncombo", "value",
    )
