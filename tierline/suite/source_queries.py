"""File scans and response documents, over files landed from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.operators.joins import Dimension, concat, star_join
from tierline.sinks import layers, ledger
from tierline.sources import arrays, envelopes, files
from tierline.suite.registry import query, table
from tierline.workspace import new_dir


@query("SRC1 SNK13", "SELECT event_id, user_id, event_type, value FROM events")
def json_scan(spark, sf_dir):
    """Array documents, one per line, give a row per element."""
    path = new_dir(spark, "events-json")
    record = F.struct("event_id", "user_id", "event_type", "value")
    layers.land_documents(table(spark, sf_dir, "events").select(F.array(record).alias("doc")), "doc", path)
    return files.read_json(spark, path, "event_id long, user_id long, event_type string, value double")


@query("SNK13", "SELECT doc_id, text, lang, CASE WHEN n_chars > 1000 THEN source END AS source FROM documents")
def json_landing(spark, sf_dir):
    path = new_dir(spark, "documents-json")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", F.when(F.col("n_chars") > 1000, F.col("source")).alias("source")
    )
    layers.land_json(docs, path)
    return files.read_json(spark, path, docs.schema)


@query("SRC1 SNK13", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def json_array_split(spark, sf_dir):
    """Documents landed as arrays, one file each, and cut by byte ranges."""
    path = new_dir(spark, "documents-arrays")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    layers.land_array(docs, path)
    return arrays.read_json_array(spark, path, docs.schema)


@query("SRC2", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def csv_scan(spark, sf_dir):
    path = new_dir(spark, "parts-csv")
    table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size").write.csv(path, header=True)
    return files.read_csv(spark, path, "p_partkey long, p_brand string, p_type string, p_size int")


_TO_CSV = {"sep": "|", "encoding": "ISO-8859-1", "header": True, "emptyValue": ""}


@query(
    "SRC3 SET1",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name,
    CASE WHEN c_nationkey = 3 THEN '' ELSE c_mktsegment END AS segment, CAST(NULL AS VARCHAR) AS nation FROM customer
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, CAST(s_nationkey AS VARCHAR) FROM supplier""",
)
def csv_pickup(spark, sf_dir):
    """Files of two layouts in one folder; every value is text."""
    folder = new_dir(spark, "drop")
    segment = F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_mktsegment"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), segment.alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    customers.write.mode("append").options(**_TO_CSV).csv(folder)
    suppliers.write.mode("append").options(**_TO_CSV).csv(folder)
    return files.pick_up_csv(spark, folder, sep="|", encoding="ISO-8859-1", mixed_headers=True)


@query(
    "SRC4 AGG12 INC3",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, true AS newer FROM customer""",
)
def csv_incremental(spark, sf_dir):
    """A second pick-up sees only the files that came after the first."""
    folder = new_dir(spark, "drop")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    suppliers.write.mode("append").csv(folder, header=True)
    first = files.pick_up_csv(spark, folder, file_columns=True)
    seen = files.newest_file_time(first).select(F.date_format("max_watermark", "yyyy-MM-dd'T'HH:mm:ss.SSS")).first()[0]
    customers.write.mode("append").csv(folder, header=True)
    second = files.pick_up_csv(spark, folder, modified_after=seen, file_columns=True)
    return second.select("key", "name", (F.col("_modified") > F.lit(seen).cast("timestamp")).alias("newer"))


def _orders_by_status(spark, sf_dir):
    root = new_dir(spark, "runs")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("execution_id"))
    layers.write_partitioned(orders, root, ["execution_id"])
    return root


@query("SRC5 SRC6", "SELECT o_orderkey, o_totalprice, o_orderstatus AS execution_id FROM orders WHERE o_orderstatus = 'P'")
def path_pruned_scan(spark, sf_dir):
    root = _orders_by_status(spark, sf_dir)
    return files.read_run(spark, root, "P")


@query("SRC6", "SELECT o_orderkey, '007' AS execution_id FROM orders WHERE o_orderstatus = 'P'")
def run_scan_numeric_ids(spark, sf_dir):
    """Ids of digits are strings: 007 is not 7."""
    root = new_dir(spark, "runs")
    run = F.when(F.col("o_orderstatus") == "P", "007").otherwise("7").alias("execution_id")
    layers.write_partitioned(table(spark, sf_dir, "orders").select("o_orderkey", run), root, ["execution_id"])
    return files.read_run(spark, root, "007")


@query("SRC3", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents")
def csv_pickup_line_breaks(spark, sf_dir):
    """Whole document texts, with their line breaks, commas and quotes."""
    root = new_dir(spark, "texts")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs.write.options(header=True, escape='"', quoteAll=True).csv(root)
    return files.pick_up_csv(spark, root)


@query("SRC6", "SELECT o_orderkey, o_totalprice, o_orderstatus AS execution_id FROM orders WHERE o_orderstatus = 'F'")
def path_prefix_scan(spark, sf_dir):
    root = _orders_by_status(spark, sf_dir)
    return files.read_below(spark, root, "execution_id=F")


@query(
    "SRC7",
    """SELECT s_suppkey AS key, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer""",
)
def schema_union_scan(spark, sf_dir):
    root = new_dir(spark, "all-runs")
    table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")).write.parquet(
        f"{root}/2024/06/15/run-1"
    )
    table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    ).write.parquet(f"{root}/2024/06/16/run-2")
    return files.read_all_runs(spark, root)


@query(
    "SRC7 SNK7",
    """SELECT s_suppkey AS key, s_name AS name, CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS DOUBLE) AS balance FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_mktsegment, NULL FROM customer UNION ALL SELECT p_partkey, NULL, p_brand, p_retailprice FROM part""",
)
def schema_union_from_ledger(spark, sf_dir):
    """Runs with columns of their own, read by the columns their ledger names; no footer is looked at for the schema."""
    root, told = new_dir(spark, "all-runs"), new_dir(spark, "ledger")
    runs = {
        "run-1": table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")),
        "run-2": table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
        ),
        "run-3": table(spark, sf_dir, "part").select(
            F.col("p_retailprice").alias("balance"), F.col("p_brand").alias("segment"), F.col("p_partkey").alias("key")
        ),
    }
    for day, (run, rows) in enumerate(runs.items()):
        rows.write.parquet(f"{root}/2024/06/{15 + day}/{run}")
        ledger.record(spark, told, run, f"2024-06-{15 + day}", rows.schema)
    return files.read_all_runs(spark, root, ledger.union_schema(ledger.entries(spark, told)))


@query(
    "SRC3 SRC4 SET1",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, 'é' || c_name AS name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS "größe" FROM customer
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name || 'ß', NULL, CAST(p_size AS VARCHAR) FROM part""",
)
def csv_pickup_encoded(spark, sf_dir):
    """Latin-1 files of two layouts, with letters of that encoding in names and values; headers are read alone."""
    folder = new_dir(spark, "drop-latin")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.concat(F.lit("é"), "c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_size").alias("größe"), F.concat("p_name", F.lit("ß")).alias("name"), F.col("p_partkey").alias("key")
    )
    customers.write.mode("append").options(**_TO_CSV).csv(folder)
    parts.write.mode("append").options(**_TO_CSV).csv(folder)
    return files.pick_up_csv(spark, folder, sep="|", encoding="latin-1", mixed_headers=True, multi_line=False)


def _landed(docs, name):
    """The documents as a later job would read them back."""
    spark = docs.sparkSession
    path = new_dir(spark, name)
    schema = docs.schema["doc"].dataType
    docs.select(F.to_json("doc").alias("value")).write.text(path)
    return files.read_json(spark, path, schema)


@query(
    "SRC8",
    """SELECT event_id, 'start' AS phase, value FROM events
    UNION ALL SELECT event_id, 'end', NULL FROM events""",
)
def envelope_explode(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    start = F.struct("event_id", F.lit("start").alias("phase"), "value")
    end = F.struct("event_id", F.lit("end").alias("phase"), F.lit(None).cast("double").alias("value"))
    docs = events.select(F.struct(F.lit(2).alias("count"), F.array(start, end).alias("results")).alias("doc"))
    return envelopes.explode_results(_landed(docs, "envelopes"))


@query("SRC9", "SELECT event_id, event_type FROM events")
def data_path(spark, sf_dir):
    items = F.array(F.struct("event_id", "event_type"))
    inner = F.struct(F.struct(items.alias("items")).alias("data"), F.lit("ok").alias("status"))
    docs = table(spark, sf_dir, "events").select(F.struct(inner.alias("response")).alias("doc"))
    return envelopes.at_path(_landed(docs, "paths"), "response.data.items")


@query(
    "SRC10",
    "SELECT CAST(event_id AS VARCHAR) AS id, event_type AS col_1, CAST(user_id AS VARCHAR) AS owner, CAST(NULL AS VARCHAR) AS absent FROM events",
)
def rows_headers_zip(spark, sf_dir):
    """Cells by header: by name, by the fall-back name, by position."""
    no_name = F.lit(None).cast("string")
    headers = F.array(
        F.struct(F.lit("id").alias("name"), no_name.alias("column")),
        F.struct(no_name.alias("name"), no_name.alias("column")),
        F.struct(no_name.alias("name"), F.lit("owner").alias("column")),
    )
    cells = F.array(*[F.col(c).cast("string") for c in ("event_id", "event_type", "user_id", "value")])
    docs = table(spark, sf_dir, "events").select(F.struct(headers.alias("headers"), F.array(cells).alias("rows")).alias("doc"))
    return envelopes.zip_rows(_landed(docs, "rows"), ["id", "col_1", "owner", "absent"])


@query(
    "SRC11 SET1",
    "SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind FROM events",
)
def container_choice(spark, sf_dir):
    """Every document is unpacked by the container it has itself."""
    kind = F.col("event_type")
    record = F.struct(F.col("event_id").cast("string").alias("id"), kind.alias("kind"))
    headers = F.array(*[F.struct(F.lit(n).alias("name")) for n in ("id", "kind")])
    cells = F.array(F.array(F.col("event_id").cast("string"), kind))
    bare = ~kind.isin("click", "view", "error")
    docs = table(spark, sf_dir, "events").select(
        F.struct(
            F.when(kind == "click", headers).alias("headers"),
            F.when(kind == "click", cells).alias("rows"),
            F.when(kind == "view", F.array(record)).alias("dataValues"),
            F.when(kind == "error", F.array(record)).alias("events"),
            F.when(bare, F.col("event_id").cast("string")).alias("id"),
            F.when(bare, kind).alias("kind"),
        ).alias("doc")
    )
    return envelopes.first_container(_landed(docs, "containers"), envelopes.TRACKER_CONTAINERS, ["id", "kind"])


@query("SRC12", "SELECT c_custkey AS id, c_name AS displayName FROM customer")
def dimension_envelope(spark, sf_dir):
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("displayName"))
    docs = table(spark, sf_dir, "customer").select(F.struct(F.array(record).alias("organisationUnits")).alias("doc"))
    return envelopes.dimension_records(_landed(docs, "dimensions"), "organisationUnits")


@query("SRC13 PRJ16", "SELECT * FROM customer")
def view_scan(spark, sf_dir):
    table(spark, sf_dir, "customer").createOrReplaceTempView("customer_view")
    return files.extract_view(spark, "customer_view")


@query(
    "JOIN1",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_name AS part_name, l_suppkey, s_name AS supplier_name,
    s_nationkey AS supplier_nation, n_name AS nation_name, r_name AS region_name, l_quantity AS value
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def star_view(spark, sf_dir):
    t = lambda name: table(spark, sf_dir, name)
    joined = star_join(
        t("lineitem"),
        [
            Dimension(t("part"), "l_partkey", "p_partkey", {"part_name": "p_name"}),
            Dimension(t("supplier"), "l_suppkey", "s_suppkey", {"supplier_name": "s_name", "supplier_nation": "s_nationkey"}),
            Dimension(t("nation"), "supplier_nation", "n_nationkey", {"nation_name": "n_name", "region_key": "n_regionkey"}),
            Dimension(t("region"), "region_key", "r_regionkey", {"region_name": "r_name"}),
        ],
    )
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "part_name",
        "l_suppkey",
        "supplier_name",
        "supplier_nation",
        "nation_name",
        "region_name",
        F.col("l_quantity").alias("value"),
    )


@query(
    "SET1",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""",
)
def concat_batches(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return concat(customers, suppliers)
