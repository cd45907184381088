"""Layer writes and keyed table loads, read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.operators.joins import Dimension, new_columns, star_join, without_matches
from tierline.plans.load import load
from tierline.sinks import layers
from tierline.sinks.distributed import DistributedTable
from tierline.sinks.tables import Rejected, SnapshotTable, load_dimension, misfits
from tierline.sources import files
from tierline.sources.envelopes import dimension_records
from tierline.suite.registry import query, table
from tierline.workspace import new_dir


def _target(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")


def _staging(spark, sf_dir):
    """Every order under twice its key: about half of them replace a target row."""
    return table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") * 2).alias("o_orderkey"),
        F.col("o_totalprice").alias("o_totalprice"),
        F.lit("S").alias("o_orderstatus"),
    )


_KEPT = "NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderkey * 2 = t.o_orderkey)"
_STAGING_SQL = "SELECT o_orderkey * 2 AS o_orderkey, o_totalprice, 'S' AS o_orderstatus FROM orders"


@query(
    "JOIN2",
    f"SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders t WHERE {_KEPT}",
)
def delete_matching(spark, sf_dir):
    return without_matches(_target(spark, sf_dir), _staging(spark, sf_dir), ["o_orderkey"])


@query(
    "SNK5 JOIN2 SET1",
    f"SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders t WHERE {_KEPT} UNION ALL {_STAGING_SQL}",
)
def merge_upsert(spark, sf_dir):
    orders = SnapshotTable(spark, new_dir(spark, "orders"))
    orders.load(_target(spark, sf_dir), "replace")
    orders.load(_staging(spark, sf_dir), "merge", ["o_orderkey"])
    return orders.read()


@query(
    "SNK5 SNK9 JOIN2",
    """SELECT strftime(o_orderdate, '%Y%m') AS period, o_orderkey, o_totalprice, o_orderstatus FROM orders
    WHERE year(o_orderdate) <> 1997
    UNION ALL SELECT strftime(o_orderdate, '%Y%m'), o_orderkey, o_totalprice + 1, 'S' FROM orders
    WHERE year(o_orderdate) = 1997""",
)
def merge_by_period(spark, sf_dir):
    """A year comes again; only the months of that year are rewritten."""
    orders = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("period"), "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate"
    )
    facts = orders.drop("o_orderdate")
    again = orders.filter(F.year("o_orderdate") == 1997).select(
        "period", "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit("S").alias("o_orderstatus")
    )
    by_period = SnapshotTable(spark, new_dir(spark, "orders-by-period"), partition_by=["period"])
    by_period.merge(facts, ["period", "o_orderkey"])
    by_period.merge(again, ["period", "o_orderkey"])
    return by_period.read()


@query(
    "SNK5 SNK8",
    """SELECT strftime(o_orderdate, '%Y%m') AS period, o_orderkey,
    o_totalprice + CASE WHEN o_orderkey % 4 = 0 THEN 2 WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS o_totalprice,
    CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 4 <> 0 THEN o_orderpriority END AS priority FROM orders""",
)
def merge_growth_by_period(spark, sf_dir):
    """A column arrives with the second batch; the third, without it, leaves the values of other rows."""
    orders = table(spark, sf_dir, "orders")
    period, price = F.date_format("o_orderdate", "yyyyMM").alias("period"), F.col("o_totalprice")
    facts = SnapshotTable(spark, new_dir(spark, "growing"), partition_by=["period"])
    facts.merge(orders.select(period, "o_orderkey", "o_totalprice"), ["period", "o_orderkey"])
    second = orders.filter("o_orderkey % 2 = 0").select(period, "o_orderkey", (price + 1).alias("o_totalprice"), F.col("o_orderpriority").alias("priority"))
    facts.merge(second, ["period", "o_orderkey"])
    third = orders.filter("o_orderkey % 4 = 0").select(period, "o_orderkey", (price + 2).alias("o_totalprice"))
    facts.merge(third, ["period", "o_orderkey"])
    return facts.read()


@query(
    "SNK5",
    """SELECT CASE WHEN l_linenumber <> 3 THEN l_shipdate END AS day, l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 2 THEN l_quantity + 1 ELSE l_quantity END AS quantity FROM lineitem
    UNION ALL SELECT NULL, l_orderkey, l_linenumber, l_quantity + 1 FROM lineitem WHERE l_linenumber = 3""",
)
def merge_null_period(spark, sf_dir):
    """A partition per day, thousands of them, and one of rows without a day, which match nothing and stay."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 3, F.col("l_shipdate")).alias("day"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity")
    )
    facts = SnapshotTable(spark, new_dir(spark, "days"), partition_by=["day"])
    facts.merge(lines, ["day", "l_orderkey", "l_linenumber"])
    facts.merge(lines.filter("l_linenumber in (2, 3)").withColumn("quantity", F.col("quantity") + 1), ["day", "l_orderkey", "l_linenumber"])
    return facts.read()


@query(
    "SNK5",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def merge_few_keys(spark, sf_dir):
    """Few keys change; only their buckets are rewritten."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    facts = SnapshotTable(spark, new_dir(spark, "bucketed"), bucket_by=["o_orderkey"], buckets=16)
    facts.merge(orders, ["o_orderkey"])
    facts.merge(orders.filter("o_orderkey % 1000 = 1").withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey"])
    return facts.read()


@query(
    "SNK4 SNK8",
    """SELECT 'key' AS "column", count(*) FILTER (WHERE o_orderkey * 1000000 > 2147483647) AS lost FROM orders
    UNION ALL SELECT 'status', count(*) FROM orders WHERE o_orderstatus <> 'F'""",
)
def append_misfit_counts(spark, sf_dir):
    """What a lossy append would null, counted per column before it is done."""
    orders = table(spark, sf_dir, "orders")
    key = (F.col("o_orderkey") * 1_000_000).alias("key")
    status = F.when(F.col("o_orderstatus") == "F", "1").otherwise(F.col("o_orderstatus")).alias("status")
    facts = SnapshotTable(spark, new_dir(spark, "misfits"))
    facts.append(spark.createDataFrame([], "key int, status int"))
    batch = orders.select(key, status)
    lost = misfits(batch, facts.schema())
    facts.append(batch, lossy=True)
    return lost


@query("SNK4 SNK8", f"SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders UNION ALL {_STAGING_SQL}")
def append_aligned(spark, sf_dir):
    """The appended columns come in another order; they are matched by name."""
    orders = SnapshotTable(spark, new_dir(spark, "orders"))
    orders.append(_target(spark, sf_dir))
    orders.append(_staging(spark, sf_dir).select("o_orderstatus", "o_orderkey", "o_totalprice"))
    return orders.read()


@query("SNK3", _STAGING_SQL)
def replace_table(spark, sf_dir):
    orders = SnapshotTable(spark, new_dir(spark, "orders"))
    orders.replace(_target(spark, sf_dir))
    orders.replace(_staging(spark, sf_dir))
    return orders.read()


@query(
    "SNK7 SNK8 SNK5 JOIN5",
    f"""SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(NULL AS VARCHAR) AS channel FROM orders t WHERE {_KEPT}
    UNION ALL SELECT o_orderkey * 2, o_totalprice, NULL, 'phone' FROM orders""",
)
def schema_growth(spark, sf_dir):
    """Staging brings a new column, lacks one, and has one in another type."""
    orders = SnapshotTable(spark, new_dir(spark, "orders"))
    orders.load(_target(spark, sf_dir), "append")
    staging = _staging(spark, sf_dir).select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("O_TotalPrice"), F.lit("phone").alias("channel")
    )
    assert [f.name for f in new_columns(staging.schema, orders.schema())] == ["channel"]
    orders.load(staging, "merge", ["o_orderkey"])
    return orders.read()


UNIT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("displayname", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("path", T.StringType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("parent_displayname", T.StringType()),
    ]
)


@query(
    "SNK6 SNK3 SRC12 PRJ18",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, left(c_name, 12) AS displayname, CAST(c_custkey % 5 AS INTEGER) AS level,
    CAST(NULL AS VARCHAR) AS path, CAST(n_nationkey AS VARCHAR) AS parent_id, n_name AS parent_displayname
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def dimension_load(spark, sf_dir):
    """Nested unit records out of their envelope, into a table of declared columns."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    record = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("displayName"),
        (F.col("c_custkey") % 5).cast("string").alias("level"),
        F.col("c_mktsegment").alias("unknownColumn"),
        F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("displayName")).alias("parent"),
    )
    docs = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        F.array(record).alias("organisationUnits")
    )
    units = SnapshotTable(spark, new_dir(spark, "units"))
    load_dimension(units, dimension_records(docs, "organisationUnits"), UNIT_SCHEMA, {"displayname": 12})
    return units.read()


@query(
    "SNK9 SNK5 JOIN2",
    f"SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders t WHERE {_KEPT} UNION ALL {_STAGING_SQL}",
)
def merge_colocated(spark, sf_dir):
    """A merge in which the rows of the table stay in their buckets."""
    orders = DistributedTable(spark, new_dir(spark, "orders-by-key"), ["o_orderkey"], 16)
    orders.replace(_target(spark, sf_dir))
    orders.merge(_staging(spark, sf_dir))
    return orders.read()


@query(
    "SNK9 JOIN1",
    """SELECT l_orderkey, l_linenumber, l_quantity, o_orderstatus, o_totalprice, p_brand, s_name FROM lineitem
    LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 5 <> 0
    LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey""",
)
def star_colocated(spark, sf_dir):
    """Lines and orders distributed by the order key: the large dimension is joined bucket by bucket, small ones are sent."""
    lines = DistributedTable(spark, new_dir(spark, "lines-by-order"), ["l_orderkey"], 16, ["l_shipdate"])
    lines.replace(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey", "l_shipdate"))
    orders = DistributedTable(spark, new_dir(spark, "orders-by-key"), ["o_orderkey"], 16)
    orders.replace(_target(spark, sf_dir).filter("o_orderkey % 5 <> 0"))
    wide = star_join(
        lines.read(),
        [
            Dimension(orders.read(), "l_orderkey", "o_orderkey", {"o_orderstatus": "o_orderstatus", "o_totalprice": "o_totalprice"}),
            Dimension(table(spark, sf_dir, "part"), "l_partkey", "p_partkey", {"p_brand": "p_brand"}),
            Dimension(table(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey", {"s_name": "s_name"}),
        ],
    )
    return wide.drop("l_partkey", "l_suppkey", "l_shipdate")


@query("DQ4 SNK5", f"SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders t WHERE {_KEPT} UNION ALL {_STAGING_SQL}")
def load_checked(spark, sf_dir):
    """A batch with nulls is not published, the same batch without them is."""
    orders = SnapshotTable(spark, new_dir(spark, "checked"), bucket_by=["o_orderkey"], buckets=8)
    checks = [{"type": "null_check", "columns": ["o_orderstatus"]}, {"type": "row_count_min", "threshold": 1}]
    load(orders, _target(spark, sf_dir), ["o_orderkey"], tag="first", batch_checks=checks)
    status = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderstatus")).alias("o_orderstatus")
    try:
        load(orders, _staging(spark, sf_dir).select("o_orderkey", "o_totalprice", status), ["o_orderkey"], tag="second", batch_checks=checks)
    except Rejected:
        load(orders, _staging(spark, sf_dir), ["o_orderkey"], tag="second", batch_checks=checks, checks=checks)
    return orders.read()


@query("SNK9", "SELECT l_shipdate, l_orderkey, l_linenumber, l_quantity FROM lineitem")
def clustered_write(spark, sf_dir):
    path = new_dir(spark, "lineitem-clustered")
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    layers.write_parquet(layers.clustered(lines, ["l_shipdate", "l_orderkey"]), path)
    return files.read_parquet(spark, path)


@query(
    "SNK1 SNK2 SRC5",
    """SELECT o_orderkey, o_totalprice, o_orderstatus AS country, CAST(year(o_orderdate) AS INTEGER) AS year
    FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) >= 1998""",
)
def layer_round_trip(spark, sf_dir):
    """One folder per run; the read lists only those it needs."""
    root = new_dir(spark, "layer")
    orders = table(spark, sf_dir, "orders")
    runs = orders.select(
        "o_orderkey",
        "o_totalprice",
        F.col("o_orderstatus").alias("country"),
        F.lit("orders").alias("pipeline"),
        F.year("o_orderdate").alias("year"),
        F.lit(1).alias("month"),
        F.lit(1).alias("day"),
        F.concat(F.lit("run-"), F.year("o_orderdate").cast("string")).alias("execution_id"),
    )
    layers.write_partitioned(runs, root)
    wanted = files.read_parquet(spark, root).filter((F.col("country") == "F") & (F.col("year") >= 1998))
    return wanted.select("o_orderkey", "o_totalprice", "country", "year")
