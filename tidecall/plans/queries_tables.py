"""File and table round trips, histories, clones, layout."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.operators import cleaning, splitting
from tidecall.plans.contacts import contact_table, table
from tidecall.plans.queries_cleaning import ML_READY_SQL
from tidecall.plans.registry import on_clean, on_contacts, query
from tidecall.schema import CONTACT_KEY, contact_schema
from tidecall.session import materialize, scratch_path
from tidecall.sources import scans
from tidecall.sources.paths import DatasetPaths, save_split_paths
from tidecall.sources.tables import TableStore


def store(spark) -> TableStore:
    """A schema of its own below the scratch folder."""
    made = TableStore(spark, f"tidecall_{uuid.uuid4().hex[:12]}", scratch_path(spark, "schema"))
    made.ensure_schema()
    return made


# --- files -----------------------------------------------------------------------------


@query("csv_roundtrip", on_contacts("SELECT * FROM contacts"))
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    raw = contact_table(spark, sf)
    scans.write_csv(raw, path)
    return scans.read_csv(spark, path, contact_schema(CONTACT_KEY, text_numbers=("duration",)))


@query(
    "csv_inferred",
    """SELECT n_nationkey, n_name, n_regionkey, CAST(c_custkey AS INTEGER) AS c_custkey, c_acctbal, c_mktsegment
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def csv_inferred(spark, sf):
    path = scratch_path(spark, "csv")
    joined = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    scans.write_csv(
        joined.select("n_nationkey", "n_name", "n_regionkey", "c_custkey", "c_acctbal", "c_mktsegment"), path
    )
    return scans.read_csv(spark, path)


@query("guarded_scan", "SELECT c_custkey, c_name FROM customer")
def guarded_scan(spark, sf):
    absent = scans.read_if_present(lambda: scans.read_path(spark, f"{sf}/no_such_table.parquet"), "no_such_table")
    present = scans.read_if_present(lambda: table(spark, sf, "customer"), "customer")
    return (absent or present).select("c_custkey", "c_name")


@query("fallback_scan", "SELECT * FROM orders")
def fallback_scan(spark, sf):
    tables, path = store(spark), scratch_path(spark, "fallback")
    table(spark, sf, "orders").write.parquet(path)
    return scans.first_available([lambda: tables.load("orders"), lambda: scans.read_path(spark, path)])


@query(
    "split_paths",
    on_clean(
        """
sides AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY md5(concat('42:', contact_id)))
    <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) THEN 'test' ELSE 'train' END AS side
  FROM clean
)
SELECT 'processed' AS kind, side, contact_id, duration, CAST("Target" AS VARCHAR) AS label FROM sides
UNION ALL
SELECT 'raw', side, contact_id, duration, CASE "Target" WHEN 1 THEN 'yes' ELSE 'no' END FROM sides"""
    ),
)
def split_paths(spark, sf):
    """Four stored copies, read back together."""
    cleaned = materialize(cleaning.clean(contact_table(spark, sf), keep=(CONTACT_KEY,)), "clean")
    labelled = materialize(splitting.split_exact(cleaned, CONTACT_KEY), "labelled", ["split"])
    paths = DatasetPaths(scratch_path(spark, "volume"))
    save_split_paths(labelled, paths)
    parts = [
        scans.read_path(spark, paths.path(kind, side)).select(
            F.lit(kind).alias("kind"),
            F.lit(side).alias("side"),
            CONTACT_KEY,
            "duration",
            F.col(V.LABEL_COLUMN).cast("string").alias("label"),
        )
        for kind in ("processed", "raw")
        for side in ("train", "test")
    ]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union


# --- tables ------------------------------------------------------------------------------


@query("table_roundtrip", "SELECT * FROM orders")
def table_roundtrip(spark, sf):
    tables = store(spark)
    orders = table(spark, sf, "orders")
    tables.save(orders.select("o_orderkey"), "orders")
    tables.save(orders, "orders", partition_by=["o_orderstatus"])
    return tables.load("orders")


@query(
    "table_listing",
    "SELECT unnest(['customer', 'orders']) AS table_name, (SELECT count(*) FROM orders) AS n_orders",
)
def table_listing(spark, sf):
    tables = store(spark)
    for name in ("orders", "customer", "part"):
        tables.save(table(spark, sf, name), name)
    tables.drop("part", if_exists=False)
    tables.drop("part")
    names = spark.createDataFrame([(n,) for n in tables.list()], "table_name string")
    return names.withColumn("n_orders", tables.load("orders").agg(F.count("*")).scalar())


@query(
    "saved_splits",
    on_clean(
        """
sides AS (
  SELECT "Target" AS y, CASE WHEN substr(md5(concat('42:', contact_id)), 1, 8) < '33333333'
    THEN 'test' ELSE 'train' END AS side FROM clean
)
SELECT side, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, '1' AS version FROM sides GROUP BY side"""
    ),
)
def saved_splits(spark, sf):
    tables = store(spark)
    cleaned = cleaning.clean(contact_table(spark, sf), keep=(CONTACT_KEY,))
    tables.save_split(materialize(splitting.split_threshold(cleaned, CONTACT_KEY), "labelled", ["split"]))
    train, test, version = tables.load_pair()
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.groupBy("side").agg(
        F.count("*").alias("n"), F.sum(V.LABEL_COLUMN).alias("positives"), F.lit(version).alias("version")
    )


@query("ml_ready_table", ML_READY_SQL)
def ml_ready_table(spark, sf):
    tables = store(spark)
    tables.save(contact_table(spark, sf), "contacts")
    return tables.ml_ready("contacts")


@query(
    "combine_tables",
    """
WITH o AS (SELECT o_custkey AS k, count(*) AS n_orders, max(o_totalprice) AS best FROM orders GROUP BY 1),
e AS (SELECT user_id AS k, count(*) AS n_events, count(DISTINCT event_type) AS best FROM events GROUP BY 1)
SELECT c_custkey AS customer_id, c_mktsegment, n_orders, o.best AS best, n_events
FROM customer LEFT JOIN o ON o.k = c_custkey LEFT JOIN e ON e.k = c_custkey""",
)
def combine_tables(spark, sf):
    tables = store(spark)
    tables.save(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), "c_mktsegment"), "base"
    )
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("customer_id"))
    tables.save(orders.agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("best")), "by_orders")
    events = table(spark, sf, "events").groupBy(F.col("user_id").alias("customer_id"))
    tables.save(events.agg(F.count("*").alias("n_events"), F.countDistinct("event_type").alias("best")), "by_events")
    return tables.combine("combined", ["base", "not_there", "by_orders", "by_events"], "customer_id")


@query(
    "publish_features",
    "SELECT o_custkey AS customer_id, count(*) AS n_orders, max(o_totalprice) AS largest FROM orders GROUP BY 1",
)
def publish_features(spark, sf):
    tables = store(spark)
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("customer_id"))
    features = orders.agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("largest"))
    tables.publish_features(features, "customer_orders", ["customer_id"], "Orders per customer")
    return tables.load("customer_orders")


@query(
    "load_history",
    """
SELECT CAST(2 AS BIGINT) AS version, 'WRITE' AS operation, 2 * count(*) AS num_rows FROM supplier
UNION ALL SELECT CAST(1 AS BIGINT), 'WRITE', count(*) FROM supplier""",
)
def load_history(spark, sf):
    tables = store(spark)
    suppliers = table(spark, sf, "supplier")
    tables.save(suppliers, "supplier")
    tables.save(suppliers.unionAll(suppliers), "supplier")
    return tables.history("supplier", 2).select("version", "operation", "num_rows")


@query("clone", "SELECT *, true AS in_view FROM supplier")
def clone(spark, sf):
    tables = store(spark)
    tables.save(table(spark, sf, "supplier"), "supplier")
    tables.clone("supplier", "supplier_copy")
    tables.clone("supplier", "supplier_view", shallow=True)
    view = tables.load("supplier_view").select("s_suppkey", F.lit(True).alias("in_view"))
    return tables.load("supplier_copy").join(view, "s_suppkey", "left")


@query("cluster_layout", "SELECT *, 'l_returnflag' AS partitioned_by FROM lineitem")
def cluster_layout(spark, sf):
    """A partitioned table with all its columns, clustered, and the partitioning it has then."""
    tables = store(spark)
    tables.save(table(spark, sf, "lineitem"), "lineitem", partition_by=["l_returnflag"])
    tables.optimize("lineitem", ["l_partkey", "l_shipdate", "no_such_column"])
    columns = spark.catalog.listColumns(tables.full_name("lineitem"))
    kept = ",".join(c.name for c in columns if c.isPartition)
    return tables.load("lineitem").withColumn("partitioned_by", F.lit(kept))


@query(
    "table_metadata",
    """
SELECT count(*) AS num_rows, CAST(5 AS BIGINT) AS num_columns, true AS has_files, true AS has_bytes,
  'parquet' AS format, 'struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string>'
  AS schema
FROM customer""",
)
def table_metadata(spark, sf):
    tables = store(spark)
    tables.save(table(spark, sf, "customer"), "customer")
    return tables.metadata("customer").select(
        "num_rows",
        "num_columns",
        (F.col("num_files") > 0).alias("has_files"),
        (F.col("size_bytes") > 0).alias("has_bytes"),
        "format",
        "schema",
    )
