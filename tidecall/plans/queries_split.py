"""Splits, samples, feature tables and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecall import fixed_values as V
from tidecall.operators import changes, features, lookup, splitting
from tidecall.plans.contacts import contact_table, table
from tidecall.plans.jobs import build_training_set, load_split, prepare_and_save, publish_feature_tables
from tidecall.plans.queries_cleaning import rounded_cycle
from tidecall.plans.queries_tables import store
from tidecall.plans.registry import CLEAN, FEATURES, on_contacts, on_features, query
from tidecall.schema import CONTACT_KEY, contact_schema
from tidecall.session import materialize, scratch_path
from tidecall.sources import scans
from tidecall.sources.paths import DatasetPaths

# --- splits ----------------------------------------------------------------------------


@query(
    "split_exact",
    """
SELECT o_orderkey,
  CASE WHEN row_number() OVER (ORDER BY md5(concat('42:', o_orderkey)))
    <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM orders""",
)
def split_exact(spark, sf):
    return splitting.split_exact(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "split_stratified",
    on_contacts(
        """
sizes AS (SELECT "Target" AS y, count(*) AS n FROM contacts GROUP BY 1),
shares AS (
  SELECT y, n, ceil(CAST(0.2 AS DOUBLE) * sum(n) OVER ()) AS test,
    ceil(CAST(0.2 AS DOUBLE) * sum(n) OVER ()) * n / sum(n) OVER () AS share
  FROM sizes
),
quota AS (
  SELECT y, floor(share) + CASE WHEN row_number() OVER (ORDER BY round(share - floor(share), 9) DESC, n DESC, y)
    <= test - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS k
  FROM shares
)
SELECT contact_id, "Target",
  CASE WHEN row_number() OVER (PARTITION BY "Target" ORDER BY md5(concat('42:', contact_id))) <= k
    THEN 'test' ELSE 'train' END AS split
FROM contacts JOIN quota ON y = "Target" """
    ),
)
def split_stratified(spark, sf):
    labelled = materialize(contact_table(spark, sf, "Target"), "labels")
    return splitting.split_exact(labelled, CONTACT_KEY, strata=["Target"])


@query(
    "split_threshold",
    """
SELECT event_id, event_type,
  CASE WHEN substr(md5(concat('42:', event_id)), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split
FROM events""",
)
def split_threshold(spark, sf):
    return splitting.split_threshold(table(spark, sf, "events").select("event_id", "event_type"), "event_id")


@query(
    "split_sizes",
    """
SELECT CAST(count(*) - ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS train_rows,
  CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS test_rows,
  count(*) AS union_rows, count(*) AS input_rows
FROM lineitem""",
)
def split_sizes(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return splitting.split_report(lines, splitting.split_exact(lines, key))


@query(
    "sample_n",
    """
SELECT o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (ORDER BY md5(concat('42:sample:', o_orderkey))) AS r, count(*) OVER () AS n FROM orders
) WHERE r <= least(1000, floor(n * CAST(0.1 AS DOUBLE)))""",
)
def sample_n(spark, sf):
    return splitting.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


@query(
    "split_complement",
    """
SELECT c_custkey, c_mktsegment FROM customer
WHERE NOT substr(md5(concat('42:sample:', c_custkey)), 1, 8) < 'cccccccc'""",
)
def split_complement(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    train = splitting.sample_fraction(customers, "c_custkey")
    return splitting.complement(customers, train.select("c_custkey"), "c_custkey")


# --- feature tables ----------------------------------------------------------------------

CUSTOMER_ID_SQL = """md5(concat_ws(chr(31), coalesce(CAST(age AS VARCHAR), chr(30)), coalesce(job, chr(30)),
    coalesce(marital, chr(30)), coalesce(education, chr(30)), coalesce(CAST(balance AS VARCHAR), chr(30))))"""


@query(
    "customer_features",
    on_features(
        f"""
SELECT DISTINCT age, job, marital, education, balance, job_category, education_level, balance_positive,
  age_group, {CUSTOMER_ID_SQL} AS customer_id
FROM feat"""
    ),
)
def customer_features(spark, sf):
    built = features.customer_features(contact_table(spark, sf, *V.CUSTOMER_KEY))
    return lookup.surrogate_key(built, V.CUSTOMER_KEY, "customer_id")


@query(
    "campaign_features",
    on_features(
        """
SELECT DISTINCT contact, month, duration, campaign, previous, month_number,
  round(month_sin, 9) + 0.0 AS month_sin, round(month_cos, 9) + 0.0 AS month_cos, campaign_intensity,
  has_previous,
  md5(concat_ws(chr(31), coalesce(contact, chr(30)), coalesce(month, chr(30)), coalesce(duration, chr(30)),
    coalesce(CAST(campaign AS VARCHAR), chr(30)), coalesce(CAST(previous AS VARCHAR), chr(30)))) AS campaign_id
FROM feat"""
    ),
)
def campaign_features(spark, sf):
    built = features.campaign_features(contact_table(spark, sf, *V.CAMPAIGN_KEY))
    return rounded_cycle(lookup.surrogate_key(built, V.CAMPAIGN_KEY, "campaign_id"))


@query(
    "feature_key_check",
    on_features(
        """
SELECT age, job, marital, education, balance, count(*) AS rows FROM (
  SELECT DISTINCT age, job, marital, education, balance, contact FROM feat
) GROUP BY ALL HAVING count(*) > 1"""
    ),
)
def feature_key_check(spark, sf):
    raw = contact_table(spark, sf, *V.CUSTOMER_KEY, "contact")
    not_a_key = features.normalize_text(raw).drop(CONTACT_KEY).distinct()
    return lookup.key_violations(not_a_key, V.CUSTOMER_KEY)


@query(
    "surrogate_id",
    on_contacts(f"SELECT contact_id, {CUSTOMER_ID_SQL} AS customer_id FROM contacts"),
)
def surrogate_id(spark, sf):
    keyed = lookup.surrogate_key(contact_table(spark, sf, *V.CUSTOMER_KEY), V.CUSTOMER_KEY, "customer_id")
    return keyed.select(CONTACT_KEY, "customer_id")


@query(
    "surrogate_id_hash64",
    on_contacts(
        """
SELECT contact_id, count(*) OVER (PARTITION BY age, job, marital, education, balance) AS sharing FROM contacts"""
    ),
)
def surrogate_id_hash64(spark, sf):
    """How many contacts share each id: as many as share the key. The ids are Spark's own hashes."""
    contacts = materialize(contact_table(spark, sf, *V.CUSTOMER_KEY), "contacts")
    keyed = lookup.surrogate_key(contacts, V.CUSTOMER_KEY, "customer_id", "xxhash64")
    sizes = keyed.groupBy("customer_id").agg(F.count("*").alias("sharing"))
    return keyed.join(sizes, "customer_id").select(CONTACT_KEY, "sharing")


@query(
    "dense_id",
    on_contacts("SELECT contact_id, age, row_number() OVER (ORDER BY age, contact_id) AS customer_id FROM contacts"),
)
def dense_id(spark, sf):
    return lookup.dense_id(contact_table(spark, sf, "age"), ["age", CONTACT_KEY], "customer_id")


@query("arbitrary_id_is_unique", "SELECT count(*) AS n_rows, count(*) AS n_ids FROM lineitem")
def arbitrary_id_is_unique(spark, sf):
    ids = lookup.arbitrary_id(table(spark, sf, "lineitem"), "id")
    return ids.groupBy("id").agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_ids")
    )


def _with_lookups(spark, sf):
    """Normalised contacts, written once, and lookups in the feature tables published from them."""
    contacts = materialize(features.normalize_text(contact_table(spark, sf)), "contacts")
    tables = store(spark)
    tables.ensure_schema()
    return contacts, publish_feature_tables(contacts, tables)


LOOKED_UP = """job_category, education_level, balance_positive, age_group, round(month_sin, 9) + 0.0 AS month_sin,
  round(month_cos, 9) + 0.0 AS month_cos, campaign_intensity, has_previous"""
INPUTS = """age, balance, day, duration, campaign, pdays, previous, job, marital, education, "default", housing,
  loan, contact, month, poutcome"""


@query(
    "training_set",
    on_features(
        f"""SELECT contact_id, {INPUTS}, CASE WHEN "Target" = 'yes' THEN 1 ELSE 0 END AS "Target", {LOOKED_UP}
FROM feat"""
    ),
)
def training_set(spark, sf):
    contacts, lookups = _with_lookups(spark, sf)
    return rounded_cycle(lookup.training_set(contacts, lookups, keep=(CONTACT_KEY,)))


@query("scoring_set", on_features(f"SELECT contact_id, {INPUTS}, {LOOKED_UP} FROM feat"))
def scoring_set(spark, sf):
    contacts, lookups = _with_lookups(spark, sf)
    return rounded_cycle(lookup.scoring_set(contacts, lookups, keep=(CONTACT_KEY,)))


PREPARED = (
    CLEAN
    + """,
train AS (
  SELECT * EXCLUDE (place, n) FROM (
    SELECT *, row_number() OVER (ORDER BY md5(concat('42:', contact_id))) AS place, count(*) OVER () AS n FROM clean
  ) WHERE place > ceil(CAST(0.2 AS DOUBLE) * n)
),"""
    + FEATURES.replace("FROM contacts", "FROM train")
)


@query(
    "prepared_training_set",
    on_contacts(
        f"""{PREPARED}
SELECT contact_id, {INPUTS}, "Target", {LOOKED_UP}, '1' AS version FROM feat"""
    ),
)
def prepared_training_set(spark, sf):
    """From a file to the training set: guarded scan, cleaning, split, stored tables and paths, published features."""
    source = scratch_path(spark, "contacts-csv")
    raw = contact_table(spark, sf)
    scans.write_csv(raw, source)
    tables, paths = store(spark), DatasetPaths(scratch_path(spark, "volume"))
    prepare_and_save(lambda: scans.read_csv(spark, source, contact_schema(CONTACT_KEY, ("duration",))), [CONTACT_KEY], paths, tables)
    train, _, version = load_split(spark, tables, paths)
    found = build_training_set(train, publish_feature_tables(train, tables), (CONTACT_KEY,))
    return rounded_cycle(found).withColumn("version", F.lit(version))


# --- changes between snapshots -------------------------------------------------------------


@query(
    "snapshot_diff",
    """
WITH before AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT'
),
after AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderstatus = 'P' AND o_totalprice > 250000 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
    o_totalprice
  FROM orders WHERE o_orderpriority <> '5-LOW'
),
pairs AS (
  SELECT b.o_orderkey AS k0, b.o_custkey AS c0, b.o_orderstatus AS s0, b.o_totalprice AS p0,
    a.o_orderkey AS k1, a.o_custkey AS c1, a.o_orderstatus AS s1, a.o_totalprice AS p1
  FROM before b FULL JOIN after a ON b.o_orderkey = a.o_orderkey
)
SELECT 'delete' AS _change_type, k0 AS o_orderkey, c0 AS o_custkey, s0 AS o_orderstatus, p0 AS o_totalprice
FROM pairs WHERE k1 IS NULL
UNION ALL SELECT 'insert', k1, c1, s1, p1 FROM pairs WHERE k0 IS NULL
UNION ALL SELECT 'update_preimage', k0, c0, s0, p0 FROM pairs WHERE k0 = k1 AND s0 IS DISTINCT FROM s1
UNION ALL SELECT 'update_postimage', k1, c1, s1, p1 FROM pairs WHERE k0 = k1 AND s0 IS DISTINCT FROM s1""",
)
def snapshot_diff(spark, sf):
    orders = table(spark, sf, "orders")
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    before = orders.where("o_orderpriority <> '1-URGENT'").select(*cols)
    settled = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 250000)
    after = (
        orders.where("o_orderpriority <> '5-LOW'")
        .withColumn("o_orderstatus", F.when(settled, "F").otherwise(F.col("o_orderstatus")))
        .select(*cols)
    )
    return changes.snapshot_diff(before, after, ["o_orderkey"])
