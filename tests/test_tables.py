import logging

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidecall.operators import layout, lookup
from tidecall.schema import contact_schema
from tidecall.session import scratch_dir, scratch_path, skew_splitting
from tidecall.sources import scans
from tidecall.sources.paths import DatasetPaths
from tidecall.sources.tables import TableStore


@pytest.fixture
def tables(spark):
    import uuid

    made = TableStore(spark, f"t_{uuid.uuid4().hex[:10]}", scratch_path(spark, "schema"))
    made.ensure_schema()
    return made


def test_scratch_is_the_configured_folder(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_missing_table_lists_the_others(spark, tables):
    tables.save(spark.range(3), "here")
    with pytest.raises(ValueError, match="here"):
        tables.load("absent")
    assert tables.exists("here") and not tables.exists("absent")
    assert tables.list() == ["here"]
    assert TableStore(spark, "no_such_schema").list() == []


def test_modes(spark, tables):
    tables.save(spark.range(3), "t")
    tables.save(spark.range(2), "t", mode="append")
    assert tables.load("t").count() == 5
    tables.save(spark.range(9), "t", mode="ignore")
    assert tables.load("t").count() == 5
    with pytest.raises(AnalysisException):
        tables.save(spark.range(1), "t", mode="error")
    tables.save(spark.range(4).selectExpr("id", "id % 2 as part"), "t", partition_by=["part"])
    assert tables.load("t").columns == ["id", "part"]
    assert rows(tables.history("t").select("version", "num_rows")) == [(3, 4), (2, 2), (1, 3)]
    assert rows(tables.history("t", 1).select("version")) == [(3,)]
    assert tables.version("t") == "3" and tables.version("other") == "0"


def test_overwrite_with_its_own_rows(spark, tables):
    tables.save(spark.range(10), "t")
    tables.save(tables.load("t").where("id > 6").selectExpr("id", "id * 2 as twice"), "t")
    assert sorted(rows(tables.load("t"))) == [(7, 14), (8, 16), (9, 18)]
    assert tables.history("t", 1).first().num_rows == 3


def test_combine_splits_hot_keys_in_the_whole_chain(spark, tables):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    }
    hot = "case when id % 3 = 0 then -1 else id end as k"
    tables.save(spark.range(60000).repartition(8).selectExpr(hot, "id", "uuid() as text"), "base")
    for name in ("a", "b"):
        tables.save(spark.range(-1, 60000).selectExpr("id as k", f"id * 2 as {name}"), name)
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = lookup.combine([tables.load(n) for n in ("base", "a", "b")], "k")
        with skew_splitting(spark):
            result = joined.agg(F.count("a"), F.count("b"), F.max("text"))
            got = result.collect()[0]
        plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert (got[0], got[1]) == (60000, 60000)
        assert plan.count("SortMergeJoin(skew=true)") == 2
        assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "false"
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert tables.combine("out", ["base", "a", "b"], "k").count() == 60000


def test_bucketed_tables_combine_without_a_shuffle(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("a", "b", "c"):
            tables.save(spark.range(1000).selectExpr("id", f"id * 2 as {name}"), name, bucket_by=(4, ["id"]))
        joined = lookup.combine([tables.load(n) for n in ("a", "b", "c")], "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_drop(spark, tables):
    tables.drop("nothing")
    with pytest.raises(AnalysisException):
        tables.drop("nothing", if_exists=False)
    tables.save(spark.range(1), "t")
    tables.drop("t", if_exists=False)
    assert not tables.exists("t")


def test_publish_checks_the_key(spark, tables):
    tables.publish_features(spark.range(5), "f", ["id"], "it's a table")
    with pytest.raises(ValueError, match="primary key"):
        tables.publish_features(spark.range(5).selectExpr("id % 2 as id"), "f", ["id"])
    assert tables.load("f").count() == 5


def test_clone(spark, tables):
    tables.save(spark.range(5), "a")
    tables.clone("a", "deep")
    tables.clone("a", "view", shallow=True)
    tables.save(spark.range(2), "a", mode="append")
    assert tables.load("deep").count() == 5
    assert tables.load("view").count() == 7
    with pytest.raises(ValueError):
        tables.clone("absent", "x")
    with pytest.raises(AnalysisException):
        tables.clone("a", "deep")


def test_optimize_keeps_rows_and_reduces_files(spark, tables, caplog):
    df = spark.range(2000).selectExpr("id", "id * 37 % 101 as a", "cast(id * 13 % 17 as string) as b")
    tables.save(df.repartition(16), "t")
    before = tables.metadata("t").first()
    tables.optimize("t", ["a", "b", "nope"], files=4)
    after = tables.metadata("t").first()
    assert before.num_files == 16 and after.num_files <= 4
    assert before.num_rows == after.num_rows == 2000
    assert sorted(rows(tables.load("t"))) == sorted(rows(df))
    assert tables.history("t", 1).first().operation == "OPTIMIZE"
    with caplog.at_level(logging.WARNING):
        tables.optimize("absent")
    assert "absent" in caplog.text


def test_files_are_narrow_in_the_first_column(spark):
    df = spark.range(4096).selectExpr("id", "id * 1103515245 % 4096 as a", "id * 69069 % 4096 as b")
    path = scratch_path(spark, "z")
    layout.cluster(df, ["a", "b"], files=16).write.parquet(path)
    spans = spark.read.parquet(path).selectExpr("*", "_metadata.file_path as f").groupBy("f").agg(
        {"a": "max", "b": "max", "id": "count"}
    )
    widths = (
        spark.read.parquet(path)
        .selectExpr("*", "_metadata.file_path as f")
        .groupBy("f")
        .agg({"a": "min"})
        .join(spans, "f")
        .selectExpr("`max(a)` - `min(a)`")
    )
    average = sum(r[0] for r in widths.collect()) / 16
    assert average < 2048


def test_optimize_keeps_partitions_buckets_and_comment(spark, tables):
    df = spark.range(200).selectExpr("id", "id % 3 as p", "id % 7 as b")
    tables.save(df, "t", partition_by=["p"], bucket_by=(4, ["b"]))
    spark.sql(f"COMMENT ON TABLE {tables.full_name('t')} IS 'it''s kept'")
    tables.optimize("t", ["id"])
    columns = {c.name: (c.isPartition, c.isBucket) for c in spark.catalog.listColumns(tables.full_name("t"))}
    assert columns == {"id": (False, False), "p": (True, False), "b": (False, True)}
    assert "kept" in spark.catalog.getTable(tables.full_name("t")).description
    assert tables._buckets("t") == (4, ["b"])
    assert tables.load("t").count() == 200 and tables.history("t", 1).first().operation == "OPTIMIZE"


def test_a_failed_swap_gives_the_table_back(spark, tables, monkeypatch, caplog):
    tables.save(spark.range(5), "t")
    real = tables._rename
    monkeypatch.setattr(tables, "_rename", lambda a, b: 1 / 0 if a == "t__new" else real(a, b))
    with caplog.at_level(logging.ERROR):
        tables.optimize("t")
    assert "failed" in caplog.text and tables.list() == ["t"] and tables.load("t").count() == 5


def test_views_are_dropped_and_not_optimized(spark, tables):
    tables.save(spark.range(5), "t")
    tables.clone("t", "v", shallow=True)
    tables.optimize("v")
    assert tables.list() == ["t", "v"]
    tables.drop("v")
    assert tables.list() == ["t"]


def test_combine_leaves_out_a_source_without_the_column(spark, tables, caplog):
    tables.save(spark.range(3).withColumnRenamed("id", "k"), "a")
    tables.save(spark.range(3), "b")
    with caplog.at_level(logging.WARNING):
        assert tables.combine("c", ["a", "b", "absent"], "k").count() == 3
    assert "left out b" in caplog.text and "left out absent" in caplog.text


def test_text_with_a_shared_prefix_gets_different_ranges(spark):
    df = spark.range(150).selectExpr("concat('Customer#', id) as name", "id % 5 as n")
    files = layout.cluster(df, ["name", "n"], files=5).selectExpr("name", "spark_partition_id() as f")
    assert files.groupBy("f").count().count() == 5


def test_metadata(spark, tables):
    tables.save(spark.range(10).repartition(2), "t")
    row = tables.metadata("t").first()
    assert (row.num_rows, row.num_columns, row.num_files, row.format) == (10, 1, 2, "parquet")
    assert row.size_bytes > 0 and row.columns == ["id"] and row.schema == "struct<id:bigint>" and row.location


def test_guarded_and_fallback_scans(spark):
    assert scans.read_if_present(lambda: spark.read.parquet("/no/such/path"), "x") is None
    path = scratch_path(spark, "p")
    spark.range(3).write.parquet(path)
    got = scans.first_available([lambda: spark.read.parquet("/no/such"), lambda: scans.read_path(spark, path)])
    assert got.count() == 3
    with pytest.raises(RuntimeError):
        scans.first_available([lambda: spark.read.parquet("/no/such")])


def test_csv_keeps_blanks_and_nulls(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([(1, " a "), (2, None), (3, 'q"x,y')], "id long, s string")
    scans.write_csv(df, path)
    assert sorted(rows(scans.read_csv(spark, path, df.schema))) == sorted(rows(df))
    assert dict(scans.read_csv(spark, path).dtypes) == {"id": "int", "s": "string"}


def test_csv_bad_numbers_become_null(spark, tmp_path):
    file = tmp_path / "c.csv"
    header = ",".join(f.name for f in contact_schema().fields)
    file.write_text(f"{header}\n30,admin.,single,tertiary,no,n/a,no,no,cellular,1,jan,10,1,-1,0,unknown,yes\n")
    row = scans.read_csv(spark, str(file), contact_schema()).first()
    assert row.age == 30 and row.balance is None and row.Target == "yes"


def test_paths():
    paths = DatasetPaths("/data/v/")
    assert paths.path("raw") == "/data/v/raw"
    assert paths.path("processed", "train") == "/data/v/processed/train"


def test_two_writers_get_distinct_versions_without_gaps(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from tidecall.sources.commits import CommitLog

    root = str(tmp_path / "log")
    write = lambda i: CommitLog(spark, root).append("a/b t", "WRITE", i)
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(write, range(60)))
    assert sorted(got) == list(range(1, 61))
    log = CommitLog(spark, root)
    assert log.newest("a/b t") == 60 and log.newest("other") == 0
    entries = log.read("a/b t", 100).collect()
    assert sorted((r.version, r.num_rows) for r in entries) == sorted(zip(got, range(60)))
    assert {r.table_name for r in entries} == {"a/b t"} and all(r.timestamp for r in entries)


def test_a_claim_that_comes_second_is_refused(spark, tmp_path):
    from tidecall.sources.commits import CommitLog

    log = CommitLog(spark, str(tmp_path / "log"))
    assert log._claim("t", 1, "WRITE", 5) and not log._claim("t", 1, "WRITE", 6)
    assert [tuple(r) for r in log.read("t", 9).select("version", "num_rows").collect()] == [(1, 5)]
    assert log.append("t", "WRITE", 7) == 2


def test_log_reads_are_bounded(spark, tmp_path, monkeypatch):
    """The newest entries are found from two listings, whatever the length of the log."""
    from tidecall.sources import commits

    monkeypatch.setattr(commits, "PER_FOLDER", 5)
    log = commits.CommitLog(spark, str(tmp_path / "log"))
    for i in range(23):
        log.append("t", "WRITE", i)
    listed = []
    plain = log._listed
    monkeypatch.setattr(log, "_listed", lambda f: listed.append(plain(f)) or listed[-1])
    assert log.newest("t") == 23 and [len(x) for x in listed] == [5, 4]
    assert len(log.read("t", 3).inputFiles()) == 3


def test_four_copies_read_one_side_each(spark, tmp_path):
    from tidecall.session import materialize
    from tidecall.sources.paths import split_copies

    df = spark.range(50).selectExpr("id", "cast(id % 2 as int) as `Target`", "if(id % 5 = 0, 'test', 'train') as split")
    stored = materialize(df, "labelled", ["split"])
    for copy in split_copies(stored).values():
        assert "PartitionFilters: [isnotnull(split" in copy._jdf.queryExecution().executedPlan().toString()
