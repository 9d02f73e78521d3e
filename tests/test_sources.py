import pytest

from lendlens.session import materialize, scratch, work_dir
from lendlens.sources.tables import delete, exists, nan_to_null, read_sources, write_csv


def test_csv_types_and_missing_sources(spark, tmp_path):
    app = tmp_path / "application.csv"
    app.write_text("SK_ID_CURR,TARGET,AMT_X,NAME\n1,0,2.5,a\n2,1,,b c\n")
    balance = tmp_path / "bureau_balance.csv"
    balance.write_text("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n7,-1,0\n7,-2,0\n")
    paths = {"application": str(app), "bureau_balance": str(balance), "bureau": str(tmp_path / "none.csv")}
    got = read_sources(spark, paths)
    assert set(got) == {"application", "bureau_balance"}
    assert dict(got["application"].dtypes) == {"SK_ID_CURR": "bigint", "TARGET": "int", "AMT_X": "double", "NAME": "string"}
    assert dict(got["bureau_balance"].dtypes)["STATUS"] == "string"


def test_required_source(spark):
    with pytest.raises(ValueError):
        read_sources(spark, {})


def test_parquet_reads_only_needed_columns(spark, tiny_dir):
    from lendlens.operators.rollup import rollup_numeric
    from lendlens.sources.tables import read_source

    orders = read_source(spark, f"{tiny_dir}/orders.parquet")
    plan = rollup_numeric(orders, "o_custkey", "P", ("o_orderkey",))._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert schema.startswith("struct<o_custkey:bigint,o_totalprice:double>")


def test_nan_and_csv_sink(spark, tmp_path):
    df = nan_to_null(spark.createDataFrame([(1, float("nan")), (2, 2.0)], "k int, x double"))
    assert [r["x"] for r in df.orderBy("k").collect()] == [None, 2.0]
    write_csv(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2


def test_materialized_table_has_no_lineage(spark):
    df = materialize(spark.range(10).withColumnRenamed("id", "k"))
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 10


def test_scratch_tables_end_with_their_scope(spark):
    kept = materialize(spark.range(3).selectExpr("id AS k"))
    with scratch(spark):
        outer = materialize(kept, "outer")
        with scratch(spark):
            inner = materialize(outer, "inner")
            assert inner.count() == 3
        assert outer.count() == 3 and not exists(spark, inner.inputFiles()[0])
        files = outer.inputFiles()
    assert kept.count() == 3 and not exists(spark, files[0])


def test_work_dir_is_the_configured_folder(spark):
    work_dir(spark)
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert work_dir(spark).startswith(folder) and work_dir(spark) == work_dir(spark)
    path = f"{work_dir(spark)}/some"
    spark.range(1).write.parquet(path)
    assert exists(spark, path)
    delete(spark, path)
    assert not exists(spark, path)


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master, applicationId = "yarn", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(RuntimeError):
        work_dir(Session())


def test_fingerprint_and_digest(spark, tmp_path):
    from lendlens.sources.tables import content_digest, fingerprint

    df = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "a int, b string")
    df.write.parquet(str(tmp_path / "one"))
    before = fingerprint(spark, {"one": str(tmp_path / "one"), "none": str(tmp_path / "none")})
    assert list(before) == ["one"] and before == fingerprint(spark, {"one": str(tmp_path / "one")})
    df.limit(3).write.mode("append").parquet(str(tmp_path / "one"))
    assert fingerprint(spark, {"one": str(tmp_path / "one")}) != before
    assert content_digest(df) == content_digest(df.repartition(7)) != content_digest(df.limit(49))
    assert content_digest(df.limit(0)) == (0, "0")


def test_zipped_csv_and_folders(spark, tmp_path):
    from lendlens.sources.tables import read_source

    df = spark.createDataFrame([(i, f"v{i}", i / 4) for i in range(20)], "SK_ID_CURR bigint, STATUS string, AMT_CREDIT double")
    df.write.option("header", True).option("compression", "gzip").csv(str(tmp_path / "many.csv"))
    one = next((tmp_path / "many.csv").glob("*.csv.gz"))
    for path in (tmp_path / "many.csv", one):
        again = read_source(spark, str(path))
        assert again.dtypes == df.dtypes
    assert read_source(spark, str(tmp_path / "many.csv")).exceptAll(df).count() == 0
