"""Sinks: tables replaced and read back, the monthly report job, materialised intermediates."""

import os

from insights.plans import report, sinks


def test_write_table_replaces_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(10).selectExpr("id", "id % 2 AS part"), path, partition_by=["part"])
    sinks.write_table(spark.range(4).selectExpr("id", "id % 2 AS part"), path, partition_by=["part"])
    assert sorted(d for d in os.listdir(path) if d.startswith("part=")) == ["part=0", "part=1"]
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3]


def test_save_table_replaces(spark):
    for n in (5, 3):
        sinks.save_table(spark.range(n), "insights_saved")
    try:
        assert spark.table("insights_saved").count() == 3
    finally:
        spark.sql("DROP TABLE insights_saved")


def test_monthly_report_job_writes_all_tables(spark, views001, tmp_path):
    report.run_monthly_report(views001.v_sales, views001.v_product, 1997, 1, str(tmp_path))
    want = report.monthly_report(views001.v_sales, views001.v_product, 1997, 1)
    assert sorted(os.listdir(tmp_path)) == sorted(want) and len(want) == 12
    for name, df in want.items():
        assert sorted(map(str, spark.read.parquet(str(tmp_path / name)).collect())) == sorted(map(str, df.collect())), name


def test_materialize_survives_its_source_and_is_released(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(7).write.parquet(src)
    kept = sinks.materialize(spark.read.parquet(src), "kept")
    for f in os.listdir(src):
        os.remove(os.path.join(src, f))
    assert kept.count() == 7
    path = kept.inputFiles()[0].removeprefix("file://")
    sinks.release(spark)
    assert not os.path.exists(path)
