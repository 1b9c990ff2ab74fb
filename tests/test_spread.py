"""Partitions grow in number with a table's bytes; the encoded loan rows are written once."""

from __future__ import annotations

from tablewright.jobs import loan, model_queries
from tablewright.plans import parallel

SF = "/root/testdata/sf0.001"


def test_partitions_grow_with_the_bytes(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 20_000, 1, 1).write.parquet(path)
    rows = spark.read.parquet(path)
    small = parallel.spread(rows).rdd.getNumPartitions()
    monkeypatch.setattr(parallel, "SPREAD_BYTES", 1000)
    held = parallel.spread(rows)
    assert held.rdd.getNumPartitions() > max(small, spark.sparkContext.defaultParallelism)
    assert sorted(r["id"] for r in held.collect()) == list(range(20_000))


def test_encoded_training_rows_are_written_once(spark):
    tr, _ = model_queries._loan_vectors(spark, SF)
    plan = tr._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan and "Project" not in plan  # neither split nor encoders run again
    assert tr.schema["features"].metadata["ml_attr"]["num_attrs"] > 0 and tr.schema["label"].metadata["ml_attr"]["vals"]


def test_many_files_grow_in_partitions_too(spark, monkeypatch, tmp_path):
    path, cores = str(tmp_path / "rows"), spark.sparkContext.defaultParallelism
    spark.range(0, 20_000, 1, cores + 1).write.parquet(path)
    rows = spark.read.parquet(path)
    assert len(rows.inputFiles()) > cores and parallel.spread(rows) is rows
    monkeypatch.setattr(parallel, "SPREAD_BYTES", 1000)
    held = parallel.spread(rows)
    assert held.rdd.getNumPartitions() > 2 * cores
    assert sorted(r["id"] for r in held.collect()) == list(range(20_000))


def test_the_scored_pipeline_is_fitted_on_written_rows(spark, monkeypatch):
    seen, fit = [], loan.pipeline_model

    def watched(train, *params):
        seen.append(train._jdf.queryExecution().executedPlan().toString())
        return fit(train, *params)

    monkeypatch.setattr(loan, "pipeline_model", watched)
    loan.scores(spark, SF, n_estimators=1, max_depth=1)
    assert len(seen) == 1 and "md5" not in seen[0] and "FileScan" not in seen[0]
