"""Parallelism guard for CPU-heavy row-wise stages."""

from __future__ import annotations

from pyspark.sql import DataFrame

# bytes of input files for a partition: what is cached of it stays far below a task's memory
SPREAD_BYTES = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """Even partitions before CPU-heavy row-wise work (regex cleaning, stemming, model fitting).

    Decided from the scan alone, nothing runs: a table of fewer files than
    cores may be a handful of scan tasks, so it gets a ``rebalance`` hint and
    adaptive execution deals it out; a small table of many files, or rows that
    are not read from files, pass through untouched.  Adaptive execution makes
    about one partition a core, and a scan splits of 128 MB, however large the
    table, so beyond ``SPREAD_BYTES`` a core the partitions grow in number, not in size.
    """
    files = df.inputFiles()
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = -(-sum(_length(df, f) for f in files) // SPREAD_BYTES)
    if parts > cores:
        return df.repartition(parts)
    return df.hint("rebalance") if 0 < len(files) < cores else df


def _length(df: DataFrame, file: str) -> int:
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.sparkSession._jvm.java.net.URI(file))
    return path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
