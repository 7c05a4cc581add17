"""Session settings that the jobs rely on."""

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    # AQE coalesces small shuffle partitions and splits hot ones in joins and
    # rebalanced writes, so no key needs to be salted by hand.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark, with a checkpoint
    folder of its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hirelake")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='hirelake-')}")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
