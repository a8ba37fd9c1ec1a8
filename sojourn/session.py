"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The co-partition flag lets the nth-to-nth join on (entity, sequence) reuse the
# exchange on the entity alone. Results do not depend on it, only the shuffle count.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session somebody else created."""
    for name, value in SQL_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(app: str = "sojourn", cores: int | str = 8, memory: str = "12g") -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores if str(cores).isdigit() else 8))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.scheduler.mode", "FAIR")
    )
    for name, value in SQL_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
