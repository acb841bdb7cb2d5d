"""A Spark session with the settings the reports assume."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # staged rows are deleted once no frame refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # generated methods beyond this size are never compiled by the JVM; past it Spark
    # splits a wide projection, such as that of file ingest, into small methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # stream state on disk instead of executor memory
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "wattframe", master: str | None = None, **settings: str) -> SparkSession:
    """Builds the session, or returns the running one. ``settings`` add to or override the above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
