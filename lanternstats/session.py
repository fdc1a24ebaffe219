"""Session settings the jobs rely on."""

from pyspark.sql import SparkSession


def build_session(master=None, app_name="lanternstats", conf=None):
    """A session in UTC with adaptive execution; on a cluster leave ``master`` empty."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Whole files pass through Arrow when archives are unpacked.
        .config("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
        # Recording the call site of every column costs more than building the plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
