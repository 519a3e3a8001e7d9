"""Session settings the runs are tuned for; all of them are ordinary Spark settings."""
from __future__ import annotations

SETTINGS = {
    # Joins, shuffles and skew are adapted to the sizes met at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above 8000 bytes; on wide tables smaller
    # generated methods are about twice as fast as one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Capturing the caller of every column expression takes longer than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Times are compared and shown without a local offset.
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder):
    """The session builder with `SETTINGS`."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
