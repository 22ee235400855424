"""Session settings the operators are designed for. All are plain Spark options."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Re-plan at run time: coalesce small partitions, split skewed ones, demote joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Malformed dates and overflowing decimals fail a load instead of turning null.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the recommended settings to a session builder."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


def shuffle_partitions(input_bytes: int, cores: int, target_bytes: int = 256 << 20) -> int:
    """Shuffle partitions for an input size: about ``target_bytes`` each, in full waves."""
    wanted = max(1, -(-input_bytes // target_bytes))
    return -(-wanted // cores) * cores
