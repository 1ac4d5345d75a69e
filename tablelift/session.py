"""Session settings this library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The JVM compiles no method above 8000 bytes of byte code (fixed value). Hash and
# mapping projections over wide tables exceed that when fused into one method;
# with this limit Spark splits them into small methods instead.
COMPILED_METHOD_BYTES = "8000"


def tune(spark: SparkSession) -> SparkSession:
    """Keep generated code small enough for the JVM to compile."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_METHOD_BYTES)
    return spark
