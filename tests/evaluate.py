"""Evaluate single column expressions."""


def one(spark, expr, value, ddl="x string"):
    """Evaluate a column expression over a one-row frame."""
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]
