"""Small helpers for tests."""

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
