"""Helpers of the tests in this folder."""


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def as_set(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}
