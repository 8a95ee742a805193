"""Apply a Column function to a list of inputs."""


def evaluate(spark, fn, values, schema="v STRING"):
    """Apply a Column function to a list of inputs in one job; returns outputs in input order."""
    from pyspark.sql import functions as F

    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i INT, {schema}")
    out = df.select("i", fn(F.col(schema.split()[0])).alias("o")).orderBy("i").collect()
    return [r["o"] for r in out]
