from pyspark.sql import DataFrame, SparkSession


def frame(spark: SparkSession, schema: str, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def tuples(df: DataFrame, *columns: str) -> list[tuple]:
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
