from pyspark.sql import DataFrame


def rows(df: DataFrame, *columns: str) -> set:
    df = df.select(*columns) if columns else df
    return {tuple(r) for r in df.collect()}


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().toString()
