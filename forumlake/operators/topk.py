from pyspark.sql import DataFrame, functions as F


def top_k(df: DataFrame, by: list[str], ties: list[str], k: int = 10) -> DataFrame:
    """The k rows with the largest `by`, NULLs last, equal rows ordered by `ties`.

    Runs as TakeOrderedAndProject: each task keeps k rows, the driver merges k per task.
    """
    return df.orderBy(*[F.desc_nulls_last(c) for c in by], *[F.asc_nulls_last(c) for c in ties]).limit(k)
