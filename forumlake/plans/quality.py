"""Declarative data checks. Each check returns the offending values with their number of rows."""

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from forumlake.constants import ITEM_TYPES
from forumlake.session import dropped_shuffles, small_splits, stored

# Checks per model and column: "not_null", "unique", ("accepted", values), ("in", model, column), or one of these
# for some rows only: ("where", condition, check).
CHECKS = {
    "stg_items": {
        "item_id": ["not_null", "unique"],
        "created_at": ["not_null"],
        "item_type": [("accepted", ITEM_TYPES)],
    },
    "dim_users": {"user_key": ["not_null", "unique"], "user_name": ["not_null", "unique"]},
    "dim_items": {"item_key": ["not_null", "unique"], "item_id": ["not_null", "unique"]},
    "fct_stories": {
        "item_key": ["not_null", "unique", ("in", "dim_items", "item_key")],
        "user_key": ["not_null", ("in", "dim_users", "user_key")],
        "created_date_key": ["not_null", ("in", "dim_dates", "date_key")],
        "created_at": ["not_null"],
    },
    "daily_story_metrics": {"story_date": ["not_null"]},
    "daily_active_authors": {"story_date": ["not_null"]},
    "story_analytics": {"item_key": ["not_null", "unique"], "item_id": ["not_null", "unique"]},
}


def _scope(df: DataFrame, where: str | Column | None) -> DataFrame:
    return df if where is None else df.filter(where)


def not_null(df: DataFrame, column: str, where: str | Column | None = None) -> DataFrame:
    """Rows in which the column is missing."""
    return _scope(df, where).filter(F.col(column).isNull())


def unique(df: DataFrame, column: str, where: str | Column | None = None) -> DataFrame:
    """Values that occur more than once; NULLs pass."""
    return (
        _scope(df, where)
        .filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def accepted_values(df: DataFrame, column: str, values, where: str | Column | None = None) -> DataFrame:
    """Values outside the list; NULLs pass."""
    return (
        _scope(df, where)
        .filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, where: str | Column | None = None
) -> DataFrame:
    """Child values that the parent does not have; NULLs pass.

    Both sides are reduced to one row per value before the anti join, map side first; its
    partitioning is the one the join needs, so that costs no shuffle.
    """
    values = (
        _scope(child, where)
        .filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return values.join(parent.select(F.col(parent_column).alias("value")).distinct(), "value", "left_anti")


def _declared(checks: dict) -> list[tuple[str, str, str, tuple, str | None]]:
    """Model, column, name, arguments and condition of every check."""
    found = []
    for model, columns in checks.items():
        for column, tests in columns.items():
            for test in tests:
                where, scope = None, ""
                if test[0] == "where":
                    _, where, test = test
                    scope = f" where {where}"
                name, *arguments = (test,) if isinstance(test, str) else test
                label = {"accepted": "accepted_values", "in": "relationships"}.get(name, name)
                found.append((model, column, label + scope, (name, *arguments), where))
    return found


def _packed(df: DataFrame, column: str) -> Column:
    """A value as a whole number, as the 16 bytes of a surrogate key or as text; two are equal where their texts are.

    A number that another column holds as text is the same value, so both are given as the number, unless the text is
    not how the number is written ("05"). The hex text of a key is twice as long as its bytes.
    """
    value = F.col(column)

    def packed(whole: Column = F.lit(None), key: Column = F.lit(None), text: Column = F.lit(None)) -> Column:
        return F.struct(whole.cast("bigint").alias("whole"), key.cast("binary").alias("key"), text.cast("string").alias("text"))

    if df.select(value).dtypes[0][1] in ("tinyint", "smallint", "int", "bigint"):
        return packed(whole=value)
    text = value.cast("string")
    # Only texts of digits are cast: one that is no number costs an exception. Those of 19 digits may be too large.
    number = F.when(text.rlike(r"\A(0|-?[1-9][0-9]{0,18})\z"), text.try_cast("bigint"))
    is_key = text.rlike(r"\A[0-9a-f]{32}\z")
    return F.when(number.isNotNull(), packed(whole=number)).when(is_key, packed(key=F.unhex(text))).otherwise(packed(text=text))


def _groups(declared: list) -> dict[tuple[str, str, str | None], tuple[int, int]]:
    """Columns whose values are counted -> number of their group and place in it.

    A column is one model's column, for all rows or those of a condition. Columns that checks refer from and to share a
    group, so that their values meet.
    """
    groups = []
    for model, column, _, (name, *arguments), where in declared:
        if name in ("unique", "in"):
            joined = [(model, column, where)] + ([(*arguments, None)] if name == "in" else [])
            for group in [g for g in groups if set(g) & set(joined)]:
                groups.remove(group)
                joined = [*group, *joined]
            groups.append(list(dict.fromkeys(joined)))
    return {source: (i, place) for i, group in enumerate(groups) for place, source in enumerate(group)}


def run_checks(models: dict[str, DataFrame], checks: dict = CHECKS) -> DataFrame:
    """One row per check: model, column, check, failures (offending rows or values).

    Each model is read once, for its own checks and those of others that refer to it. A column's values travel once,
    however many checks need them, as numbers or bytes where they can; missing values and those outside a list are only
    counted. All is summed up by value, map side first: one shuffle for all checks. It runs here; a few sums are stored.
    """
    declared = _declared(checks)
    groups = _groups(declared)
    n_groups = 1 + max((i for i, _ in groups.values()), default=-1)
    places = range(1 + max((place for _, place in groups.values()), default=0))
    added = {model: [] for model in checks}

    def row(group: int, place: int, value: Column) -> Column:
        return F.struct(F.lit(group).alias("group"), F.lit(place).alias("place"), value.alias("value"))

    def scoped(wanted: Column, where: str | None) -> Column:
        return wanted if where is None else F.expr(where) & wanted

    for (model, column, where), (group, place) in groups.items():
        wanted = scoped(F.col(column).isNotNull(), where)
        added.setdefault(model, []).append(F.when(wanted, row(group, place, _packed(models[model], column))))
    listed, pairs = [], set()
    nothing = F.lit(None).cast("struct<whole bigint, key binary, text string>")
    for number, (model, column, label, (name, *arguments), where) in enumerate(declared):
        if name in ("unique", "in"):
            group, place = groups[model, column, where]
            found = f"repeated_{place}"
            if name == "in":
                parent = groups[(*arguments, None)][1]
                pairs.add((place, parent))
                found = f"only_{place}_{parent}"
        elif name in ("not_null", "accepted"):
            value = F.col(column)
            wanted = value.isNull() if name == "not_null" else ~value.isin(*arguments[0])
            group, found = n_groups + number, "n_0"
            added[model].append(F.when(scoped(wanted, where), row(group, 0, nothing)))
        else:
            raise ValueError(f"no check is called {name}")
        listed.append((model, column, label, group, found))
    parts = [models[model].select(F.inline(F.array_compact(F.array(*rows)))) for model, rows in added.items() if rows]
    values = reduce(DataFrame.unionByName, parts).select("group", "place", "value.*").groupBy("group", "whole", "key", "text")
    values = values.agg(*[F.count_if(F.col("place") == place).alias(f"n_{place}") for place in places])
    totals = {f"repeated_{place}": F.count_if(F.col(f"n_{place}") > 1) for place in places}
    totals |= {f"only_{a}_{b}": F.count_if((F.col(f"n_{a}") > 0) & (F.col(f"n_{b}") == 0)) for a, b in sorted(pairs)}
    totals["n_0"] = F.sum("n_0")
    failed = values.groupBy("group").agg(*[total.alias(name) for name, total in totals.items()])
    by_name = F.create_map(*[x for name in totals for x in (F.lit(name), F.col(name))])
    spark = failed.sparkSession
    with small_splits(spark), dropped_shuffles(spark):
        failed = stored(failed.select("group", F.explode(by_name).alias("found", "failures")))
    fields = "model string, column string, check string, group int, found string"
    report = spark.createDataFrame(listed, fields).join(failed, ["group", "found"], "left")
    return report.select("model", "column", "check", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))


def missing_rates(silver: DataFrame, columns=("item_id", "created_at", "author"), by: str = "ingest_date") -> DataFrame:
    """Share of rows per ingest day in which each critical field is missing."""
    return silver.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(F.col(c).isNull().cast("int")).alias(f"{c}_missing_rate") for c in columns],
    )


def missing_days(silver: DataFrame, calendar: DataFrame, by: str = "ingest_date") -> DataFrame:
    """Calendar days for which nothing was loaded."""
    loaded = silver.select(F.col(by).cast("date").alias("date_day")).distinct()
    return calendar.select("date_day").join(loaded, "date_day", "left_anti")


def ingestion_latency(files: DataFrame, now: dt.datetime | Column, by: str, written: str) -> DataFrame:
    """Seconds from the last write of each group of files until `now`."""
    moment = F.lit(now).cast("timestamp") if isinstance(now, dt.datetime) else now
    return (
        files.groupBy(by)
        .agg(F.max(written).alias("last_written_at"))
        .withColumn("_now", moment)
        .withColumn("latency_seconds", F.timestamp_diff("SECOND", "last_written_at", "_now"))
        .drop("_now")
    )


def ingestion_volumes(silver: DataFrame) -> DataFrame:
    """Rows, distinct source files and items without id per ingest day."""
    per_file = silver.groupBy("ingest_date", "source_file").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("item_id").isNull()).alias("broken")
    )
    return per_file.groupBy("ingest_date").agg(
        F.sum("n").alias("n_rows"), F.count("source_file").alias("n_files"), F.sum("broken").alias("n_without_id")
    )
