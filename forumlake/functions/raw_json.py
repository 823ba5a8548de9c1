"""Strict reading of raw JSON lines."""

from pyspark.sql import Column, DataFrame, functions as F

from forumlake.constants import RAW_FIELDS

# First second of year 1 and last of 9999; other epoch values are no timestamps.
_EPOCH_SECONDS = (-62135596800, 253402300799)


def _scalar_or_null(text: Column, line: Column, field: str) -> Column:
    """Text of a JSON scalar; NULL where the field holds an object or an array.

    The line is parsed a second time only where the text begins and ends like an object or
    an array, so a title such as '[pdf] ...' costs no more than a look at both ends.
    """
    found = F.try_variant_get(F.try_parse_json(line), f"$.{field}", "variant")
    nested = F.schema_of_variant(found).rlike("^(OBJECT|ARRAY)")
    suspicious = (text.startswith("{") & text.endswith("}")) | (text.startswith("[") & text.endswith("]"))
    # A branch of its own: Spark evaluates what several conditions have in common, joined by AND or not, for every row.
    return F.when(suspicious, F.when(~F.coalesce(nested, F.lit(False)), text)).otherwise(text)


def _typed(text: Column, line: Column, field: str, kind: str) -> Column:
    if kind == "string":
        return _scalar_or_null(text, line, field)
    # The text of an object or an array is no number either, so it needs no check here.
    number = text.try_cast("bigint")
    if kind == "bigint":
        return number
    in_range = number.between(*_EPOCH_SECONDS)
    return F.when(in_range, F.timestamp_seconds(F.when(in_range, number)))


_END = "\x01end"


def read_object(line: Column, fields: list[str]) -> Column:
    """The texts of the fields of a line that is exactly one JSON object, as a struct; else NULL.

    The line is read once, as the first of two elements of an array. The second is a mark with a hash of the line: text or
    another object after the line's object, unbalanced braces, single quotes and numbers like NaN leave no array of
    these two.
    """
    mark = F.concat(F.lit(',{"\\u0001end":"'), F.xxhash64(line).cast("string"), F.lit('"}]'))
    names = ",".join(f"`{name}`:string" for name in [*fields, _END])
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    return F.from_json(F.concat(F.lit("["), line, mark), f"array<struct<{names}>>", strict)


def parsed_fields(
    lines: DataFrame, keep: list[str], line: str = "value", fields: dict[str, tuple[str, str]] | None = None
) -> DataFrame:
    """The `keep` columns and one typed column per JSON field; one output row per line.

    All fields are read in one pass over the line. A line that is not exactly one JSON object gives a row of NULLs
    instead of being lost. Of a repeated key the last value counts.
    """
    fields = fields or RAW_FIELDS
    read = lines.select(*keep, line, read_object(F.col(line), list(fields)).alias("_read"))
    whole = (F.size("_read") == 2) & (F.col("_read")[1][_END] == F.xxhash64(line).cast("string"))
    texts = read.select(*keep, line, F.when(whole, F.col("_read")[0]).alias("_text"))
    return texts.select(
        *[_typed(F.col("_text")[field], F.col(line), field, kind).alias(name) for field, (name, kind) in fields.items()],
        *keep,
    )
