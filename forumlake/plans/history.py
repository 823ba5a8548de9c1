"""State history as intervals, kept up to date by deliveries in any order.

Kept are each item's newest state per ingest day and the intervals made of them, both by ranges of item ids. A delivery
replaces only the ranges it has items in.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from forumlake.operators.intervals import state_intervals
from forumlake.operators.versions import latest_version
from forumlake.schemas import SILVER
from forumlake.session import stored
from forumlake.sources.parts import id_part, names, read_parts, replace_parts

IDS_PER_PART = 1_000_000
MEASURES = ["score", "descendants"]
_STATES = StructType([SILVER[n] for n in ("item_id", "ingest_date", "source_file", "created_at", *MEASURES)])
_INTERVALS = StructType(
    [
        *(SILVER[n] for n in ("item_id", *MEASURES)),
        StructField("first_day", StringType()),
        StructField("last_day", StringType()),
        StructField("n_days", LongType()),
        StructField("next_day", StringType()),
    ]
)


def day_states(items: DataFrame) -> DataFrame:
    """The newest state of every item on every ingest day; items without id or day are left out."""
    known = items.filter(F.col("item_id").isNotNull() & F.col("ingest_date").isNotNull()).select(*_STATES.names)
    return latest_version(known, ["item_id", "ingest_date"], ["source_file", "created_at"], MEASURES)


def item_intervals(items: DataFrame) -> DataFrame:
    """Score and comment count of every item as intervals of ingest days."""
    return state_intervals(day_states(items), "item_id", "ingest_date", MEASURES)


def refresh(spark: SparkSession, delivered: DataFrame, store: str, run: int, ids_per_part: int = IDS_PER_PART) -> list[str]:
    """Add a delivery of parsed items, new, late or repeated, and return the ranges of ids it touched.

    A late day may split an interval, so a touched range's intervals are made anew from its states; others are
    neither read nor written. Equal to item_intervals over all deliveries. A run that died is repeated with its number.
    """
    part = id_part("item_id", ids_per_part)
    arrived = stored(day_states(delivered))
    touched = names(arrived, part)
    if touched:
        known = read_parts(spark, f"{store}/states", _STATES, touched, before=run)
        states = stored(day_states(arrived.unionByName(known)))
        replace_parts(states, f"{store}/states", part, touched, run)
        made = state_intervals(states, "item_id", "ingest_date", MEASURES)
        replace_parts(made, f"{store}/intervals", part, touched, run)
    return touched


def read_intervals(spark: SparkSession, store: str, parts: list[str] | None = None) -> DataFrame:
    """Intervals of all or the given ranges of ids as the newest run left them."""
    return read_parts(spark, f"{store}/intervals", _INTERVALS, parts)
