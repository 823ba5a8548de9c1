from pyspark.sql import DataFrame, functions as F

from forumlake.operators.skew import MAX_HOT_KEYS, MIN_HOT_ROWS, hot_keys, salted_join
from forumlake.operators.versions import latest_version, version_history

STAGED_COLUMNS = [
    "item_id", "parent_id", "created_at", "ingest_date_str", "author", "item_type", "title",
    "text_content", "url", "score", "descendants", "source_file", "ingest_date",
]

# Compared in this order where two versions came in the same file; the long texts come last.
TIES = ["created_at", "item_type", "author", "parent_id", "score", "descendants", "ingest_date_str"]
TEXTS = ["title", "url", "text_content"]


def staged_items(silver: DataFrame, texts: list[str] = TEXTS) -> DataFrame:
    """Newest version of every item: latest ingest day, then source file, then the content itself.

    `texts` may leave out the last or all of TEXTS for readers that do not need them. Versions
    that differ in nothing else are then the same row, so the other columns come out the same,
    but the texts, most of the bytes, are neither scanned nor shuffled.
    """
    if texts != TEXTS[: len(texts)]:
        raise ValueError(f"texts must be the beginning of {TEXTS}")
    columns = [c for c in STAGED_COLUMNS if c in texts or c not in TEXTS]
    return latest_version(silver.select(*columns), ["item_id"], ["ingest_date", "source_file"], TIES + texts)


def item_history(silver: DataFrame) -> DataFrame:
    """Score and comment count of every item per ingest day, with the change since the day seen before."""
    known = silver.filter(F.col("item_id").isNotNull())
    return version_history(known, "item_id", "ingest_date", ["source_file", "created_at"], ["score", "descendants"],
                           ["score", "descendants"])


def comments_on(
    items: DataFrame, parent_type: str = "story", min_rows: int = MIN_HOT_ROWS, max_keys: int = MAX_HOT_KEYS
) -> DataFrame:
    """Comments whose direct parent is an item of the given type; much discussed parents are salted."""
    parents = items.filter(F.col("item_type") == parent_type).select(F.col("item_id").alias("parent_id"))
    comments = items.filter((F.col("item_type") == "comment") & F.col("parent_id").isNotNull())
    hot = hot_keys(comments, "parent_id", min_rows=min_rows, max_keys=max_keys)
    return salted_join(comments, parents, "parent_id", "left_semi", hot, ["item_id"])
