from pyspark.sql import Column, functions as F

from forumlake.constants import NULL_KEY_MARKER


def surrogate_key(*columns: Column | str) -> Column:
    """Hex MD5 of the columns as text, joined by '-'; a NULL hashes as a fixed marker."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY_MARKER))
        for c in columns
    ]
    return F.md5(F.concat_ws("-", *parts))
