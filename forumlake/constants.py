"""Results and stored layouts depend on these exact strings and numbers."""

# Item types a feed may carry.
ITEM_TYPES = ("story", "comment", "job", "poll", "pollopt")

# Member of the author dimension that stands for a missing author.
UNKNOWN_USER_KEY = "unknown_user_key"
UNKNOWN_USER_NAME = "unknown_user_name"

# Text hashed in place of a NULL when a surrogate key is built.
NULL_KEY_MARKER = "_dbt_utils_surrogate_key_null_"

# Scheme prefixes removed from a URL before its host is cut out.
URL_SCHEMES = ("android-app://", "http://", "https://")

# Shown in the reporting view for a story without a URL.
NO_DOMAIN = "N/A"

# Calendar dimension, end excluded.
CALENDAR_START = "2006-01-01"
CALENDAR_END = "2026-12-31"

# Ids looked up by one task and landed in one file.
ITEMS_PER_CHUNK = 10_000

# Raw JSON field -> (silver column, type).
RAW_FIELDS = {
    "id": ("item_id", "bigint"),
    "type": ("item_type", "string"),
    "by": ("author", "string"),
    "time": ("created_at", "timestamp"),
    "title": ("title", "string"),
    "text": ("text_content", "string"),
    "url": ("url", "string"),
    "parent": ("parent_id", "bigint"),
    "score": ("score", "bigint"),
    "descendants": ("descendants", "bigint"),
}
