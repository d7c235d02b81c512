"""DataFrame -> DataFrame building blocks."""

from .explode import explode_json_object, json_members
from .keys import continued_ids, date_key, dense_ids, sequential_ids, unique_ids
from .quality import bad_ints, bad_json, duplicate_keys, orphans, orphans_dense, unique_violations
from .upsert import first_wins, insert_ignore, insert_or_replace, merge_tracked, only_records, repeated_keys, upsert_partial

__all__ = [
    "explode_json_object", "json_members", "continued_ids", "date_key", "dense_ids",
    "sequential_ids", "unique_ids", "bad_ints", "bad_json", "duplicate_keys", "orphans", "orphans_dense", "unique_violations",
    "first_wins", "insert_ignore", "insert_or_replace", "merge_tracked", "only_records", "repeated_keys", "upsert_partial",
]
