from tidegate.functions.dates import day_key, day_text, shifted_day, stamp_literal
from tidegate.functions.keys import as_text, partition_json, partition_key
from tidegate.functions.names import resolve, resolve_all

__all__ = [
    "as_text",
    "day_key",
    "day_text",
    "partition_json",
    "partition_key",
    "resolve",
    "resolve_all",
    "shifted_day",
    "stamp_literal",
]
