"""Column expressions. All are built-in Spark expressions, so they stay inside codegen."""

from millrace.functions.codes import EVENT_TYPE_CODES, event_type_code
from millrace.functions.text import decimal_text, first_name_token, path_part, uuid_hex
from millrace.functions.times import (
    archive_stamp,
    epoch_seconds_to_timestamp,
    micros_between,
    seconds_between,
    tumbling_index,
)

__all__ = [
    "EVENT_TYPE_CODES",
    "archive_stamp",
    "decimal_text",
    "epoch_seconds_to_timestamp",
    "event_type_code",
    "first_name_token",
    "micros_between",
    "path_part",
    "seconds_between",
    "tumbling_index",
    "uuid_hex",
]
