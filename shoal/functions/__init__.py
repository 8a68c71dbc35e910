"""Column expressions (all JVM-side built-ins)."""

from shoal.functions.exprs import (as_int, decimal_product, is_entry_page, keep_keys,
                                   map_get)
from shoal.functions.json import is_json, is_json_object, to_json_value
from shoal.functions.time import (ONE_DAY_MS, format_text_time, millis_to_timestamp,
                                  ntz_epoch_millis, to_date_str, to_ts, to_ymdhms, visit_date)

__all__ = [
    "as_int", "decimal_product", "is_entry_page", "keep_keys", "map_get",
    "is_json", "is_json_object", "to_json_value",
    "ONE_DAY_MS", "format_text_time", "millis_to_timestamp", "ntz_epoch_millis", "to_date_str",
    "to_ts",
    "to_ymdhms", "visit_date",
]
