"""Column-level expressions (all built-in, JVM-side)."""

from logflow.functions.jsoncheck import CODE_BAD_FIELDS, CODE_NOT_JSON, CODE_OK, parse_one, request_code
from logflow.functions.keys import (JOBS_PREFIX, LOCKS_PREFIX, add_prefix, key_prefix,
                                    strip_prefix)
from logflow.functions.logline import LEVELS, format_log_line, level_name, log_prefix
from logflow.functions.timefmt import (as_utc_ntz, from_micros, index_name, micros,
                                       tick_of, tick_start)

__all__ = [
    "CODE_BAD_FIELDS", "CODE_NOT_JSON", "CODE_OK", "parse_one", "request_code", "JOBS_PREFIX", "LOCKS_PREFIX", "add_prefix",
    "key_prefix", "strip_prefix", "LEVELS", "format_log_line", "level_name", "log_prefix",
    "as_utc_ntz", "from_micros", "index_name", "micros", "tick_of", "tick_start",
]
