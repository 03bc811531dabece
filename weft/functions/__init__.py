"""Column-expression helpers (built-in functions only)."""

from weft.functions.columns import (  # noqa: F401
    MISSING_INT, MISSING_STRING, epoch_micros, exact_round_ratio, jvm_trim,
    lenient_int, parse_log_time, session_hash_id, url_host,
)
