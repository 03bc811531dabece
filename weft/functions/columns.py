"""Column expressions for the record formats and value conventions.

Everything here returns a ``Column`` built from built-in functions, so it
runs inside whole-stage codegen; there is no Python on the row path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's behaviour.
MISSING_STRING = "-"          # sentinel for an absent string value
MISSING_INT = -1              # sentinel for an absent / unparsable integer
LOG_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Leading scheme, optional user-info, then the host up to port / path / query / fragment.
URL_HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/:?#]*)"
# Characters the JVM's String.trim removes: every char from U+0000 to U+0020.
JVM_WHITESPACE = "".join(chr(i) for i in range(0x21))
# Whole text is an optional sign and digits (``\z``: no trailing newline).
INT_TEXT_PATTERN = r"^[+-]?[0-9]+\z"
LOG_TIME_PATTERN = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jvm_trim(c: str | Column) -> Column:
    """Trim like ``java.lang.String.trim`` (all chars <= U+0020), not only
    spaces. A character-set trim: no regex on the row path."""
    return F.btrim(col(c), F.lit(JVM_WHITESPACE))


def _sql_string(text: str) -> str:
    """A Spark SQL string literal for ``text`` (control chars as \\u escapes)."""
    out = []
    for ch in text:
        if ch in ("'", "\\") or ord(ch) < 0x20:
            out.append(f"\\u{ord(ch):04x}")
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def lenient_int_sql(expr: str, default: int | None = MISSING_INT) -> str:
    """SQL text of ``lenient_int`` over the SQL expression ``expr``; a default of None is null."""
    none = "CAST(NULL AS INT)" if default is None else str(default)
    return (f"CASE WHEN {expr} RLIKE {_sql_string(INT_TEXT_PATTERN)} "
            f"THEN coalesce(try_cast({expr} AS INT), {none}) ELSE {none} END")


def jvm_trim_sql(expr: str) -> str:
    """SQL text of ``jvm_trim`` over the SQL expression ``expr``."""
    return f"btrim({expr}, {_sql_string(JVM_WHITESPACE)})"


def lenient_int(c: str | Column, default: int = MISSING_INT) -> Column:
    """Integer with a default for blank, ``...NA`` and non-numeric text.

    Only an optional sign followed by ASCII digits parses, untrimmed: ``" 7"``
    and ``"7\n"`` give the default, as do blanks, ``NA``, fractions,
    exponents and overflow. (A digits-only text is never blank and never ends
    in ``NA``, so one shape test covers the whole rule.) The shape is checked
    before the cast because Spark's string-to-int ``try_cast`` throws and
    catches internally on bad input, which is slow.
    """
    s = col(c)
    return (F.when(s.rlike(INT_TEXT_PATTERN),
                   F.coalesce(s.try_cast(T.IntegerType()), F.lit(default)))
             .otherwise(F.lit(default)))


def url_host(url: str | Column, missing: str = MISSING_STRING) -> Column:
    """Host of a URL, ``missing`` when there is none.

    ``try_parse_url`` handles IPv6 literals; the pattern covers what it
    rejects (hosts with ``_``, URLs with spaces).
    """
    u = col(url)
    return F.coalesce(
        F.try_parse_url(u, F.lit("HOST")),
        F.nullif(F.regexp_extract(u, URL_HOST_PATTERN, 1), F.lit("")),
        F.lit(missing))


def parse_log_time(c: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to ``timestamp_ntz``; null when malformed.

    The text carries no zone, so it stays a wall-clock value and never shifts
    with the session time zone.
    """
    s = col(c)
    # Fixed-width fields: one shape test, then plain substrings (all digits,
    # so the casts cannot fail); impossible dates give null.
    parts = [F.substring(s, pos, n).cast("int") for pos, n in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2))]
    return F.when(s.rlike(LOG_TIME_PATTERN), F.try_make_timestamp_ntz(*parts))


def epoch_micros(ts: str | Column, dtype: T.DataType | None = None) -> Column:
    """Microseconds since the epoch.

    For ``timestamp_ntz`` this is built from the wall-clock fields, so it never
    passes through the session time zone (no DST shifts in gap arithmetic).
    """
    c = col(ts)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    day_us = F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000_000)
    clock_us = (F.hour(c).cast("long") * 3_600_000_000 + F.minute(c).cast("long") * 60_000_000)
    sec_us = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return day_us + clock_us + sec_us


def floor_div(c: Column, n: int) -> Column:
    """Exact integer floor division (also for negative values)."""
    return (c - F.pmod(c, F.lit(n))).__truediv__(F.lit(n)).cast("long")


def session_hash_id(*parts: str | Column) -> Column:
    """Deterministic session id: SHA-256 over ``|``-joined string parts."""
    return F.sha2(F.concat_ws("|", *[col(p).cast("string") for p in parts]), 256)


def ts_text(ts: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> Column:
    return F.date_format(col(ts), fmt)


def exact_round_ratio(num: str | Column, den: str | Column, scale: int = 2,
                      num_scale: int = 2) -> Column:
    """``round(num / den, scale)`` with half-up on the exact quotient.

    The numerator is taken as a decimal with ``num_scale`` places, so ties are
    decided on the true value, not on a binary double. Zero / null divisor
    gives null.
    """
    n = col(num).cast(T.DecimalType(38 - 10, num_scale))
    d = col(den)
    q = F.try_divide(n, F.nullif(d, F.lit(0)))
    return F.round(q, scale).cast("double")
