"""Scalar coercions (SCL-*) as Column expressions.

Everything here is a plain ``pyspark.sql.functions`` expression so it stays in
the JVM and inside whole-stage codegen.  ANSI mode is on by default in Spark 4,
so every cast that may fail is a ``try_cast``.  The one exception is the
six-significant-digit score, which needs exact binary rounding (see
``score6``).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the loader being replaced:
# C isspace() set used by trim in the opinion/cluster/panel/... readers.
C_SPACE = " \t\n\r\x0b\x0c"
# The narrower set trimmed by the parenthetical reader.
PAREN_SPACE = " \t\r\n"
# Lower-cased words read as boolean true.
TRUE_WORDS = ("true", "t", "1", "yes")
# Integer sentinel for a missing docket.
DOCKET_SENTINEL = 2147483647

INT_PREFIX = r"^([+-]?[0-9]+)"
# stoi/stoll skip leading C white space themselves: one regex, no separate trim
_LEAD_INT = r"^[ \t\n\r\x0b\x0c]*([+-]?[0-9]+)"
_POWERS = 10.0 ** np.arange(23)  # exact doubles
DOUBLE_PREFIX = r"^([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` evaluated once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(c), use), 0)


def ctrim(c, chars: str = C_SPACE) -> Column:
    """SCL-1: trim the given character set from both ends (C ``isspace`` by default)."""
    return F.btrim(_col(c), F.lit(chars))


def paren_trim(c) -> Column:
    """SCL-1: the parenthetical reader trims only space, tab, CR and LF."""
    return ctrim(c, PAREN_SPACE)


def int_prefix_text(c, chars: str = C_SPACE) -> Column:
    """Optional sign + digit prefix of the trimmed text ('' when there is none)."""
    return F.regexp_extract(ctrim(c, chars), INT_PREFIX, 1)


def _lead_int(c, chars: str = C_SPACE) -> Column:
    if chars == C_SPACE:
        return F.regexp_extract(_col(c), _LEAD_INT, 1)
    return int_prefix_text(c, chars)


def parse_int(c, default: int = 0, chars: str = C_SPACE) -> Column:
    """SCL-3: ``stoi`` semantics: digit prefix, default when absent or outside 32 bits."""
    # nullif first: a failing try_cast is far slower than a NULL input
    return F.coalesce(F.nullif(_lead_int(c, chars), F.lit("")).try_cast("int"), F.lit(default).cast("int"))


def parse_optional_int(c) -> Column:
    """SCL-4: blank/unparsable -> NULL; parsed as 64-bit then narrowed to 32 bits (wraps)."""
    v = F.nullif(_lead_int(c), F.lit("")).try_cast("bigint")
    # two's-complement narrowing with one reference to v and no overflow
    return ((F.pmod(v, F.lit(4294967296)) + F.lit(2147483648)) % F.lit(4294967296) - F.lit(2147483648)).cast("int")


def parse_bool(c) -> Column:
    """SCL-2 + SCL-5: trimmed, lower-cased membership in the true words; all else false."""
    return F.coalesce(F.lower(ctrim(c)).isin(*TRUE_WORDS), F.lit(False))


def parse_double(c, default: float = 0.0, chars: str = PAREN_SPACE) -> Column:
    """SCL-6: ``stod``-style decimal prefix; default when absent, infinite or underflowing."""
    v = F.nullif(F.regexp_extract(ctrim(c, chars), DOUBLE_PREFIX, 1), F.lit("")).try_cast("double")

    def kept(v: Column) -> Column:
        bad = v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))) | (
            (v != F.lit(0.0)) & (F.abs(v) < F.lit(2.2250738585072014e-308))
        )
        return F.when(bad, F.lit(default)).otherwise(v)

    return once(v, kept)


def blank_to_null(c, trim_value: bool = False) -> Column:
    """SCL-7: blank text -> NULL.  ``download_url`` keeps its untrimmed value."""
    c = _col(c)
    if trim_value:
        return F.nullif(ctrim(c), F.lit(""))
    return F.when(ctrim(c) != F.lit(""), c)


def null_to_empty(c) -> Column:
    """SCL-8: NULL is written as the empty string."""
    return F.coalesce(_col(c), F.lit(""))


def _six_digits(vals: np.ndarray) -> np.ndarray:
    """Exact round-half-even on the binary value, like C's default ostream precision.

    A value of ordinary size is scaled to six digits before the point. Scaling errs by less than
    1e-9 there, so unless the fraction is near a half the nearest integer holds the six digits;
    that integer and the power of ten are exact doubles, so one division or multiplication gives
    the double that the six digits read as. All other values are written and read.
    """
    with np.errstate(all="ignore"):
        size = np.abs(vals)
        exp = np.where((size >= 1e-12) & (size < 1e18), np.floor(np.log10(size)), 0)
        power = _POWERS[np.abs(5 - exp).astype("int64")]
        up = exp <= 5
        scaled = np.where(up, vals * power, vals / power)
        digits = np.rint(scaled)
        sure = (np.abs(np.abs(scaled - np.trunc(scaled)) - 0.5) > 1e-6) & (np.abs(digits) > 100_000) & (np.abs(digits) < 999_999)
        out = np.where(up, digits / power, digits * power)
    rest = ~(sure & (size >= 1e-12) & (size < 1e18))
    if rest.any():
        out[rest] = np.char.mod("%.6g", vals[rest]).astype("float64")
    return out


@F.pandas_udf(T.DoubleType())
def _score6(s: pd.Series) -> pd.Series:
    return pd.Series(_six_digits(s.to_numpy(dtype="float64", na_value=np.nan)), index=s.index)


def score6(c) -> Column:
    """SCL-9: a double as written with six significant digits.

    Spark's ``format_string('%.6g')`` rounds the shortest decimal form half-up,
    which differs from C on values such as 12345.65, so this one runs as an
    Arrow-batched pandas UDF over a single double column.
    """
    return _score6(_col(c).cast("double"))


def cast_timestamp(c) -> Column:
    """SCL-10: text -> TIMESTAMP; NULL for blank or unparsable text."""
    return F.nullif(ctrim(c), F.lit("")).try_cast("timestamp")


def cast_date(c) -> Column:
    """SCL-10: text -> DATE; NULL for blank or unparsable text."""
    return F.nullif(ctrim(c), F.lit("")).try_cast("date")


def cast_failed(text, typed) -> Column:
    """True when non-blank text did not survive its cast (a row failing as ``other``)."""
    text = _col(text)
    return text.isNotNull() & (ctrim(text) != F.lit("")) & _col(typed).isNull()


def docket_sentinel(c) -> Column:
    """SCL-11: a docket id <= 0 means 'unknown' and maps to the sentinel."""
    c = _col(c)
    return F.when(c <= F.lit(0), F.lit(DOCKET_SENTINEL)).otherwise(c).cast("int")


def csv_escape(c) -> Column:
    """SCL-12: double every quote."""
    return F.replace(_col(c), F.lit('"'), F.lit('""'))


def count_char(c, ch: str) -> Column:
    """Occurrences of one character."""
    c = _col(c)
    return (F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))).cast("int")


def record_diagnostics(raw, cols=None) -> list[Column]:
    """SCL-13: length, quote count (should be even), newline count, column count."""
    out = [
        F.length(_col(raw)).cast("int").alias("record_length"),
        count_char(raw, '"').alias("quote_count"),
        count_char(raw, "\n").alias("newline_count"),
    ]
    if cols is not None:
        out.append(F.size(_col(cols)).alias("column_count"))
    return out
