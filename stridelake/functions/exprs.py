"""Scalar column expressions (SC-*).

All of these are built-in Catalyst expressions: they stay inside whole-stage
codegen and need no Python worker. Rounding is done on exact integers or
decimals, never on binary doubles, so results are identical on every engine
that follows the same decimal rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

_WS = K.PY_WHITESPACE_CLASS


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: Column, b: int) -> Column:
    """Floor division of a long by a positive constant, exact: the dividend
    minus its remainder is an exact multiple of ``b``."""
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("long")


# --- text -------------------------------------------------------------------

def py_strip(c: Column | str) -> Column:
    """Strip leading/trailing whitespace the way Python's ``str.strip()`` does
    (tabs, newlines and Unicode spaces too, unlike SQL ``trim``)."""
    return F.regexp_replace(col_(c), f"^{_WS}+|{_WS}+$", "")


def blank_to_null(c: Column | str) -> Column:
    """SC-11: strip, then empty text becomes NULL."""
    return F.nullif(py_strip(c), F.lit(""))


def is_blank_sql(c: Column | str) -> Column:
    """FL-5: ``c IS NULL OR trim(c) = ''`` with SQL trim (spaces only)."""
    c = col_(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def text_to_int(c: Column | str, to: str = "int") -> Column:
    """SC-9: strip, comma -> dot, parse as a float, truncate toward zero.

    ``'29.0'`` -> 29, ``'12,7'`` -> 12, blank -> NULL, junk (``'12d'`` too)
    -> NULL. ``to="long"`` for identifiers, exact in the whole 64-bit range:
    plain integers are cast as they are, other numbers as decimals.
    """
    text = F.replace(blank_to_null(c), F.lit(","), F.lit("."))
    number = F.when(text.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"), text)
    exact = number.try_cast("decimal(38,6)")
    whole = F.when(exact < 0, F.ceil(exact)).otherwise(F.floor(exact))
    return F.coalesce(number.try_cast(to), whole.try_cast(to))


def text_to_decimal(c: Column | str, precision: int = 12, scale: int = 2) -> Column:
    """SC-10: strip, comma -> dot, parse as decimal (half-up to ``scale``)."""
    return F.replace(blank_to_null(c), F.lit(","), F.lit(".")).try_cast(
        f"decimal({precision},{scale})")


def default_sport(c: Column | str) -> Column:
    """SC-7: empty or missing declared sport becomes the default label."""
    return F.coalesce(F.nullif(col_(c), F.lit("")), F.lit(K.DEFAULT_SPORT))


def normalise_sport(c: Column | str) -> Column:
    """SC-8: known misspellings are corrected, everything else unchanged."""
    c = col_(c)
    out = c
    for wrong, right in K.SPORT_NORMALISATION.items():
        out = F.when(c == F.lit(wrong), F.lit(right)).otherwise(out)
    return out


# --- time -------------------------------------------------------------------

def parse_iso_ts(c: Column | str) -> Column:
    """SC-1/SC-2: ISO-8601 text (``Z`` or offset) -> timestamp, NULL on bad
    input. ``to_timestamp`` raises under ANSI; ``try_to_timestamp`` does not."""
    return F.try_to_timestamp(col_(c))


def iso_text(c: Column | str) -> Column:
    """Timestamp -> ISO-8601 UTC text with microseconds (wire format)."""
    return F.date_format(col_(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def duration_minutes_1dp(start: Column | str, end: Column | str) -> Column:
    """SC-4: ``round((epoch_s(end) - epoch_s(start)) / 60, 1)`` where each end
    is first floored to a whole second, as a double.

    Computed on whole seconds ``s``: tenths of a minute rounded half away from
    zero are ``(|s| + 3) div 6``; the final division by 10 is a single IEEE
    operation, the same on every engine.
    """
    s = F.unix_seconds(col_(end)) - F.unix_seconds(col_(start))
    tenths = int_div(F.abs(s) + 3, 6)
    signed = F.when(s < 0, -tenths).otherwise(tenths)
    return signed.cast("double") / F.lit(10.0)


def whole_minutes_half_even(start: Column | str, end: Column | str) -> Column:
    """SC-5: ``max(1, round(total_seconds / 60))`` with half-to-even rounding
    and fractional seconds kept. Exact integer arithmetic on microseconds."""
    t = F.unix_micros(col_(end)) - F.unix_micros(col_(start))
    d = 60_000_000
    r = F.pmod(t, F.lit(d))
    q = int_div(t, d)
    rounded = (F.when(r * 2 > d, q + 1)
               .when(r * 2 < d, q)
               .otherwise(q + F.pmod(q, F.lit(2))))
    one = F.lit(1).cast("long")
    return F.when(t <= 0, one).otherwise(F.greatest(one, rounded))


# --- numbers ----------------------------------------------------------------

def metres_to_km_2dp(c: Column | str) -> Column:
    """SC-6 (Silver): Spark's ``round(m / 1000, 2)`` - half-up on the
    decimal value - done as exact decimal multiplication (never decimal or
    binary division). The commute check uses Python's rounding instead
    (``python_round_km``)."""
    m = col_(c).cast("decimal(24,6)")
    return F.round(m * F.lit(0.001).cast("decimal(4,3)"), 2).cast("decimal(18,2)")


def python_round_km(metres: Column | str, digits: int, integral: bool = False) -> Column:
    """``round(float(m) / 1000, digits)`` with Python's semantics, as an
    exact decimal: the binary double of the quotient rounded half to even.

    Away from ties the decimal quotient rounded half-up gives the same digits
    (the quotient has few decimals, the double is within an ulp of it). On an
    exact decimal tie (only possible for a whole number of metres) the side
    of the tie the double lies on decides; it is found with an error-free
    product (Dekker split of ``d * 1000``) in double arithmetic, and a double
    equal to the tie rounds half to even. ``integral=True`` (whole metres)
    takes a long-arithmetic path.
    """
    step = f"{10 ** -digits:.{digits}f}"
    m = col_(metres)
    if integral and digits < 3:
        # Whole metres: the rounding unit is 10**(3 - digits) metres, so the
        # half-up result, the tie test and the lower neighbour are long
        # arithmetic (no wide decimals).
        unit = 10 ** (3 - digits)
        a = F.abs(m.cast("long"))
        r = F.pmod(a, F.lit(unit))
        n = int_div(a, unit)
        up_n = F.when(r * 2 >= unit, n + 1).otherwise(n)
        to_dec = lambda c: c.cast("decimal(18,0)") * F.lit(step).cast(f"decimal({digits + 1},{digits})")
        up, down = to_dec(up_n), to_dec(up_n - 1)
        q = a.cast("decimal(18,0)") * F.lit(0.001).cast("decimal(4,3)")
        tie = (r * 2) == F.lit(unit)
    else:
        q = F.abs(m.cast("decimal(24,6)")) * F.lit(0.001).cast("decimal(4,3)")    # exact |m|/1000
        up = F.round(q, digits)                                                     # half-up
        down = up - F.lit(step).cast(f"decimal({digits + 1},{digits})")
        tie = ((q * (10 ** (digits + 1))) % 10) == F.lit(5)

    m_abs = F.abs(m.cast("double"))
    d = m_abs / F.lit(1000.0)                                                   # Python's float
    p = d * F.lit(1000.0)
    c = d * F.lit(134217729.0)
    d_hi = c - (c - d)
    d_lo = d - d_hi
    err = (d_hi * F.lit(1000.0) - p) + d_lo * F.lit(1000.0)
    side = (p - m_abs) + err                                                    # sign of d - |m|/1000

    mag = (F.when(~tie | (side > 0), up)
           .when(side < 0, down)
           .otherwise(F.bround(q, digits)))
    mag = mag.cast(f"decimal(20,{digits})")
    return F.when(m.isNull(), F.lit(None).cast(f"decimal(20,{digits})")).otherwise(
        F.when(m.cast("double") < 0, -mag).otherwise(mag))


def km_text_1dp(metres: Column | str) -> Column:
    """SC-15: text of ``f"{float(m) / 1000:.1f}"`` (Python formats the exact
    binary value, ties to even; see ``python_round_km``). Python keeps the
    sign of a negative value that rounds to zero ("-0.0")."""
    m = col_(metres)
    mag = F.abs(python_round_km(m, 1))
    text = mag.cast("string")
    return F.when(m.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(m.cast("double") < 0, F.concat(F.lit("-"), text)).otherwise(text))


def python_float_text(c: Column | str) -> Column:
    """Text of a 2-decimal value as Python prints ``round(x, 2)``: one
    trailing zero dropped (``15.50`` -> ``15.5``, ``20.00`` -> ``20.0``)."""
    return F.regexp_replace(col_(c).cast("decimal(18,2)").cast("string"), "0$", "")


def percent_1dp(n: Column | str, total: Column | str) -> Column:
    """``round(100 * n / total, 1)`` half-up, from integers only."""
    n, total = col_(n).cast("long"), col_(total).cast("long")
    tenths = ((n * 2000 + total) - F.pmod(n * 2000 + total, total * 2)) / (total * 2)
    return (tenths.cast("double") / F.lit(10.0)).cast("decimal(6,1)")
