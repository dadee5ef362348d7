"""Null-aware arithmetic, coercion and code mapping as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names in code order.
LABELS = ("baixo", "medio", "alto")
LABEL_CODES = {"baixo": 0, "medio": 1, "alto": 2}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_number(x) -> Column:
    """Text or number to double; anything unparsable, and NaN, becomes null."""
    v = _c(x).try_cast("double")
    return F.when(~F.isnan(v), v)


def to_date(x, fmt: str | None = None) -> Column:
    """Text, date or timestamp to date; unparsable values become null."""
    return _c(x).try_cast("date") if fmt is None else F.try_to_timestamp(_c(x), F.lit(fmt)).cast("date")


def to_instant(x) -> Column:
    """Text, date or timestamp to timestamp; unparsable values become null."""
    return _c(x).try_cast("timestamp")


def parse_iso_instant(x) -> Column:
    """Catalogue timestamps: ISO with or without time or fraction, anything from ``Z`` on cut off."""
    shape = r"^\d{4}-\d{1,2}-\d{1,2}(T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?)?$"
    return F.regexp_extract(F.split(_c(x).cast("string"), "Z")[0], shape, 0).try_cast("timestamp")


def utc_to_local(ts, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a UTC instant."""
    return F.from_utc_timestamp(_c(ts), zone)


def local_to_utc(ts, zone: str) -> Column:
    """UTC instant of a wall-clock time in ``zone``."""
    return F.to_utc_timestamp(_c(ts), zone)


def safe_ratio(a, b) -> Column:
    """a / b, null where b is zero or either side is null."""
    return F.try_divide(_c(a), _c(b))


def clip_low(x, low: float = 0.0) -> Column:
    """max(x, low), keeping null (plain ``greatest`` would turn null into ``low``)."""
    x = _c(x)
    return F.when(x.isNotNull(), F.greatest(x, F.lit(float(low))))


def row_sum(cols: Sequence, need_one: bool = False) -> Column:
    """Sum across columns with nulls as 0; with ``need_one`` null when all are null."""
    cols = [_c(c) for c in cols]
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(c, F.lit(0.0))
    if need_one and cols:
        return F.when(F.coalesce(*cols).isNotNull(), total)
    return total


def net_sum(plus: Sequence, minus: Sequence = ()) -> Column:
    """Σ plus − Σ minus with nulls as 0, null only when every input is null."""
    both = [_c(c) for c in (*plus, *minus)]
    if not both:
        return F.lit(None).cast("double")
    return F.when(F.coalesce(*both).isNotNull(), row_sum(plus) - row_sum(minus))


def same_value(a, b) -> Column:
    """Equality in which two nulls are equal."""
    return _c(a).eqNullSafe(_c(b))


def map_values(x, mapping: Mapping, default=None) -> Column:
    """Look a value up in a small fixed mapping."""
    x = _c(x)
    out = None
    for key, value in mapping.items():
        cond = x == F.lit(key)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    if out is None:
        return F.lit(default)
    return out if default is None else out.otherwise(default)


def encode_label(x) -> Column:
    return map_values(x, LABEL_CODES).cast("int")


def decode_label(x) -> Column:
    return map_values(_c(x).cast("int"), {code: name for name, code in LABEL_CODES.items()})
