"""Row-level column expressions; all stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo=None, hi=None) -> Column:
    """Bound a value on either or both sides; NULL stays NULL."""
    c = _c(c)
    out = c
    if lo is not None:
        out = F.when(out < lo, F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > hi, F.lit(hi)).otherwise(out)
    return out


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(~F.isnan(c), c)


def number(c) -> Column:
    """The value as a double: NaN is missing, -0.0 is 0.0."""
    return nan_to_null(_c(c).cast("double")) + F.lit(0.0)


def label_at(p, t: float = 0.5, op: str = ">") -> Column:
    """0/1 label of a probability. Metrics use ``>``; model predict uses ``>=``."""
    p = _c(p)
    if op not in (">", ">="):
        raise ValueError("op must be '>' or '>='")
    return ((p > t) if op == ">" else (p >= t)).cast("int")


def confidence(p) -> Column:
    p = _c(p)
    return F.greatest(p, F.lit(1.0) - p)


def is_correct(y, p, t: float = 0.5) -> Column:
    return label_at(p, t) == _c(y).cast("int")


# Band edges and names of the risk report.
RISK_BANDS = ((0.3, "LOW"), (0.7, "MEDIUM"))
RISK_TOP = "HIGH"


def risk_band(p) -> Column:
    p = _c(p)
    out = None
    for edge, name in RISK_BANDS:
        out = F.when(p < edge, name) if out is None else out.when(p < edge, name)
    return F.when(p.isNotNull(), out.otherwise(RISK_TOP))


def logit(p) -> Column:
    p = _c(p)
    return F.ln(p / (F.lit(1.0) - p))


def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def residual(y, p) -> Column:
    return _c(y).cast("double") - _c(p)


def percent_text(share, digits: int = 1) -> Column:
    """``0.1234`` as ``12.3%``."""
    return F.format_string(f"%.{digits}f%%", _c(share) * 100.0)


def known_in(c, values) -> Column:
    """Membership with NULL counted as not a member."""
    return F.coalesce(_c(c).isin(list(values)), F.lit(False))


def digest(seed, *parts) -> Column:
    """Layout-independent pseudo-random text key of a row: md5 of ``seed:part:...``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_c(p).cast("string") for p in parts]))


def uniform(seed, draw: str, key) -> Column:
    """A number in [0, 1) that depends on (seed, draw, key) only: 52 digest bits."""
    bits = F.conv(F.substring(digest(f"{seed}:{draw}", key), 1, 13), 16, 10).cast("double")
    return bits / F.lit(float(2**52))


def as_instant(ntz) -> Column:
    """Zone-less wall-clock time read as UTC, whatever the session's time zone."""
    t = _c(ntz)
    secs = F.hour(t) * 3600 + F.minute(t) * 60
    micros = (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    days = F.unix_date(t.cast("date")).cast("bigint")
    return F.timestamp_micros((days * 86_400 + secs) * 1_000_000 + micros)


def as_wall_clock(ts) -> Column:
    """The UTC wall-clock time of an instant, without a zone."""
    secs = (F.unix_micros(_c(ts)).cast("decimal(24,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, secs)
