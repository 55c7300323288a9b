"""Column expressions (JVM-side, code-generated; no Python UDFs).

All of these return ``pyspark.sql.Column`` and can be used inside
``select``/``agg``. Weights and thresholds are parameters with the
reference values as defaults.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Interaction weights used by the recency-weighted score.
DEFAULT_INTERACTION_WEIGHTS = {"purchase": 5.0, "add_to_cart": 3.0, "view": 1.0}
DEFAULT_OTHER_WEIGHT = 0.5
# Exponential decay rate per day.
DEFAULT_DECAY_RATE = 0.1
# Hybrid score weights (interaction, recency, content).
DEFAULT_HYBRID_WEIGHTS = (0.5, 0.3, 0.2)
# Content match strengths (same brand, same category, other).
DEFAULT_CONTENT_MATCH = (1.0, 0.7, 0.2)
# Price band upper bounds, inclusive: Low < 500, Mid 500..2000,
# High 2000..5000, else Premium (NULL price falls through to Premium).
DEFAULT_PRICE_BANDS = (500.0, 2000.0, 5000.0)
# Activity classes by purchase frequency.
POWER_FREQUENCIES = ("very frequent", "high")
ACTIVE_FREQUENCIES = ("medium",)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_of_date(as_of) -> Column:
    """A DATE literal from a date/str, or ``current_date()`` when None."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.strftime("%Y-%m-%d")
    return F.lit(str(as_of)).cast("date")


def as_of_timestamp(as_of) -> Column:
    """A TIMESTAMP_NTZ literal (midnight of ``as_of``); current time when None."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, _dt.datetime):
        return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    if isinstance(as_of, _dt.date):
        as_of = as_of.strftime("%Y-%m-%d")
    s = str(as_of)
    if len(s) == 10:
        s += " 00:00:00"
    return F.lit(s).cast("timestamp_ntz")


def is_type(col, name: str) -> Column:
    """Case-insensitive interaction-type test (``lower(x) = name``)."""
    return F.lower(_c(col)) == F.lit(name)


#: A stored fact carries its types in lower case beside the published ones, under this name.
TYPE_KEY = "type_key"


def with_type_key(df: DataFrame, col: str = "InteractionType") -> DataFrame:
    """FLT4: the interaction type in lower case, so that a filter on it is a plain
    equality that reaches the scan."""
    return df.withColumn(TYPE_KEY, F.lower(col))


def age_group(age) -> Column:
    """Eight age labels; NULL age is 'Unknown'."""
    a = _c(age)
    return (F.when(a.isNull(), "Unknown")
            .when(a < 18, "Under 18")
            .when(a.between(18, 24), "18-24")
            .when(a.between(25, 34), "25-34")
            .when(a.between(35, 44), "35-44")
            .when(a.between(45, 54), "45-54")
            .when(a.between(55, 64), "55-64")
            .otherwise("65+"))


def price_band(price, bounds=DEFAULT_PRICE_BANDS) -> Column:
    """First match wins: exactly 2000 is Mid, 5000 is High, NULL is Premium."""
    p = _c(price)
    low, mid, high = bounds
    return (F.when(p < low, "Low")
            .when(p.between(low, mid), "Mid")
            .when(p.between(mid, high), "High")
            .otherwise("Premium"))


def interaction_weight(itype, weights=None, other=DEFAULT_OTHER_WEIGHT) -> Column:
    """Weight by lower-cased interaction type; unknown or NULL types get ``other``."""
    weights = weights or DEFAULT_INTERACTION_WEIGHTS
    t = F.lower(_c(itype))
    expr = None
    for name, w in weights.items():
        expr = (F.when(t == name, F.lit(float(w))) if expr is None
                else expr.when(t == name, F.lit(float(w))))
    return expr.otherwise(F.lit(float(other)))


def recency_decay(ts, as_of=None, rate=DEFAULT_DECAY_RATE) -> Column:
    """``exp(-rate * datediff(as_of, ts))`` in calendar days (future events > 1)."""
    return F.exp(F.lit(-float(rate)) * F.datediff(as_of_date(as_of), _c(ts)))


def content_match(brand_a, brand_b, cat_a, cat_b, strengths=DEFAULT_CONTENT_MATCH) -> Column:
    """Same brand -> 1.0, else same category -> 0.7, else 0.2 (NULL compares false)."""
    same_brand, same_cat, other = strengths
    return (F.when(_c(brand_a) == _c(brand_b), F.lit(same_brand))
            .when(_c(cat_a) == _c(cat_b), F.lit(same_cat))
            .otherwise(F.lit(other)))


def discount_percent(mrp, price, scale: int = 2) -> Column:
    """``round((MRP - Price) / MRP * 100, scale)``; NULL when MRP is 0 or NULL."""
    m, p = _c(mrp), _c(price)
    return F.when(m != 0, F.round((m - p) / m * 100, scale))


def activity_class(frequency) -> Column:
    """power / active / casual from the purchase-frequency label."""
    f = F.lower(F.coalesce(_c(frequency).cast("string"), F.lit("")))
    return (F.when(f.isin(*POWER_FREQUENCIES), "power")
            .when(f.isin(*ACTIVE_FREQUENCIES), "active")
            .otherwise("casual"))


def elapsed_days(ts, as_of_ts) -> Column:
    """Whole days elapsed (floor of elapsed seconds / 86400), not calendar days."""
    secs = F.unix_timestamp(as_of_ts.cast("timestamp")) - F.unix_timestamp(_c(ts).cast("timestamp"))
    return F.floor(secs / F.lit(86400)).cast("long")


def digits_only(col) -> Column:
    return F.regexp_replace(_c(col), "[^0-9]", "")
