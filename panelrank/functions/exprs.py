"""Column expressions (all JVM-side, no Python per row).

Each helper returns a ``Column`` so callers compose them inside one
``select``; Catalyst folds them into a single whole-stage-codegen span.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelrank import constants as K


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- predicates
def is_true(c) -> Column:
    """Three-valued flag test: NULL and FALSE are both 'not true' (F01)."""
    return F.coalesce(col(c), F.lit(False))


def is_not_true(c) -> Column:
    return ~is_true(c)


def masked(value, flag) -> Column:
    """``CASE WHEN flag IS TRUE THEN value ELSE 0 END``."""
    return F.when(is_true(flag), col(value)).otherwise(F.lit(0))


# ---------------------------------------------------------------- numerics
def nan_to_null(c) -> Column:
    """NaN and +-Inf become NULL (D-02)."""
    x = col(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None).cast("double")).otherwise(x)


def clip(c, lo=None, hi=None) -> Column:
    x = col(c)
    if lo is not None:
        x = F.greatest(x, F.lit(lo))
    if hi is not None:
        x = F.least(x, F.lit(hi))
    return x


def ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def round_ratio(num, den, scale: int, times: int = 1) -> Column:
    """round(num * times / den, scale), half away from zero, on integers.

    Exact for integer inputs (no float rounding of the quotient), so two
    engines give the same bits. NULL when den is 0.
    """
    p = 10 ** scale
    n = col(num).cast("long") * F.lit(times * p)
    d = col(den).cast("long")
    a = F.abs(n) * 2 + F.abs(d)
    b = F.abs(d) * 2
    # exact floor(a / b) for non-negative longs: a - pmod(a, b) is a multiple of b
    q = ((a - F.pmod(a, b)) / b).cast("long")
    q = F.when(d == 0, F.lit(None).cast("long")).otherwise(F.signum(n).cast("long") * F.signum(d).cast("long") * q)
    return q / F.lit(float(p))


def log1p0(c) -> Column:
    """log1p on a zero-filled count (counts are >= 0, so no NULL arises)."""
    return F.log1p(col(c).cast("double"))


# ---------------------------------------------------------------- coercion
def numeric_coerce(c, dtype: str = "double") -> Column:
    """Bad text -> NULL (C01). ``try_cast`` because ANSI mode raises on cast."""
    return nan_to_null(F.expr(f"try_cast(`{c}` as {dtype})") if isinstance(c, str) else c.try_cast(dtype))


def bool_coerce(c) -> Column:
    """true/1/yes/y in any case -> true, else false."""
    return F.coalesce(F.lower(col(c).cast("string")).isin(*K.BOOLEAN_TRUE_TEXT), F.lit(False))


def category_normalize(c) -> Column:
    """NULL, '' and 'nan' -> 'unknown' (C03); exact match, no trim."""
    s = col(c).cast("string")
    return F.when(s.isNull() | s.isin(*K.CATEGORY_BLANKS), F.lit(K.UNKNOWN)).otherwise(s)


# ---------------------------------------------------------------- tiers
def _chain(pairs, otherwise) -> Column:
    out = None
    for cond, label in pairs:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def age_tier(c="content_age_days") -> Column:
    x = col(c)
    return _chain([(x.isNull(), None)] + [(x <= hi, lab) for lab, hi, _ in K.AGE_TIERS], K.AGE_TIER_TOP[0])


def age_tier_order(c="content_age_days") -> Column:
    x = col(c)
    return _chain([(x.isNull(), None)] + [(x <= hi, o) for _, hi, o in K.AGE_TIERS], K.AGE_TIER_TOP[1]).cast("int")


def freshness_tier(c="days_since_last_update") -> Column:
    x = col(c)
    return _chain([(x.isNull(), K.FRESHNESS_NEVER)] + [(x <= hi, lab) for lab, hi in K.FRESHNESS_TIERS],
                  K.FRESHNESS_TOP)


def word_count_tier(c="word_count") -> Column:
    x = col(c)
    return _chain([(x.isNull(), None)] + [(x < hi, lab) for lab, hi in K.WORD_COUNT_TIERS], K.WORD_COUNT_TOP)


def char_count_tier(c="char_count") -> Column:
    x = col(c)
    return _chain([(x.isNull(), None)] + [(x < hi, lab) for lab, hi in K.CHAR_COUNT_TIERS], K.CHAR_COUNT_TOP)


def impression_tier(c="impressions_90d", has_source=None) -> Column:
    x = col(c)
    no_source = x.isNull() if has_source is None else (x.isNull() | is_not_true(has_source))
    return _chain([(no_source, "no_data"), (x <= 0, "none")] + [(x >= lo, lab) for lab, lo in K.IMPRESSION_TIERS],
                  "low")


def position_tier(c="avg_position") -> Column:
    x = col(c)
    return _chain([(x.isNull() | (x <= 0), "no_data")] + [(x <= hi, lab) for lab, hi in K.POSITION_TIERS],
                  K.POSITION_TOP)


def position_tier_exact(num, den) -> Column:
    """Position tier of the ratio num / den without dividing: ``num <= edge * den``."""
    n, d = col(num), col(den)
    return _chain([(d.isNull() | (d <= 0) | n.isNull() | (n <= 0), "no_data")]
                  + [(n <= d * hi, lab) for lab, hi in K.POSITION_TIERS], K.POSITION_TOP)


def competition_level(c="competition") -> Column:
    x = col(c)
    return _chain([(x.isNull(), None)] + [(x < hi, lab) for lab, hi in K.COMPETITION_LEVELS], K.COMPETITION_TOP)


def trend_direction(last, prev, band: float = K.TREND_BAND) -> Column:
    """new / flat / up / down / stable from two window totals.

    Compares ``last`` with ``(1 +- band) * prev``; no division, so no NULL.
    """
    lo, p = col(last), col(prev)
    return (F.when((p == 0) & (lo > 0), F.lit("new"))
            .when((p == 0) & (lo == 0), F.lit("flat"))
            .when(lo > (1 + band) * p, F.lit("up"))
            .when(lo < (1 - band) * p, F.lit("down"))
            .otherwise(F.lit("stable")))


def trend_pct(last, prev) -> Column:
    """(last - prev) / prev * 100 at 1 dp; NULL when prev = 0 (C14)."""
    return round_ratio(col(last) - col(prev), prev, 1, times=100)


# ---------------------------------------------------------------- arrays
def any_of(*conds) -> Column:
    return reduce(lambda a, b: a | b, conds)


def has_any(arr, codes) -> Column:
    """Set intersection test on a code array."""
    return F.arrays_overlap(col(arr), F.array(*[F.lit(c) for c in codes]))


def code_list(pairs) -> Column:
    """Ordered array of the codes whose condition holds (NULLs dropped)."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(code)) for cond, code in pairs]))


def short_action(c) -> Column:
    m = F.create_map(*[x for kv in K.SHORT_ACTION.items() for x in map(F.lit, kv)])
    return F.coalesce(m[col(c)], col(c))
