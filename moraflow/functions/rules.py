"""Business rules as native Column expressions (no UDFs, whole-stage codegen all through)."""

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from moraflow.functions import fixed_values as fv

MEAN_PLACES = 9


# ---- casts, filters, defaults ----------------------------------------------------------------

def safe_long(c: Column) -> Column:
    """Integer value of a text column, null where it is not a number."""
    return c.try_cast("bigint")


def within_days(ts: Column, first: date, last: date) -> Column:
    """Timestamp falls on a day in [first, last]; raw bounds, so the filter reaches the Parquet scan."""
    return (ts >= F.lit(first)) & (ts < F.lit(last + timedelta(days=1)))


def or_default(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


# ---- exact sums and ratios -------------------------------------------------------------------

def cents(c: Column) -> Column:
    """Amount in whole cents, as a long: exact sums in any order, at the cost of primitive arithmetic.

    NaN and infinite amounts fail the cast (ANSI mode). Amounts are in whole cents by contract; others are rounded.
    """
    return F.rint(c * 100).cast("bigint")


def from_cents(total: Column) -> Column:
    return F.coalesce(total, F.lit(0)).cast("double") / 100


def money_sum(c: Column) -> Column:
    """Order-independent money total, 0 for no rows."""
    return from_cents(F.sum(cents(c)))


def ratio(num: Column, den: Column) -> Column:
    """num/den at full precision, null on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num/den, 0 unless the denominator is positive."""
    return F.coalesce(F.when(den > 0, ratio(num, den)), F.lit(0.0))


def millionths(c: Column) -> Column:
    """Rate with at most six places, in whole millionths, as a long."""
    return F.floor(c * 1_000_000 + 0.5)


def mean_of(c: Column) -> Column:
    """Order-independent mean of a ratio column: summed exactly with 15 places, the mean given with MEAN_PLACES."""
    return F.round(ratio(F.sum(c.cast("decimal(28,15)")), F.count(c)), MEAN_PLACES)


# ---- assignment rules ------------------------------------------------------------------------

def portfolio(file_name: Column, alternates: bool = True) -> Column:
    """Portfolio type from the file name; `alternates=False` keeps only the first fragment per type."""
    name = F.upper(file_name)
    rule = F
    for label, fragments in fv.PORTFOLIO_FRAGMENTS:
        hit = name.contains(fragments[0])
        for other in fragments[1:] if alternates else []:
            hit = hit | name.contains(other)
        rule = rule.when(hit, label)
    return rule.otherwise(fv.PORTFOLIO_OTHER)


def objective(segment: Column, late_rate: bool = True) -> Column:
    """Recovery objective of a segment; `late_rate=False` drops the separate rate for TARDIA."""
    rule = F
    for label, rate in fv.OBJECTIVE_BY_SEGMENT.items():
        if label != "TARDIA" or late_rate:
            rule = rule.when(segment == label, F.lit(rate))
    return rule.otherwise(fv.OBJECTIVE_DEFAULT)


def due_category(due: Column, ref: Column, sentinel: bool = False) -> Column:
    """Due-date category against a reference date; `sentinel` reads 1900-01-01 as no due date."""
    missing = due.isNull() | (due == F.lit(fv.MISSING_DUE_DATE)) if sentinel else due.isNull()
    rule = F.when(missing, fv.DUE_NONE).when(due <= ref, fv.DUE_PAST)
    for days, label in fv.DUE_WITHIN:
        rule = rule.when(due <= F.date_add(ref, days), label)
    return rule.otherwise(fv.DUE_LATER)


def instalment_type(flag: Column) -> Column:
    return F.when(flag == "SI", "FRACCIONADO").otherwise("NORMAL")


def segment_label(segment: Column, instalment: Column, quota: Column) -> Column:
    """Segment text with instalment and quota suffixes."""
    has_quota = quota.isNotNull() & ~F.trim(quota).isin("", "0")
    text = F.concat(
        or_default(segment, ""),
        F.when(instalment == "SI", " - FRACCIONADO").otherwise(""),
        F.when(has_quota, F.concat(F.lit(" - CUOTA_"), quota)).otherwise(""),
    )
    return or_default(F.nullif(text, F.lit("")), fv.NOT_SPECIFIED)


# ---- interaction rules -----------------------------------------------------------------------

def detailed_response(n1: Column, n2: Column, n3: Column, management: Column) -> Column:
    """Non-blank levels joined by ' - ', else the management text, else the default."""
    levels = [F.nullif(F.trim(n), F.lit("")) for n in (n1, n2, n3)]
    return F.coalesce(F.nullif(F.concat_ws(" - ", *levels), F.lit("")), management, F.lit(fv.NOT_AVAILABLE))


def is_effective_like(management: Column) -> Column:
    """Effective contact by fragment, any case."""
    return F.coalesce(F.upper(management).contains(fv.EFFECTIVE_FRAGMENT), F.lit(False))


def is_effective_exact(management: Column) -> Column:
    """Effective contact by the two accepted spellings."""
    return F.coalesce(management.isin(fv.EFFECTIVE_SPELLINGS), F.lit(False))


def declares_commitment(management: Column) -> Column:
    return F.coalesce(management.rlike(fv.COMMITMENT_PATTERN), F.lit(False))


# ---- payment attribution rules ---------------------------------------------------------------

def _promised(is_promise: Column) -> Column:
    return F.coalesce(is_promise == 1, F.lit(False))


def paid_with_promise(is_promise: Column) -> Column:
    return _promised(is_promise)


def promise_was_live(is_promise: Column, promised_for: Column, paid_on: Column) -> Column:
    live = paid_on.between(promised_for, F.date_add(promised_for, 7))
    return _promised(is_promise) & F.coalesce(live, F.lit(False))


def paid_on_time(is_promise: Column, promised_for: Column, paid_on: Column) -> Column:
    return _promised(is_promise) & F.coalesce(paid_on == promised_for, F.lit(False))


def attribution_score(is_promise: Column, promised_for: Column, paid_on: Column, contacted_on: Column) -> Column:
    promised = _promised(is_promise)
    return (
        F.when(promised & (paid_on == promised_for), 1.0)
        .when(promised & (paid_on <= F.date_add(promised_for, 3)), 0.8)
        .when(promised & (paid_on <= F.date_add(promised_for, 7)), 0.6)
        .when(F.datediff(paid_on, contacted_on) <= 7, 0.4)
        .when(contacted_on.isNotNull(), 0.2)
        .otherwise(0.0)
    )


# ---- labels ----------------------------------------------------------------------------------

def objective_status(attainment: Column) -> Column:
    return (
        F.when(attainment >= 1.0, fv.STATUS_EXCEEDED)
        .when(attainment >= 0.8, fv.STATUS_IN_RANGE)
        .otherwise(fv.STATUS_BELOW)
    )


def check_label(cases: Column) -> Column:
    return F.when(cases == 0, fv.CHECK_OK).when(cases < 1000, fv.CHECK_REVIEW).otherwise(fv.CHECK_PROBLEM)


def day_text(d: Column) -> Column:
    return F.date_format(d, "dd/MM/yyyy")
