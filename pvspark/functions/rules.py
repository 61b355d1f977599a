"""Column-valued business rules (no Python workers: every helper returns a JVM expression)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's behaviour -------------------------------
# Age-group bucket labels and their upper bounds (exclusive): <18, <35, <65, otherwise 65+.
AGE_BUCKETS = [(18, "0-17"), (35, "18-34"), (65, "35-64")]
AGE_TOP = "65+"
AGE_UNKNOWN = "unknown"
# Risk label thresholds on the serious-reaction percentage: <30 LOW, <70 MEDIUM, else HIGH.
RISK_THRESHOLDS = (30.0, 70.0)
# Label warning severity thresholds on warnings length: <500 LOW, <2000 MEDIUM, else HIGH.
WARNING_THRESHOLDS = (500, 2000)
# Allowed report severities.
VALID_SEVERITIES = (1, 2)
# ------------------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_key(c) -> Column:
    """Join-key normalisation ``upper(trim(x))`` (trim strips spaces only)."""
    return F.upper(F.trim(_c(c)))


_INT_LITERAL = r"^\s*[+-]?[0-9]+\s*$"


def lenient_int(c) -> Column:
    """Int parse that yields NULL for anything not an integer literal ('45.0', 'abc').

    Strings are screened with a regex first: a failing ``try_cast`` costs an exception per row
    inside the JVM (measured ~17x slower on a column that is mostly 'n/a'), the regex does not.
    ``try_cast`` still guards overflow."""
    x = _c(c)
    return F.when(x.cast("string").rlike(_INT_LITERAL), x.try_cast("int"))


def age_group(c) -> Column:
    """Bucket an age. Non-integers truncate (``int()`` semantics), unparsable -> unknown,
    negative ages fall in the first bucket."""
    # numeric input truncates (cheap); string input follows try_cast (use lenient_int first on
    # large string columns - see lenient_int)
    a = _c(c).try_cast("int")
    expr = F.when(a.isNull(), F.lit(AGE_UNKNOWN))
    for bound, label in AGE_BUCKETS:
        expr = expr.when(a < bound, F.lit(label))
    return expr.otherwise(F.lit(AGE_TOP))


def flag(c) -> Column:
    """S3 / P10: 1 iff the value parses to the integer 1, else 0 (never null)."""
    return F.when(lenient_int(c) == 1, F.lit(1)).otherwise(F.lit(0))


def zero_if_null_int(c) -> Column:
    """P10: outcome flag cast to int, null (or unparsable) -> 0."""
    return F.coalesce(lenient_int(c), F.lit(0))


def risk_label(c) -> Column:
    lo, hi = RISK_THRESHOLDS
    x = _c(c)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(x < lo, F.lit("LOW")).when(x < hi, F.lit("MEDIUM")).otherwise(F.lit("HIGH")))


def label_severity(c) -> Column:
    """Warning severity from the warnings length; null length counts as LOW."""
    lo, hi = WARNING_THRESHOLDS
    x = _c(c).try_cast("double")
    return (F.when(x.isNull() | (x < lo), F.lit("LOW")).when(x < hi, F.lit("MEDIUM"))
            .otherwise(F.lit("HIGH")))


def _strip(x: Column) -> Column:
    # Python str.strip(): all leading / trailing whitespace, not just spaces.
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def split_interactions(c) -> Column:
    """CSV -> array of stripped, non-empty pieces; null or blank -> empty array."""
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), ","), _strip)
    return F.filter(parts, lambda p: p != F.lit(""))


def blank(c) -> Column:
    """Falsy-string test used by the validity rules: null or empty."""
    x = _c(c)
    return x.isNull() | (x == F.lit(""))


def pct1(c) -> Column:
    """Display form ``x.x`` like Python's ``'{:.1f}'``: the exact double rounded half-even
    (``format_number``), without grouping separators."""
    return F.regexp_replace(F.format_number(_c(c).cast("double"), 1), ",", "")
