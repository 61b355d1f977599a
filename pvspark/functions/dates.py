"""Date helpers: report date parsing, publication dates from XML parts, epoch conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's behaviour -------------------------------
# Month abbreviations accepted in publication dates and their numbers.
MONTHS = {"Jan": "01", "Feb": "02", "Mar": "03", "Apr": "04", "May": "05", "Jun": "06",
          "Jul": "07", "Aug": "08", "Sep": "09", "Oct": "10", "Nov": "11", "Dec": "12"}
DEFAULT_MONTH = "01"
# ------------------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def report_date(c) -> Column:
    """``yyyyMMdd`` string -> DATE, NULL when it does not parse (ANSI-safe)."""
    return F.try_to_date(_c(c), "yyyyMMdd")


def _digits(x: Column) -> Column:
    return x.rlike(r"^[0-9]+$")


def month_number(month) -> Column:
    """Month text -> two-digit month: name, number (zero-padded, never truncated) or 01."""
    m = _c(month)
    mapping = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    return (F.when(m.isNull() | (m == ""), F.lit(DEFAULT_MONTH))
            .when(F.element_at(mapping, m).isNotNull(), F.element_at(mapping, m))
            .when(_digits(m), F.when(F.length(m) < 2, F.lpad(m, 2, "0")).otherwise(m))
            .otherwise(F.lit(DEFAULT_MONTH)))


def pub_date(year, month, medline) -> Column:
    """``Year`` if present, else the first token of ``MedlineDate`` when all digits;
    month normalised; day 01; NULL without a year. Returns the ``yyyy-MM-01`` string."""
    y = _c(year)
    token = F.get(F.split(F.trim(F.coalesce(_c(medline), F.lit(""))), " "), 0)
    yr = (F.when(y.isNotNull() & (y != ""), y)
          .when(token.isNotNull() & _digits(token), token))
    return F.when(yr.isNotNull(), F.concat_ws("-", yr, month_number(month), F.lit("01")))


def iso_from_epoch(c) -> Column:
    """Epoch seconds -> TIMESTAMP (UTC session)."""
    return F.timestamp_seconds(_c(c).try_cast("double"))
