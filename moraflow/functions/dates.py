"""Dates from file names, and Easter, as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dated(year: Column, month: Column, day: Column) -> Column:
    """Date of three digit texts, null where there is no such day."""
    # A cast parses without a formatter and without raising for invalid dates.
    dash = F.lit("-")
    return F.when(year != "0000", F.concat(year, dash, month, dash, day).try_cast("date"))


def file_date(file_name: Column, year: Column) -> Column:
    """Date in a file name: YYYYMMDD, then TRAN_DEUDA_DDMM of `year`, then DDMMYYYY.

    An invalid date in one pattern falls through to the next.
    """
    # No match gives an empty text, which is no date.
    eight = F.regexp_extract(file_name, r"(\d{8})", 1)
    four = F.regexp_extract(file_name, r"TRAN_DEUDA_(\d{4})", 1)
    return F.coalesce(
        _dated(F.substring(eight, 1, 4), F.substring(eight, 5, 2), F.substring(eight, 7, 2)),
        _dated(F.lpad(year.cast("string"), 4, "0"), F.substring(four, 3, 2), F.substring(four, 1, 2)),
        _dated(F.substring(eight, 5, 4), F.substring(eight, 3, 2), F.substring(eight, 1, 2)),
    )


def debt_date(file_name: Column, created: Column) -> Column:
    """Date of a debt file: DDMM in its name with the year of `created`, else the day of `created`.

    Null where the name holds an impossible date.
    """
    four = F.regexp_extract(file_name, r"TRAN_DEUDA_(\d{4})", 1)
    named = _dated(
        F.lpad(F.year(created).cast("string"), 4, "0"), F.substring(four, 3, 2), F.substring(four, 1, 2)
    )
    return F.when(four != "", named).otherwise(F.to_date(created))


def easter(year: Column) -> Column:
    """Gregorian Easter Sunday (Oudin's integer method)."""
    def div(a, b):
        return F.floor(a / b)

    golden = year % 19
    century = div(year, 100)
    epact = (century - div(century, 4) - div(8 * century + 13, 25) + 19 * golden + 15) % 30
    late = div(epact, 28)
    moon = epact - late * (1 - late * div(F.lit(29), epact + 1) * div(21 - golden, 11))
    weekday = (year + div(year, 4) + moon + 2 - century + div(century, 4)) % 7
    return F.date_add(F.make_date(year, F.lit(3), F.lit(1)), (moon - weekday + 27).cast("int"))
