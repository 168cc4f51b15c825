"""Dates in several text formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: English month names by number, as the formats MMM (the first three letters) and MMMM have them.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def _made(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, month, day).try_cast("date")


def parse_date(c: Column) -> Column:
    """The date of a text of the form yyyy-MM-dd, d/M/yyyy, d-M-yyyy, d MMM yyyy or d MMMM yyyy; null for any other text or impossible date.

    The form is told by a pattern and the parts are cast, so that no format is tried in vain and a bad date is no exception.
    """
    number = {}
    for i, name in enumerate(MONTHS, 1):
        number |= {name: f"{i:02d}", name[:3]: f"{i:02d}"}
    names = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])
    part = lambda mark, i: F.split_part(c, F.lit(mark), F.lit(i))
    month = F.element_at(names, F.lower(part(" ", 2)))
    return (
        F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))
        .when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), _made(part("/", 3), part("/", 2), part("/", 1)))
        .when(c.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), _made(part("-", 3), part("-", 2), part("-", 1)))
        .when(c.rlike(r"^\d{1,2} [A-Za-z]{3,9} \d{4}$") & month.isNotNull(), _made(part(" ", 3), month, part(" ", 1)))
    )
