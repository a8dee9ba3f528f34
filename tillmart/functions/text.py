"""Text helpers shared by the marts and the intake."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(date) -> Column:
    """``yyyy-MM`` of a date or timestamp; NULL stays NULL."""
    return F.substring(F.col(date).cast("string"), 1, 7)


def full_name(first, last) -> Column:
    """First and last name with a blank between; NULL if either part is NULL."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def pack_columns(columns) -> Column:
    """All unexpected cells of a row in one text.

    NULL cells are left out, so a row with none gives ``''``. No unexpected column at all
    gives NULL.
    """
    columns = list(columns)
    if not columns:
        return F.lit(None).cast("string")
    return F.concat_ws(", ", *columns)


def base_name(path) -> Column:
    """The part of a path after the last slash."""
    return F.element_at(F.split(F.col(path), "/"), -1)
