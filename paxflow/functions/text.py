"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def upper_trim(c) -> Column:
    return F.upper(F.trim(F.col(c) if isinstance(c, str) else c))


def code_list(c) -> Column:
    """Comma separated codes held as data -> array of trimmed upper codes."""
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.transform(F.split(col, ","), lambda x: F.upper(F.trim(x))), lambda x: x != "")
