from pyspark.sql import Column, functions as F


def as_col(c) -> Column:
    """Accept a Column or a column name."""
    return c if isinstance(c, Column) else F.col(c)


def let(value: Column, f) -> Column:
    """``f(value)`` with the value as a lambda variable: an expression that ``f``
    uses many times is in the plan, and computed for a row, once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))
