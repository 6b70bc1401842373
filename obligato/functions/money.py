"""Money expressions.

Amounts are stored as doubles. A double sum depends on the order in which tasks finish, so
every sum runs on exact decimals (no fraction of a cent is cut) and only the finished total becomes a
double again. Loads refuse amounts that do not fit, so no sum of loaded data can fail.
"""

from pyspark.sql import Column, functions as F


MAX_AMOUNT = 1e20


def exact(amount: Column) -> Column:
    return amount.cast("decimal(28,6)")


def unfit(amount: Column) -> Column:
    """Amounts that no exact sum can hold: not a number, infinite or beyond any budget."""
    return F.isnan(amount) | (F.abs(amount) >= MAX_AMOUNT)


def exact_sum(amount: Column) -> Column:
    return F.sum(exact(amount)).cast("double")


def amount_text(amount: Column) -> Column:
    """Plain decimal notation; a bare cast would print large doubles as 1.725E7."""
    return amount.cast("decimal(20,2)").cast("string")
