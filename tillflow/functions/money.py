"""Money totals that do not depend on the order rows arrive in.

A double sum changes in its last digits with the order of its inputs, so two
runs of one query on a cluster disagree.  Amounts that are whole cents are
summed as integers instead.  A group holding any amount that is not (more
decimals, NaN, infinity, beyond the integer range) is summed as doubles, so no
value is dropped or rounded away.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_cents(amount: Column) -> Column:
    """The amount in cents, or null where it is not a whole number of cents."""
    cents = F.rint(amount * 100).try_cast("bigint")
    return F.when(cents / F.lit(100.0) == amount, cents)


def cents_total(cents: Column, amount: Column, count_cents: Column, count_amount: Column) -> Column:
    exact = F.when(count_cents == count_amount, F.try_sum(cents) / F.lit(100.0))
    return F.coalesce(exact, F.sum(amount))


def money_sum(amount: Column) -> Column:
    cents = whole_cents(amount)
    return cents_total(cents, amount, F.count(cents), F.count(amount))


def money_avg(amount: Column) -> Column:
    return F.try_divide(money_sum(amount), F.count(amount))


def revenue_sum(quantity: Column, price: Column) -> Column:
    """Sum of quantity x price."""
    amount = quantity * price
    cents = F.try_multiply(quantity.cast("bigint"), whole_cents(price))
    return cents_total(cents, amount, F.count(cents), F.count(amount))


def _near_cents(amount: Column) -> Column:
    """The amount in cents as a double, whole or not."""
    return F.rint(amount * 100)


def _exact(cents: Column) -> Column:
    return F.abs(cents) < F.lit(float(2**53))


def rounded(amount: Column) -> Column:
    """``round(amount, 2)``, half up on the decimal text.

    Most amounts have two decimals already; only the others need the decimal
    arithmetic behind ``round``.
    """
    cents = _near_cents(amount)
    return F.when((cents / 100.0 == amount) & _exact(cents), amount).otherwise(F.round(amount, 2))


def line_total(quantity: Column, price: Column) -> Column:
    """``round(quantity * price, 2)``, by way of whole cents where the price has them."""
    cents = _near_cents(price)
    total = quantity * cents
    return F.when((cents / 100.0 == price) & _exact(total), total / 100.0).otherwise(F.round(quantity * price, 2))
