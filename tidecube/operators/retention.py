"""Contribution, retained users and retention rate of every period pair.

The columns are SQL expressions: there are 63 of them, all of one form.
"""

from __future__ import annotations

from tidecube.plans.options import Options
from tidecube.plans.periods import Pair


def contribution(pair: Pair) -> str:
    """Users the long period gained since the short one began."""
    return f"UU{pair.long} - {pair.key} AS {pair.contribution}"


def _still_active(pair: Pair, short: str) -> str:
    return f"UU{short} - UU{pair.long} + {pair.key}"


def retained(pair: Pair, options: Options) -> str:
    """Users of the short period who already were in the long one before it began.

    As written, the two columns for 2YTD subtract from the 3YTD users.
    """
    as_written = pair.short == "2YTD" and options.retained_2ytd == "as_written"
    return f"{_still_active(pair, '3YTD' if as_written else pair.short)} AS {pair.retained}"


def retention_rate(pair: Pair) -> str:
    """Retained users as a share of those who could be; 0 when nobody could."""
    share = f"try_divide(CAST({_still_active(pair, pair.short)} AS DOUBLE), {pair.key})"
    return f"coalesce({share}, 0.0D) AS {pair.rate}"


def pair_columns(pair: Pair, options: Options) -> list[str]:
    return [contribution(pair), retained(pair, options), retention_rate(pair)]
