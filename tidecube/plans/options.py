"""What a cube run can be asked to do differently."""

from __future__ import annotations

from dataclasses import dataclass

from tidecube.operators.dimensions import COMPANY, PAYMENT_TYPE, Dimension


@dataclass(frozen=True)
class Options:
    """Defaults give the published formulas as they are written.

    ``dth_average``: ``"as_written"`` takes the day's averages from the month-wide
    running value; ``"day"`` averages over the day itself.
    ``retained_2ytd``: ``"as_written"`` uses the three-year users in the two
    "retained since 2YTD" columns; ``"fixed"`` uses the two-year users.
    ``two_month``: adds the odd-month two-month period and its five metrics.
    ``hour_offset``: shifts the hour of day (not the date) of every transaction.
    ``dimensions``: cube dimensions; more than the two default ones may be given.
    """

    dth_average: str = "as_written"
    retained_2ytd: str = "as_written"
    two_month: bool = False
    hour_offset: int = 0
    dimensions: tuple[Dimension, ...] = (PAYMENT_TYPE, COMPANY)

    def __post_init__(self) -> None:
        if self.dth_average not in ("as_written", "day"):
            raise ValueError(f"dth_average: {self.dth_average!r}")
        if self.retained_2ytd not in ("as_written", "fixed"):
            raise ValueError(f"retained_2ytd: {self.retained_2ytd!r}")
        if not {PAYMENT_TYPE, COMPANY} <= set(self.dimensions):
            raise ValueError("PaymentType and CompanyId are always cube dimensions")

    @property
    def dimension_names(self) -> list[str]:
        return [d.name for d in self.dimensions]

    @property
    def extra_dimensions(self) -> list[Dimension]:
        return [d for d in self.dimensions if d not in (PAYMENT_TYPE, COMPANY)]
