"""Parameters shared by the question operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TripWindow:
    """Days of month, hours of day and ranking size a question looks at.

    Days are days of the month over all months present; hours are independent of
    days, so hour 0 belongs to the listed day itself, not to the night before.
    """

    # The window behind the published results.
    days: tuple[int, ...] = (26, 27, 28)
    hours: tuple[int, ...] = (21, 22, 23, 0)
    top_k: int = 20

    @classmethod
    def spanning(cls, first_hour, first_day, top_k=20, n_hours=4, n_days=3) -> TripWindow:
        """Consecutive hours (wrapping at midnight) and consecutive days."""
        return cls(
            days=tuple(range(first_day, first_day + n_days)),
            hours=tuple(h % 24 for h in range(first_hour, first_hour + n_hours)),
            top_k=top_k,
        )

    @classmethod
    def from_seed(cls, seed: int) -> TripWindow:
        """Window picked by a number, as the published runs pick theirs."""
        return cls.spanning(first_hour=seed % 24, first_day=1 + seed % 26, top_k=10 + seed % 11)
