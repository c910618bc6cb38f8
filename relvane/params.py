"""Parameters of the rolling evaluation, one record for each step of the job. The defaults are fixed values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Fit:
    """Rows back from a rebalance date: for the components, and for the tests of pairs, which need `overlap` common rows."""

    components: int = 252
    tests: int = 504
    overlap: int = 200


@dataclass(frozen=True)
class Pick:
    """What a tested pair must be to be held, and how many are."""

    most: int = 10
    p: float = 0.05
    half_life: tuple[float, float] = (5.0, 60.0)
    overlap: int = 200


@dataclass(frozen=True)
class Trade:
    """Bounds of the rolling z-score, in deviations, and the most rows a position is held; None: no bound."""

    rows: int = 60
    enter: float = 2.0
    leave: float = 0.5
    stop: float | None = 4.0
    hold: int | None = 60
