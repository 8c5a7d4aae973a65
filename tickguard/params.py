"""Parameters of the detectors. The defaults are the live feed's settings."""

from __future__ import annotations

from dataclasses import dataclass

MICROS = 1_000_000


@dataclass(frozen=True)
class WindowSpec:
    """Epoch-aligned, half-open sliding windows and the lateness a stream allows."""

    length_s: int = 60
    slide_s: int = 10
    lateness_s: int = 30

    def __post_init__(self):
        if not 0 < self.slide_s <= self.length_s:
            raise ValueError("slide must be positive and no longer than the window")

    @property
    def length(self) -> str:
        return f"{self.length_s} seconds"

    @property
    def slide(self) -> str:
        return f"{self.slide_s} seconds"

    @property
    def lateness(self) -> str:
        return f"{self.lateness_s} seconds"

    @property
    def panes(self) -> int | None:
        """Slides per window, or None when the slide does not divide the length."""
        whole, rest = divmod(self.length_s, self.slide_s)
        return None if rest else whole


@dataclass(frozen=True)
class VolatilityRule:
    """A window alerts when stddev / mean is strictly above the threshold."""

    threshold: float = 1e-5
    min_trades: int = 2


@dataclass(frozen=True)
class ZScoreRule:
    """A trade alerts when |z| is strictly above the threshold."""

    threshold: float = 3.0
    min_trades: int = 5


@dataclass(frozen=True)
class FeedRate:
    """Admission control of the streaming sources."""

    files_per_trigger: int = 10
    messages_per_trigger: int = 1000
    messages_per_shard: int = 100
    polls_per_trigger: int = 1         # at most, of a log that is behind
    trigger_s: int = 10

    @property
    def trigger(self) -> dict[str, str]:
        return {"processingTime": f"{self.trigger_s} seconds"}
