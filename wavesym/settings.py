"""What to compute (`Spec`) and how to lay it out on a cluster (`Scale`)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Spec:
    """Parameters of the analysis; the defaults are fixed values that results depend on."""

    lookback: int = 16  # rows before the current one in the moving average: a frame of 17
    probs: tuple[float, ...] = (0.2, 0.4, 0.6, 0.8)
    accuracy: int = 10_000  # of the approximate percentiles: rank error at most 1/accuracy
    word_lengths: tuple[int, ...] = (6, 7)

    @property
    def letters(self) -> str:
        return "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[: len(self.probs) + 1]

    @property
    def reach(self) -> int:
        """Points a word can extend past the point it starts on."""
        return max(self.word_lengths) - 1


@dataclass(frozen=True)
class Scale:
    """Limits that keep one task's share of the data bounded, whatever the key distribution.

    A key is *hot* when it holds more than ``hot_rows`` rows, however many rows there are. Hot keys are a stored
    table, which is broadcast up to ``hot_keys`` rows and joined by a shuffle beyond.
    """

    segment: int = 4096  # points per array row
    fan: int = 4096  # segments whose moments are combined at once
    hot_rows: int = 4_000_000
    gathered: int = 65_536  # points of an id that are sorted in one array
    hot_keys: int = 100_000
    bucket_points: int = 32_000_000  # of segments that are stored by id, a bucket's
    broadcast_rows: int = 200_000  # short rows a broadcast table may have, counted beforehand
    task_points: tuple[int, int] = (50_000, 64_000_000)  # whose words one task counts: few, many
