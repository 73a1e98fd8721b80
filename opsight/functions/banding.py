"""Band labels for elapsed times and durations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Band:
    """One labelled test. ``low``/``high`` are the ends; the flags say whether each end belongs to it."""

    label: str
    low: float | None = None
    high: float | None = None
    low_in: bool = True
    high_in: bool = True

    def test(self, value: Column) -> Column:
        parts = []
        if self.low is not None:
            parts.append(value >= F.lit(self.low) if self.low_in else value > F.lit(self.low))
        if self.high is not None:
            parts.append(value <= F.lit(self.high) if self.high_in else value < F.lit(self.high))
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return out


@dataclass(frozen=True)
class BandSpec:
    """Bands tried in order. ``otherwise`` labels what no test accepts, NULL values included;
    ``None`` leaves those rows with the value as text (NULL stays NULL)."""

    bands: tuple[Band, ...]
    otherwise: str | None = None

    def label(self, value: Column) -> Column:
        out = F
        for band in self.bands:
            out = out.when(band.test(value), F.lit(band.label))
        rest = F.lit(self.otherwise) if self.otherwise is not None else value.cast("string")
        return out.otherwise(rest)


# Labels and edges that reports compare by name.
ELAPSED_LEGACY = BandSpec(
    (
        Band("lt_5", high=5, high_in=False),
        Band("between_06-10", 6, 10),
        Band("between_10-30", 10, 30),
        Band("between_31-60", 31, 60),
        Band("between_61-120", 61, 120),
    ),
    otherwise="gt_120",
)
ELAPSED_ROWS_LEGACY = BandSpec(
    (
        Band("lt_10", high=10, high_in=False),
        Band("between_10-30", 10, 30),
        Band("between_31-60", 31, 60),
        Band("between_61-120", 61, 120),
    ),
    otherwise="gt_120",
)
MINUTES_LONG = BandSpec(
    (
        Band("gt_240", low=240, low_in=False),
        Band("between_121_240", 121, 240),
        Band("between_60_120", 60, 120),
        Band("0", 0, 0),
    ),
    otherwise="lt_60",
)
MINUTES_SHORT = BandSpec(
    (
        Band("lt_10", high=10, high_in=False),
        Band("between_10-20", 10, 20),
        Band("between_21-30", 21, 30),
        Band("gt_30", low=30, low_in=False),
    ),
)
HOURS_COARSE = BandSpec(
    (
        Band("lt_5", high=5, high_in=False),
        Band("between_05-10", 5, 10),
    ),
    otherwise="gt_10",
)


def contiguous(edges: list[float], unknown: str = "unknown") -> BandSpec:
    """Gap-free bands: below the first edge, between neighbours, from the last edge on; NULL is apart."""
    bands = [Band(f"lt_{edges[0]:g}", high=edges[0], high_in=False)]
    for low, high in zip(edges, edges[1:]):
        bands.append(Band(f"{low:g}_to_{high:g}", low, high, high_in=False))
    bands.append(Band(f"ge_{edges[-1]:g}", low=edges[-1]))
    return BandSpec(tuple(bands), otherwise=unknown)


def capped(value: Column, cap: int) -> Column:
    """The whole value as text, everything above the cap in one ``gt_<cap>`` band."""
    return F.when(value > cap, F.lit(f"gt_{cap}")).otherwise(value.cast("string"))
