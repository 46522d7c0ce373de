"""Parameters of the stages. One name may have another value in another stage, so each stage has its own."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Row:
    """Right-of-way transects."""

    half: float = 250.0
    chord: float = 10.0
    tile: float = 300.0
    inset: float = 40.0
    inset_share: float = 0.35
    spacing: float = 25.0
    least: int = 5
    most: int = 40
    shortest: float = 8.0


@dataclass(frozen=True)
class Curb:
    """Curb stations and what is read off them."""

    spacing: float = 5.0
    chord: float = 10.0
    margin: float = 20.0
    floor: float = 25.0
    assumed: float = 40.0
    tile: float = 100.0
    corner: float = 30.0
    narrow: float = 18.0
    pinch: float = 24.0
    drop: float = 3.0
    shortest_run: float = 10.0
    band: float = 0.5
    covered: float = 0.8


#: Curb types.
STREET_CURBS, MEDIAN, SHOULDER, FLEX = (3110, 3120), 3130, 3140, 3150
