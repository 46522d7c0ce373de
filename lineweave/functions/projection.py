"""Lambert conformal conic with two parallels, geographic degrees to and from feet, as column arithmetic.

The default is the northern zone of Oregon's state plane in international feet on the GRS80 ellipsoid (EPSG:2913). No
datum shift is made between its datum and that of the degrees: about a metre at most, and not verified here.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

FOOT = 0.3048


@dataclass(frozen=True)
class Conic:
    lon0: float = -120.5
    lat0: float = 43 + 2 / 3
    lat1: float = 44 + 1 / 3
    lat2: float = 46.0
    x0: float = 2_500_000.0  #: metres
    y0: float = 0.0
    a: float = 6_378_137.0
    f: float = 1 / 298.257222101
    unit: float = FOOT

    @property
    def e(self) -> float:
        return math.sqrt(2 * self.f - self.f**2)

    def _t(self, lat: float) -> float:
        s = self.e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (self.e / 2)

    def _m(self, lat: float) -> float:
        return math.cos(lat) / math.sqrt(1 - (self.e * math.sin(lat)) ** 2)

    @property
    def constants(self) -> tuple[float, float, float]:
        """Cone constant, scale, and radius of the origin's parallel."""
        one, two = math.radians(self.lat1), math.radians(self.lat2)
        n = (math.log(self._m(one)) - math.log(self._m(two))) / (math.log(self._t(one)) - math.log(self._t(two)))
        scale = self._m(one) / (n * self._t(one) ** n)
        return n, scale, self.a * scale * self._t(math.radians(self.lat0)) ** n


def to_feet(lon: Column, lat: Column, zone: Conic = Conic()) -> tuple[Column, Column]:
    n, scale, rho0 = zone.constants
    phi, e = F.radians(lat), zone.e
    s = e * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(e / 2))
    rho, theta = zone.a * scale * F.pow(t, F.lit(n)), n * F.radians(lon - zone.lon0)
    return (zone.x0 + rho * F.sin(theta)) / zone.unit, (zone.y0 + rho0 - rho * F.cos(theta)) / zone.unit


def to_degrees(x: Column, y: Column, zone: Conic = Conic(), rounds: int = 6) -> tuple[Column, Column]:
    n, scale, rho0 = zone.constants
    dx, dy = x * zone.unit - zone.x0, rho0 - (y * zone.unit - zone.y0)
    t = F.pow(F.sqrt(dx * dx + dy * dy) / (zone.a * scale), F.lit(1 / n))
    phi = math.pi / 2 - 2 * F.atan(t)
    for _ in range(rounds):
        s = zone.e * F.sin(phi)
        phi = math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(zone.e / 2)))
    return F.degrees(F.atan2(dx, dy) / n) + zone.lon0, F.degrees(phi)


def project(parts: Column, zone: Conic = Conic(), inverse: bool = False) -> Column:
    """A geometry in the other coordinates."""
    turn = to_degrees if inverse else to_feet

    def one(p: Column) -> Column:
        x, y = turn(p["x"], p["y"], zone)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(parts, lambda part: F.transform(part, one))
