"""Projections, angles, temperature and reflectance as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84
A = 6378137.0
E2 = 0.00669437999014
_E = math.sqrt(E2)


def _rad(x: Column) -> Column:
    return F.radians(x)


class SceneProjection:
    """Local metres around a centre: oblique Mercator with azimuth 0 and scale 1 (Snyder 1987, Hotine), minus the centre.

    With azimuth 0 the central line runs north through the centre, the angle at the equator vanishes and the general
    formulas reduce to a transverse form on the Gaussian sphere of the centre's latitude.
    """

    def __init__(self, lat: float, lon: float):
        phi = math.radians(lat)
        self.lon = math.radians(lon)
        s, c = math.sin(phi), math.cos(phi)
        self.b = math.sqrt(1 + E2 * c**4 / (1 - E2))
        self.a = A * self.b * math.sqrt(1 - E2) / (1 - E2 * s * s)
        t0 = self._t(phi)
        d = max(1.0, self.b * math.sqrt(1 - E2) / (c * math.sqrt(1 - E2 * s * s)))
        sign = 1.0 if lat >= 0 else -1.0
        self.f = d + sign * math.sqrt(max(0.0, d * d - 1))
        self.e = self.f * t0**self.b
        # the centre lies at u = (a / b) atan2(sqrt(d^2 - 1), cos 0)
        self.u0 = sign * self.a / self.b * math.atan2(math.sqrt(max(0.0, d * d - 1)), 1.0)

    @staticmethod
    def _t(phi: float) -> float:
        s = _E * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (_E / 2)

    def forward(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        """East and north of the centre in metres."""
        phi = _rad(lat)
        s = F.sin(phi) * _E
        t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(_E / 2))
        q = F.lit(self.e) / F.pow(t, F.lit(self.b))
        sinh, cosh = (q - 1 / q) / 2, (q + 1 / q) / 2
        turn = (_rad(lon) - self.lon) * self.b
        big_u = -F.sin(turn) / cosh  # the angle at the equator is 0
        v = F.log((1 - big_u) / (1 + big_u)) * (self.a / (2 * self.b))
        u = F.atan2(sinh, F.cos(turn)) * (self.a / self.b)
        return v, u - self.u0

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Latitude and longitude in degrees."""
        q = F.exp(-x * (self.b / self.a))
        sinh, cosh = (q - 1 / q) / 2, (q + 1 / q) / 2
        angle = (y + self.u0) * (self.b / self.a)
        big_u = F.sin(angle) / cosh
        t = F.pow(F.lit(self.e) / F.sqrt((1 + big_u) / (1 - big_u)), F.lit(1 / self.b))
        chi = F.lit(math.pi / 2) - 2 * F.atan(t)
        e2, e4, e6, e8 = E2, E2**2, E2**3, E2**4
        phi = (
            chi
            + F.sin(2 * chi) * (e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360)
            + F.sin(4 * chi) * (7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520)
            + F.sin(6 * chi) * (7 * e6 / 120 + 81 * e8 / 1120)
            + F.sin(8 * chi) * (4279 * e8 / 161280)
        )
        lon = F.lit(self.lon) - F.atan2(sinh, F.cos(angle)) / self.b
        return F.degrees(phi), F.degrees(lon)

    def square(self, size_km: float) -> Column:
        """Corners of the scene square as an array of (lat, lon), from the south-west round by the south-east."""
        h = size_km * 500.0
        corners = [self.inverse(F.lit(x), F.lit(y)) for x, y in ((-h, -h), (h, -h), (h, h), (-h, h))]
        return F.array(*(F.struct(a.alias("lat"), b.alias("lon")) for a, b in corners))


def rectangle(cx: Column, cy: Column, width: Column, height: Column) -> Column:
    """Bounds of a rectangle about a centre."""
    return F.struct((cx - width / 2).alias("xmin"), (cy - height / 2).alias("ymin"), (cx + width / 2).alias("xmax"), (cy + height / 2).alias("ymax"))


def utm_epsg(lat: Column, lon: Column) -> Column:
    zone = F.floor((lon + 180) / 6) + 1
    return (F.when(lat >= 0, 32600).otherwise(32700) + zone).cast("long")


def utm_forward(lat: Column, lon: Column, epsg: int) -> tuple[Column, Column]:
    """Easting and northing in a UTM zone (326zz north, 327zz south), WGS84, by Krueger's series to the fourth order."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    scale = 0.9996 * A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)
    c = 2 * math.sqrt(n) / (1 + n)
    s = F.sin(_rad(lat))
    t = F.sinh(F.atanh(s) - F.atanh(s * c) * c)
    turn = _rad(lon - float((epsg % 100) * 6 - 183))
    xi, eta = F.atan2(t, F.cos(turn)), F.atanh(F.sin(turn) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a
        north = north + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a
    return east * scale + 500_000.0, north * scale + (10_000_000.0 if epsg // 100 == 327 else 0.0)


def pixel_size(size_km: Column, pixels: Column) -> Column:
    return size_km * 1000.0 / pixels


def pixel_centre(row: Column, col: Column, bounds: tuple[Column, Column, Column, Column], width: Column, height: Column) -> tuple[Column, Column]:
    """Scene x and y of a pixel's centre; row 0 is north. bounds: xmin, ymin, xmax, ymax."""
    x0, y0, x1, y1 = bounds
    return x0 + (col + 0.5) / width * (x1 - x0), y1 - (row + 0.5) / height * (y1 - y0)


def spherical_to_xyz(zenith: Column, azimuth: Column, distance: Column | float) -> tuple[Column, Column, Column]:
    """Zenith 0 is down the z axis' origin, azimuth 0 is east."""
    z, a = _rad(zenith), _rad(azimuth)
    return F.sin(z) * F.cos(a) * distance, F.sin(z) * F.sin(a) * distance, F.cos(z) * distance


def target_from_angles(origin: tuple[Column, Column, Column], zenith: Column, azimuth: Column) -> tuple[Column, ...]:
    """A point 1000 m along the ray."""
    return tuple(o + d for o, d in zip(origin, spherical_to_xyz(zenith, azimuth, 1000.0), strict=True))


def distant_direction(zenith: Column, azimuth: Column) -> tuple[Column, Column, Column]:
    """From a distant sensor to the scene; azimuth from north."""
    z, a = _rad(zenith), _rad(azimuth)
    return F.sin(z) * F.sin(a), F.sin(z) * F.cos(a), -F.cos(z)


def angle_convention(view_zenith: Column, azimuth: Column) -> tuple[Column, Column]:
    """Instrument angles to scene angles: zenith turned round, azimuth from east."""
    return F.lit(180.0) - view_zenith, F.pmod(F.lit(90.0) - azimuth, F.lit(360.0))


def asset_to_scene(p: tuple[Column, ...], rotation: tuple[Column, ...], scale: Column, position: tuple[Column, ...]) -> tuple[Column, Column, Column]:
    """Rotation about x, then y, then z (fixed axes, degrees), scale, translation."""
    x, y, z = p
    rx, ry, rz = map(_rad, rotation)
    y, z = y * F.cos(rx) - z * F.sin(rx), y * F.sin(rx) + z * F.cos(rx)
    x, z = x * F.cos(ry) + z * F.sin(ry), z * F.cos(ry) - x * F.sin(ry)
    x, y = x * F.cos(rz) - y * F.sin(rz), x * F.sin(rz) + y * F.cos(rz)
    return x * scale + position[0], y * scale + position[1], z * scale + position[2]


def instance_matrix(x: Column, y: Column, z: Column, rotation: Column, scale: Column, tilt_x: Column, tilt_y: Column) -> Column:
    """Row-major 4x4 product of translation, turn by 90 about x, rotation about y, tilts about x and y, and scale."""
    r, a, b = _rad(rotation), _rad(tilt_x), _rad(tilt_y)
    sr, cr, sa, ca, sb, cb = F.sin(r), F.cos(r), F.sin(a), F.cos(a), F.sin(b), F.cos(b)
    # rows of Ry(r) Rx(a) Ry(b)
    m0 = (cr * cb - sr * ca * sb, sr * sa, cr * sb + sr * ca * cb)
    m1 = (sa * sb, ca, -sa * cb)
    m2 = (-sr * cb - cr * ca * sb, cr * sa, cr * ca * cb - sr * sb)
    # a turn by 90 about x sends y to z and z to -y
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(*(v * scale for v in m0), x, *(-v * scale for v in m2), y, *(v * scale for v in m1), z, zero, zero, zero, one)


def dn_to_reflectance(dn: Column) -> Column:
    return F.greatest(F.lit(0.0), dn * 1e-4 - 0.1)


#: Day of the year of a month's snow state.
MONTH_DAYS = {"June": 172, "December": 355}


def season_temperature(lat: Column, elevation: Column, day: int) -> Column:
    """Degrees Celsius: 26 - 0.62 |lat| + A cos(2 pi / 365 (day - warmest)) - 0.0095 z, A from 3 to 18 over latitudes 10 to 60."""
    amplitude = F.greatest(F.lit(3.0), F.least(F.lit(18.0), 3.0 + (F.abs(lat) - 10.0) * (15.0 / 50.0)))
    warmest = F.when(lat >= 0, 172.0).otherwise(355.0)
    return 26.0 - 0.62 * F.abs(lat) + amplitude * F.cos((day - warmest) * (2 * math.pi / 365)) - 0.0095 * elevation


def snow_probability(t: Column) -> Column:
    """Logistic about 0 degrees, cut above 0.3."""
    return F.when(t <= 0.3, 1 / (1 + F.exp(t / 0.15))).otherwise(0.0)


def max_per_pixel(res_x: Column, res_y: Column, spacing: Column) -> Column:
    """Most plants that a pixel holds at a spacing; 100 without spacing."""
    room = F.when(spacing > 0, spacing)
    across, along = F.greatest(F.lit(1), (res_x / room).cast("long")), F.greatest(F.lit(1), (res_y / room).cast("long"))
    return F.when(spacing <= 0, F.lit(100)).otherwise(F.floor(across * along * 0.75)).cast("long")


def spectral_angle(a: Column, b: Column) -> Column:
    """Angle between two arrays; pi/2 where either has no length."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(dot(a, b), norm))))).otherwise(math.pi / 2)


def brf(radiance: Column, irradiance: Column, sun_zenith: Column) -> Column:
    return radiance * math.pi / (irradiance * F.cos(_rad(sun_zenith)))


def hdrf(radiance: Column, irradiance: Column) -> Column:
    return radiance * math.pi / irradiance


def hcrf(radiance: Column, irradiance: Column) -> Column:
    return hdrf(radiance, irradiance)


def bhr(radiosity: Column, reference: Column) -> Column:
    return radiosity / reference
