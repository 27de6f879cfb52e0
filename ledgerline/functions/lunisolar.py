"""Lunisolar calendar arithmetic: new moons, the sun's longitude, and the months that they make in a time zone.

Instants come from the usual truncated series for the moon's phases and the sun's apparent longitude (good to about a
minute and to a quarter of an hour). A month begins on the local day of a new moon; the one that holds the winter solstice is the eleventh;
where thirteen months lie between two of these, the first that holds no principal term (a multiple of 30 degrees) repeats its
predecessor's number.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import cache
from math import floor, radians, sin

#: Multiples of the sun's anomaly, the moon's anomaly and the moon's argument of latitude, the power of the orbit's eccentricity, and days, of the series for new moons.
_MOON = [
    (0, 1, 0, 0, -0.40720), (1, 0, 0, 1, 0.17241), (0, 2, 0, 0, 0.01608), (0, 0, 2, 0, 0.01039), (-1, 1, 0, 1, 0.00739), (1, 1, 0, 1, -0.00514), (2, 0, 0, 2, 0.00208), (0, 1, -2, 0, -0.00111),
    (0, 1, 2, 0, -0.00057), (1, 2, 0, 1, 0.00056), (0, 3, 0, 0, -0.00042), (1, 0, 2, 1, 0.00042), (1, 0, -2, 1, 0.00038), (-1, 2, 0, 1, -0.00024), (2, 1, 0, 0, -0.00007), (0, 2, -2, 0, 0.00004),
    (3, 0, 0, 0, 0.00004), (1, 1, -2, 0, 0.00003), (0, 2, 2, 0, 0.00003), (1, 1, 2, 0, -0.00003), (-1, 1, 2, 0, 0.00003), (-1, 1, -2, 0, -0.00002), (1, 3, 0, 0, -0.00002), (0, 4, 0, 0, 0.00002),
]
#: Phase, rate and days of the planets' largest terms.
_PLANETS = [(299.77, 0.107408, 0.000325), (251.88, 0.016321, 0.000165), (251.83, 26.651886, 0.000164), (349.42, 36.412478, 0.000126), (84.66, 18.206239, 0.000110)]
_EPOCH, _CENTURY = 2451545.0, 36525.0
#: Days by which dynamical time is ahead of the clock in the years that matter here.
_AHEAD = 0.0008


def _clock(jd: float, hours: float) -> datetime:
    return datetime(2000, 1, 1, 12) + timedelta(days=jd - _AHEAD - _EPOCH, hours=hours)


@cache
def new_moon(k: int) -> float:
    """Julian day (dynamical time) of the k-th new moon after that of January 2000."""
    t = k / 1236.85
    sun = radians(2.5534 + 29.10535670 * k - 0.0000014 * t * t)
    moon = radians(201.5643 + 385.81693528 * k + 0.0107582 * t * t)
    node = radians(160.7108 + 390.67050284 * k - 0.0016118 * t * t)
    narrow = 1 - 0.002516 * t - 0.0000074 * t * t
    days = 2451550.09766 + 29.530588861 * k + 0.00015437 * t * t - 0.00017 * sin(radians(124.7746 - 1.56375588 * k))
    days += sum(c * narrow**e * sin(a * sun + b * moon + f * node) for a, b, f, e, c in _MOON)
    return days + sum(c * sin(radians(phase + rate * k)) for phase, rate, c in _PLANETS)


def sun_longitude(jd: float) -> float:
    """Apparent longitude of the sun, in degrees."""
    t = (jd - _EPOCH) / _CENTURY
    m = radians(357.52911 + 35999.05029 * t - 0.0001537 * t * t)
    centre = (1.914602 - 0.004817 * t) * sin(m) + (0.019993 - 0.000101 * t) * sin(2 * m) + 0.000289 * sin(3 * m)
    return (280.46646 + 36000.76983 * t + 0.0003032 * t * t + centre - 0.00569 - 0.00478 * sin(radians(125.04 - 1934.136 * t))) % 360


@cache
def solar_term(year: int, degrees: float, hours: float) -> date:
    """The local day in a year on which the sun reaches a longitude."""
    jd = _EPOCH + (year - 2000) * 365.2422 + (degrees - 280) % 360 / 360 * 365.2422
    for _ in range(6):
        jd += 58 * sin(radians(degrees - sun_longitude(jd)))
    return _clock(jd, hours).date()


@cache
def _from_solstice(year: int, hours: float) -> list[date]:
    """First days of the months from the one that holds the year's winter solstice up to the one that holds the next year's, which is the last."""
    first, last = solar_term(year, 270, hours), solar_term(year + 1, 270, hours)
    k = floor((year - 2000) * 12.3685 + 10)
    starts = [_clock(new_moon(i), hours).date() for i in range(k - 1, k + 17)]
    held = [max(i for i, d in enumerate(starts) if d <= solstice) for solstice in (first, last)]
    return starts[held[0] : held[1] + 1]


def _holds_term(start: date, end: date, hours: float) -> bool:
    noon = lambda d: sun_longitude((datetime(d.year, d.month, d.day) - datetime(2000, 1, 1, 12)).total_seconds() / 86400 + _EPOCH + _AHEAD - hours / 24)
    return floor(noon(start) / 30) != floor(noon(end) / 30)


@cache
def month_starts(year: int, hours: float) -> dict[int, date]:
    """First day of each month (1 to 12, leap months left out) of the lunar year that begins in a year. hours: the zone's offset."""
    out = {}
    for y in (year - 1, year):
        starts = _from_solstice(y, hours)
        leap = len(starts) == 14
        number = 11
        for start, end in zip(starts[:-1], starts[1:], strict=True):
            if leap and start != starts[0] and not _holds_term(start, end, hours):
                leap = False
                continue
            month = (number - 1) % 12 + 1
            if (y == year - 1) == (month <= 10):
                out[month] = start
            number += 1
    return out


def lunar_day(year: int, month: int, day: int, hours: float) -> date:
    """The day of a lunar month of the lunar year that begins in a year; day 0 is the eve of the month."""
    return month_starts(year, hours)[month] + timedelta(day - 1)
