"""Column functions of the feeds.  All stay JVM-side.

Rounding is half to even (``bround``, ``rint``), as the feeds' own is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def clip(x: Column, lo: float | Column, hi: float | Column) -> Column:
    lo, hi = (v if isinstance(v, Column) else F.lit(v) for v in (lo, hi))
    return F.when(x.isNotNull(), F.greatest(lo, F.least(x, hi)))


def steps(x: Column, limits: list[tuple[float, object]], top: object) -> Column:
    """The value of the first limit that x doesn't exceed, else ``top``; null stays null."""
    out = F.when(x.isNull(), None)
    for limit, value in limits:
        out = out.when(x <= limit, value)
    return out.otherwise(top)


def aqi_category(aqi: Column) -> Column:
    """1 (good) to 6 (hazardous)."""
    return steps(aqi, [(50, 1), (100, 2), (150, 3), (200, 4), (300, 5)], 6)


#: fixed values: category names, folded
CATEGORY_NAMES = {
    "good": 1,
    "moderate": 2,
    "unhealthyforsensitivegroups": 3,
    "usg": 3,
    "unhealthy": 4,
    "veryunhealthy": 5,
    "hazardous": 6,
}


def lookup(key: Column, values: dict) -> Column:
    """A constant map's value, null for other keys."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.element_at(F.create_map(*pairs), key)


def named_category(name: Column, aqi: Column) -> Column:
    """By name in any case and spacing, else by value."""
    return F.coalesce(lookup(F.lower(F.regexp_replace(F.trim(name), " +", "")), CATEGORY_NAMES), aqi_category(aqi))


def confidence(c: Column) -> Column:
    """Null where the row is to be dropped, else whether it is high; without a confidence it isn't."""
    c = F.coalesce(F.lower(F.trim(c)), F.lit(""))
    digits = F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))
    return (
        F.when(c.isin("low", "l") | (digits < 50), None)
        .when(digits.isNotNull(), digits >= 80)
        .otherwise(c.isin("high", "h"))
    )


def first_usable(*columns: Column) -> Column:
    """The first text that is a number, to a whole one, else 0."""
    return F.rint(F.coalesce(*(c.try_cast("double") for c in columns), F.lit(0.0))).cast("int")


def satellite_code(name: Column, codes: dict[str, int]) -> Column:
    """P5: -1 where unknown."""
    return F.coalesce(lookup(F.upper(F.trim(name)), codes), F.lit(-1))


def is_day(flag: Column) -> Column:
    """P5: whether the day flag is D, in any case."""
    return F.coalesce(F.upper(F.trim(flag)) == "D", F.lit(False))


def footprint(scan: Column, track: Column) -> Column:
    """P5: the larger side of a pixel, to a tenth; an empty text is 0, and with one that isn't a number there is no size."""
    side = lambda t: F.coalesce(F.nullif(F.trim(t), F.lit("")), F.lit("0")).try_cast("double")
    a, b = side(scan), side(track)
    return F.when(a.isNull() | b.isNull(), 0.0).otherwise(F.bround(F.greatest(a, b), 1))


def age_minutes(epoch: Column, now: int) -> Column:
    """Whole minutes, not below 0."""
    return F.greatest(F.floor((F.lit(now) - epoch) / 60), F.lit(0)).cast("long")


def masked(value: Column, flag: Column, bad: tuple[str, ...] = ("X", "Q", "B")) -> Column:
    """P10: null where the quality flag is a bad one."""
    return F.when(~F.coalesce(flag, F.lit("")).isin(*bad), value)


def ranged(x: Column, lo: float, hi: float, ends: str = "[]") -> Column:
    """Null outside of the range; ``ends`` tells which of its ends belong to it."""
    above = x >= lo if ends[0] == "[" else x > lo
    below = x <= hi if ends[1] == "]" else x < hi
    return F.when(above & below, x)


def size_ramp(acres: Column) -> Column:
    """A symbol's size from an area."""
    return F.bround(0.55 + 1.25 * clip((F.log10(F.greatest(acres, F.lit(0.1))) + 1) / 7, 0.0, 1.0), 3)


def smoke_density(d: Column) -> Column:
    """Light, medium or heavy, also from the old codes; else light."""
    known = {"light": "light", "medium": "medium", "heavy": "heavy", "5": "light", "16": "medium", "27": "heavy"}
    return F.coalesce(lookup(F.regexp_replace(F.lower(F.trim(d)), r"\.0+$", ""), known), F.lit("light"))


def unmasked(v: Column, sentinel_lt: float = 0.0, scale: float = 1.0, nodata: float = -9999.0) -> Column:
    """Null below the sentinel and where there is no data, else scaled."""
    return F.when(~F.isnan(v) & (v != nodata) & (v >= sentinel_lt), v * scale)


def longitude(x: Column) -> Column:
    """P20: to -180..180 from 0..360."""
    return F.when(x > 180, x - 360).otherwise(x)


def celsius(t: Column) -> Column:
    """M1: from kelvin; what isn't over 100 is degrees Celsius already."""
    return F.when(t > 100, t - 273.15).otherwise(t)


def fahrenheit(t_c: Column) -> Column:
    """M1: from degrees Celsius."""
    return t_c * 1.8 + 32


def knots(v: Column) -> Column:
    """M1: from metres a second."""
    return v * 1.94384


def inches(mm: Column) -> Column:
    """M1: from millimetres."""
    return mm / 25.4


def hectopascals(p: Column) -> Column:
    """M1: from pascals; what isn't over 2000 is hectopascals already."""
    return F.when(p > 2000, p / 100).otherwise(p)


def magnitude(u: Column, v: Column) -> Column:
    """M2."""
    return F.sqrt(u * u + v * v)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """M3."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, F.lit(0.0))))


#: fixed values for parallax: the earth's radius, the orbit's, and kilometres a degree of latitude and of longitude at the equator
PARALLAX_EARTH_KM, PARALLAX_ORBIT_KM, KM_A_LATITUDE, KM_A_LONGITUDE = 6378.137, 42164.16, 110.574, 111.320


def parallax(lat: Column, lon: Column, sub_lon: Column | float, height_km: float = 4.0) -> tuple[Column, Column]:
    """M4: where a cloud top of this height really is, seen from over ``sub_lon``.

    The top's line of sight meets the ground beyond it, on the great circle away
    from the point under the satellite; it goes back along it by the height times
    the tangent of the zenith angle.
    """
    sub = sub_lon if isinstance(sub_lon, Column) else F.lit(sub_lon)
    phi, east = F.radians(lat), F.radians(sub - lon)
    cos_c = F.cos(phi) * F.cos(east)
    sin_c = F.sqrt(clip(1 - cos_c * cos_c, 0.0, 1.0))
    shift = height_km * sin_c / (cos_c - PARALLAX_EARTH_KM / PARALLAX_ORBIT_KM)
    bearing = F.atan2(F.sin(east), -F.sin(phi) * F.cos(east))
    wide = KM_A_LONGITUDE * F.cos(phi)
    wide = F.when(F.abs(wide) < 1e-6, 1e-6).otherwise(wide)
    return lat + shift * F.cos(bearing) / KM_A_LATITUDE, lon + shift * F.sin(bearing) / wide


def mercator(lat: Column, lon: Column, radius: float = 6378137.0) -> tuple[Column, Column]:
    """M5: Web-Mercator x and y in metres."""
    return F.radians(lon) * radius, F.log(F.tan(F.lit(0.7853981633974483) + F.radians(lat) / 2)) * radius


def rotated(u: Column, v: Column, angle: Column) -> tuple[Column, Column]:
    """M6: grid wind to earth wind, by the angle of the grid in radians."""
    return u * F.cos(angle) + v * F.sin(angle), v * F.cos(angle) - u * F.sin(angle)


def dewpoint_c(t_c: Column, rh: Column, a: float = 17.67, b: float = 243.5) -> Column:
    """M7 (and M8 with 17.625, 243.04): Magnus; humidity held to 1..100."""
    g = F.log(clip(rh, 1.0, 100.0) / 100) + a * t_c / (b + t_c)
    return b * g / (a - g)


def theta_e(t_k: Column, td_k: Column, p_hpa: Column) -> Column:
    """M9: Bolton's equivalent potential temperature; a dew point above the temperature is taken as that, and a pressure left for dry air is one hPa at least."""
    td = F.least(td_k, t_k)
    e = 6.112 * F.exp(17.67 * (td - 273.15) / (td - 29.65))
    r = 0.622 * e / F.greatest(p_hpa - e, F.lit(1.0))
    lcl = 1 / (1 / (t_k - 56) + F.log(t_k / td) / 800) + 56
    out = t_k * F.pow(1000 / p_hpa, 0.2854 * (1 - 0.28 * r)) * F.exp((3.376 / lcl - 0.00254) * 1000 * r * (1 + 0.81 * r))
    return F.when(t_k.isNotNull() & td_k.isNotNull() & p_hpa.isNotNull(), out)  # least and greatest skip nulls


def leading_bits(x: Column, bits: int = 20) -> Column:
    """A double to so many leading bits, half to even, in steps that are exact in every engine."""
    y = x * 2.0**-64  # so that the product below doesn't overflow
    c = y * (2.0 ** (53 - bits) + 1)
    return F.when(F.abs(x) == float("inf"), x).otherwise((c - (c - y)) * 2.0**64)


def precip_type(rain: Column, snow: Column, ice: Column, freezing: Column) -> Column:
    """The most hazardous wins: 4 freezing, 3 ice, 2 snow, 1 rain, 0 none."""
    return F.when(freezing > 0, 4).when(ice > 0, 3).when(snow > 0, 2).when(rain > 0, 1).otherwise(0)


def byte_gray(v: Column, lo: float, hi: float) -> Column:
    """1..255 over the range, 0 for no data."""
    return F.coalesce(F.rint(1 + 254 * (clip(v, lo, hi) - lo) / (hi - lo)), F.lit(0.0)).cast("short")


def byte_dbz(v: Column) -> Column:
    """2 a dB from -32 on, plus 2; 0 below -31.5 and for no data."""
    return F.when(v >= -31.5, clip(F.rint((v + 32) * 2) + 2, 2.0, 255.0)).otherwise(0).cast("short")


def byte_correlation(v: Column) -> Column:
    """Inverted, 200 a unit below 1.05; 0 for no data and above."""
    return F.when(v.isNull(), 0).otherwise(clip(F.rint((1.05 - v) * 200), 0.0, 255.0)).cast("short")


def byte_rotation(v: Column) -> Column:
    """128 is none."""
    return F.when(v.isNull(), 128).otherwise(clip(F.rint(128 + v * 5000), 0.0, 255.0)).cast("short")


def byte_wind(v: Column) -> Column:
    """0.4 m/s a step, 128 is none."""
    return clip(F.rint(v / 0.4 + 128), 0.0, 255.0).cast("short")


def event_time(start: Column, offset: Column, limit: float = 25.0) -> Column:
    """DT3: the granule's start plus the offset where that is sane."""
    return start + F.when(F.abs(offset) <= limit, offset).otherwise(0)


def utc_offset_seconds(zone: Column, at: Column, lon: Column) -> Column:
    """DT2: of a named zone at a time; by longitude where there is no zone."""
    named = F.unix_timestamp(F.from_utc_timestamp(at, F.coalesce(zone, F.lit("UTC")))) - F.unix_timestamp(at)
    return F.when(zone.isNotNull(), named).otherwise((F.rint(lon / 15) * 3600).cast("long"))


def place_name(name: Column, default: str = "Unnamed") -> Column:
    """ST1: trimmed, single spaces, without a trailing country or its prefix."""
    s = F.regexp_replace(F.trim(name), " +", " ")
    s = F.regexp_replace(F.regexp_replace(s, " US$", ""), "^US-", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(default))


def lat_lon_tag(tag: Column) -> tuple[Column, Column]:
    """ST3: ``43N-93W``."""
    part = lambda g: F.regexp_extract(tag, r"^(\d+)([NS])-(\d+)([EW])$", g)
    value = lambda d, s, minus: part(d).try_cast("int") * F.when(part(s) == minus, -1).otherwise(1)
    return value(1, 2, "S"), value(3, 4, "W")


#: fixed values: the accumulation period of each code
PERIODS = {1: "1h", 3: "3h", 6: "6h", 12: "12h", 18: "18h", -1: "local-midnight", -2: "utc-midnight", -3: "24h", -4: "5m", -5: "15m"}


def accumulation_period(first: Column, third: Column) -> Column:
    """What an accumulation is of; none unless the third code is 0 and the first one is known."""
    return F.when(third == 0, lookup(first, PERIODS))


def pruned(properties: Column, drop: tuple[str, ...]) -> Column:
    """A map without some keys, of any case."""
    return F.map_filter(properties, lambda k, _: ~F.lower(k).isin(*(d.lower() for d in drop)))


def region_size(west: Column, south: Column, east: Column, north: Column, metres: float, least: int = 2048, most: int = 4096) -> tuple[Column, Column]:
    """M5: width and height in square Mercator pixels of about so many metres; the width is kept within bounds, the height below the upper one."""
    x0, y0 = mercator(south, west)
    x1, y1 = mercator(north, east)
    width = clip(F.rint((x1 - x0) / metres), float(least), float(most))
    return width.cast("int"), F.least(F.rint(width * (y1 - y0) / (x1 - x0)), F.lit(float(most))).cast("int")
