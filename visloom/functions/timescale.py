"""Dates, time scales and angles as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of each field of a packed frame time, from the lowest: 20 ns ticks up to the year since 2000.
PACKED = (("tick", 6), ("us", 10), ("ms", 10), ("second", 6), ("minute", 6), ("hour", 5), ("day", 5), ("month", 4), ("year", 12))
J2000 = 2451545.0


def pack_time(fields: dict[str, Column]) -> Column:
    """The inverse of `unpack_time`; year is the full year."""
    out, at = F.lit(0).cast("long"), 0
    for name, bits in PACKED:
        value = fields[name] - (2000 if name == "year" else 0)
        out = out.bitwiseOR(F.shiftleft(value.cast("long"), at))
        at += bits
    return out


def unpack_time(packed: Column) -> dict[str, Column]:
    """Fields of a packed time; ticks of 50 and more, which are no 20 ns ticks of a microsecond, count as 0."""
    out, at = {}, 0
    for name, bits in PACKED:
        out[name] = F.shiftrightunsigned(packed, at).bitwiseAND((1 << bits) - 1)
        at += bits
    out["year"] = out["year"] + 2000
    out["ns"] = F.when(out["tick"] >= 50, 0).otherwise(out["tick"] * 20)
    return out


def instant(f: dict[str, Column]) -> Column:
    """Zone-less timestamp of unpacked fields, to the microsecond."""
    seconds = F.format_string("%04d-%02d-%02d %02d:%02d:%02d.%03d%03d", *(f[x] for x in ("year", "month", "day", "hour", "minute", "second", "ms", "us")))
    return seconds.cast("timestamp_ntz")


def to_utc(local: Column) -> Column:
    """Universal time of the observatory's clock, eight hours ahead of it."""
    return local - F.expr("INTERVAL '8' HOUR")


def iso_text(ts: Column, ns: Column) -> Column:
    """ISO text with nine fractional digits."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lpad(ns.cast("string"), 3, "0"))


def parse_date_text(text: Column) -> Column:
    """`YYYY-MM-DD`, with ` HH:MM:SS` or ` HH:MM:SS ffffff`; null where no form fits."""
    forms = ("yyyy-MM-dd HH:mm:ss SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(x)).cast("timestamp_ntz") for x in forms))


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp."""
    return F.unix_micros(ts.cast("timestamp"))


def julian_date(ts: Column) -> Column:
    return micros(ts) / 86400e6 + 2440587.5


def calendar_to_jd(year: Column, month: Column, day: Column) -> Column:
    """Julian date at midnight of a Gregorian date, by integer arithmetic."""
    a = F.floor((14 - month) / 12)
    y, m = year + 4800 - a, month + 12 * a - 3
    return day + F.floor((153 * m + 2) / 5) + 365 * y + F.floor(y / 4) - F.floor(y / 100) + F.floor(y / 400) - 32045 - 0.5


def jd_to_calendar(jd: Column) -> tuple[Column, Column, Column]:
    """Year, month and day with fraction of a Julian date."""
    z = F.floor(jd + 0.5)
    a = z + 32044
    b = F.floor((4 * a + 3) / 146097)
    c = a - F.floor(146097 * b / 4)
    d = F.floor((4 * c + 3) / 1461)
    e = c - F.floor(1461 * d / 4)
    m = F.floor((5 * e + 2) / 153)
    day = e - F.floor((153 * m + 2) / 5) + 1 + (jd + 0.5 - z)
    return 100 * b + d - 4800 + F.floor(m / 10), m + 3 - 12 * F.floor(m / 10), day


def earth_rotation(jd_ut1: Column) -> Column:
    """Earth rotation angle in turns, [0, 1)."""
    return F.pmod(0.7790572732640 + 0.00273781191135448 * (jd_ut1 - J2000) + F.pmod(jd_ut1, F.lit(1.0)), F.lit(1.0))


def sidereal_hours(jd_ut1: Column, jd_tdb: Column, lon_deg: float = 0.0) -> Column:
    """Mean sidereal time at an east longitude, hours in [0, 24)."""
    t = (jd_tdb - J2000) / 36525.0
    # The accumulated precession in right ascension, in arc seconds.
    p = 0.014506 + t * (4612.156534 + t * (1.3915817 + t * (-0.00000044 + t * (-0.000029956 + t * -0.0000000368))))
    return F.pmod(p / 54000.0 + earth_rotation(jd_ut1) * 24.0 + lon_deg / 15.0, F.lit(24.0))


# Days from which TAI - UTC is FIRST_LEAP seconds and then one more each.
LEAP_DAYS = (
    "1972-01-01 1972-07-01 1973-01-01 1974-01-01 1975-01-01 1976-01-01 1977-01-01 1978-01-01 1979-01-01 1980-01-01 1981-07-01 1982-07-01 1983-07-01 1985-07-01 "
    "1988-01-01 1990-01-01 1991-01-01 1992-07-01 1993-07-01 1994-07-01 1996-01-01 1997-07-01 1999-01-01 2006-01-01 2009-01-01 2012-07-01 2015-07-01 2017-01-01"
).split()
FIRST_LEAP = 10


def tai_minus_utc(utc: Column) -> Column:
    """Leap seconds in force at a zone-less time; null before 1972. The table is a short literal, so that no join is needed."""
    days = F.array(*(F.lit(d).cast("timestamp_ntz") for d in LEAP_DAYS))
    passed = F.size(F.filter(days, lambda d: d <= utc))
    return F.when(passed > 0, passed + (FIRST_LEAP - 1))


def tt_micros(utc: Column) -> Column:
    """Microseconds since 1970 of terrestrial time: UTC, then TAI by leap seconds, then TT by 32.184 s."""
    return micros(utc) + tai_minus_utc(utc) * 1_000_000 + 32_184_000


def tai_of_day(day: Column, micros_of_day: Column) -> Column:
    """Microseconds since 1970 of atomic time, of a date and microseconds in it; a leap second's are beyond 86400 s. Before 1972 ten seconds hold."""
    leap = F.coalesce(tai_minus_utc(day.cast("timestamp_ntz")), F.lit(FIRST_LEAP))
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000_000 + micros_of_day + leap * 1_000_000


def utc_iso(tai: Column, places: int = 0) -> Column:
    """ISO text of universal time at microseconds of atomic time, rounded to so many places of a second; a leap second is second 60."""
    unit = 10 ** (6 - places)
    t = F.floor((tai + unit // 2) / unit) * unit
    # When each count of leap seconds begins.
    starts = F.array(*((F.unix_date(F.lit(d).cast("date")).cast("long") * 86_400 + i) * 1_000_000 for i, d in enumerate(LEAP_DAYS, FIRST_LEAP)))
    n = F.size(F.filter(starts, lambda s: s <= t))
    leap = FIRST_LEAP - 1 + F.greatest(n, F.lit(1))
    inserted = F.coalesce((n > 0) & (t >= F.get(starts, n) - 1_000_000), F.lit(False))
    utc = t - (leap + inserted.cast("int")) * 1_000_000
    s = F.pmod(F.floor(utc / 1_000_000), F.lit(86_400))
    day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(utc / 86_400_000_000).cast("int")), "yyyy-MM-dd")
    clock = F.format_string("T%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60 + inserted.cast("int"))
    part = F.concat(F.lit("."), F.lpad((F.pmod(t, F.lit(1_000_000)) / unit).cast("long").cast("string"), places, "0")) if places else F.lit("")
    return F.concat(day, clock, part, F.lit("Z"))


def tdb_minus_tt(jd_tt: Column) -> Column:
    """Seconds of the periodic terms between the two dynamical times."""
    t = (jd_tt - J2000) / 36525.0
    # Amplitude, rate and phase of each term.
    terms = ((0.001657, 628.3076, 6.2401), (0.000022, 575.3385, 4.2970), (0.000014, 1256.6152, 6.1969), (0.000005, 606.9777, 4.0212), (0.000005, 52.9691, 0.4444), (0.000002, 21.3299, 5.5431))
    out = F.lit(0.0)
    for a, r, p in terms:
        out = out + a * F.sin(r * t + p)
    return out + 0.000010 * t * F.sin(628.3076 * t + 4.2490)


def delta_t(leap_seconds: Column, ut1_utc: Column) -> Column:
    """TT minus UT1 in seconds."""
    return 32.184 + leap_seconds - ut1_utc


def sexagesimal(value: Column) -> tuple[Column, Column, Column, Column]:
    """Sign, whole units, minutes and seconds of degrees or hours."""
    a = F.abs(value)
    minutes = F.floor((a - F.floor(a)) * 60)
    return F.signum(value), F.floor(a), minutes, (a - F.floor(a)) * 3600 - minutes * 60


def from_sexagesimal(text: Column) -> Column:
    """Value of `dd:mm:ss.s`, also with a sign."""
    parts = F.transform(F.split(F.regexp_replace(F.trim(text), "^[+-]", ""), ":"), lambda x: x.cast("double"))
    value = F.get(parts, F.lit(0)) + F.coalesce(F.get(parts, F.lit(1)), F.lit(0.0)) / 60 + F.coalesce(F.get(parts, F.lit(2)), F.lit(0.0)) / 3600
    return F.when(F.trim(text).startswith("-"), -value).otherwise(value)


def refraction(alt_deg: Column, celsius: float, millibar: float) -> Column:
    """Degrees by which air lifts an object; none more than a degree below the horizon or near the zenith."""
    r = 0.016667 / F.tan(F.radians(alt_deg + 7.31 / (alt_deg + 4.4)))
    return F.when((alt_deg >= -1.0) & (alt_deg <= 89.9), r * (0.28 * millibar / (celsius + 273.0))).otherwise(0.0)


def apparent_altitude(alt_deg: Column, celsius: float, millibar: float, rounds: int = 4) -> Column:
    """Altitude at which an object appears: refraction taken at the apparent altitude, in a fixed number of rounds."""
    out = alt_deg
    for _ in range(rounds):
        out = alt_deg + refraction(out, celsius, millibar)
    return out
