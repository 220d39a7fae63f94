"""Column expressions: names, geography, units, dates, nulls.  All stay in the JVM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_008.8
#: Metres of one degree of latitude, rounded down.
DEGREE_M = 111_194.0
SQUARE_FEET = 43_560

#: Company suffixes that do not tell names apart.
_SUFFIXES = "LLC|L L C|INC|INCORPORATED|CORP|CORPORATION|CO|COMPANY|LTD|LIMITED|LP|LLP|TRUST"


def normal_name(name: Column) -> Column:
    """Upper case, letters and digits only, single spaces, no company suffix at the end."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.upper(name), r"[^A-Z0-9]+", " "), r" +", " "))
    return F.trim(F.regexp_replace(plain, rf"( ({_SUFFIXES}))+$", ""))


def normal_address(address: Column) -> Column:
    """Upper case, single spaces, common street words abbreviated."""
    out = F.trim(F.regexp_replace(F.upper(address), r"[^A-Z0-9]+", " "))
    for word, short in (("STREET", "ST"), ("AVENUE", "AVE"), ("ROAD", "RD"), ("DRIVE", "DR"), ("LANE", "LN"), ("BOULEVARD", "BLVD"), ("HIGHWAY", "HWY"), ("COURT", "CT")):
        out = F.regexp_replace(out, rf"\b{word}\b", short)
    return out


def block_key(name: Column) -> Column:
    """The first word of a normal name, for blocking."""
    return F.split(normal_name(name), " ")[0]


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres."""
    a = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), 2.0) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2.0)
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def valid_point(lat: Column, lon: Column) -> Column:
    """In range and not (0, 0), which stands for missing; null counts as not valid."""
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180) & ~((lat == 0) & (lon == 0)), F.lit(False))


def acres(square_feet: Column) -> Column:
    return (square_feet.cast("decimal(20,4)") / F.lit(SQUARE_FEET)).cast("decimal(12,4)")


def years_before(as_of: dt.date, years: int) -> dt.date:
    """The same day ``years`` ago; 29 February becomes the 28th.  A literal, so comparisons with it are pushed to scans."""
    try:
        return as_of.replace(year=as_of.year - years)
    except ValueError:
        return as_of.replace(year=as_of.year - years, day=28)


def digest(*columns: Column) -> Column:
    """SHA-256 of columns as text, nulls told apart from empty ones."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns)), 256)


def compact(*items: Column) -> Column:
    """An array of the items that are not null."""
    return F.array_compact(F.array(*items))


def url_part(url: Column, part: str) -> Column:
    """HOST, PATH, QUERY, PROTOCOL ... of a url, null where it has none or is not one; hosts in lower case."""
    out = F.try_parse_url(url, F.lit(part))
    return F.lower(out) if part == "HOST" else out
