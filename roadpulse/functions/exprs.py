"""Column-expression builders (all JVM-side, codegen-friendly; no UDFs)."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(mapping: Mapping) -> Column:
    """A literal MAP<k, v> column from a small fixed dictionary."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def lookup(key: str | Column, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup with a default on miss (PF10)."""
    v = F.try_element_at(literal_map(mapping), col(key))
    return v if default is None else F.coalesce(v, F.lit(default))


def as_ts(c: str | Column) -> Column:
    """Any timestamp-like column as TIMESTAMP (session zone is UTC)."""
    return col(c).cast("timestamp")


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """(end - start) in minutes as double; null when either is null (SC6)."""
    return (F.unix_micros(as_ts(end)) - F.unix_micros(as_ts(start))) / F.lit(60_000_000.0)


def clip(c: str | Column, lower=None, upper=None) -> Column:
    """pandas-style clip: null stays null (Q18: least/greatest skip nulls)."""
    x = col(c)
    out = x
    if lower is not None:
        out = F.greatest(out, lower if isinstance(lower, Column) else F.lit(lower))
    if upper is not None:
        out = F.least(out, upper if isinstance(upper, Column) else F.lit(upper))
    return F.when(x.isNotNull(), out)


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 int; null condition -> 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def severity_bin(score: str | Column) -> Column:
    """Right-closed bins (PF13): (-0.1,.9]->0, (.9,1.9]->1, (1.9,2.9]->2, (2.9,10]->3."""
    s = col(score)
    e = K.SEVERITY_BIN_EDGES
    return (
        F.when((s > e[0]) & (s <= e[1]), 0)
        .when((s > e[1]) & (s <= e[2]), 1)
        .when((s > e[2]) & (s <= e[3]), 2)
        .when((s > e[3]) & (s <= e[4]), 3)
    )


def haversine_km(lat: str | Column, lon: str | Column, lat0: float = K.CITY_LAT, lon0: float = K.CITY_LON) -> Column:
    """Great-circle distance in km to (lat0, lon0), R = 6371 (SC5)."""
    rlat = F.radians(col(lat))
    rlon = F.radians(col(lon))
    clat = math.radians(lat0)
    clon = math.radians(lon0)
    a = F.pow(F.sin((rlat - F.lit(clat)) / 2), 2) + F.cos(rlat) * F.lit(math.cos(clat)) * F.pow(F.sin((rlon - F.lit(clon)) / 2), 2)
    return F.lit(2 * K.EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def cyc_sin(c: str | Column, period: int) -> Column:
    return F.sin(F.lit(2 * math.pi) * col(c) / F.lit(float(period)))


def cyc_cos(c: str | Column, period: int) -> Column:
    return F.cos(F.lit(2 * math.pi) * col(c) / F.lit(float(period)))


def round_even(c: str | Column, scale: int = 0) -> Column:
    """Python-style round half to even (SC8/Q15)."""
    return F.bround(col(c), scale)


def title_label(c: str | Column) -> Column:
    """'congestion_severity' -> 'Congestion Severity' (SC14, all underscores)."""
    return F.initcap(F.regexp_replace(col(c), "_", " "))


def normalized_cause(c: str | Column = "event_cause") -> Column:
    """PF9: fill 'others', lower, strip; 'debris' -> 'debris_'."""
    x = F.trim(F.lower(F.coalesce(col(c), F.lit("others"))))
    return F.when(x == "debris", F.lit("debris_")).otherwise(x)
