"""Scalar functions as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(x: Column, digits: int = 2) -> Column:
    """Round half to even after scaling, as arrays of floats are rounded."""
    return F.rint(x * 10**digits) / 10**digits


def finite(x: Column) -> Column:
    """NaN and infinities become null, so that comparisons and aggregates leave them out."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def at_least(x: Column, limit: float) -> Column:
    """x >= limit, false for NaN and null."""
    return F.coalesce(finite(x) >= limit, F.lit(False))


def percentage(part: Column, whole: Column) -> Column:
    """part in per cent of whole with two digits; null if whole isn't positive."""
    return F.when(whole > 0, half_even(F.try_divide(part * 100, whole)))


# By archive, the pattern of a file stem and what stands before its group in an event id.
EVENT_PATTERNS = {"GFD": (r"^(DFO_\d+)_From", ""), "Unosat": (r"^(\d+)_", "UNOSAT_"), "WorldFloods": (r"^EMSR(\d+)_", "EMSR_")}


def event_id(stem: Column, archive: Column) -> Column:
    """The event id in a file stem by its archive's rule; the stem where the rule doesn't fit. Archives without a rule have WorldFloods'."""
    found = {a: F.regexp_extract(stem, p, 1) for a, (p, _) in EVENT_PATTERNS.items()}
    ids = {a: F.when(x != "", F.concat(F.lit(EVENT_PATTERNS[a][1]), x)).otherwise(stem) for a, x in found.items()}
    return F.when(archive == "GFD", ids["GFD"]).when(archive == "Unosat", ids["Unosat"]).otherwise(ids["WorldFloods"])


def tokens(text: Column, separator: str = ",") -> Column:
    """Trimmed tokens of a separated list, empty ones dropped."""
    return F.filter(F.transform(F.split(text, separator), lambda x: F.trim(x)), lambda x: x != "")


# Spellings of one satellite, a long name and its short form, and tokens that stand for no single satellite.
VIIRS_SPELLINGS, VIIRS = "(?i)VIIRS-NOAA|VIIRS_NOAA|NOO-VIIRS|NOAA/VIIRS|NOAA_VIIRS", "NOAA-VIIRS"
LONG_SATELLITE, SHORT_SATELLITE = "COSMO-SkyMed Second Generation", "COSMO-SkyMed SG"
OTHER_SATELLITE = r"(?i)^\s*(35|42|44|58|multi[\s_-]*sensors?)\s*$"


def ordered_unique(text: Column, other: str | None = None) -> Column:
    """Tokens without repeats in first order; those that match the pattern become Other."""
    items = tokens(text)
    if other:
        items = F.transform(items, lambda x: F.when(x.rlike(other), F.lit("Other")).otherwise(x))
    return F.array_distinct(items)


def satellites(text: Column) -> Column:
    """A list of satellites in one spelling, each once, joined again."""
    one = F.replace(F.regexp_replace(text, VIIRS_SPELLINGS, VIIRS), F.lit(LONG_SATELLITE), F.lit(SHORT_SATELLITE))
    return F.array_join(ordered_unique(one, OTHER_SATELLITE), ", ")


def safe_name(text: Column, default: str = "unknown") -> Column:
    """A name of word characters of any script: other signs go, white space becomes underscores."""
    plain = F.regexp_replace(F.regexp_replace(text, r"(?U)[^\w\s-]", ""), r"(?U)\s+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(plain, "^_+|_+$", ""), F.lit("")), F.lit(default))


def without_suffix(text: Column, suffix: str) -> Column:
    return F.when(F.endswith(text, F.lit(suffix)), F.left(text, F.length(text) - len(suffix))).otherwise(text)


def path_part(path: Column, n: int, guard: int | None = None, expected: str = "") -> Column:
    """Part n (from 0) of a path with slashes; null if there is none, or part guard isn't the expected one."""
    parts = F.split(path, "/")
    found = F.get(parts, F.lit(n))
    return found if guard is None else F.when(F.get(parts, F.lit(guard)) == expected, found)


def url_candidates(base: str, folder: Column, name: Column, endings: tuple[str, ...] = ("_SHP.zip", "_shp.zip", ".zip")) -> Column:
    """All addresses that a file may have, in the order in which they are tried; null without folder or name."""
    return F.when(folder.isNotNull() & name.isNotNull(), F.array(*[F.concat(F.lit(f"{base}/"), folder, F.lit("/"), name, F.lit(e)) for e in endings]))


# What a flood layer's name holds and what it doesn't.
FLOOD_WORD, OTHER_LAYERS = "flood", ("preflood", "analysis_extent", "analysisextent", "cloud", "damage")


def is_flood_layer(name: Column) -> Column:
    low = F.lower(name)
    return F.contains(low, F.lit(FLOOD_WORD)) & ~reduce(lambda a, b: a | b, [F.contains(low, F.lit(x)) for x in OTHER_LAYERS])


def date_column(schema) -> str | None:
    """The first column of a schema that is a date or a time, else the first whose name says so."""
    import re

    by_type = [f.name for f in schema if f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz")]
    by_name = [f.name for f in schema if re.search(r"date|_dat|dat_|^dat$", f.name, re.IGNORECASE)]
    return next(iter(by_type + by_name), None)


def compact_date(text: Column) -> Column:
    """A date as yyyyMMdd; the first ten word characters of what isn't one, nodate if there are none."""
    parsed = F.date_format(F.try_to_timestamp(text), "yyyyMMdd")
    rest = F.left(F.regexp_replace(text, r"(?U)\W", ""), F.lit(10))
    return F.coalesce(parsed, F.nullif(rest, F.lit("")), F.lit("nodate"))


def date_prefix(moment: Column) -> Column:
    """The date of an ISO moment that is text."""
    return F.split_part(moment, F.lit("T"), F.lit(1))


def epoch_day(n: Column, epoch: str = "1951-01-01") -> Column:
    """The date so many days after the epoch."""
    return F.date_add(F.to_date(F.lit(epoch)), n.cast("int"))


def next_month(day: Column) -> Column:
    """The first day of the month after."""
    return F.add_months(F.trunc(day, "month"), 1)


# Daily variables that change their sign, and what others are multiplied by.
SIGN_FLIPS = ("total_evaporation", "potential_evaporation")
UNIT_SCALES = {"surface_net_solar_radiation": 1 / 86400, "surface_net_thermal_radiation": 1 / 86400, "snow_depth_water_equivalent": 1000.0, "surface_pressure": 1 / 1000}
# Short names of variables.
LONG_NAMES = {
    "d2m": "2m_dewpoint_temperature", "t2m": "2m_temperature", "sd": "snow_depth_water_equivalent", "sf": "snowfall", "smlt": "snowmelt",
    "swvl1": "volumetric_soil_water_layer_1", "swvl2": "volumetric_soil_water_layer_2", "swvl3": "volumetric_soil_water_layer_3", "swvl4": "volumetric_soil_water_layer_4",
    "ssr": "surface_net_solar_radiation", "str": "surface_net_thermal_radiation", "pev": "potential_evaporation", "e": "total_evaporation",
    "u10": "10m_u_component_of_wind", "v10": "10m_v_component_of_wind", "sp": "surface_pressure", "tp": "total_precipitation",
}
# Variables in whole millimetres, and the variables of the series that values are compared with.
WHOLE_MILLIMETRES = ("snowfall", "snowmelt", "potential_evaporation", "total_evaporation", "total_precipitation", "snow_depth_water_equivalent")
COMPARED = {
    "10m_u_component_of_wind": "u_component_of_wind_10m_mean", "10m_v_component_of_wind": "v_component_of_wind_10m_mean",
    "2m_dewpoint_temperature": "dewpoint_temperature_2m_mean", "2m_temperature": "temperature_2m_mean", "potential_evaporation": "potential_evaporation_sum_ERA5_LAND",
    "snow_depth_water_equivalent": "snow_depth_water_equivalent_mean", "surface_net_solar_radiation": "surface_net_solar_radiation_mean",
    "surface_net_thermal_radiation": "surface_net_thermal_radiation_mean", "surface_pressure": "surface_pressure_mean", "total_precipitation": "total_precipitation_sum",
    "volumetric_soil_water_layer_1": "volumetric_soil_water_layer_1_mean", "volumetric_soil_water_layer_2": "volumetric_soil_water_layer_2_mean",
    "volumetric_soil_water_layer_3": "volumetric_soil_water_layer_3_mean", "volumetric_soil_water_layer_4": "volumetric_soil_water_layer_4_mean",
}


def chosen(key: Column, table: dict, default: Column) -> Column:
    """The table's value for a key, else the default."""
    return reduce(lambda w, kv: w.when(key == kv[0], F.lit(kv[1])), list(table.items())[1:], F.when(key == next(iter(table)), F.lit(next(iter(table.values()))))).otherwise(default)


def published(variable: Column, value: Column) -> Column:
    """Sign, unit and two digits, in this order."""
    flipped = F.when(variable.isin(*SIGN_FLIPS), -value).otherwise(value)
    return half_even(flipped * chosen(variable, UNIT_SCALES, F.lit(1.0)))


def by_variable(variable: Column, value: Column) -> Column:
    """Whole millimetres, or two digits."""
    return F.when(variable.isin(*WHOLE_MILLIMETRES), half_even(value, 0)).otherwise(half_even(value))


def dead_band(x: Column, least: float = 0.01) -> Column:
    """0 where x is within least of 0."""
    return F.when(F.abs(x) <= least, F.lit(0.0)).otherwise(x)


def agreement(pbias: Column) -> Column:
    """100 less the bias's amount, within 0 and 100."""
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100 - F.abs(pbias)))


def log10_positive(x: Column) -> Column:
    """log10 of positive values, null for others."""
    return F.when(x > 0, F.log10(F.when(x > 0, x)))


def tile_name(west: Column, south: Column, east: Column, north: Column) -> Column:
    """A tile's file name, with signs and leading zeros."""
    return F.format_string("hand_lon%+04d_lat%+03d_lon%+04d_lat%+03d.tif", *[c.cast("int") for c in (west, south, east, north)])


def lenient_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """A date, or null where the text isn't one."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def packed(x: Column, scale: float, offset: float, fill: int = -32768) -> Column:
    """A value as a 16-bit number with scale and offset; fill for null, NaN and infinities, an error for values out of range."""
    stored = F.rint((finite(x) - offset) / scale)
    ranged = F.when(stored.between(-32767, 32767), stored.cast("int")).otherwise(F.raise_error(F.format_string("%s is out of the packed range", x)).cast("int"))
    return F.when(stored.isNull(), F.lit(fill)).otherwise(ranged)


def unpacked(x: Column, scale: float, offset: float, fill: int = -32768) -> Column:
    return F.when(x != fill, x * scale + offset)


def band(area: Column, limits: tuple[float, ...]) -> Column:
    """Number of the band: 0 up to and including the first limit, and so on."""
    return reduce(lambda a, b: a + b, [(area > x).cast("int") for x in limits])


def row_mean(*columns: Column) -> Column:
    """Mean over columns, nulls left out."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in columns])
    return F.try_divide(total, reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns]))
