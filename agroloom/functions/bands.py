"""Bands of a sample's time series: names, no-data and units, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The no-data mark, and the column of each band; ``{}`` is the timestep.
NODATA = 65535
BAND_COLUMNS = {
    "B2": "OPTICAL-B02-ts{}-10m",
    "B3": "OPTICAL-B03-ts{}-10m",
    "B4": "OPTICAL-B04-ts{}-10m",
    "B5": "OPTICAL-B05-ts{}-20m",
    "B6": "OPTICAL-B06-ts{}-20m",
    "B7": "OPTICAL-B07-ts{}-20m",
    "B8": "OPTICAL-B08-ts{}-10m",
    "B8A": "OPTICAL-B8A-ts{}-20m",
    "B11": "OPTICAL-B11-ts{}-20m",
    "B12": "OPTICAL-B12-ts{}-20m",
    "VH": "SAR-VH-ts{}-20m",
    "VV": "SAR-VV-ts{}-20m",
    "precipitation": "METEO-precipitation_flux-ts{}-100m",
    "temperature": "METEO-temperature_mean-ts{}-100m",
    "elevation": "DEM-alt-20m",
    "slope": "DEM-slo-20m",
}
OPTICAL = ("B2", "B3", "B4", "B5", "B6", "B7", "B8", "B8A", "B11", "B12")
SAR = ("VH", "VV")
METEO = ("precipitation", "temperature")
DEM = ("elevation", "slope")
# End of fixed values.


def valid(value: Column) -> Column:
    """Whether a value is one: not null and not the no-data mark."""
    return value.isNotNull() & (value != NODATA)


def sar_to_db(value: Column) -> Column:
    """Amplitude in decibels; a value of no amplitude stays as it is."""
    return F.when(valid(value) & (value > 0), 20 * F.log10(value) - 83).otherwise(value)


def precipitation_in_metres(value: Column) -> Column:
    return F.when(valid(value), value / 100_000).otherwise(value)


def temperature_in_degrees(value: Column) -> Column:
    return F.when(valid(value), value / 100).otherwise(value)


def in_units(band: str, value: Column) -> Column:
    """The band's value in its unit; an unknown band is an error."""
    if band in SAR:
        return sar_to_db(value)
    if band == "precipitation":
        return precipitation_in_metres(value)
    if band == "temperature":
        return temperature_in_degrees(value)
    if band in OPTICAL or band in DEM:
        return value
    raise ValueError(f"unknown band: {band}")


def no_values(length: int) -> Column:
    """A series without values."""
    return F.array_repeat(F.lit(float(NODATA)), length)


def packed(band: str, timesteps: int) -> Column:
    """The band's timestep columns as one array; null counts as no data."""
    columns = [BAND_COLUMNS[band].format(t) for t in range(timesteps)]
    return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(NODATA))) for c in columns])
