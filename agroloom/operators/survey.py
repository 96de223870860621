"""Field survey and desk classification: recoding and joining."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import code_from_number, date_prefix

#: Names of land-use codes.
LAND_USE = {
    "1": "forest",
    "2": "natural_grassland",
    "3": "agriculture",
    "4": "bare",
    "5": "build_up",
    "6": "natural_shrubs",
    "7": "water",
    "8": "wetland",
    "9": "undecided",
}
# End of fixed values.
UNDECIDED = "9"
KEY = ("id_psu", "box_id", "id_ssu", "lu_code")


def land_use_name(code: Column) -> Column:
    """The name of a code; a code without one stays."""
    names = F.create_map(*[F.lit(x) for pair in LAND_USE.items() for x in pair])
    return F.coalesce(F.try_element_at(names, code), code)


def recode_land_use(df: DataFrame) -> DataFrame:
    """``lu_code``, ``landuse`` and ``croptype`` without gaps.

    A missing code is undecided; a missing land use is its code's name, one that is a number is that
    number's name; a missing crop type is the land use.
    """
    df = df.withColumn("lu_code", F.coalesce("lu_code", F.lit(UNDECIDED)))
    df = df.withColumn("lu_code", F.coalesce(code_from_number(F.col("lu_code")), F.col("lu_code")))
    number = code_from_number(F.col("landuse"))
    named = F.when(F.col("landuse").rlike(r"^[1-9]\.0$"), land_use_name(number)).otherwise(F.col("landuse"))
    df = df.withColumn("landuse", F.coalesce(named, land_use_name(F.col("lu_code"))))
    return df.withColumn("croptype", F.coalesce("croptype", "landuse"))


def join_survey(survey: DataFrame, desk: DataFrame, key: tuple[str, ...] = KEY, geometry: str | None = None) -> DataFrame:
    """All desk rows with their survey rows; other columns that both have end in ``_x`` and ``_y``.

    ``geometry`` names a column that is the desk's alone in the result, under its own name.
    """
    if geometry:
        survey = survey.drop(geometry)
    clash = (set(survey.columns) & set(desk.columns)) - set(key)
    survey = survey.withColumnsRenamed({c: f"{c}_x" for c in clash})
    desk = desk.withColumnsRenamed({c: f"{c}_y" for c in clash})
    return survey.join(desk, list(key), "right")


def fill_dates(df: DataFrame, text: str, date: str = "date") -> DataFrame:
    """``date`` from a text's first ten characters; where it is null, the earliest of all."""
    df = df.withColumn(date, F.to_date(date_prefix(F.col(text))))
    earliest = df.agg(F.min(date).alias("__earliest"))
    return df.crossJoin(F.broadcast(earliest)).withColumn(date, F.coalesce(date, "__earliest")).drop("__earliest")


def join_rounded(left: DataFrame, right: DataFrame, digits: int = 4) -> DataFrame:
    """Left rows with the right rows at equal x and y after rounding, halves to the even digit.

    Other columns that both have end in ``_original`` on the right. Several matches give several
    rows; a null coordinate matches nothing.
    """
    key = [F.bround(c, digits).alias(f"__{c}") for c in ("x", "y")]
    clash = set(left.columns) & set(right.columns)
    renamed = right.select("*", *key).withColumnsRenamed({c: f"{c}_original" for c in clash})
    joined = left.select("*", *key).join(renamed, ["__x", "__y"], "left")
    return joined.drop("__x", "__y")
