"""Row filters and projections."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.schemas import LATITUDE_BOX, LONGITUDE_BOX

# Single letters stand for one or two digits.
DATE_FORMATS = (
    "yyyy-M-d", "yyyy/M/d", "M/d/yyyy", "d.M.yyyy", "yyyyMMdd",
    "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy",
)
# A time of day after the date, with or without fractions and zone.
TIME_OF_DAY = r"[T ]\d{1,2}:\d{2}(:\d{2}([.,]\d+)?)?\s*(Z|UTC|[+-]\d{2}:?\d{2})?$"


def price_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Keep rows with ``low <= column <= high``. A null is dropped."""
    if not low < high:
        raise ValueError(f"The lower bound must be below the upper one: {low}, {high}")
    return df.where(F.col(column).between(low, high))


def parse_date(column: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits; a text that fits none becomes null.

    A time of day after the date is left out, unless a format has one. Formats are tried
    just on texts of their shape: a failed parse costs an exception, and a column of junk
    would raise one per row and format.
    """
    text = F.trim(column)
    day = F.regexp_replace(text, TIME_OF_DAY, "")
    return F.coalesce(*[_parse(text if "H" in fmt else day, fmt) for fmt in formats])


def _parse(text: Column, fmt: str) -> Column:
    day = F.to_date(F.try_to_timestamp(text, F.lit(fmt)))
    if not set(re.findall("[A-Za-z]", fmt)) <= set("yMdHms") or "'" in fmt or "[" in fmt:
        return day

    def shape(run: re.Match) -> str:
        letters = run.group()
        if not letters[0].isalpha():
            return re.escape(letters)
        if letters.startswith("MMM"):
            return r"[A-Za-z]{3}" if letters == "MMM" else r"[A-Za-z]{3,9}"
        return r"\d{1,2}" if len(letters) == 1 else rf"\d{{{len(letters)}}}"

    pattern = re.sub(r"([A-Za-z])\1*|[^A-Za-z]", shape, fmt)
    return F.when(text.rlike(f"^{pattern}$"), day)


def clean_dates(
    df: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """Make date columns real dates: text is parsed, dates and timestamps lose the time."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            c: parse_date(F.col(c), formats) if types[c] == "string" else F.col(c).cast("date")
            for c in columns
        }
    )


def lost_dates(
    df: DataFrame, columns: Sequence[str], formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """One row per text column: how many texts it has, and how many ``clean_dates`` loses."""
    counts = []
    for c in columns:
        has_text = F.coalesce(F.trim(F.col(c)) != "", F.lit(False))
        counts.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count_if(has_text).alias("texts"),
                F.count_if(has_text & parse_date(F.col(c), formats).isNull()).alias("lost"),
            )
        )
    return df.agg(F.array(*counts).alias("_c")).select(F.inline("_c"))


def bounding_box(
    df: DataFrame,
    longitude: str,
    latitude: str,
    longitude_box: tuple[float, float] = LONGITUDE_BOX,
    latitude_box: tuple[float, float] = LATITUDE_BOX,
) -> DataFrame:
    """Keep points inside the box, borders included. A point without a coordinate is dropped."""
    return df.where(
        F.col(longitude).between(*longitude_box) & F.col(latitude).between(*latitude_box)
    )


def clean_listings(
    df: DataFrame,
    low: float,
    high: float,
    price: str = "price",
    dates: Sequence[str] = ("last_review",),
    longitude: str = "longitude",
    latitude: str = "latitude",
    longitude_box: tuple[float, float] = LONGITUDE_BOX,
    latitude_box: tuple[float, float] = LATITUDE_BOX,
) -> DataFrame:
    """Price filter, dates, box filter. Column names and their order do not change."""
    cleaned = (
        price_range(df, price, low, high)
        .transform(clean_dates, dates)
        .transform(bounding_box, longitude, latitude, longitude_box, latitude_box)
    )
    if cleaned.columns != df.columns:
        raise ValueError("Cleaning must keep the columns and their order")
    return cleaned


def split_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Features without the label, and the label alone; use one with the table's key."""
    return df.drop(label), df.select(label)


def keep_features(df: DataFrame, features: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Only the declared features, after any ``extra`` columns such as key and label."""
    return df.select(*extra, *features)
