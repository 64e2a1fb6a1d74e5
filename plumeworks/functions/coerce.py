"""Tolerant casts. ANSI mode stays on: what cannot be read becomes NULL, nothing raises.

Missing values are NULL only; a NaN that arrives from a file is turned into NULL here,
because Spark aggregates do not skip NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, NumericType, StringType, TimestampNTZType, TimestampType

# Cell texts that a delimited reader takes as "missing".
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_DATED = r"^\s*\d{4}(?:-.*)?$"
# what the cast reads as it stands, and how the other common forms are brought into that shape
_PLAIN = r"^\s*\d{4}(?:-\d\d?(?:-\d\d?(?:[T ]\d\d?:\d\d(?::\d\d.*)?)?)?)?\s*$"
_REWRITES = [
    (r"^\s*(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3"),
    (r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2"),
    (r"^\s*(\d{4})(\d{2})(\d{2})(?=\s|T|$)", "$1-$2-$3"),
    (r"([T ]\d{1,2}:\d{2})(?=(?:[zZ]|[+-]\d{2}:?\d{2})\s*$)", "$1:00"),
]
_MONTH_FIRST = r"^\s*([A-Za-z]{3})[A-Za-z]*\.?\s+(\d{1,2}),?\s+(\d{4})(.*)$"
_DAY_FIRST = r"^\s*(\d{1,2})\s+([A-Za-z]{3})[A-Za-z]*\.?,?\s+(\d{4})(.*)$"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

_NUMBER = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)\s*$"
_OFFSET = r"([zZ]|[+-]\d{2}:?\d{2})\s*$"
_CLOCK = r"^(?:[01]\d|2[0-3])[0-5]\d$"
_MICROS_PER_DAY = 86_400_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~c.isin(MISSING_TOKENS), c)


def nan_to_null(c: Column | str) -> Column:
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def to_number(c: Column | str) -> Column:
    """Text to double, NULL when it is not a plain decimal (``1d`` and ``0x1`` are not)."""
    text = _col(c).cast("string")
    # names its input once, so it does not multiply when the optimizer repeats it
    return F.regexp_extract(text, _NUMBER, 0).try_cast("double")


def number_in(df: DataFrame, name: str) -> Column:
    """``to_number`` for a text column; a column that is numeric already only loses its NaNs."""
    kind = df.schema[name].dataType
    if isinstance(kind, (DoubleType, FloatType)):
        return nan_to_null(F.col(name).cast("double"))
    return F.col(name).cast("double") if isinstance(kind, NumericType) else to_number(name)


def day_in(df: DataFrame, name: str) -> Column:
    """``to_day`` for a text column; a date or timestamp column is not turned into text first."""
    kind = df.schema[name].dataType
    if isinstance(kind, (DateType, TimestampNTZType, TimestampType)):
        return F.to_date(name)
    return to_day(name)


def _named_month(text: Column, pattern: str, month: int, day: int) -> Column:
    number = F.floor((F.instr(F.lit(_MONTHS), F.lower(F.regexp_extract(text, pattern, month))) + 2) / 3)
    return F.concat(
        F.regexp_extract(text, pattern, 3), F.lit("-"), number.cast("string"), F.lit("-"), F.regexp_extract(text, pattern, day),
        F.regexp_extract(text, pattern, 4),
    )


def _readable(text: Column) -> Column:
    """The text as the cast reads it, else an empty text.

    Read are year-month-day with dashes, slashes or nothing in between, month/day/year, and
    English month names before or after the day; a time of day and an offset may follow, the
    seconds may be missing. Most feeds are dashed already and skip the rewriting.
    """
    dashed = text
    for pattern, to in _REWRITES:
        dashed = F.regexp_replace(dashed, pattern, to)
    named = F.when(text.rlike(_MONTH_FIRST), _named_month(text, _MONTH_FIRST, 1, 2)).when(text.rlike(_DAY_FIRST), _named_month(text, _DAY_FIRST, 2, 1))
    return F.regexp_extract(F.when(text.rlike(_PLAIN), text).otherwise(F.coalesce(named, dashed)), _DATED, 0)


def parse_once(df: DataFrame, columns: list[Column]) -> DataFrame:
    """Select parsed columns so that each text is parsed exactly once.

    Later filters on a parsed column would be pushed below the projection and repeat the
    parsing there (and grow the generated code beyond what the JVM compiles). They are
    not pushed below a generator; the one-element ``inline`` is such a generator. Tables
    whose columns are typed already do not come here and keep their pushdown.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def _dashed(text: Column) -> Column:
    """Whether the cast reads the text as :func:`_readable` gives it, if it reads it at all: a year of four digits and a dash, no
    white space at the end. No pattern is run, and most feeds look like this."""
    return (F.substring(text, 5, 1) == "-") & (F.substring(text, -1, 1) > " ")


def to_local_timestamp(c: Column | str) -> Column:
    """Text to a zone-less timestamp; an offset in the text is ignored, the wall clock kept."""
    text = _col(c).cast("string")
    return F.coalesce(F.when(_dashed(text), text.try_cast("timestamp_ntz")), _readable(text).try_cast("timestamp_ntz"))


def to_day(c: Column | str) -> Column:
    return F.to_date(to_local_timestamp(c))


def utc_day(c: Column | str) -> Column:
    """The UTC calendar day of a text with an offset; without one the text counts as UTC.

    Computed from the epoch, so the session time zone does not matter.
    """
    text = _readable(_col(c).cast("string"))
    micros = F.unix_micros(text.try_cast("timestamp"))
    shifted = F.date_from_unix_date(F.floor(micros / F.lit(_MICROS_PER_DAY)).cast("int"))
    return F.when(text.rlike(_OFFSET), shifted).otherwise(F.to_date(text.try_cast("timestamp_ntz")))


def _clock(acq_time: Column | str) -> Column:
    clock = F.trim(_col(acq_time).cast("string"))
    # lpad would cut longer texts, and those must stay invalid
    return F.when(F.length(clock) < 4, F.lpad(clock, 4, "0")).otherwise(clock)


def fire_moment(df: DataFrame) -> Column:
    """``fire_timestamp`` of a table: a typed ``acq_date`` gives its day without going through text."""
    if is_text(df, "acq_date"):
        return fire_timestamp("acq_date", "acq_time")
    clock = _clock("acq_time")
    minutes = F.substring(clock, 1, 2).try_cast("int") * 60 + F.substring(clock, 3, 2).try_cast("int")
    day = F.to_date("acq_date").cast("timestamp_ntz")
    return F.when(clock.rlike(_CLOCK), day + F.make_dt_interval(mins=minutes))


def fire_timestamp(acq_date: Column | str, acq_time: Column | str) -> Column:
    """Acquisition day plus an ``HHMM`` clock that may have lost its leading zeros.

    Impossible clocks are common in these feeds; a pattern refuses them, which is far
    cheaper than letting the parser fail.
    """
    day = _readable(F.trim(_col(acq_date).cast("string")))
    clock = _clock(acq_time)
    moment = F.concat(day, F.lit(" "), F.substring(clock, 1, 2), F.lit(":"), F.substring(clock, 3, 2))
    return F.when(clock.rlike(_CLOCK), moment.try_cast("timestamp_ntz"))
