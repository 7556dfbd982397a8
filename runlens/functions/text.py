"""Run keys, ISO timestamps and canonical row text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.numeric import decimal_text
from runlens.schemas import METRIC_DECIMALS


def compact_date(date: Column) -> Column:
    """yyyyMMdd of a date. Casting a date to text involves no time zone, unlike ``date_format``."""
    return F.replace(date.cast("date").cast("string"), F.lit("-"), F.lit(""))


def midnight_iso(date: Column) -> Column:
    """yyyy-MM-ddT00:00:00 of a date."""
    return F.concat(date.cast("date").cast("string"), F.lit("T00:00:00"))


def iso_timestamp(ts: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ss of a timestamp without zone; fractions of a second are dropped. Casting it to
    text involves no time zone, unlike ``date_format``."""
    return F.replace(F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19), F.lit(" "), F.lit("T"))


def run_date(run_timestamp: Column) -> Column:
    """The calendar day of an ISO run timestamp; null where the text is no date."""
    return F.substring(run_timestamp, 1, 10).try_cast("date")


def run_key(pipeline: Column, day: Column, ordinal: Column | None = None) -> Column:
    """``{pipeline}_{yyyymmdd}`` and, if given, ``_{ordinal}``; null when any part is null."""
    key = F.concat(pipeline, F.lit("_"), compact_date(day))
    return key if ordinal is None else F.concat(key, F.lit("_"), ordinal.cast("string"))


def canonical_text(df: DataFrame, columns: list[str], decimals: int = METRIC_DECIMALS) -> Column:
    """One text per row for hashing, different for different rows: ``N`` for null, otherwise ``V``, the
    text's length, a colon and the text. Doubles are written with ``decimals`` digits, as metrics are;
    one that needs more fails the query rather than being cut."""

    def field(name: str) -> Column:
        text = F.col(name).cast("string")
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            value = F.col(name).cast("double") + F.lit(0.0)
            text = decimal_text(value, decimals)
            refuse = F.raise_error(F.concat(F.lit(f"{name} needs more than {decimals} decimals: "), value.cast("string")))
            text = F.when(text.cast("double").eqNullSafe(value), text).otherwise(refuse.cast("string"))
        return F.coalesce(F.concat(F.lit("V"), F.length(text).cast("string"), F.lit(":"), text), F.lit("N"))

    return F.concat(*[field(c) for c in columns])


def python_text(df: DataFrame) -> DataFrame:
    """Booleans and doubles as Python prints them (True, 7.1e-05), for consumers of the CSV that
    parse it as text. Doubles of 1e16 and more, which Python prints with an exponent, fail the query."""

    def field(f: T.StructField) -> Column:
        value = F.col(f.name)
        if isinstance(f.dataType, T.BooleanType):
            value = F.initcap(value.cast("string"))
        elif isinstance(f.dataType, T.DoubleType):
            plain = F.call_function("format_number", value, F.lit("0.0" + "#" * 17))
            short = F.call_function("format_number", value, F.lit("0." + "#" * 17 + "E00"))
            tiny = (F.abs(value) < 1e-4) & (value != 0)
            refuse = F.raise_error(F.concat(F.lit(f"{f.name} is too large: "), value.cast("string"))).cast("string")
            value = F.when(F.abs(value) >= 1e16, refuse).when(tiny, F.lower(short)).otherwise(plain)
        return value.alias(f.name)

    return df.select(*[field(f) for f in df.schema.fields])
