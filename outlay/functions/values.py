"""Typing, comparing and formatting of values. Nothing here raises on bad data under ANSI mode."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that the usual dataframe CSV readers take for a missing value.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def na_to_null(df: DataFrame) -> DataFrame:
    """Read the NA tokens of every text column as NULL."""
    return df.select(
        *[
            F.when(~F.col(f.name).isin(NA_TOKENS), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def typed(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bind ``schema`` by name; a value that does not fit its type becomes NULL, and so does a
    floating-point number that is not finite.

    ``keep`` names further columns to carry along unchanged.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(
        *[_fitting(f).alias(f.name) for f in schema],
        *[F.col(name) for name in keep],
    )


def _fitting(field: T.StructField) -> Column:
    value = F.col(field.name).try_cast(field.dataType)
    return F.when(is_finite(value), value) if isinstance(field.dataType, T.DoubleType) else value


def is_finite(number: Column) -> Column:
    """False for NaN and the infinities, NULL for NULL."""
    return F.when(number.isNotNull(), ~F.isnan(number) & (F.abs(number) < float("inf")))


def unparsed(column: str, data_type: str) -> Column:
    """True where the value is missing or cannot be read as ``data_type``."""
    return F.col(column).try_cast(data_type).isNull()


def is_close(actual: Column, expected: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """True where the two differ by at most ``atol + rtol * |expected|``; NULL where one is NULL.

    Numbers that are not finite are close to nothing.
    """
    near = F.abs(actual - expected) <= F.lit(atol) + F.lit(rtol) * F.abs(expected)
    known = actual.isNotNull() & expected.isNotNull()
    return F.when(known, near & is_finite(actual) & is_finite(expected))


# Places behind the point, in bits, of a double's fraction that are added up exactly.
_FRACTION_BITS = 60


def exact_parts(x: Column) -> tuple[Column, Column]:
    """A double as two whole numbers: its floor, and its fraction in units of 2^-60.

    Nothing is lost for numbers of at least 2^-8 and less than 2^63 in size, and zero; of smaller
    ones, what lies below 2^-60 is. Larger ones and those that are not finite raise.
    """
    whole = F.floor(x)
    fraction = F.floor((x - whole) * F.lit(float(1 << _FRACTION_BITS)))
    return whole.cast("decimal(20,0)"), fraction.cast("decimal(20,0)")


def exact_total(whole: Column, fraction: Column) -> Column:
    """The double nearest to the sum of numbers of which the parts (:func:`exact_parts`) were added.

    Whole numbers have no order of addition. They are put together as one number in units of 2^-60
    and read as text, which rounds once; where that has more than 38 digits, the fraction only
    decides ties.
    """
    unit = F.lit(1 << _FRACTION_BITS).cast("decimal(38,0)")
    whole, fraction = whole.cast("decimal(38,0)"), fraction.cast("decimal(38,0)")
    rest = F.pmod(fraction, unit).cast("decimal(38,0)")
    carried = ((fraction - rest) / unit).cast("decimal(38,0)")
    high = (whole + carried).cast("decimal(38,0)")
    small = F.abs(high) < F.lit(str(1 << 64)).cast("decimal(38,0)")
    units = (high * unit + rest).cast("decimal(38,0)").cast("string").cast("double")
    sticky = (high * 10 + (rest > 0).cast("int")).cast("decimal(38,0)").cast("string")
    return F.when(small, units / F.lit(float(1 << _FRACTION_BITS))).when(
        high.isNotNull(), F.concat(sticky, F.lit("e-1")).cast("double")
    )


def fixed2(amount: Column) -> Column:
    """Two decimals as text, NULL kept: the double's exact value rounded, ties to even.

    Formatting by the JVM would round the shortest decimal form half up instead. The fraction,
    times 2^60, is an exact whole number from 2^-8 up (below, it rounds to nothing), and its
    hundredfold is formed from two halves of 30 bits.
    """
    size = F.abs(amount)
    whole = F.floor(size)
    scaled = ((size - whole) * F.lit(float(1 << 60))).cast("bigint")
    half = F.lit(1 << 30)
    low = F.pmod(scaled, half) * 100
    high = F.shiftright(scaled, 30) * 100 + F.shiftright(low, 30)
    cents = F.shiftright(high, 30)
    rest = F.pmod(high, half) * half + F.pmod(low, half)
    tie = F.lit(1 << 59)
    up = (rest > tie) | ((rest == tie) & (cents % 2 == 1))
    cents = cents + up.cast("bigint")
    text = F.format_string(
        "%s%d.%02d", F.when(amount < 0, "-").otherwise(""), whole + F.floor(cents / 100), cents % 100
    )
    small = is_finite(amount) & (size < float(1 << 52))
    return F.when(small, text).when(amount.isNotNull(), F.format_string("%.2f", amount))


def half_even(amount: Column) -> Column:
    """Whole number as text, ties to even, NULL kept."""
    return F.when(amount.isNotNull(), F.format_string("%.0f", F.bround(amount, 0)))
