"""Column expressions: coercion, label coding, derived features, hash draws.

Everything here returns a ``Column`` made of built-in functions, so it stays in
generated code next to the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidecall import fixed_values as V

# --- coercion and missing values -------------------------------------------------


def to_number(c: str | Column) -> Column:
    """Text to double; anything but a decimal number, an infinity or NaN becomes null.

    The cast alone would also take the suffixes and hexadecimal forms of Java.
    """
    return F.when(_col(c).rlike(V.NUMBER_PATTERN), _col(c).try_cast("double"))


def drop_sentinel(c: str | Column, sentinel: str = V.UNKNOWN) -> Column:
    """Null where the text equals the sentinel exactly."""
    return F.nullif(_col(c), F.lit(sentinel))


def fill(c: str | Column, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def nan_to_null(c: str | Column) -> Column:
    return F.nullif(_col(c), F.lit(float("nan")))


def finite(c: str | Column) -> Column:
    """The value as double, or null for null, NaN and infinities."""
    x = _col(c).cast("double")
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def normalize_text(c: str | Column) -> Column:
    return F.trim(F.lower(_col(c)))


def epoch_millis(c: str | Column) -> Column:
    return F.timestamp_millis(_col(c))


def struct_field(c: str | Column, field: str, default) -> Column:
    """Field of a struct that may be null, with a default."""
    return F.coalesce(_col(c).getField(field), F.lit(default))


# --- label -----------------------------------------------------------------------


def encode_label(c: str | Column) -> Column:
    """1 for the exact positive word, 0 for everything else including null."""
    return F.when(_col(c) == V.POSITIVE, 1).otherwise(0)


def decode_label(c: str | Column) -> Column:
    """1 and 0 to words; any other number becomes null."""
    return F.when(_col(c) == 1, V.POSITIVE).when(_col(c) == 0, V.NEGATIVE)


# --- derived features --------------------------------------------------------------
# Comparisons with null are never true, so nulls reach the last branch.


def _first_match(branches: list[tuple[Column, object]], rest) -> Column:
    start = F.when(*branches[0])
    return reduce(lambda acc, b: acc.when(*b), branches[1:], start).otherwise(rest)


def job_category(c: str | Column = "job") -> Column:
    job = _col(c)
    return _first_match([(job.isin(names), g) for g, names in V.JOB_GROUPS.items()], V.JOB_OTHER)


def education_level(c: str | Column = "education") -> Column:
    return _first_match([(_col(c) == name, n) for name, n in V.EDUCATION_LEVELS.items()], 0)


def positive_flag(c: str | Column) -> Column:
    return F.when(_col(c) > 0, 1).otherwise(0)


def age_group(c: str | Column = "age") -> Column:
    return _first_match([(_col(c) < cut, name) for cut, name in V.AGE_CUTS], V.AGE_REST)


def campaign_intensity(c: str | Column = "campaign") -> Column:
    return _first_match([(_col(c) <= cut, name) for cut, name in V.CAMPAIGN_CUTS], V.CAMPAIGN_REST)


def month_number(c: str | Column = "month") -> Column:
    position = F.array_position(F.lit(V.MONTHS), _col(c)).cast("int")
    return F.coalesce(F.nullif(position, F.lit(0)), F.lit(V.MONTH_DEFAULT))


def month_cycle(number: Column) -> tuple[Column, Column]:
    """Sine and cosine of the month's angle on a yearly circle."""
    angle = F.lit(2.0) * F.pi() * number / F.lit(12.0)
    return F.sin(angle), F.cos(angle)


# --- row keys and hash draws -----------------------------------------------------

FIELD_SEPARATOR = "\x1f"
NULL_MARK = "\x1e"


def row_digest(cols: list[str]) -> Column:
    """md5 over the named columns; null and empty text stay distinct."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_MARK)) for c in cols]
    return F.md5(F.concat_ws(FIELD_SEPARATOR, *parts))


def hash_order(key: str | list[str], seed: int = V.SEED, draw: str | None = None) -> Column:
    """A uniform pseudo-random text per row key, the same on every run and layout.

    Different ``draw`` names give independent orders: rows picked by one draw
    (say, the test side of a split) are not favoured by another.
    """
    keys = [key] if isinstance(key, str) else key
    prefix = f"{seed}:{draw}" if draw else str(seed)
    return F.md5(F.concat_ws(":", F.lit(prefix), *[F.col(f"`{k}`").cast("string") for k in keys]))


def hash_below(order: Column, fraction: float) -> Column:
    """True for the given share of rows, by the leading 32 bits of a hash order."""
    if fraction >= 1.0:
        return F.lit(True)
    return F.substring(order, 1, 8) < F.lit(f"{int(fraction * 2**32):08x}")


def hash_uniform(order: Column, part: int = 0) -> Column:
    """A double in [0, 1) from one of the four 32-bit words of a hash order."""
    word = F.conv(F.substring(order, 1 + 8 * part, 8), 16, 10).cast("double")
    return word / F.lit(float(2**32))


# --- scoring ---------------------------------------------------------------------


def decide(probability: str | Column, threshold: float = V.THRESHOLD) -> Column:
    return (_col(probability) >= F.lit(threshold)).cast("int")


def adjust_prediction(
    prediction: str | Column,
    key: str | list[str],
    boost: float = V.CONFIDENCE_BOOST,
    seed: int = V.SEED,
) -> Column:
    """Turn the given share of zero predictions into ones, chosen by row key."""
    flip = (_col(prediction) == 0) & hash_below(hash_order(key, seed, "adjust"), boost)
    return F.when(flip, 1).otherwise(_col(prediction))


def _col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c
