"""Phone numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptflow.config import COUNTRY_PREFIX, MOBILE_PREFIX, PHONE_COLUMNS

# decimal digits of any script, but only of the basic plane
NOT_A_DIGIT = r"[\P{Nd}\x{10000}-\x{10FFFF}]+"


def digits(raw: Column) -> Column:
    return F.regexp_replace(raw, NOT_A_DIGIT, "")


def mobile_number(raw: Column, prefix: str = MOBILE_PREFIX, strict_length: bool = False) -> Column:
    """The last ten digits when they begin with ``prefix``, else null.

    A shorter number that begins with the prefix is accepted as well unless
    ``strict_length`` is set.
    """
    rest = 10 - len(prefix)
    last_ten, shorter = f"{prefix}.{{{rest}}}", f"^{prefix}.{{0,{rest - 1}}}"
    pattern = f"({last_ten})$" if strict_length else f"({last_ten}|{shorter})$"
    return F.nullif(F.regexp_extract(digits(raw), pattern, 1), F.lit(""))


def contact_dimension(
    df: DataFrame,
    phone_cols: Sequence[str] = PHONE_COLUMNS,
    prefix: str = MOBILE_PREFIX,
    strict_length: bool = False,
) -> DataFrame:
    """``df`` plus ``mobile``: the first usable number in ``phone_cols`` order."""
    present = [c for c in phone_cols if c in df.columns]
    if not present:
        return df.withColumn("mobile", F.lit(None).cast("string"))
    numbers = [mobile_number(F.col(c), prefix, strict_length) for c in present]
    return df.withColumn("mobile", F.coalesce(*numbers))


def msisdn(number: Column, country: str = COUNTRY_PREFIX) -> Column:
    return F.when(F.char_length(number) == 10, F.concat(F.lit(country), number)).otherwise(number)
