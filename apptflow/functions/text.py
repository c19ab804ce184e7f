"""Text tests, label lookups and small parsers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Whether the lower-cased text holds one of ``words``; null stays null."""
    pattern = "|".join(re.escape(w) for w in words)
    return F.lower(text).rlike(pattern)


def label(value: Column, labels: Mapping, default: str | Column) -> Column:
    """A fixed code list as a conditional expression, no join needed."""
    out = None
    for code, name in labels.items():
        out = (F.when if out is None else out.when)(value == F.lit(code), F.lit(name))
    fallback = default if isinstance(default, Column) else F.lit(default)
    return fallback if out is None else out.otherwise(fallback)


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def owner_name(owner: Column) -> Column:
    """The part of an account before ``@``; empty when there is no account."""
    return F.coalesce(F.substring_index(owner, "@", 1), F.lit(""))


def topic_phone(topic: Column) -> Column:
    """The last ten characters of a longer topic when all are digits, else empty."""
    return F.coalesce(F.regexp_extract(topic, r"(?s).(\p{Nd}{10})\z", 1), F.lit(""))


def is_free(code: Column) -> Column:
    """Null or zero: nobody has taken the record over."""
    return code.isNull() | (code == 0)


def delivery_code(content: Column) -> Column:
    return F.split_part(content, F.lit(" "), F.lit(1))


def delivery_time(content: Column) -> Column:
    """Second word as ``yyyyMMddHHmm``; null when it is anything else."""
    stamp = F.split_part(content, F.lit(" "), F.lit(2))
    parts = [F.substring(stamp, i, n) for i, n in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2))]
    y, mo, d, h, mi = parts
    iso = F.concat(y, F.lit("-"), mo, F.lit("-"), d, F.lit(" "), h, F.lit(":"), mi)
    return F.when(stamp.rlike(r"^[0-9]{12}$"), iso).try_cast("timestamp_ntz")
