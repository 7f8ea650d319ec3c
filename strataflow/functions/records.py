"""Reading loosely typed record fields, and column naming."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """NULL or empty: a page without a previous page opens a visit."""
    return F.coalesce(text, F.lit("")) == ""


def int_of(text: Column) -> Column:
    return text.try_cast("int")


def decimal_of(text: Column) -> Column:
    return text.try_cast("decimal(16,2)")


def double_or_zero(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", lambda hit: "_" + hit.group(1).lower(), name)


def camel_case(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(part.capitalize() for part in rest)
