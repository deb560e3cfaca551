"""Match minutes such as ``45+2``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Minute text is leading digits, optionally "+" and stoppage digits to the end.
BASE_PATTERN = r"^(\d+)"
STOPPAGE_PATTERN = r"^\d+\+(\d+)$"

# Buckets are 15 minutes wide up to 90.
BUCKET_WIDTH = 15
LAST_BUCKET_END = 90


class Minute(NamedTuple):
    raw: Column
    base: Column
    stoppage: Column
    exact: Column


def parse_minute(value: Column) -> Minute:
    """Split minute text. Stoppage is 0 for any text without a strict ``N+M``, null for null text."""
    raw = F.trim(value.cast("string"))
    base = F.regexp_extract(raw, BASE_PATTERN, 1).try_cast("int")
    extra = F.regexp_extract(raw, STOPPAGE_PATTERN, 1)
    stoppage = F.when(extra == "", F.lit(0)).otherwise(extra.try_cast("int"))
    return Minute(raw, base, stoppage, F.try_add(base, stoppage))


def minute_bucket(minute: Column) -> Column:
    """Label of the 15-minute bucket; later minutes share one open bucket, null stays null."""
    label = F.when(minute.isNull(), F.lit(None).cast("string"))
    start = 0
    for end in range(BUCKET_WIDTH, LAST_BUCKET_END + 1, BUCKET_WIDTH):
        label = label.when(minute <= end, F.lit(f"{start:02d}_{end:02d}"))
        start = end + 1
    return label.otherwise(F.lit(f"{LAST_BUCKET_END}_plus"))
