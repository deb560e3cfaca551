"""Documents that operators must cope with, and plain versions of what they compute."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor\tsit amet consectetur\n" * 4000 + "z" * 30_000

TEXTS = [
    "Hello  world, don't!\n\n\tHello world", None, "", "   \n\t ", LONG, "a", "aaaa" * 300, "日本語 🎉🎉 é x\x1cy",
    "same text here of five words", "same text here of five words", "Same TEXT here of five words",
    "<s> </turn> ### \\ <|endoftext|> 0x0A ▁▁x", "token = \"b44e15e09fd311c3cf3163b66d5a9875\"", "1234567890 " * 7,
]

#: Names that operators use for themselves, with values that would do harm.
CLASHING = {"_row": "1", "_text": "x", "_hash": "y", "_fp": "2", "score": "3", "n_tokens": "4", "kept": "5"}


def awkward(spark):
    """Null, empty, blank, very long and repeated texts; a null id; equal ids; a repeated row; extra columns."""
    rows = [(number, text, "en" if number % 2 else None, f"src{number % 5}") for number, text in enumerate(TEXTS, 1)]
    rows += [(None, "a text without an id", "de", "src1"), (1, "another text of id one", "xx", None), rows[7], rows[7]]
    schema = StructType(
        [
            StructField("doc_id", LongType()),
            StructField("text", StringType()),
            StructField("lang", StringType()),
            StructField("source", StringType()),
        ]
    )
    frame = spark.createDataFrame(rows, schema)
    return frame.select("*", F.lit(1).cast("long").alias("n_chars"), *[F.lit(v).alias(k) for k, v in CLASHING.items()])


def nothing(spark):
    return awkward(spark).limit(0)


def plain_rows(frame):
    """Rows as sorted tuples, null first."""
    return sorted((tuple(row) for row in frame.collect()), key=lambda row: [(v is not None, str(v)) for v in row])


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def labels(spark, rows):
    return spark.createDataFrame(
        rows, StructType([StructField("doc_id", LongType()), StructField("quality", LongType()),
                          StructField("toxic", LongType()), StructField("score", DoubleType())])
    )
