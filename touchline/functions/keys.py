"""Event identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator between the parts of a hashed key.
KEY_SEPARATOR = "||"


def digest_id(match_id: Column, *parts: Column) -> Column:
    """SHA-256 over the match key and the parts; a null part counts as empty text, a null match key is left out."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, match_id.cast("string"), *texts), 256)
