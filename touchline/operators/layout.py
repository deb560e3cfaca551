"""Typed projections from loosely named source columns."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fold_name(name: str) -> str:
    """Header spelling without accents, case, or the choice between space, hyphen and underscore."""
    decomposed = unicodedata.normalize("NFKD", name)
    plain = "".join(mark for mark in decomposed if not unicodedata.combining(mark))
    return plain.strip().lower().translate(str.maketrans(" -", "__"))


def resolve_column(available: Sequence[str], candidates: Sequence[str]) -> str:
    """First candidate that names one of the available columns; of equal spellings the last column wins."""
    spelled = {fold_name(name): name for name in available}
    for candidate in candidates:
        found = spelled.get(fold_name(candidate))
        if found is not None:
            return found
    raise KeyError(f"none of the columns {list(candidates)} found; the input has {list(available)}")


@dataclass(frozen=True)
class Field:
    """One output column: its name, the headers it may come under, and how its text is read."""

    name: str
    headers: tuple[str, ...]
    read: Callable[[Column], Column]


def source_columns(raw: DataFrame, fields: Sequence[Field]) -> dict[str, str]:
    """Output name to source header, for every field."""
    return {field.name: resolve_column(raw.columns, field.headers) for field in fields}


def rename_resolved(raw: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """The source columns under their output names, still as text."""
    found = source_columns(raw, fields)
    return raw.select(*[column(source).alias(name) for name, source in found.items()])


def project(
    raw: DataFrame, fields: Sequence[Field], extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """Typed projection of the fields, then the extra columns."""
    found = source_columns(raw, fields)
    typed = [field.read(column(found[field.name])).alias(field.name) for field in fields]
    more = [value.alias(name) for name, value in (extra or {}).items()]
    return raw.select(*typed, *more)


@dataclass(frozen=True)
class Target:
    """A declared output column: name, type, and the expression that fills it."""

    name: str
    type: str
    value: Callable[[], Column]


def conform(frame: DataFrame, targets: Sequence[Target]) -> DataFrame:
    """Project a frame onto a declared shape."""
    return frame.select(*[t.value().cast(t.type).alias(t.name) for t in targets])
