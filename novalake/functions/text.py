"""Flags, file names, manifest fields and object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a positive and of a negative difference.
POSITIVE_FLAGS = ["t", "1"]
NEGATIVE_FLAGS = ["f", "0"]

# What str.split() without arguments takes for white space.
_BLANKS = r"(?U)[\s\x1c-\x1f]+"


def difference_sign(flag: Column) -> Column:
    """true / false / NULL for anything else."""
    norm = F.lower(F.trim(flag))
    return F.when(norm.isin(POSITIVE_FLAGS), F.lit(True)).when(
        norm.isin(NEGATIVE_FLAGS), F.lit(False)
    )


def blank_separated_fields(line: Column) -> Column:
    """Fields of a line; leading and trailing blanks make no empty field."""
    trimmed = F.regexp_replace(line, rf"{_BLANKS}$|^{_BLANKS}", "")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, _BLANKS)).otherwise(
        F.array().cast("array<string>")
    )


def base_name(path: Column) -> Column:
    bare = F.regexp_replace(path, r"(/\.?)+$", "")
    return F.element_at(F.split(bare, "/"), -1)


def payload_kind(payload_type: Column) -> Column:
    return F.lower(F.replace(payload_type, F.lit("cutout"), F.lit("")))


def payload_key(prefix: str, candid: Column, payload_type: Column) -> Column:
    """``<prefix>/<candid>/<candid>_<kind>.fits.gz``, one slash after the prefix."""
    folder = prefix if prefix.endswith("/") else prefix + "/"
    return F.concat(
        F.lit(folder), candid, F.lit("/"), candid, F.lit("_"), payload_kind(payload_type),
        F.lit(".fits.gz"),
    )
