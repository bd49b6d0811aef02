"""File names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/*$", 1)


def stem(path: Column) -> Column:
    """The base name without its last suffix; a name that only begins with a dot keeps it."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def shell_stem(path: Column) -> Column:
    """As a shell's suffix cut does it: a leading dot counts as a suffix too."""
    return F.regexp_replace(basename(path), r"\.[^.]*$", "")


def extension(path: Column) -> Column:
    """The last suffix with its dot, or nothing."""
    return F.regexp_extract(basename(path), r".(\.[^.]*)$", 1)


def strip_prefix(path: Column, prefix: str) -> Column:
    """path relative to a leading folder; other paths stay."""
    return F.when(F.startswith(path, F.lit(prefix)), F.substring(path, F.lit(len(prefix) + 1), F.char_length(path))).otherwise(path)


def result_name(name: Column, mark: str) -> Column:
    """A result's stem without every mark in it, wherever it stands."""
    return F.replace(name, F.lit(mark), F.lit(""))
