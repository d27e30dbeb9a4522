"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV with header; quotes are doubled and blanks kept, so ``read_delimited`` gives the same values."""
    df.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=compression).csv(path)


def write_json(df: DataFrame, path: str, compression: str = "none") -> None:
    """One JSON object per line, NULL fields included."""
    df.write.options(ignoreNullFields=False, compression=compression).json(path)
