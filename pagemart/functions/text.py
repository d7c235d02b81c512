"""Text and scalar clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# A "word" for title-casing is a run of letters/digits; every other run (space, '-', '_', '#',
# apostrophe, ...) is kept as is and starts a new word. This is the SQL INITCAP rule; Spark's own
# ``initcap`` splits on spaces only, so it would give 'Pneus-scp' instead of 'Pneus-Scp'.
_WORD_OR_GAP = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def initcap_words(c: Column) -> Column:
    """Upper-case the first character of every alphanumeric run, lower-case the rest."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(_WORD_OR_GAP), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substr(r, F.lit(1), F.lit(1))),
                                                              F.substr(r, F.lit(2)))), "")


def blank_to_null(c: Column) -> Column:
    """``NULLIF(TRIM(c), '')``: trim spaces (not tabs) and turn an empty result into NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def zero_to_null(c: Column) -> Column:
    """``NULLIF(c, 0)`` for counters."""
    return F.nullif(c, F.lit(0))


def int_to_bool(c: Column) -> Column:
    """0/1 integer flag to boolean (non-zero is true, NULL stays NULL)."""
    return c.cast("boolean")


def strip_nul(c: Column) -> Column:
    """Remove NUL characters, which a text column in the target database cannot hold."""
    return F.translate(c, "\x00", "")


def strip_nul_strings(df: DataFrame) -> DataFrame:
    """Apply ``strip_nul`` to every top-level string column, pass other types through."""
    return df.select([strip_nul(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType)
                      else F.col(f.name) for f in df.schema.fields])
