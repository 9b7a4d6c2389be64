"""Text and text-as-number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The longest leading part of a text that reads as a number, and the collation that
# ignores case, accents and trailing blanks.
NUMERIC_PREFIX = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
LOOSE_COLLATION = "UNICODE_CI_AI_RTRIM"


def lenient_num(c: Column) -> Column:
    """Number at the start of a text, 0 when there is none, NULL for NULL; never raises."""
    prefix = F.regexp_extract(c, NUMERIC_PREFIX, 1)
    return F.when(c.isNotNull(), F.coalesce(prefix.try_cast("double"), F.lit(0.0)))


def strict_num(c: Column) -> Column:
    """Number a text consists of, NULL for any other text (``try_cast`` would also read ``NaN`` or ``1d``)."""
    return F.regexp_extract(c, NUMERIC_PREFIX + r"\s*$", 1).try_cast("double")


def capitalise(c: Column) -> Column:
    """First letter upper, everything after it lower (unlike ``initcap``, which works per word)."""
    return F.concat(F.upper(F.substr(c, F.lit(1), F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def last_word(c: Column) -> Column:
    """Part after the last blank."""
    return F.substring_index(c, " ", -1)


def same_name(c: Column, name: str) -> Column:
    """Equality that ignores case, accents and trailing blanks."""
    return F.collate(c, LOOSE_COLLATION) == F.collate(F.lit(name), LOOSE_COLLATION)
