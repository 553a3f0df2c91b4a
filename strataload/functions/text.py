"""Text cleansing expressions. ``trim`` removes spaces only, as in the source systems' database."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "N/A"


def fold_null(text: Column) -> Column:
    """NULL becomes the unknown text; blanks are kept."""
    return F.coalesce(text, F.lit(UNKNOWN))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def clean_text(text: Column) -> Column:
    """Trimmed text; NULL and blank become the unknown text."""
    return F.coalesce(blank_to_null(text), F.lit(UNKNOWN))


def clean_flag(flag: Column) -> Column:
    """Trimmed upper-case flag; NULL and blank count as set."""
    return F.coalesce(F.nullif(F.upper(F.trim(flag)), F.lit("")), F.lit("Y"))


def has_key(key: Column) -> Column:
    """True for keys that are neither NULL nor blank."""
    return blank_to_null(key).isNotNull()


def is_set(flag: Column, value: str = "Y") -> Column:
    """Flag comparison that tolerates case and padding; NULL is not set."""
    return F.upper(F.trim(F.coalesce(flag, F.lit("")))) == F.lit(value)


def joined_key(separator: str, *parts: Column) -> Column:
    """Parts joined by ``separator`` after folding NULL to the unknown text."""
    return F.concat_ws(separator, *[fold_null(part) for part in parts])


def plain_concat_key(separator: str, *parts: Column) -> Column:
    """Parts joined by ``separator`` with NULL as empty text, so the key is never NULL."""
    pieces: list[Column] = []
    for position, part in enumerate(parts):
        if position:
            pieces.append(F.lit(separator))
        pieces.append(F.coalesce(part, F.lit("")))
    return F.concat(*pieces)
