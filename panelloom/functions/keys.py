"""Key and label normalisation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace plus the four separator control characters.
_SPACE = r"[\s\x1c-\x1f]"


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` drops spaces only)."""
    return F.regexp_replace(col, f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def pad_key(col: Column, width: int = 5, trim: bool = False) -> Column:
    """Left-pad with zeros to ``width``; longer keys stay whole and NULL stays NULL.

    A leading sign stays in front of the zeros.
    """
    key = col.cast("string")
    if trim:
        key = strip(key)
    signed = key.rlike("^[+-]")
    padded = F.when(
        signed, F.concat(key.substr(1, 1), F.lpad(F.regexp_replace(key, "^[+-]", ""), width - 1, "0"))
    ).otherwise(F.lpad(key, width, "0"))
    return F.when(F.length(key) < width, padded).otherwise(key)


def strip_suffix_word(col: Column, word: str = "County") -> Column:
    """Trim, drop one trailing ``word`` and collapse runs of whitespace to one space."""
    without = F.regexp_replace(strip(col.cast("string")), f"(?U){_SPACE}+{word}$", "")
    return F.regexp_replace(without, f"(?U){_SPACE}+", " ")


def category_label(col: Column, exact: Mapping[str, str] | None = None) -> Column:
    """Map known labels exactly; turn any other label into a lower-case identifier."""
    raw = strip(col.cast("string"))
    ident = F.translate(F.replace(F.lower(raw), F.lit("&"), F.lit("and")), "/- ", "___")
    if not exact:
        return ident
    pairs = [F.lit(part) for item in exact.items() for part in item]
    return F.coalesce(F.create_map(*pairs)[raw], ident)


def has_prefix(col: Column, prefix: str) -> Column:
    """Prefix test that is False, not NULL, on a missing value."""
    return F.coalesce(F.startswith(col, F.lit(prefix)), F.lit(False))
