"""Text, key and hash functions as Columns; everything here stays inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip() sees it: Unicode white space and the four separators U+001C-001F.
_SPACE = r"[\s\x1C-\x1F\x{85}\p{Z}]"
TOKEN = r"[a-z0-9]+|[\x{4e00}-\x{9fff}]"


def strip(col: Column) -> Column:
    """Without white space of any kind at both ends; `trim` removes blanks only."""
    return F.regexp_replace(col, f"^{_SPACE}+|{_SPACE}+$", "")


def collapse(col: Column) -> Column:
    """White space runs as one blank, ends stripped."""
    return F.trim(F.regexp_replace(col, f"{_SPACE}+", " "))


def blank(col: Column) -> Column:
    """True for null and for text of white space only."""
    return F.coalesce(strip(col) == "", F.lit(True))


def tokens(col: Column) -> Column:
    """Runs of a-z and 0-9 of the lower-case text, and each character of U+4E00-9FFF; null has none."""
    return F.coalesce(F.regexp_extract_all(F.lower(col), F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))


def hash_fraction(key: Column) -> Column:
    """The first eight hexadecimal digits of the SHA-256 of a key as a fraction of their largest value."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def in_share(key: Column, seed: object, share: float) -> Column:
    """A stable draw: true for about `share` of the keys; adding keys moves none."""
    return hash_fraction(F.concat(F.lit(f"{seed}:"), key)) < F.lit(float(share))


def blob_sha(content: Column) -> Column:
    """The object name that git gives a file of these bytes."""
    head = F.encode(F.concat(F.lit("blob "), F.length(content).cast("string")), "UTF-8")
    return F.sha1(F.concat(head, F.unhex(F.lit("00")), content))
