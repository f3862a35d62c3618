"""One consistent form for texts that look the same but differ in their characters.

Method: a character belongs to the *unstable* set when Unicode's quick-check property for compatibility
composition is No or Maybe for it, or when it is an invisible character, an unusual white space or a
look-alike letter. One regular expression finds the runs of unstable characters; each run is taken with the
single character before it (the only one a combining mark can still merge with), brought to canonical form
on its own, and spliced back. Text outside the runs is never touched, and a text without any run is returned
as the same object.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts that are drawn like a Latin letter, each beside that letter.
LOOKALIKES = {
    "ɑ": "a", "ɡ": "g", "ı": "i", "ȷ": "j", "Ɡ": "G",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Һ": "H",
    "а": "a", "е": "e", "к": "k", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i",
    "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ү": "y", "ѵ": "v", "ӏ": "l", "Ӏ": "I",
    "Օ": "O", "Տ": "S", "Լ": "L", "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "զ": "q",
}

#: Characters outside category Cf that show nothing: the joiner, fillers and variation selectors.
_HIDDEN = "͏ᅟᅠ឴឵᠋-᠍᠏ㅤ︀-️ﾠ\U000e0100-\U000e01ef"
_CJK = "㐀-䶿一-鿿豈-﫿\U00020000-\U000323af"
_WORD = re.compile(f"[{_CJK}]|[^\\W_{_CJK}]+")
_ASCII_WORD = re.compile("[a-z0-9]+")


def _ranges(points: list[int]) -> str:
    """A regular-expression class body for sorted code points."""
    out, start, last = [], None, None
    for p in [*points, None]:
        if start is not None and (p is None or p != last + 1):
            out.append(f"\\U{start:08x}-\\U{last:08x}")
            start = p
        elif start is None:
            start = p
        last = p
    return "".join(out)


@lru_cache(maxsize=1)
def _tables() -> tuple[re.Pattern, re.Pattern, dict[int, str]]:
    """The segment expression, the expression for control characters, and the map of single characters.

    Beyond the basic plane every character counts as unstable: bringing a stable one to canonical form changes
    nothing, and the expression stays a bitmap.
    """
    hidden = re.compile(f"[{_HIDDEN}]")
    unstable, gone = [], [*range(0xE0100, 0xE01F0), *range(0xE0000, 0xE0080)]
    for p in [*range(0x80, 0xD800), *range(0xE000, 0x10000)]:
        c = chr(p)
        kind = unicodedata.category(c)
        if kind == "Cf" or hidden.match(c):
            gone.append(p)
        elif not (
            c in LOOKALIKES
            or c.isspace()
            or unicodedata.combining(c)
            or 0x1161 <= p <= 0x11C2
            or not unicodedata.is_normalized("NFKC", c)
        ):
            continue
        unstable.append(p)
    cls = "\\x00-\\x1f\\x7f" + _ranges(unstable) + "\\U00010000-\\U0010ffff"
    moves = {ord(a): b for a, b in LOOKALIKES.items()} | {p: "" for p in gone}
    moves |= {p: "" for p in [*range(0x09), *range(0x0E, 0x1C), 0x7F]}
    moves |= {p: " " for p in [*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0x2028, 0x2029]}
    return re.compile(f"[^{cls}]?[{cls}]+"), re.compile("[\\x00-\\x08\\x0e-\\x1b\\x7f]"), moves


def _segment(m: re.Match) -> str:
    _, _, moves = _tables()
    s = unicodedata.normalize("NFKD", m.group().translate(moves)).translate(moves)
    return unicodedata.normalize("NFC", re.sub(r"\s", " ", s))


def plain(text: str | None) -> str | None:
    """The plain form: ordinary characters, single spaces, trimmed ends. Case, punctuation and accents stay.

    A null stays null; a text of only white space or invisible characters becomes the empty text.
    """
    if text is None:
        return None
    segment, control, _ = _tables()
    if not text.isascii():
        text = segment.sub(_segment, text)
    elif control.search(text):
        text = control.sub("", text)
    return " ".join(text.split())


def words(text: str | None) -> list[str]:
    """Words of the plain lower-case form: runs of letters or digits; each Chinese character is a word."""
    if not text:
        return []
    text = plain(text).lower()
    return (_ASCII_WORD if text.isascii() else _WORD).findall(text)


def plain_column(col: Column) -> Column:
    """`plain` over a string column, in Arrow batches; texts of printable ASCII without runs stay in the JVM."""

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(plain, na_action="ignore")

    settled = col.isNull() | col.rlike("^(?:[!-~]+(?: [!-~]+)*)?$")
    return F.when(settled, col).otherwise(run(F.when(~settled, col)))
