"""Text clean-up, keys and delimited micro-formats."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Texts the sources use for "no value".
SENTINELS = ("", "#n/a", "none", "null", "to be confirmed")


def clean_sentinels(col: Column, sentinels: Sequence[str] = SENTINELS, default=None, null_too: bool = True) -> Column:
    """Replace no-value texts (trimmed, any case) by ``default``."""
    hit = F.lower(F.trim(col)).isin([s.lower() for s in sentinels])
    if null_too:
        hit = hit | col.isNull()
    return F.when(hit, F.lit(default)).otherwise(col)


def first_present(*cols: Column) -> Column:
    """First value that is neither null nor empty text; the last one is taken as it is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols[:-1]], cols[-1])


def join_parts(first: Column, second: Column, na: str = "N/A", sep: str = " , ") -> Column:
    """Two address parts in one text. ``na`` stands for a part left out; a null part makes the result null."""
    no_first, no_second = first == F.lit(na), second == F.lit(na)
    return (F.when(no_first & no_second, F.lit(None)).when(~no_first & no_second, first).when(no_first & ~no_second, second)
            .when(~no_first & ~no_second, F.concat(first, F.lit(sep), second)))


def fold_key(col: Column) -> Column:
    """Join key that ignores case and blanks."""
    return F.replace(F.lower(col), F.lit(" "), F.lit(""))


def strip_line_breaks(col: Column, by: str = "") -> Column:
    return F.regexp_replace(col, r"[\r\n]+", by)


def strip_leading_zeros(col: Column) -> Column:
    return F.regexp_replace(col, "^0+", "")


def alnum_only(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9A-Za-z]", "")


def normalise_ref(col: Column, drop: str = "r") -> Column:
    """Invoice reference as lower-case letters and digits, one noise letter removed."""
    return F.translate(F.lower(alnum_only(col)), drop, "")


def trimmed_ref(col: Column) -> Column:
    """Invoice reference in lower case without blanks, leading zeros or a trailing ``r``."""
    return F.regexp_replace(strip_leading_zeros(F.lower(F.trim(col))), "r$", "")


def strip_trailing(col: Column, mark: str = ",") -> Column:
    """Drop one trailing mark."""
    return F.when(F.endswith(col, F.lit(mark)), F.substring(col, F.lit(1), F.length(col) - len(mark))).otherwise(col)


def currency_number(col: Column, type_: str = "double") -> Column:
    """``$1,234.50`` to a number; text that is not a number gives null."""
    return F.translate(col, "$, ", "").try_cast(type_)


def export_safe(col: Column, sep: str = ",") -> Column:
    """Remove the delimiter, quotes and line breaks so that no quoting is needed."""
    return F.translate(col, sep + "\"'\r\n", "")


def match_key(*parts: Column, sep: str = "|") -> Column:
    """Concatenated key; any null part makes the key null, so it matches nothing."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [part.cast("string"), F.lit(sep)]
    return F.concat(*pieces[:-1])


def token(col: Column, sep: str, position: int) -> Column:
    """The token at a 0-based position of a delimited text, null past the end."""
    return F.get(F.split(col, re.escape(sep)), F.lit(position))


def split_code(col: Column, pattern: str, group: int, type_: str = "int") -> Column:
    """One group of a compound code such as ``M12S345``; no match gives null."""
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit("")).try_cast(type_)


def stamp_rule_value(col: Column, want: str, sep: str = "|", inner: str = ":") -> Column:
    """From ``value:count|value:count`` the value whose count equals ``want``.

    A text with a single pair gives its value whatever the count.
    """
    parts = F.transform(F.split(col, re.escape(sep)), lambda p: F.split(p, re.escape(inner)))
    hits = F.filter(parts, lambda p: F.get(p, F.lit(1)) == F.lit(want))
    chosen = F.when(F.size(parts) == 1, F.get(parts, F.lit(0))).otherwise(F.get(hits, F.lit(0)))
    return F.get(chosen, F.lit(0))


def route_first_char(col: Column, letters: bool) -> Column:
    """The value when its first character is a letter (or, with ``letters=False``, is not)."""
    is_letter = F.rlike(col, F.lit("^[A-Za-z]"))
    return F.when(is_letter if letters else ~is_letter, col)


def url_param(url: Column, key: str) -> Column:
    """A query parameter's raw value; no such parameter gives null."""
    found = F.regexp_extract(url, r"[?&]" + re.escape(key) + r"=([^&#]*)", 1)
    return F.nullif(found, F.lit(""))


def underscore_name(name: str) -> str:
    """A column name with runs of blanks and punctuation turned into ``_``."""
    return re.sub(r"[^0-9A-Za-z]+", "_", name.strip()).strip("_").lower()
