"""String column functions (STR-*). Every helper returns a native ``Column``.

Conventions (fixed-record semantics):
* character fields are blank-padded; on ingest they become ``rtrim`` and
  missing becomes ``''`` (``clean_text``), so blank keys still match;
* comparisons against padded literals rtrim both sides (``eq_padded``).
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = "Column | str"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Ingest policy: right-trim blanks, missing -> ''."""
    return F.coalesce(F.rtrim(col(c)), F.lit(""))


def eq_padded(c, value: str) -> Column:
    """Equality that ignores trailing blanks on both sides (fixed-width CHAR)."""
    return F.rtrim(col(c)) == F.lit(value.rstrip(" "))


def isin_padded(c, values: Iterable[str]) -> Column:
    return F.rtrim(col(c)).isin([v.rstrip(" ") for v in values])


def substr(c, pos: int, length: int) -> Column:
    """1-based substring (STR-01)."""
    return F.substring(col(c), pos, length)


def suffix(c, n: int) -> Column:
    """Last n characters (STR-02)."""
    return F.right(col(c), F.lit(n))


def concat_text(*cols) -> Column:
    """Concatenate; any missing part gives missing (STR-03)."""
    return F.concat(*[col(c) for c in cols])


def remove_chars(c, chars: str = " ") -> Column:
    """Delete every occurrence of each character in ``chars`` (STR-04)."""
    return F.translate(col(c), chars, "")


def translate_chars(c, from_chars: str, to_chars: str) -> Column:
    """Map each character of ``from_chars`` to the same position of ``to_chars`` (STR-05)."""
    return F.translate(col(c), from_chars, to_chars)


def zero_pad(n, width: int) -> Column:
    """Zero-padded integer text of ``width`` (STR-06).

    ``%0<w>d``: never truncates (a wider value is returned whole) and a minus
    sign counts in the width (-5 in width 3 is ``-05``). Missing stays missing.
    One call, so a rule that tests the padded value several times stays cheap.
    """
    v = col(n).cast("long")
    return F.when(v.isNotNull(), F.format_string(f"%0{int(width)}d", v))


def trim_text(c) -> Column:
    """Strip blanks both sides (STR-07)."""
    return F.trim(col(c))


def left_justify(c) -> Column:
    """Move leading blanks to the end, i.e. drop them (STR-08)."""
    return F.ltrim(col(c))


def upper_text(c) -> Column:
    return F.upper(col(c))


def contains_text(c, needle: str) -> Column:
    return F.contains(col(c), F.lit(needle))


def literal_alternation(needles: Iterable[str]) -> str:
    """Java regex matching any of the literals (each quoted with \\Q..\\E),
    guarded by a look-ahead on the possible first characters so that most
    positions are rejected with a single character-class test."""
    needles = list(needles)
    alts = "|".join("\\Q" + n.replace("\\E", "\\E\\\\E\\Q") + "\\E" for n in needles)
    firsts = "".join(ch if ch.isalnum() else "\\" + ch for ch in sorted({n[0] for n in needles if n}))
    return f"(?=[{firsts}])(?:{alts})" if firsts else alts


def contains_any(c, needles: Iterable[str]) -> Column:
    """True if any literal occurs (STR-10 / FLT-08).

    One regex over the column, not N ``contains`` calls: a filter on a computed
    column is pushed below its projection by substituting the definition into
    every reference, so N references would rebuild the column N times."""
    needles = list(needles)
    if len(needles) == 1:
        return contains_text(c, needles[0])
    return col(c).rlike(literal_alternation(needles))


def contains_none(c, needles: Iterable[str]) -> Column:
    return ~contains_any(c, needles)


def replace_value(c, old: str, new: str) -> Column:
    """Replace the whole value ``old`` with ``new`` (STR-11)."""
    return F.when(col(c) == F.lit(old), F.lit(new)).otherwise(col(c))


def overlay_at(c, text: str, pos: int) -> Column:
    """Overwrite characters starting at ``pos`` (STR-12)."""
    return F.overlay(col(c), F.lit(text), F.lit(pos), F.lit(len(text)))


def pad_right(c, width: int) -> Column:
    """Left-aligned field of exactly ``width`` chars, missing -> blanks (STR-14)."""
    return F.rpad(F.coalesce(col(c).cast("string"), F.lit("")), width, " ")


def pad_left(c, width: int, fill: str = " ") -> Column:
    """Right-aligned field of exactly ``width`` chars (STR-14)."""
    return F.lpad(F.coalesce(col(c).cast("string"), F.lit("")), width, fill)


def format_template(fmt: str, *cols) -> Column:
    """printf-style template (STR-15)."""
    return F.format_string(fmt, *[col(c) for c in cols])


def all_digits(c) -> Column:
    return col(c).rlike("^[0-9]+$")


def digits_to_long(c) -> Column:
    """Parse only all-digit text, else missing (STR-16)."""
    return F.when(all_digits(c), col(c).try_cast("long"))


def pad_concat(cols, width: int) -> Column:
    """Zero-pad each numeric column (missing as 0) and concatenate (STR-17)."""
    return F.concat(*[zero_pad(F.coalesce(col(c), F.lit(0)), width) for c in cols])


# ---------------------------------------------------------------------------
# Zip + city at the start of an address line (STR-13, FLT-12)
# ---------------------------------------------------------------------------

# Characters that may not appear in the five zip positions.
ZIP_EXCLUDED_CHARS = " ,&/-"
# Open text bounds of an accepted zip.
ZIP_LOW, ZIP_HIGH = "00001", "99998"


def zip_line_ok(line) -> Column:
    """Line begins with a plausible zip: text strictly between the bounds, none
    of the excluded characters in positions 1-5, a blank in position 6."""
    # Stored text is right-trimmed: pad back to 6 so a short line reads as blanks.
    head = F.rpad(F.coalesce(col(line), F.lit("")), 6, " ")
    z = F.substring(head, 1, 5)
    return ((z > F.lit(ZIP_LOW)) & (z < F.lit(ZIP_HIGH)) &
            z.rlike("^[^ ,&/\\-]{5}$") &
            (F.substring(head, 6, 1) == F.lit(" ")))


def zip_of(line) -> Column:
    return F.substring(col(line), 1, 5)


def city_of(line) -> Column:
    return F.substring(col(line), 7, 25)
