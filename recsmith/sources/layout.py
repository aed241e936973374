"""Record layouts: one declaration used by both the reader and the writer.

A ``Layout`` is an ordered list of ``Field(name, start, width, kind, scale)``
with 1-based byte positions. Kinds:

``c``  character, stored right-trimmed, missing -> ''
``n``  display number (``w.`` / ``w.d``); no decimal point -> implied decimals
``z``  display number written zero-padded (``Zw.``)
``p``  packed decimal (``PDw.d``), ``width`` bytes, from a binary record
``x``  packed decimal already rendered as hex text (2 * width characters)
``d``  date text in ``pattern``

Decoding is a single ``select`` of ``substring`` expressions over the record
column, so unused fields are pruned by the optimizer and every row is
decoded inside generated code. Duplicate names: the later field wins
(the same bytes read twice under one name).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.functions.strings import clean_text, zero_pad


@dataclass(frozen=True)
class Field:
    name: str
    start: int
    width: int
    kind: str = "c"
    scale: int = 0
    pattern: str = "yyyy-MM-dd"

    @property
    def chars(self) -> int:
        """Characters the field occupies in a text record (hex packed: 2 per byte)."""
        return 2 * self.width if self.kind == "x" else self.width

    @property
    def end(self) -> int:
        return self.start + self.chars - 1


@dataclass
class Layout:
    fields: list[Field] = field(default_factory=list)
    lrecl: int | None = None

    @classmethod
    def of(cls, spec: Iterable[tuple], lrecl: int | None = None) -> "Layout":
        return cls([Field(*t) for t in spec], lrecl)

    @property
    def names(self) -> list[str]:
        seen: dict[str, None] = {}
        for f in self.fields:
            seen[f.name] = None
        return list(seen)

    # ------------------------------------------------------------------ read
    def field_expr(self, f: Field, record: Column, binary: bool = False) -> Column:
        raw = F.substring(record, f.start, f.width)
        if f.kind == "c":
            return clean_text(raw.cast("string") if binary else raw)
        if f.kind in ("n", "z"):
            return display_number(raw, f.width, f.scale)
        if f.kind == "p":
            return unpack_hex(F.hex(raw), f.scale)
        if f.kind == "x":
            return unpack_hex(F.substring(record, f.start, 2 * f.width), f.scale)
        if f.kind == "d":
            return F.try_to_date(F.trim(raw), f.pattern)
        raise ValueError(f"unknown field kind {f.kind!r}")

    def raw_expr(self, f: Field, raw: Column) -> Column:
        """Value of a field from what the binary record source gives for it."""
        if f.kind == "c":
            return clean_text(raw)
        if f.kind in ("n", "z"):
            return display_number(raw, f.width, f.scale)
        if f.kind == "p":
            number = raw.try_cast("decimal(38,0)")
            return (number / F.lit(10 ** f.scale)).try_cast(f"decimal(38,{f.scale})") if f.scale else raw.try_cast("long")
        if f.kind == "d":
            return F.try_to_date(F.trim(raw), f.pattern)
        raise ValueError(f"no binary field kind {f.kind!r}")

    def decode(self, df: DataFrame, record: str = "value", keep: Sequence[str] = (),
               binary: bool = False) -> DataFrame:
        exprs: dict[str, Column] = {}
        for f in self.fields:
            exprs[f.name] = self.field_expr(f, F.col(record), binary)
        return df.select(*[F.col(k) for k in keep],
                         *[e.alias(n) for n, e in exprs.items()])

    # ----------------------------------------------------------------- write
    def number_text(self, f: Field, value: Column) -> Column:
        """Digits of a numeric field before it is laid out (null stays null)."""
        if f.kind == "z":
            return zero_pad(value, f.width)
        if f.kind == "x":
            return pack_hex(value, f.width, f.scale)
        return value.cast(f"decimal(38,{f.scale})").cast("string") if f.scale else value.cast("long").cast("string")

    def overflow(self, f: Field, value: Column) -> Column:
        """Does a number need more characters than its field has?"""
        if f.kind not in ("n", "z", "x"):
            return F.lit(False)
        return F.coalesce(F.length(self.number_text(f, value)) > f.chars, F.lit(False))

    def overflow_count(self, values: dict[str, Column] | None = None) -> Column:
        """How many fields of a row do not fit; such a field is written as
        asterisks, never as some of its digits."""
        values = values or {}
        return sum((self.overflow(f, values.get(f.name, F.col(f.name))).cast("int") for f in self.fields), F.lit(0))

    def format_field(self, f: Field, value: Column) -> Column:
        """The field's text, always ``f.chars`` characters and never null: missing
        text and numbers are blanks, a missing packed number is positive zero, a
        number that does not fit is asterisks."""
        if f.kind == "c":
            return F.rpad(F.coalesce(value.cast("string"), F.lit("")), f.width, " ")
        if f.kind == "d":
            return F.rpad(F.coalesce(F.date_format(value, f.pattern), F.lit("")), f.width, " ")
        if f.kind not in ("n", "z", "x"):
            raise ValueError(f"cannot render field kind {f.kind!r}")
        missing = "0" * (f.chars - 1) + "C" if f.kind == "x" else " " * f.chars
        txt = self.number_text(f, value)
        laid = F.coalesce(F.lpad(txt, f.chars, "0" if f.kind == "z" else " "), F.lit(missing))
        return F.when(F.length(txt) > f.chars, F.lit("*" * f.chars)).otherwise(laid)

    def rendered_values(self, width: int | None = None,
                        names: Sequence[str] | None = None) -> list[Column]:
        """Field values exactly as the writer lays them out inside the first
        ``width`` bytes (text cut to its width and right-trimmed). Two rows
        render the same prefix iff these values are equal, so a dedup on the
        rendered prefix is a plain distinct on these columns, with no string
        building and no sort. ``names`` restricts the output to those fields."""
        out = []
        for f in self.fields:
            if width is not None and f.start > width:
                continue
            if names is not None and f.name not in names:
                continue
            w = f.width if width is None else min(f.width, width - f.start + 1)
            if f.kind == "c":
                v = F.rtrim(F.substring(F.coalesce(F.col(f.name).cast("string"), F.lit("")), 1, w))
            else:
                v = F.substring(self.format_field(f, F.col(f.name)), 1, w)
            out.append(v.alias(f.name))
        return out

    def render(self, df: DataFrame, name: str = "value", keep: Sequence[str] = ()) -> DataFrame:
        return df.select(*[F.col(k) for k in keep], self.render_expr().alias(name))

    def render_expr(self, values: dict[str, Column] | None = None) -> Column:
        """Concatenate fields at their positions; gaps are blanks, literal
        fields may be given as ``values={name: lit(...)}``."""
        values = values or {}
        parts: list[Column] = []
        pos = 1
        for f in sorted(self.fields, key=lambda x: x.start):
            if f.start < pos:
                raise ValueError(f"field {f.name} overlaps the previous field")
            if f.start > pos:
                parts.append(F.lit(" " * (f.start - pos)))
            parts.append(self.format_field(f, values.get(f.name, F.col(f.name))))
            pos = f.end + 1
        line = F.concat(*parts)
        if self.lrecl:
            line = F.rpad(line, self.lrecl, " ")
        return line


def binary_record(layout: Layout, values: dict[str, Column] | None = None) -> Column:
    """SNK-04 for binary records: fields at their byte positions, packed decimals as bytes
    (missing: positive zero), gaps blank. A packed number too wide for its field is an error."""
    values, parts, pos = values or {}, [], 1
    for f in sorted(layout.fields, key=lambda x: x.start):
        if f.start < pos:
            raise ValueError(f"field {f.name} overlaps the previous field")
        if f.start > pos:
            parts.append(F.lit(" " * (f.start - pos)).cast("binary"))
        value = values.get(f.name, F.col(f.name))
        if f.kind == "p":
            text = F.coalesce(pack_hex(value, f.width, f.scale), F.lit("0" * (2 * f.width - 1) + "C"))
            wide = F.length(text) > 2 * f.width
            parts.append(F.unhex(F.when(wide, F.raise_error(F.lit(f"{f.name} does not fit {f.width} packed bytes")))
                                 .otherwise(text)))
        else:
            # Widths are bytes: text of several bytes a character is cut or padded by bytes.
            parts.append(F.rpad(layout.format_field(f, value).cast("binary"), f.width, F.lit(" ").cast("binary")))
        pos = f.start + f.width
    line = F.concat(*parts)
    return F.rpad(line, layout.lrecl, F.lit(" ").cast("binary")) if layout.lrecl else line


def display_number(raw: Column, width: int, scale: int = 0) -> Column:
    """Display numeric text -> number. Text with a decimal point is taken as
    written; otherwise ``scale`` implied decimals are applied."""
    t = F.trim(raw.cast("string"))
    if scale == 0:
        return t.try_cast("long")
    dec = t.try_cast(f"decimal({max(width, scale + 1) + 1},{scale})")
    implied = (t.try_cast("decimal(38,0)") / F.lit(10 ** scale)).try_cast(
        f"decimal({max(width, scale + 1) + 1},{scale})")
    return F.when(F.contains(t, F.lit(".")), dec).otherwise(implied)


def unpack_hex(hex_text: Column, scale: int = 0) -> Column:
    """Packed decimal from its hex text: all nibbles but the last are digits,
    the last is the sign (D negative; C, F positive). Anything else -> missing."""
    h = F.upper(hex_text)
    digits = F.substring(h, F.lit(1), F.length(h) - 1)
    sign = F.substring(h, -1, 1)
    valid = digits.rlike("^[0-9]+$") & sign.isin("C", "D", "F")
    mag = digits.try_cast("decimal(38,0)")
    signed = F.when(sign == "D", -mag).otherwise(mag)
    if scale:
        signed = (signed / F.lit(10 ** scale)).try_cast(f"decimal(38,{scale})")
    else:
        signed = signed.try_cast("long")
    return F.when(valid, signed)


def pack_hex(value: Column, width: int, scale: int = 0) -> Column:
    """Inverse of ``unpack_hex``: hex text of a ``width``-byte packed field;
    longer than the field if the number does not fit."""
    n = value if not scale else value * F.lit(10 ** scale)
    n = n.cast("decimal(38,0)")
    digits = F.abs(n).cast("string")
    digits = F.when(F.length(digits) < 2 * width - 1, F.lpad(digits, 2 * width - 1, "0")).otherwise(digits)
    sign = F.when(n < 0, F.lit("D")).otherwise(F.lit("C"))
    return F.concat(digits, sign)
