"""Address repair (PIPE-08).

Address lines joined with address elements; only addresses missing a city
or a zip are repaired; foreign countries and foreign words are dropped; the
zip and city are taken from the first of lines 2..5 that starts with a zip
(first match wins); the state comes from the zip ranges. Two outputs from
one frame: a verify report (header line + old/new values) and an update file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.functions.numbers import first_matching_source
from recsmith.functions.rules import state_of
from recsmith.functions.strings import city_of, left_justify, zip_line_ok, zip_of
from recsmith.operators.filters import FOREIGN_COUNTRIES, FOREIGN_WORDS, any_blank, drop_in, drop_words
from recsmith.operators.joins import inner_join
from recsmith.operators.project import ensure_columns
from recsmith.sinks.writers import with_header
from recsmith.sources.layout import Layout

LINES = ["LINE1ADR", "LINE2ADR", "LINE3ADR", "LINE4ADR", "LINE5ADR"]
NEW_COUNTRY = "MALAYSIA"

UPDATE_LAYOUT = Layout.of([("CUSTNO", 1, 11), ("ADDREF", 12, 11, "z"), ("NEW_CITY", 23, 25),
                           ("STATEX", 48, 3), ("NEW_ZIP", 51, 5), ("NEW_COUNTRY", 56, 10)], lrecl=200)

VERIFY_LAYOUT = Layout.of([
    ("CUSTNO", 1, 11), ("DASH", 12, 1), ("ADDREF", 13, 11, "z"), ("LINE1ADR", 25, 40),
    ("LINE2ADR", 66, 40), ("LINE3ADR", 107, 40), ("LINE4ADR", 148, 40), ("LINE5ADR", 189, 40),
    ("OLD", 230, 5), ("ZIP", 236, 5), ("CITY", 241, 25), ("COUNTRY", 267, 10), ("NEW", 279, 5),
    ("NEW_ZIP", 285, 5), ("NEW_CITY", 291, 25), ("STATEX", 317, 3), ("NEW_COUNTRY", 321, 10),
], lrecl=350)

VERIFY_HEADER = Layout.of([
    ("h1", 1, 5), ("h2", 12, 1), ("h3", 13, 8), ("h4", 25, 8), ("h5", 66, 8), ("h6", 107, 8),
    ("h7", 148, 8), ("h8", 189, 8), ("h9", 236, 3), ("h10", 241, 4), ("h11", 267, 7),
    ("h12", 285, 3), ("h13", 291, 4), ("h14", 317, 7),
], lrecl=350)
# Header texts of the verify report, in field order.
VERIFY_HEADER_TEXT = ["CIS #", "-", "ADDR REF", "ADDLINE1", "ADDLINE2", "ADDLINE3", "ADDLINE4",
                      "ADDLINE5", "ZIP", "CITY", "COUNTRY", "ZIP", "CITY", "COUNTRY"]


def repaired(lines: DataFrame, elements: DataFrame) -> DataFrame:
    """``lines``: ADDREF, LINE1ADR..LINE5ADR (+ optional CUSTNO);
    ``elements``: ADDREF, CITY, ZIP, COUNTRY (+ optional STATEX)."""
    # Printed / tested but absent from the declared inputs: '' unless supplied.
    lines = ensure_columns(lines, {"CUSTNO": ""})
    elements = ensure_columns(elements, {"STATEX": ""})
    j = inner_join(lines, elements, "ADDREF")
    j = j.filter(any_blank("CITY", "ZIP"))
    j = drop_in(j, "COUNTRY", FOREIGN_COUNTRIES)
    pick = first_matching_source([
        (zip_line_ok(c), F.struct(zip_of(c).alias("zip"), city_of(c).alias("city"))) for c in LINES[1:]])
    j = j.withColumn("_m", pick).withColumns({
        "NEW_ZIP": F.coalesce(F.col("_m.zip"), F.lit("")),
        "NEW_CITY": F.coalesce(F.col("_m.city"), F.lit("")),
        "NEW_COUNTRY": F.when(F.col("_m").isNotNull(), F.lit(NEW_COUNTRY)).otherwise(F.lit("")),
        "ADDRLINE": F.concat(*[F.rpad(F.coalesce(F.col(c), F.lit("")), 40, " ") for c in LINES]),
    }).drop("_m")
    j = drop_words(j, "ADDRLINE", FOREIGN_WORDS)
    blank_state = (F.trim(F.col("STATEX")) == "") | (F.col("STATEX") == "N/A")
    j = j.withColumn("_zip", F.trim("NEW_ZIP").try_cast("int"))
    j = j.withColumn("STATEX", F.when(blank_state, state_of(F.col("_zip"))).otherwise(F.col("STATEX"))).drop("_zip")
    return j.withColumns({"NEW_ZIP": left_justify("NEW_ZIP"), "NEW_CITY": left_justify("NEW_CITY"),
                          "NEW_COUNTRY": left_justify("NEW_COUNTRY")}) \
        .filter(F.col("NEW_ZIP") != "")


def update_record() -> Column:
    return UPDATE_LAYOUT.render_expr({"NEW_CITY": F.upper("NEW_CITY")})


def update_records(rep: DataFrame) -> DataFrame:
    return rep.select(update_record().alias("value"))


def verify_report(rep: DataFrame) -> DataFrame:
    """Header line (number 0) + one line per repaired address, numbered in
    (CUSTNO, ADDREF) order."""
    body = rep.select("CUSTNO", "ADDREF", VERIFY_LAYOUT.render_expr(
        {"DASH": F.lit("-"), "OLD": F.lit("*OLD*"), "NEW": F.lit("*NEW*")}).alias("value"))
    return with_header(body, _header_text(), ["CUSTNO", "ADDREF", "value"])


def _header_text() -> str:
    line = [" "] * 350
    for f, text in zip(VERIFY_HEADER.fields, VERIFY_HEADER_TEXT):
        for i, ch in enumerate(text):
            line[f.start - 1 + i] = ch
    return "".join(line)
