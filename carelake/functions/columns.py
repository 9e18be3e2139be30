"""Column expressions shared by the operators, of built-in Spark functions only.
Those that a catalog view needs, too, are written as SQL text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_bigint(c) -> Column:
    """SAFE_CAST(x AS INT64): NULL instead of an error; '5.0' -> NULL."""
    return col_(c).try_cast("bigint")


def lenient_double(c) -> Column:
    """Coerce text to a number the forgiving way: unparsable -> NULL, NaN -> NULL."""
    d = col_(c).try_cast("double")
    return F.when(~F.isnan(d), d)


def number_or_zero(c) -> Column:
    """Fill-then-coerce of the legacy ETL: NULL, unparsable or NaN -> 0.0."""
    return F.coalesce(lenient_double(c), F.lit(0.0))


def integral_key(c) -> Column:
    """A numeric code read leniently ('5', ' 05 ', '5.0') as a whole number;
    NULL for text and for non-integral values like '5.5'."""
    d = lenient_double(c)
    return F.when(d % 1 == 0, d.try_cast("bigint"))


# Unicode white space, for Java's and RE2's regular expressions alike, and its
# characters one after the other.
WHITESPACE = (r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
              r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
BLANKS = "".join(map(chr, [*range(0x09, 0x0e), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b),
                           0x2028, 0x2029, 0x202f, 0x205f, 0x3000]))


def strip_ws_sql(c: str) -> str:
    """Remove leading and trailing Unicode white space, as a warehouse TRIM()
    or Python's str.strip() does; Spark's ``trim`` alone only removes spaces."""
    blanks = "".join(f"\\u{ord(blank):04x}" for blank in BLANKS)
    return f"btrim({c}, '{blanks}')"


def strip_ws(c) -> Column:
    """:func:`strip_ws_sql` of a column or its name."""
    return F.btrim(col_(c), F.lit(BLANKS))


# The months of the dd-MMM-yyyy form.
MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()


def date_forms(c: str) -> dict[str, tuple[str, str]]:
    """The date forms of the raw files: name -> (SQL test of the shape, SQL of the
    same date in ISO form, which may still be no date)."""
    months = ", ".join(f"'{m}', '{i:02d}'" for i, m in enumerate(MONTHS, 1))
    return {
        "iso": (rf"{c} RLIKE r'^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\z'", c),
        "compact": (rf"{c} RLIKE r'^[0-9]{{8}}\z'", f"concat(substr({c}, 1, 4), '-', substr({c}, 5, 2), '-', substr({c}, 7, 2))"),
        "named": (rf"{c} RLIKE r'^[0-9]{{2}}-[A-Za-z]{{3}}-[0-9]{{4}}\z'",
                  f"concat(substr({c}, 8, 4), '-', try_element_at(map({months}), upper(substr({c}, 4, 3))), '-', substr({c}, 1, 2))"),
    }


def iso_date_sql(c: str) -> str:
    """Render a date given as yyyy-MM-dd, yyyyMMdd or dd-MMM-yyyy as ISO text; text
    that is none of them is kept as it is. ISO text passes without being parsed."""
    forms = date_forms(c)
    others = " ".join(f"WHEN {test} THEN coalesce(CAST(TRY_CAST({iso} AS DATE) AS STRING), {c})"
                      for name, (test, iso) in forms.items() if name != "iso")
    return f"CASE WHEN {forms['iso'][0]} THEN {c} {others} ELSE {c} END"


def iso_date_text(c: str) -> Column:
    """:func:`iso_date_sql` of a column's name."""
    return F.expr(iso_date_sql(c))


def month_of(c) -> Column:
    """SUBSTR(date_text, 1, 7): the YYYY-MM month of an ISO date string."""
    return F.substring(col_(c), 1, 7)


def non_negative_amount(c) -> Column:
    """``x >= 0`` on a text amount: cast first (ANSI compares text with
    numbers as BIGINT), and NaN does not count as non-negative."""
    d = col_(c).cast("double")
    return (d >= 0) & ~F.isnan(d)
