"""Column expressions shared by the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that count as missing.
NULL_TEXTS = ["", "nan", "none", "null", "na", "n/a", "sin dato", "sin_dato", "desconocido"]
NULL_ID_TEXTS = ["", "nan", "none", "null", "na", "n/a"]

# Latin letters with accents and their plain forms.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC"

# White space of any script.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Letters that Java's number parser would take ("1.0d", hex) are kept out by this pattern.
NUMBER_PATTERN = r"^[-+0-9.eE\s]+$|^\s*[-+]?(?i:inf|infinity)\s*$"


def strip_space(c: Column) -> Column:
    """Drop every kind of white space at both ends (``trim`` only drops blanks)."""
    return F.trim(c, F.lit(SPACES))


def text_form(c: Column) -> Column:
    return F.lower(strip_space(c.cast("string")))


def known_text(text: Column, null_texts: Iterable[str] = NULL_TEXTS) -> Column:
    """A text in its form, null where it stands for a missing value."""
    return F.when(~text.isin(list(null_texts)), text)


def strip_accents(c: Column) -> Column:
    # Combining marks cover text that arrives already decomposed.
    return F.regexp_replace(F.translate(c, ACCENTED, PLAIN), r"\p{M}+", "")


def text_key(c: Column) -> Column:
    """Lookup form of a text: no accents, no outer space, lower case, null as ''."""
    return F.lower(strip_space(strip_accents(F.coalesce(c.cast("string"), F.lit("")))))


def decimal_point(c: Column) -> Column:
    return F.translate(c, ",", ".")


def parsed(text: Column) -> Column:
    """Text with decimal points to double; what is no number gives null.

    Plain numbers are told by their first and last character; only other texts that the
    cast takes (suffixes, hex, infinities, NaN, outer space) are held against the pattern.
    """
    value = text.try_cast("double")
    first, last = F.substring(text, 1, 1), F.substring(text, -1, 1)
    plain = (
        (first.between("0", "9") | first.isin("-", "+", "."))
        & (last.between("0", "9") | (last == "."))
        & ~F.contains(text, F.lit("x")) & ~F.contains(text, F.lit("X"))
    )
    return F.when(value.isNull(), value).when(plain | text.rlike(NUMBER_PATTERN), value)


def numeric_text(c: Column) -> Column:
    """Text to double: decimal comma allowed, anything else that is no number gives null."""
    return parsed(decimal_point(c))


def numeric(df: DataFrame, name: str) -> Column:
    """The column as a nullable double, whatever type it has now; NaN becomes null."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        return numeric_text(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c.cast("double"))
    return c.cast("double")


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, null where the divisor is zero or missing."""
    return F.try_divide(num, den)


def flag(condition: Column) -> Column:
    """Condition as 0/1; a null condition is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def peak_hour(hour: Column) -> Column:
    return hour.between(7, 9) | hour.between(18, 21)


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows where both are present.

    Built from moments: ``corr`` raises on a constant column under ANSI rules.
    """
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)
