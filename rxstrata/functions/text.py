"""Standard forms of names and strengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rxstrata import fixed_values as V


def clean_drug_name(name: Column, strip_before_upper: bool = False) -> Column:
    """Upper-case name without disallowed characters.

    ``strip_before_upper`` drops lower-case letters as disallowed before the case is
    changed, which leaves only the capitals of a mixed-case name.
    """
    if strip_before_upper:
        return F.upper(F.regexp_replace(name, V.NAME_DISALLOWED, ""))
    return F.regexp_replace(F.upper(name), V.NAME_DISALLOWED, "")


def file_drug_name(name: Column) -> Column:
    """Name form of the plain CSV cleaner; NULL and empty give an empty string."""
    upper = F.upper(F.regexp_replace(name, r"^\s+|\s+$", ""))
    spaced = F.replace(upper, F.lit("-"), F.lit(" "))
    return F.coalesce(F.replace(spaced, F.lit("MG"), F.lit("")), F.lit(""))


def product_name(name: Column) -> Column:
    """Name without punctuation, dosage form and unit at its end; NULL for an empty name."""
    kept = F.regexp_replace(F.upper(name), V.NAME_DISALLOWED, "")
    single_spaced = F.trim(F.regexp_replace(kept, r"\s+", " "))
    without_form = F.regexp_replace(single_spaced, V.PRODUCT_FORM_SUFFIX, "")
    return F.when(name != "", F.regexp_replace(without_form, V.PRODUCT_UNIT_SUFFIX, ""))


def strength_number(strength: Column) -> Column:
    """First number in the text, NULL where there is none."""
    found = F.regexp_extract(strength, V.STRENGTH_NUMBER, 1)
    return F.nullif(found, F.lit("")).try_cast("double")


def strength_unit(strength: Column) -> Column:
    """Lower-case word after the first number; empty where there is none."""
    return F.lower(F.regexp_extract(strength, V.STRENGTH_NUMBER_AND_UNIT, 2))


def label_strength(strength: Column) -> Column:
    """Struct of number and known unit; the number of ``1.2.3`` is 1.2."""
    digits = F.regexp_extract(strength, V.LABEL_STRENGTH, 1)
    number = F.regexp_extract(digits, r"^(\d*\.?\d*)", 1).try_cast("double")
    unit = F.lower(F.regexp_extract(strength, V.LABEL_STRENGTH, 2))
    return F.struct(
        number.alias("numeric_value"),
        F.nullif(unit, F.lit("")).alias("unit"),
    )


def list_size(text: Column, separator: str = ",") -> Column:
    """Number of parts between plain ``separator`` strings, 0 for NULL."""
    parts = F.size(F.split(text, f"\\Q{separator}\\E")).cast("long")
    return F.when(text.isNotNull(), parts).otherwise(F.lit(0).cast("long"))


def stable_suffix(key: Column, digits: int = 3) -> Column:
    """Zero-padded number below 10**digits that depends on ``key`` alone."""
    leading = F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("long")
    return F.lpad((leading % 10**digits).cast("string"), digits, "0")
