"""Text hygiene as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumbung.constants import EMAIL_PATTERN


def trimmed(name: str) -> Column:
    """Spaces removed at both ends; newlines and tabs stay."""
    return F.trim(F.col(name))


def lowered(name: str) -> Column:
    return F.lower(trimmed(name))


def raised(name: str) -> Column:
    return F.upper(trimmed(name))


def has_email_format(name: str) -> Column:
    """True or false, never NULL."""
    return F.coalesce(trimmed(name).rlike(EMAIL_PATTERN), F.lit(False))


def contains_ignoring_case(name: str, term: str) -> Column:
    return F.contains(F.lower(F.col(name)), F.lit(term.lower()))
