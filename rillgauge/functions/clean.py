"""Cleaning, parsing and naming expressions. All stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillgauge.schemas import EARLY_LABEL, FIRST_SINGLE_YEAR, PERIOD_FORMAT

# Every character the text trim removes (Unicode white space).
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: str | Column) -> Column:
    """White space removed at both ends.

    Text that starts and ends with a visible ASCII character, nearly all of it, passes
    through: searching the long list of white space costs more than all other parsing.
    """
    text = col(c)
    visible = text.between("!", "~") & F.right(text, F.lit(1)).between("!", "~")
    return F.when(visible, text).otherwise(F.trim(text, F.lit(WHITE_SPACE)))


def once(*columns: Column) -> Column:
    """Named columns as a one-row generator, so that each is computed once.

    An expression used several times, or filtered on after a projection, is otherwise
    copied to every use; a generated column is not.
    """
    return F.inline(F.array(F.struct(*columns)))


def blank_to_null(c: str | Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(trimmed(c), F.lit(""))


def to_number(c: str | Column) -> Column:
    """Double, or NULL for text that is not a number."""
    return col(c).try_cast("double")


def to_finite_text_number(c: str | Column) -> Column:
    """Like ``to_number`` for free text: NaN and Java-only suffixes (``5d``) are NULL."""
    number = F.nullif(to_number(c), F.lit(float("nan")))
    return F.when(~col(c).rlike(r"[0-9.][dDfF]\s*$"), number)


def to_period_date(c: str | Column) -> Column:
    """Date of a strict month/day/four-digit-year text, NULL otherwise."""
    return F.when(
        col(c).rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(col(c), PERIOD_FORMAT)
    )


def state_prefix(permit_id: str | Column) -> Column:
    """First two characters of a permit id, NULL when blank."""
    return F.nullif(F.trim(F.substring(col(permit_id), 1, 2)), F.lit(""))


def backfilled_state(state: str | Column, permit_id: str | Column) -> Column:
    """The state, or the permit prefix where the state is blank."""
    return F.coalesce(F.nullif(F.trim(col(state)), F.lit("")), state_prefix(permit_id))


def year_suffix(date_text: str | Column) -> Column:
    """Last four characters of a period date, kept only when they are digits."""
    tail = F.right(col(date_text), F.lit(4))
    return F.when(tail.rlike(r"^[0-9]{4}$"), tail)


def label_of_year(year: str | Column) -> Column:
    """File label holding a year: one shared label for the early years."""
    y = col(year).cast("int")
    return F.when(y < FIRST_SINGLE_YEAR, F.lit(EARLY_LABEL)).otherwise(y.cast("string"))


def safe_name(pollutant: str | Column) -> Column:
    """File-safe pollutant name: slash to dash, space to underscore, no commas."""
    name = F.translate(col(pollutant), "/ ,", "-_")
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit("unnamed_pollutant")).otherwise(name)


def display_name(filename: str | Column) -> Column:
    """Menu text of a file name: suffix dropped, underscores shown as spaces."""
    return F.translate(F.regexp_replace(col(filename), r"\.json$", ""), "_", " ")
