"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r\x0b\x0c"


def clean_key(c: Column) -> Column:
    """Key without trailing blanks, so padded and unpadded forms meet."""
    return F.rtrim(c)


def clean_code(c: Column) -> Column:
    """Code in upper case without blanks around it."""
    return F.upper(F.trim(c))


def mask_tail(c: Column) -> Column:
    """Eight asterisks and the last visible character; blank or NULL gives NULL."""
    last = F.nullif(F.right(F.trim(c, F.lit(_BLANKS)), F.lit(1)), F.lit(""))
    return F.concat(F.lit("********"), last)


def mask_name(first: Column, last: Column) -> Column:
    """Initials only, as ``A*** B***``; NULL when either name is NULL."""
    one = F.lit(1)
    return F.concat(F.left(first, one), F.lit("*** "), F.left(last, one), F.lit("***"))


def concat_text(*cols: Column) -> Column:
    """Join values as text; NULL when any of them is NULL."""
    return F.concat(*[c.cast("string") for c in cols])


def replace_char(c: Column, old: str, new: str) -> Column:
    return F.translate(c, old, new)


def text_length(c: Column) -> Column:
    return F.length(c.cast("string"))
