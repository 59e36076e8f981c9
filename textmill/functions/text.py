"""Scalar text functions: HTML removal, punctuation padding, tokens, templates."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
)

# Fixed patterns. A tag may hold anything but '>' and a line feed.
TAG = r"<[^>\n]*+>"
# Every ASCII punctuation mark except the backslash.
PUNCTUATION = r"([!\"#$%&'()*+,\-./:;<=>?@\[\]^_`{|}~])"
# White space as Python's str pattern \s sees it.
WHITESPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
# A token: a run of letters, a run of numbers, or one other visible character.
TOKEN = r"\p{L}+|\p{N}+|[^\t-\r \p{L}\p{N}]"


def strip_html(text: Column) -> Column:
    """Delete each shortest ``<...>`` run that stays on one line.

    The negated class matches what a lazy ``.*?`` would, without backtracking.
    """
    return F.regexp_replace(text, TAG, "")


def pad_punct(text: Column) -> Column:
    """Put spaces round punctuation marks, then squeeze white-space runs to one space."""
    return F.regexp_replace(F.regexp_replace(text, PUNCTUATION, " $1 "), WHITESPACE, " ")


def tokens(text: Column) -> Column:
    """The tokens of a text, in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def token_count(text: Column) -> Column:
    """Number of tokens, without building the array."""
    return F.regexp_count(text, F.lit(TOKEN))


def printed(column: Column, data_type: DataType, name: str) -> Column:
    """A value as the template language prints it; null prints ``None``."""
    if isinstance(data_type, StringType):
        shown = column
    elif isinstance(data_type, (ByteType, ShortType, IntegerType, LongType)):
        shown = column.cast("string")
    elif isinstance(data_type, BooleanType):
        shown = F.when(column, "True").when(~column, "False")
    else:
        raise TypeError(
            f"column {name!r} is {data_type.simpleString()}; cast it to string, integer or boolean "
            "before using it in a template"
        )
    return F.coalesce(shown, F.lit("None"))


def render_expr(schema: StructType, template: str, columns: Sequence[str]) -> Column:
    """Compile a ``str.format`` template over ``columns`` to one concat expression.

    ``{}``, ``{0}``, ``{{`` and ``}}`` are understood; anything else fails here, before any job.
    """
    missing = [c for c in columns if c not in schema.fieldNames()]
    if missing:
        raise ValueError(f"template columns not in the table: {missing}")

    pieces: list[Column] = []
    numbering: set[str] = set()
    following = 0
    for literal, field, spec, conversion in string.Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if field is None:
            continue
        if spec or conversion:
            raise ValueError(f"format options are not supported: {template!r}")
        if field == "":
            numbering.add("automatic")
            position, following = following, following + 1
        elif field.isdecimal():
            numbering.add("manual")
            position = int(field)
        else:
            raise ValueError(f"only positional fields are supported, not {{{field}}}")
        if len(numbering) > 1:
            raise ValueError(f"automatic and manual field numbers are mixed: {template!r}")
        if position >= len(columns):
            raise ValueError(f"template {template!r} needs more columns than {list(columns)}")
        name = columns[position]
        pieces.append(printed(F.col(f"`{name}`"), schema[name].dataType, name))
    return F.concat(*pieces) if pieces else F.lit("")
