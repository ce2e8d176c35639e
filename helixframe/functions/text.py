"""String helpers with the tokenizer rules VCF expressions rely on."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column, delimiter: str) -> Column:
    """Non-empty tokens between literal delimiters."""
    return F.array_remove(split_literal(text, delimiter), "")


def strtok(text: Column, delimiter: str, n: int) -> Column:
    """The n-th (1-based) non-empty token; NULL when there are fewer."""
    return F.get(tokens(text, delimiter), F.lit(n - 1))


def split_literal(text: Column, delimiter: str) -> Column:
    """Split on a literal delimiter."""
    return F.split(text, re.escape(delimiter))


def split_ids(id_text: Column) -> Column:
    """ID column to an array (``;`` separated)."""
    return F.split(id_text, ";")


def split_alts(alt_text: Column) -> Column:
    """ALT column to an array (``,`` separated)."""
    return F.split(alt_text, ",")
