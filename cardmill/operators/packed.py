"""Text columns as one text, for rows that are moved.

In a shuffle each text costs its length, its place and padding, and compression finds little in between. Columns that
nothing looks at on the way are moved as one text and taken apart behind the last move. Any text and NULL comes back.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PACKED = "_packed"

# Characters between texts, for NULL, and before the letter that stands for one of the three in a text.
BETWEEN, MISSING, ESCAPE = "\x1f", "\x1a", "\x1b"
_LETTERS = {ESCAPE: "e", BETWEEN: "b", MISSING: "m"}


def _escaped(text: Column) -> Column:
    """The escape character itself comes first, so that no escape is escaped again."""
    return reduce(lambda c, char: F.replace(c, F.lit(char), F.lit(ESCAPE + _LETTERS[char])), _LETTERS, text)


def _plain(text: Column) -> Column:
    return reduce(lambda c, char: F.replace(c, F.lit(ESCAPE + _LETTERS[char]), F.lit(char)), reversed(_LETTERS), text)


def pack(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace text columns by one column."""
    if not columns:
        return df
    texts = (F.coalesce(_escaped(F.col(c)), F.lit(MISSING)) for c in columns)
    return df.withColumn(PACKED, F.concat_ws(BETWEEN, *texts)).drop(*columns)


def unpack(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns of ``pack``, given in the same order."""
    if not columns:
        return df
    # Columns of their own: a row is split once for all, and only one that has an escape is looked through for them.
    split = df.withColumn("_texts", F.split(PACKED, BETWEEN))
    plain = F.transform("_texts", lambda t: F.when(t != MISSING, _plain(t)))
    split = split.withColumn("_plain", F.when(F.contains(F.col(PACKED), F.lit(ESCAPE)), plain))
    texts, plain = F.col("_texts"), F.col("_plain")
    found = {c: F.when(plain.isNotNull(), plain[i]).when(texts[i] != MISSING, texts[i]) for i, c in enumerate(columns)}
    return split.withColumns(found).drop(PACKED, "_texts", "_plain")
