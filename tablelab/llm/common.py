"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.session import scratch_dir

#: A word: a run of characters other than the six ASCII white-space characters.
#: ``bytes.split()`` without arguments splits UTF-8 text at exactly these.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of alphanumeric words: A-Z go to a-z, digits, a-z and everything beyond
#: ASCII stay, the rest becomes a blank.
ALNUM_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

#: A-Z go to a-z, all else stays.
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def col(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for w in wanted:
        name = w
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def n_words(text: Column) -> Column:
    """Number of words of a text; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    A join then knows the size of this side when it is planned.  If it is small it is
    broadcast at once, and the texts on the other side aren't shuffled only to find out."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
