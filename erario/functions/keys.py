"""Key normalisation and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters of Unicode's white space, the no-break space included.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def stripped(c: Column) -> Column:
    """``c`` without outer white space of any kind; null stays null. A trim, as a pattern costs ten times as much."""
    return F.btrim(c, F.lit(BLANKS))


def plain_key(c: Column) -> Column:
    """Key text without outer blanks and letter case; null where null or blank."""
    k = F.lower(stripped(c))
    return F.when(k != "", k)


def plain_number(c: Column) -> Column:
    """Key text without outer blanks, letter case and leading zeros; null where null or blank.

    A key of zeros alone becomes ``0``.
    """
    k = F.lower(stripped(c))
    return F.when(k != "", F.regexp_replace(k, r"^0+(?=.)", ""))


def digits(c: Column) -> Column:
    """Only the digits of ``c``; null where none is left."""
    d = F.regexp_replace(c, r"[^0-9]", "")
    return F.when(d != "", d)


def surrogate_key(*cols: Column) -> Column:
    """Lower-case md5 over the columns as text, nulls as empty, with ``||`` between."""
    return F.md5(F.concat_ws("||", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def key_number(c: Column) -> Column:
    """A bigint for a key text, such that keys which are whole numbers keep their order and distance.

    Whole numbers of up to 17 digits are taken as they are. Hexadecimal keys of 32 digits give their first 60 bits,
    any other text its 64-bit hash; for those two the number alone does not identify the key, so readers must compare
    the text too.
    """
    return (
        F.when(c.rlike(r"^[0-9]{1,17}$"), c.try_cast("bigint"))
        .when(c.rlike(r"^[0-9a-f]{32}$"), F.conv(F.substring(c, 1, 15), 16, 10).try_cast("bigint"))
        .otherwise(F.xxhash64(c))
    )
