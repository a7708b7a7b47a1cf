"""Bitmaps of the months in which a key was active.

A month is a number (year x 12 + month - 1); a word holds ``WORD`` of them, one bit each.  A key's activity
is one row per word, so a long history is a few rows, two histories merge with ``bit_or`` (also a stored
one with new orders), and questions about periods are bit operations on a word and a mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 60


def month_number(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day) - 1).cast("bigint")


def month_of(number: Column) -> Column:
    return F.make_date(F.call_function("div", number, F.lit(12)).cast("int"), (F.pmod(number, F.lit(12)) + 1).cast("int"), F.lit(1))


def active_months(rows: DataFrame, key: str, day: str) -> DataFrame:
    """``key``, ``word``, ``bits``: the months of ``day`` in which each key has a row.  Bits are combined
    before the shuffle, so a hot key is one row per word and task."""
    number = month_number(F.col(day))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(WORD)).cast("int"))
    return (rows.select(key, F.call_function("div", number, F.lit(WORD)).alias("word"), bit.alias("bit"))
            .where(F.col("word").isNotNull()).groupBy(key, "word").agg(F.bit_or("bit").alias("bits")))


def merge_months(*bitmaps: DataFrame, key: str) -> DataFrame:
    """One bitmap of several of the same key column."""
    every = bitmaps[0]
    for more in bitmaps[1:]:
        every = every.unionByName(more)
    return every.groupBy(key, "word").agg(F.bit_or("bits").alias("bits"))


def first_month(word: Column, bits: Column) -> Column:
    """The number of the lowest month set: the bits below the lowest one are counted."""
    return word * F.lit(WORD) + F.bit_count(bits.bitwiseAND(-bits) - F.lit(1)).cast("bigint")


def months_in(word: Column, bits: Column) -> Column:
    """The numbers of all months set, as an array (at most ``WORD``)."""
    places = F.sequence(F.lit(0), F.lit(WORD - 1))
    on = F.filter(places, lambda p: F.call_function("shiftright", bits, p).bitwiseAND(F.lit(1)) == 1)
    return F.transform(on, lambda p: word * F.lit(WORD) + p)


def months_between(word: Column, first: Column, after: Column) -> Column:
    """The mask of the months from number ``first`` until before ``after`` within a word."""
    def below(number: Column) -> Column:
        place = F.least(F.greatest(number - word * F.lit(WORD), F.lit(0)), F.lit(WORD)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), place) - F.lit(1)
    return F.greatest(below(after) - below(first), F.lit(0))
