"""Exchanges between chunks of texts and ranges of keys in which rows follow the bytes.

A row for each chunk and range is right while ranges are few.  Beyond ``direct``
ranges it would be rows by the square of the table, with ever fewer keys in
each.  Then chunks send to about sqrt(R) coarse ranges; a relay for each coarse
range and group of chunks merges what the group sends and cuts it into fine
ranges.  Answers go back the same way: a relay for each coarse range and group
puts together what its fine ranges answer and hands each chunk its own.  That is
two times R ** 1.5 rows, each with thousands of keys, and a relay holds about as
much as a chunk does.  The result is the same at any number of levels.

A key that goes through a relay has its slot with it: the place of its chunk
among those of the group, whose names are in a row of their own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from isobar.llm.blocks import U

DIRECT = 8192  #: most ranges that chunks send to themselves


@dataclass(frozen=True)
class Levels:
    """``coarse`` ranges, ``fine`` ones in each; ``groups`` of chunks, 0 where there are no relays."""

    coarse: int
    fine: int = 1
    groups: int = 0

    def edges(self, coarse: int, width: int = 64) -> np.ndarray:
        """Where the fine ranges of a coarse one begin among keys of so many bits."""
        first = coarse * self.fine
        return np.array([(r << width) // (self.coarse * self.fine) for r in range(first, first + self.fine)], U)

    def group(self) -> Column:
        return F.pmod(F.xxhash64("chunk"), F.lit(self.groups)).alias("grp")


def levels(ranges: int, direct: int = DIRECT) -> Levels:
    if ranges <= direct:
        return Levels(ranges)
    coarse = math.isqrt(ranges - 1) + 1
    return Levels(coarse, -(-ranges // coarse), coarse)


def merged(keys: list[np.ndarray], *columns: list[np.ndarray]) -> list[np.ndarray]:
    """What several chunks send, in order of the keys: keys, slots and the other columns."""
    every = np.concatenate([np.zeros(0, U), *keys])
    slots = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    order = np.argsort(every, kind="stable")
    return [every[order], slots[order], *(np.concatenate([np.zeros(0, U), *c])[order] for c in columns)]


def by_slot(slots: list[np.ndarray], n: int, *columns: list[np.ndarray]) -> list[list[np.ndarray]]:
    """The pieces of ranges in order, to each column's part for each of n slots, in the order of the keys."""
    every = np.concatenate([np.zeros(0, U), *slots])
    order = np.argsort(every, kind="stable")
    cuts = np.searchsorted(every[order], np.arange(1, n))
    return [np.split(np.concatenate([np.zeros(0, U), *c])[order], cuts) for c in columns]


def checked(sent: int, answered: int) -> None:
    if sent != answered:
        raise ValueError("a relay's answers are not complete: texts were read differently a second time")
