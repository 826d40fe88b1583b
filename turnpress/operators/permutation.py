"""Keyed permutations of 0..n-1: a row's place in any epoch is arithmetic on one dense number.

A number is a pair (left, right) on a grid of ``a`` x ``b`` cells with a * b just above n. Four rounds
add a keyed function of one half to the other, modulo its side, which can be undone whatever
the function is. A value that lands in one of the few cells beyond n is sent through again
until it does not; how often that can happen is counted exactly, so the walk is a chain of
fixed length. The same arithmetic backwards gives the number that stands at a place.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnpress.session import sealed

# Two primes below 2^31, so that products fit 64 bits, and a multiplier for each.
PRIME, FACTOR = 2147483647, 48271
PRIME_2, FACTOR_2 = 2147483629, 69621
ROUNDS = 4
TRIED = 1024


@dataclass(frozen=True)
class Permutation:
    """Permutations of ``0..n-1``, one for every epoch of ``epochs``, for a seed."""

    n: int
    seed: int
    epochs: int

    @cached_property
    def sides(self) -> tuple[int, int]:
        """``(a, b)`` with the fewest cells beyond n, among the sides from the square root up.

        At most ``TRIED`` sides, and a quarter beyond the root: both halves stay about as wide.
        """
        low = max(1, math.isqrt(max(self.n - 1, 0)) + 1)
        a = min(range(low, low + min(TRIED, max(1, low // 4))), key=lambda a: (-self.n % a, a))
        return a, max(1, -(-self.n // a))

    @cached_property
    def walk(self) -> int:
        """How often the rounds are run at most, in any epoch, until a number of 0..n-1 is back there."""
        a, b = self.sides
        longest = 0
        if not self.n:
            return 1
        for epoch in range(self.epochs):
            after = {v: self._once(v, epoch) for v in range(self.n, a * b)}
            for first in set(after) - set(after.values()):  # entered from below n; other cells are cycles of their own
                v, steps = first, 0
                while v in after:
                    v, steps = after[v], steps + 1
                longest = max(longest, steps)
        return 1 + longest

    def key(self, epoch, i: int):
        """Key of a round: a number for a number, a column for a column."""
        return (epoch * FACTOR + (self.seed % PRIME * 16807 + (i + 1) * FACTOR_2) % PRIME) % PRIME

    @staticmethod
    def mixed(half, key):
        """A keyed function of one half, number or column: a square modulo a prime, stretched modulo another."""
        shifted = (half + key) % PRIME
        return (shifted * shifted % PRIME + key) * FACTOR_2 % PRIME_2

    def _once(self, value: int, epoch: int, back: bool = False) -> int:
        a, b = self.sides
        halves = [value % a, value // a]
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            to, size = i % 2, (a, b)[i % 2]
            moved = self.mixed(halves[1 - to], self.key(epoch, i)) % size
            halves[to] = (halves[to] + (size - moved if back else moved)) % size
        return halves[0] + a * halves[1]

    def _walked(self, value: int, epoch: int, back: bool) -> int:
        if not 0 <= value < self.n:
            raise ValueError(f"{value} is not in 0..{self.n - 1}")
        value = self._once(value, epoch, back)
        while value >= self.n:
            value = self._once(value, epoch, back)
        return value

    def place(self, number: int, epoch: int) -> int:
        """Place of a number in an epoch."""
        return self._walked(number, epoch, False)

    def number(self, place: int, epoch: int) -> int:
        """Number that stands at a place in an epoch."""
        return self._walked(place, epoch, True)

    def with_place(self, df: DataFrame, number: str, epoch: str, out: str = "position") -> DataFrame:
        """Adds the place of ``number`` in ``epoch`` (two columns)."""
        return self._applied(df, number, epoch, out, False)

    def with_number(self, df: DataFrame, place: str, epoch: str, out: str = "number") -> DataFrame:
        """Adds the number that stands at ``place`` in ``epoch``."""
        return self._applied(df, place, epoch, out, True)

    def _applied(self, df: DataFrame, value: str, epoch: str, out: str, back: bool) -> DataFrame:
        """One projection per round, so every half is computed once and generated code stays small.

        The result is sealed: a filter on a place would otherwise be rewritten in terms of the number.
        """
        a, b = self.sides
        left, right, passed = unused(df, "left", "right", "passed")
        c: Callable[[str], Column] = F.col
        now = df.withColumn(passed, c(value).cast("bigint"))
        for step in range(self.walk):
            now = now.withColumns({left: c(passed) % a, right: F.call_function("div", c(passed), F.lit(a).cast("bigint"))})
            for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
                to, other, size = ((left, right, a), (right, left, b))[i % 2]
                moved = self.mixed(c(other), self.key(c(epoch).cast("bigint"), i)) % size
                now = now.withColumn(to, (c(to) + (size - moved if back else moved)) % size)
            again = c(left) + c(right) * a
            now = now.withColumn(passed, again if step == 0 else F.when(c(passed) < self.n, c(passed)).otherwise(again))
        return sealed(now.withColumn(out, c(passed)).drop(*({left, right, passed} - {out})))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        taken.add(name)
        found.append(name)
    return found
