"""Stable pseudo-random draws.

One draw per (key, salt) pair, computed from a digest of the key. A draw does not change when a task
is retried, when the plan is re-used, or when the data is partitioned in another way, which
``rand()`` cannot promise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

HEX_DIGITS = 15  # 60 bits of the digest: far above any modulus, and a whole number in 64 bits


def draw(salt: str, modulus: int | Column, *keys: Column | str) -> Column:
    """Integer in ``[0, modulus)`` decided by the key columns and the salt."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return draw_of(F.concat_ws(":", *[p.cast("string") for p in parts], F.lit(salt)), modulus)


def draw_of(text: Column, modulus: int | Column) -> Column:
    """``draw`` of keys and salt that are one text already, with a colon between them; keys without nulls are joined faster by ``concat``."""
    number = F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("bigint")
    m = modulus if isinstance(modulus, Column) else F.lit(modulus)
    return number % m.cast("bigint")


def weighted_bucket(salt: str, weights: Sequence[tuple[object, int]], *keys: Column | str) -> Column:
    """Label chosen with the given whole percentages; the last label takes what is left.

    The digest is evaluated once per row: the cut points are searched in one array, not in a ladder
    of conditions that would each draw again.
    """
    if sum(pct for _, pct in weights) != 100:
        raise ValueError("weights must add up to 100")
    slots = [label for label, pct in weights for _ in range(pct)]
    return F.element_at(F.array(*[F.lit(s) for s in slots]), (draw(salt, 100, *keys) + 1).cast("int"))


def number_between(salt: str, low: int, high: int, *keys: Column | str) -> Column:
    """Whole number in ``[low, high]``."""
    return (draw(salt, high - low + 1, *keys) + low).cast("bigint")
