"""Anchors are counted in full, also within one block."""

import numpy as np

from bazaarmill.llm import suffixes as s


def test_one_block_can_make_an_anchor_hot():
    counts = s.asked(np.array([1, 2, 300, 301, 20_001, 5]), np.array([False, False, False, False, False, True]))
    back = np.arange(6)
    assert s.unpacked(s.packed(counts), np.uint32).tolist() == counts.tolist()
    assert s.anchor_kinds(counts, back, 6, 300).tolist() == [0, 1, 1, 2, 2, 2]
    assert s.anchor_kinds(counts, back, 6, s.HOT).tolist() == [0, 1, 1, 1, 2, 2]


def test_counts_of_blocks_add_up():
    counts = s.asked(np.array([15_000, 15_000, 1]), np.zeros(3, bool))
    assert s.anchor_kinds(counts, np.array([0, 0, 1]), 2, s.HOT).tolist() == [2, 2, 0]
