"""Features of long words."""

import numpy as np
import pytest

from roadloom.llm import quality_fm


@pytest.mark.parametrize("head", ["a" * 64, "中文" * 20, "x=1;" * 30])
def test_the_whole_of_a_long_word_counts(head):
    one, two = (quality_fm.features(f"{head}{tail}")[: quality_fm.WORD_SLOTS] for tail in ("abcdefg", "gfedcba"))
    assert not np.array_equal(one, two)
    assert quality_fm._slots(f"{head}a1!".encode())[1] != quality_fm._slots(f"{head}|A#".encode())[1]
