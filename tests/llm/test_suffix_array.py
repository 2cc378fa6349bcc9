import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from courtstats.llm.suffix_array import permuted_common_prefixes, suffix_array


def check(values, most):
    text = np.array(values, np.uint8)
    raw = text.tobytes()
    want = sorted(range(len(raw)), key=lambda i: raw[i:])
    order = suffix_array(text)
    assert order.tolist() == want
    shared = permuted_common_prefixes(text, order, most)
    for before, here in zip(want, want[1:]):
        n = 0
        while n < most and max(before, here) + n < len(raw) and raw[before + n] == raw[here + n]:
            n += 1
        assert shared[here] == n


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=120), st.integers(1, 40))
def test_small_alphabet(values, most):
    check(values, most)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 254), min_size=1, max_size=60), st.integers(1, 5))
def test_repeats(values, times):
    check(values * times, 25)


@pytest.mark.parametrize("values", [[], [7], [7] * 500, [1, 2] * 300, [2, 1] * 300, list(range(1, 255)) * 3])
def test_plain_shapes(values):
    check(values, 64)
