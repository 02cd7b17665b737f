import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm.ngram_join import may_link, parity_sketch


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 2**63), min_size=1, max_size=60), st.sets(st.integers(0, 2**63), max_size=20), st.integers(0, 59), st.sampled_from([80, 85, 95]))
def test_sketches_never_rule_out_a_link(base, more, cut, percent):
    a, b = base, (set(sorted(base)[min(cut, len(base) - 1) :]) | more)
    arrays = [np.array(sorted(x), np.uint64) for x in (a, b)]
    similar = 100 * len(a & b) >= percent * len(a | b)
    assert may_link(len(a), len(b), *map(parity_sketch, arrays), percent) or not similar
