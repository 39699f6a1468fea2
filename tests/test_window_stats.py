"""The stream's window statistics against a plain loop."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.streaming.state import window_stats

value = st.one_of(st.none(), st.floats(-100, 100))


@settings(max_examples=100, deadline=None)
@given(st.lists(value, min_size=1, max_size=30), st.integers(1, 8))
def test_against_loop(series, rows):
    table = np.array([[np.nan if v is None else v] for v in series], dtype=float)
    got = [s[:, 0] for s in window_stats(table, rows, 0)]
    for i in range(len(series)):
        seen = [v for v in series[max(0, i - rows + 1): i + 1] if v is not None]
        if not seen:
            assert all(np.isnan(s[i]) for s in got)
            continue
        slope = np.polyfit(np.arange(len(seen)), seen, 1)[0] if len(seen) > 1 else 0.0
        expected = [np.mean(seen), np.std(seen), min(seen), max(seen), slope]
        assert np.allclose([s[i] for s in got], expected, atol=1e-6)
        assert min(seen) - 1e-9 <= got[0][i] <= max(seen) + 1e-9
