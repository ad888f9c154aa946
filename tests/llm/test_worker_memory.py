"""What a Python worker keeps between tasks."""

import numpy as np

from parley.llm import words


def test_tables_of_powers_stay_small(monkeypatch):
    monkeypatch.setattr(words, "_up", words._up[:4096])
    monkeypatch.setattr(words, "_down", words._down[:4096])
    data = np.random.default_rng(24).integers(97, 123, 3 << 20, dtype=np.uint8)
    starts = np.arange(0, len(data), 8)
    whole = words.span_hashes(data, starts, starts + 7)
    assert words._up.nbytes + words._down.nbytes <= 8 << 20
    at = 200_000  # a span's hash depends on its bytes alone
    assert words.span_hashes(data[starts[at] :], starts[at:] - starts[at], starts[at:] + 7 - starts[at])[0] == whole[at]
