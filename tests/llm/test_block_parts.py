"""What the byte transform sorts at a time."""

import random

import numpy as np
import pyarrow as pa

from parley.llm import suffixes


def test_a_block_is_sorted_in_parts_of_whole_cores(monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    for core in range(60):
        base = rng.integers(97, 100, 900, dtype=np.uint8).tobytes()
        rows += [(core, 2 * core + k, 1, b[:900]) for k, b in enumerate((base, base[:600] + b"z" + base[601:]))]
    random.Random(1).shuffle(rows)
    table = pa.table({k: pa.array(v) for k, v in zip(("core", "context", "n", "bytes"), zip(*rows, strict=True), strict=True)})
    sizes, whole = [], suffixes.repeated_windows
    monkeypatch.setattr(suffixes, "PART_BYTES", 10_000)
    monkeypatch.setattr(suffixes, "repeated_windows", lambda c, n, k: sizes.append(sum(map(len, c))) or whole(c, n, k))
    out = suffixes._expand(400)(table).to_pylist()
    assert sum(sizes) == 108_000 and max(sizes) <= 10_000 + 1800
    assert {r["context"]: r["ranges"] for r in out} == {c: [{"first": 0, "last": 200}] if c % 2 else out_of_even(rows, c) for c in range(120)}


def out_of_even(rows, context):
    """The unchanged text: windows before the changed byte, and none that hold it."""
    texts = {c: b for _, c, _, b in rows}
    a, b = texts[context], texts[context + 1]
    flags = np.array([a[i : i + 400] == b[i : i + 400] for i in range(501)])
    return suffixes._ranges(flags)
