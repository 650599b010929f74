"""All sides of a block of cells are met in one array step, not one call a side."""

import pyarrow as pa

from arpent.operators import outlines as ou


def test_sides_of_a_block_meet_in_one_step():
    rows = [
        ("a", 0, 0, True, 0.0, 1.0),  # goes on in the next cell, but for a part
        ("a", 0, 0, True, 1.0, 0.25 + 1e-12),
        ("a", 0, 0, False, 0.25, 0.25),
        ("a", 0, 1, True, 1.0, 2.0),  # another side
        (None, 0, 1, True, 2.0, 1.0),  # another group on that side
        ("a", 1, 0, True, 0.0, 1.0),
        ("a", 1, 0, True, 1.0, 0.0),
    ]
    kind = pa.schema([("g", pa.string()), ("line", pa.int64()), ("cell", pa.int64()), ("edge", pa.bool_()), ("s", pa.float64()), ("e", pa.float64()), ("upright", pa.bool_())])
    table = pa.table([*map(list, zip(*rows, strict=True)), [True] * len(rows)], schema=kind)
    made = [tuple(r[c] for c in ("g", "line", "cell", "edge", "a", "b")) for r in ou._meet_on_sides("g", 1.0)((True, 0, 0), table).to_pylist()]
    assert sorted(made, key=str) == sorted([("a", 0, 0, True, 0.0, 0.25), ("a", 0, 0, False, 0.25 + 1e-12, 0.25), ("a", 0, 1, True, 1.0, 2.0), (None, 0, 1, True, 2.0, 1.0)], key=str)
