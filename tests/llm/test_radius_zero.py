"""Two flips within one triple of bit planes are two, also when the radius is 0."""

import numpy as np
import pytest

from stepfold.llm import simhash


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_flips_within_a_triple_count(radius):
    fps = np.array([0, *(1 << a | 1 << b for a in range(64) for b in range(a))], dtype=np.uint64)
    q, f = simhash.BitPlanes(fps).within(fps[:1], radius)
    assert {(int(a), int(b)) for a, b in zip(q, f)} == {(0, j) for j in range(len(fps)) if bin(int(fps[j])).count("1") <= radius}
