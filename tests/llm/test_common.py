import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from fieldlake.llm.common import lean


def held_mb():
    """MB of this process without mapped files."""
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_freed_memory_goes_back_after_a_kernel():
    most, pins = [], []

    def kernel(batches):
        for batch in batches:
            values = [np.ones(6000) for _ in range(6000)]  # below the size that is mapped by itself
            most.append(held_mb())
            pins.append(values[-1])  # keeps the end of the heap in use
            del values
            yield batch

    rows = [pa.RecordBatch.from_arrays([pa.array([n])], ["n"]) for n in range(2)]
    assert [batch.column("n").to_pylist() for batch in lean(kernel)(iter(rows))] == [[0], [1]]
    assert held_mb() < max(most) - 200
