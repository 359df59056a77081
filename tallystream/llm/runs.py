"""Groups of a sorted partition inside a task, one at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def runs(
    batches: Iterator[pa.RecordBatch], arrays: Callable[[pa.RecordBatch], dict[str, np.ndarray]], keys: list[str]
) -> Iterator[dict[str, np.ndarray]]:
    """Consecutive rows with equal ``keys``, also across batches; ``arrays`` turns a batch into columns."""
    held: list[dict[str, np.ndarray]] = []

    def whole() -> dict[str, np.ndarray]:
        return held[0] if len(held) == 1 else {k: np.concatenate([h[k] for h in held]) for k in held[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = arrays(batch)
        change = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            change |= columns[k][1:] != columns[k][:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = {k: v[a:b] for k, v in columns.items()}
            if held and any(held[-1][k][-1] != part[k][0] for k in keys):
                yield whole()
                held = []
            held.append(part)
    if held:
        yield whole()
