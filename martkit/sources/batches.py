"""Arrow batches of bounded size on their way from Python to the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd

# Text held by one batch: bodies may be large, and small ones must not make
# a batch each.
BATCH_CHARACTERS = 4 << 20


def frames(
    rows: Iterable[tuple], columns: list[str], limit: int = BATCH_CHARACTERS
) -> Iterator[pd.DataFrame]:
    """Rows as data frames, each closed once its text exceeds ``limit``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(value) for value in row if isinstance(value, str))
        if size > limit:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)
