"""Row filters that carry whole rows through Arrow unchanged."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame


def keep_rows(docs: DataFrame, decide: Callable[[Sequence[str | None]], Sequence[bool]]) -> DataFrame:
    """Rows whose `text` is kept, with all their columns; `decide` sees a batch of texts at a time."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([bool(x) for x in decide(batch.column(at).to_pylist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
