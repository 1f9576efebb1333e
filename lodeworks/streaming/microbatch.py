"""A stream as a series of load packages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lodeworks.plans.dataset import Dataset
from lodeworks.plans.loader import load
from lodeworks.spec import LoadSpec


def stream_load(
    dataset: Dataset,
    spec: LoadSpec,
    *,
    checkpoint: str,
    query_name: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    trigger: dict[str, Any] | None = None,
    **options: Any,
) -> StreamingQuery:
    """Apply every micro-batch of ``spec.data`` (a streaming DataFrame) as one package.

    The load id is made of the query name and the batch number. A batch that is replayed
    after a failure finds its id in the load log (or on the table) and changes nothing.
    The order of rows inside a batch is given by ``spec.order_by``, never by arrival.
    """

    def apply(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        load(dataset, replace(spec, data=rows), load_id=f"{query_name}:{number:012d}", **options)

    writer = spec.data.writeStream.foreachBatch(apply).queryName(query_name)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
