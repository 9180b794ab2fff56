"""What the text operators share: the shared folder, written intermediate tables, and Arrow batch helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weavegraph.sources.shared import forget, scratch, shared_folder, stored  # noqa: F401

#: Lower-cases A-Z only, as the word rules ask for.
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def free_name(df: DataFrame, base: str) -> str:
    """base, or base with as many underscores as it takes to clash with no column of df."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def slices(batch: pa.RecordBatch, column: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices whose texts hold about most_bytes; a longer text is a slice of its own."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def annotate(
    df: DataFrame, text: str, carry: list[str], into: str, result: str, judge: Callable[[], Callable[[pa.Array], pa.Array]], most_bytes: int = 4 << 20
) -> DataFrame:
    """The carried columns and one struct column `into`, which judge()(texts) makes for each slice of texts.

    result: the struct's fields as DDL. judge is called once per task, so it may set up what the task needs. Rows keep their number and order.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    # A text that is carried anyway goes once.
    more = [] if text in carry else [F.col(f"`{text}`").alias("text__in")]
    given, at = df.select(*[F.col(f"`{c}`") for c in carry], *more), carry.index(text) if text in carry else len(carry)
    schema = T.StructType([*given.schema.fields[: len(carry)], T.StructField(into, T.StructType.fromDDL(result), False)])
    kind, names = to_arrow_type(schema.fields[-1].dataType), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = judge()
        for batch in batches:
            for part in slices(batch, at, most_bytes):
                made = call(part.column(at))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(carry)], made.cast(kind)], names=names)

    return given.mapInArrow(run, schema)


def struct_array(result: dict[str, pa.Array | np.ndarray | list]) -> pa.StructArray:
    arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in result.values()]
    return pa.StructArray.from_arrays(arrays, names=list(result))
