"""Run a per-text function over a DataFrame in bounded Arrow batches.

Every Python operator of this subpackage goes through :func:`append_columns`:
Spark partitions the rows, a task streams Arrow batches, and a batch is cut
into slices of about ``SLICE_BYTES`` of text so that the memory of a task does
not grow with the batch. A text itself is never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text handled at once inside a task (a longer single text is one slice).
SLICE_BYTES = 1 << 20

#: Most bytes of an Arrow batch between the JVM and Python (Spark's own limit is four times that).
BATCH_BYTES = 16 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

#: A worker: texts as UTF-8 bytes (None for null) -> one column per output field.
Worker = Callable[[list], Sequence]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column holding about ``limit`` bytes each."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield start, len(lengths)


def append_columns(
    df: DataFrame,
    text_col: str,
    fields: Sequence[T.StructField],
    make_worker: Callable[[], Worker],
    *,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` (or its ``keep`` columns) plus the columns a worker computes from
    one text column. No shuffle.

    ``make_worker`` runs once per task; its result maps a list of texts to one
    list or Arrow array per field. An input column with the name of an output
    field gives way to the output.
    """
    out_names = {f.name for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in out_names]
    # One struct column of kept values; a text among them isn't sent twice.
    inside = kept.index(text_col) if text_col in kept and df.schema[text_col].dataType == T.StringType() else None
    row = F.struct(*[F.col(_q(c)).alias(c) for c in kept]).alias("row") if kept else F.lit(True).alias("row")
    packed = df.select(row) if inside is not None else df.select(row, F.col(_q(text_col)).cast("string").alias("text"))
    _bound_batches(df)
    schema = T.StructType([packed.schema["row"], *fields])
    arrow_fields = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make_worker()
        for batch in batches:
            row = batch.column(0)
            text = batch.column(1) if inside is None else row.field(inside)
            for lo, hi in text_slices(text):
                part = text.slice(lo, hi - lo)
                values = work(part.cast(pa.binary()).to_pylist())
                arrays = [v if isinstance(v, pa.Array) else pa.array(v) for v in values]
                yield pa.RecordBatch.from_arrays([row.slice(lo, hi - lo), *arrays], ["row", *arrow_fields])

    out = packed.mapInArrow(run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], *[F.col(_q(n)) for n in arrow_fields])


def _bound_batches(df: DataFrame) -> None:
    """Keep the Arrow batches of the session within BATCH_BYTES: a task holds a
    few of them in the JVM and in Python at once."""
    conf = df.sparkSession.conf
    now = (conf.get(_BATCH_CONF, None) or "").rstrip("bB")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        conf.set(_BATCH_CONF, str(BATCH_BYTES))


def _q(name: str) -> str:
    """A column name as one quoted identifier (names may hold dots)."""
    return "`" + name.replace("`", "``") + "`"


def held_out(id_col: str):
    """Fold of the registered learners: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col(_q(id_col)).cast("string")) % 5 == 0
