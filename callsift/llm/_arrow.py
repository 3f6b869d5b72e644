"""Arrow batches of (identifier, text) through a Python function, without a shuffle."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from callsift.shipping import ship

#: Texts handed to a function at once stay below this many characters (one text may be longer).
CHUNK_CHARS = 2_000_000
#: Bound of an Arrow batch.
BATCH_BYTES = 8_000_000
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Let the session hand Arrow batches of at most ``BATCH_BYTES`` to Python, unless it has a lower bound.

    A batch of whole texts exists several times at once, in the JVM and in Python.
    """
    digits = re.match(r"\d+", spark.conf.get(BATCH_SETTING))
    if digits is None or int(digits[0]) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def chunks(texts: pa.ChunkedArray | pa.Array, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """``(first row, texts)`` pieces of a text column; nulls become empty texts."""
    start, held, size = 0, [], 0
    for at, scalar in enumerate(texts):
        value = scalar.as_py() or ""
        if held and size + len(value) > limit:
            yield start, held
            start, held, size = at, [], 0
        held.append(value)
        size += len(value)
    if held:
        yield start, held


def map_texts(
    docs: DataFrame,
    make: Callable[[], Callable[[list[str]], dict[str, list]]],
    fields: T.StructType,
    id_col: str = "doc_id",
    text_col: str = "text",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Apply ``make()(texts)`` to every text; it returns one list per field of ``fields``.

    ``make`` runs once per task. The result has ``id_col``, the ``extra`` columns, then ``fields``.
    """
    ship(docs.sparkSession)
    bound_batches(docs.sparkSession)
    keep = [id_col, *extra]
    schema = T.StructType([docs.schema[c] for c in keep] + list(fields.fields))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for start, texts in chunks(batch.column(len(keep))):
                made = fn(texts)
                columns = [batch.column(i).slice(start, len(texts)).cast(arrow.field(i).type) for i in range(len(keep))]
                own = [(made[f.name], arrow.field(f.name).type) for f in fields.fields]
                columns += [x.cast(kind) if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in own]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.select(*keep, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def text_column(make: Callable[[], Callable[[list[str]], list]], kind: T.DataType) -> Callable:
    """A column function that applies ``make()(texts)`` to a text column; one value per text.

    ``make`` runs once per worker and use; nulls reach the function as empty texts.
    """
    held: list[Callable] = []
    arrow_type = to_arrow_schema(T.StructType([T.StructField("v", kind)])).field(0).type

    @F.arrow_udf(kind)
    def column(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(make())
        values: list = []
        for _, part in chunks(texts):
            values += list(held[0](part))
        return pa.array(values, arrow_type)

    return column
