"""Shared plumbing of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from ..checkpoints import checkpointed, shared_folder
from ..shipping import ship

__all__ = ["SLICE_ROWS", "WordHash", "attach", "checkpointed", "col", "shared_folder", "ship", "table_size"]

#: Rows turned into Python objects at a time; an Arrow batch may hold many long texts.
SLICE_ROWS = 256


def col(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def attach(
    df: DataFrame,
    needs: dict[str, str],
    factory: Callable[[], Callable[[dict[str, list]], dict[str, list]]],
    fields: dict[str, pa.DataType],
    carry: Iterable[str] = (),
) -> DataFrame:
    """Map rows to rows in Arrow batches: carried columns plus computed ones.

    ``needs`` maps the names that the function sees to columns of ``df``.
    ``factory`` runs once per task and returns the function, which gets lists
    and returns a list for each of ``fields``. A key ``_keep`` in its result
    holds booleans that filter the rows. Its attribute ``done``, if it has one,
    is called when the task ends. A carried column named like a
    computed one gives way to it.
    """
    ship(df.sparkSession)
    carry = [c for c in carry if c not in fields]
    inner = [f"c{i}" for i in range(len(carry))]
    source = df.select(*[col(c).alias(i) for c, i in zip(carry, inner)], *[col(v).alias(f"n_{k}") for k, v in needs.items()])
    made = [f"m{i}" for i in range(len(fields))]
    names = inner + made
    kinds = list(fields.values())
    keys = list(fields)
    wanted = list(needs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = factory()
        try:
            for whole in batches:
                for start in range(0, whole.num_rows, SLICE_ROWS):
                    batch = whole.slice(start, SLICE_ROWS)
                    out = work({k: batch.column(f"n_{k}").to_pylist() for k in wanted})
                    arrays = [batch.column(i) for i in inner] + [pa.array(out[k], kind) for k, kind in zip(keys, kinds)]
                    result = pa.RecordBatch.from_arrays(arrays, names=names)
                    yield result.filter(pa.array(out["_keep"], pa.bool_())) if "_keep" in out else result
        finally:
            getattr(work, "done", int)()

    schema = source.select(*inner).schema
    for m, kind in zip(made, kinds):
        schema = schema.add(m, from_arrow_type(kind))
    result = source.mapInArrow(run, schema)
    return result.select(*[F.col(i).alias(c) for c, i in zip(carry + keys, names)])


class WordHash(dict):
    """64-bit hashes of words, remembered for the words seen last.

    ``marked`` words get an odd hash and all others an even one.
    """

    LIMIT = 200_000

    def __init__(self, marked: frozenset[bytes] | None = None):
        super().__init__()
        self.marked = marked

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if self.marked is not None:
            value = value & ~1 | (word in self.marked)
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value
        return value


def table_size(df: DataFrame) -> int:
    """Catalyst's estimate of a plan's size in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
