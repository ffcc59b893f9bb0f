"""Mergeable user aggregates: create / add / merge / result.

Accumulators are combined three times: inside each task over its own rows, per (key, salt)
after a shuffle, and per key after another. A hot key sends one accumulator per task, its
merge is spread over ``fanout`` groups first, and no task ever holds a key's rows. Merging
reads sorted accumulators one at a time, so a task holds one of them.

Use built-in aggregates where they can say it; this is for accumulators they lack.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


class UserAggregate:
    """``state`` and ``result`` are schemas; an accumulator is a tuple or list of the
    state's fields (nested types allowed). ``merge`` has to be associative."""

    state: str
    result: str

    def create(self) -> tuple:
        raise NotImplementedError

    def add(self, acc: tuple, *values) -> tuple:
        raise NotImplementedError

    def merge(self, a: tuple, b: tuple) -> tuple:
        raise NotImplementedError

    def value(self, acc: tuple) -> tuple:
        return tuple(acc)


class TopList(UserAggregate):
    """The ``k`` largest values with the ids that hold them; ties go to the smaller id.
    Null values are left out."""

    state = "vals array<double>, ids array<bigint>"
    result = "vals array<double>, ids array<bigint>"

    def __init__(self, k: int):
        self.k = k

    def create(self):
        return [], []

    def _best(self, pairs):
        best = sorted(pairs, key=lambda p: (-p[0], p[1]))[:self.k]
        return [p[0] for p in best], [p[1] for p in best]

    def add(self, acc, value, id_):
        if value is None or (len(acc[0]) == self.k and (-value, id_) > (-acc[0][-1], acc[1][-1])):
            return acc
        return self._best([*zip(*acc), (value, id_)])

    def merge(self, a, b):
        return self._best([*zip(*a), *zip(*b)])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def aggregate_by(df: DataFrame, keys: list[str], inputs: list[str], agg: UserAggregate, fanout: int = 32,
                 most_keys: int = 100_000) -> DataFrame:
    """``keys`` and the aggregate's result, a row per group (null keys are a group).

    A task gives out its accumulators when it holds ``most_keys`` of them. An empty table
    has no groups."""
    if {f.name for f in _parse_datatype_string(agg.state).fields} & {*keys, "_salt"}:
        raise ValueError("the aggregate's state must not be named like a key")
    picked = df.select(*keys, *[F.col(c).alias(f"_in{i}") for i, c in enumerate(inputs)])
    head = StructType([picked.schema[k] for k in keys])
    state = StructType([*head.fields, *_parse_datatype_string("_salt int").fields, *_parse_datatype_string(agg.state).fields])
    out = StructType([*head.fields, *_parse_datatype_string(agg.result).fields])
    n = len(keys)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, held = to_arrow_schema(state), {}
        salt = TaskContext.get().partitionId() % fanout
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                key = row[:n]
                held[key] = agg.add(held[key] if key in held else agg.create(), *row[n:])
            if len(held) >= most_keys:
                yield _batch([(*k, salt, *acc) for k, acc in held.items()], arrow)
                held = {}
        yield _batch([(*k, salt, *acc) for k, acc in held.items()], arrow)

    def merging(final: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            arrow, rows = to_arrow_schema(out if final else state), []
            stream = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
            for key, group in groupby(stream, key=lambda r: r[:n] if final else r[:n + 1]):
                acc = None
                for r in group:
                    acc = r[n + 1:] if acc is None else agg.merge(acc, r[n + 1:])
                rows.append((*key, *(agg.value(acc) if final else acc)))
                if len(rows) == 4096:
                    yield _batch(rows, arrow)
                    rows = []
            yield _batch(rows, arrow)
        return run

    once = picked.mapInArrow(partial, state)
    by = [*keys, "_salt"]
    twice = once.repartition(*by).sortWithinPartitions(*by).mapInArrow(merging(False), state)
    if not keys:
        return twice.coalesce(1).mapInArrow(merging(True), out)
    return twice.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(merging(True), out)
