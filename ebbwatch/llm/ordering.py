"""Places of rows within their key, for keys of any size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbwatch.llm.common import Batches, map_batches
from ebbwatch.session import write_table


def placed(rows: DataFrame, key: str, order: list[str], weight: str) -> DataFrame:
    """Adds ``pos``: the sum of the weights of the rows before this one with the same key (nulls first, null is a key too).

    The rows are sorted by ranges of key and order, so a key with a third of all rows is spread over as many partitions
    as its rows need; what comes before a partition in the key that it begins with is added from the
    edges of the partitions, two rows each. Rows that are equal in all of these columns must have been counted into one.
    """
    ranges = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    columns = rows.columns

    def work(batches: Batches) -> Batches:
        part, run, total, last = TaskContext.get().partitionId(), -1, 0, None
        for b in batches:
            if not b.num_rows:
                continue
            keys, sizes = b.column(key), np.asarray(b.column(weight)).astype(np.int64)
            same = np.asarray(_equal(keys.slice(1), keys.slice(0, len(keys) - 1)))
            new = np.concatenate([[run < 0 or keys[0] != last], ~same])
            runs = run + np.cumsum(new)
            sums = np.cumsum(sizes) - sizes
            starts = np.flatnonzero(new)
            # A run that came with the batch before goes on from its total.
            base = np.where(runs == run, -total, 0)
            if len(starts):
                base = np.where(runs == run, base, sums[starts[np.maximum(np.cumsum(new) - 1, 0)]])
            at = sums - base
            run, total, last = int(runs[-1]), int(at[-1] + sizes[-1]), keys[len(keys) - 1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in columns), pa.array(np.full(b.num_rows, part)), pa.array(runs.astype(np.int64)), pa.array(at)],
                [*columns, "part", "run", "at"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    local = write_table(map_batches(ranges, work, f"{schema}, part long, run long, at long"), "ordered")
    end = (F.col("at") + F.col(weight)).alias("end")
    edges = local.groupBy("part").agg(
        F.max(F.when(F.col("run") == 0, F.struct(end, F.col(key).alias("key")))).alias("first"),
        F.max(F.struct("run", end, F.col(key).alias("key"))).alias("last"),
    )
    first = edges.select("part", F.lit(0).alias("run"), "first.end", "first.key")
    last = edges.where("last.run > 0").select("part", "last.run", "last.end", "last.key")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = first.union(last).withColumn("carried", F.sum("end").over(before)).where("run = 0 AND carried IS NOT NULL")
    rest = local.join(carried.select("part", F.lit(0).cast("long").alias("run"), "carried"), ["part", "run"], "left")
    return rest.select(*columns, (F.col("at") + F.coalesce("carried", F.lit(0))).alias("pos"))


def _equal(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether values are equal, null with null as well."""
    return pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))


def runs_of(batches: Batches, *keys: str):
    """Consecutive rows with the same values of ``keys``, over the bounds of batches: (values, rows as dicts)."""
    held, now = [], None
    for b in batches:
        for row in b.to_pylist():
            values = tuple(row[k] for k in keys)
            if held and values != now:
                yield now, held
                held = []
            now = values
            held.append(row)
    if held:
        yield now, held
