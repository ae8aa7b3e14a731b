"""Sums over all rows in an order, by two passes: inside range partitions, then over their totals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexfold.llm.common import Scratch


def running(df: DataFrame, order: list, value: str, scratch: Scratch, name: str) -> DataFrame:
    """``df`` with _before: the sum of ``value`` (long, not null) over all rows that come earlier in ``order``.

    Rows are sorted into range partitions; equal rows are dealt by a number of
    their own, so that no value of the order, however common, is one task's.
    A task adds up its own rows and the totals, one number a partition, are
    added up on the driver.  The rows are written between the passes, so a
    lost executor moves none.
    """
    source = df.withColumn("_deal", F.monotonically_increasing_id()).repartitionByRange(*order, "_deal").sortWithinPartitions(*order, "_deal").drop("_deal")
    schema = T.StructType([*source.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_local", T.LongType())])

    def add(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = before + np.cumsum(sizes)
            if len(ends):
                before = int(ends[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(sizes), part, np.int32)), pa.array(ends - sizes)], names=schema.names)

    rows = scratch.written(source.mapInArrow(add, schema), name)
    totals = sorted(tuple(r) for r in rows.groupBy("_part").agg(F.sum(value)).collect())
    ends = np.cumsum([n for _, n in totals], dtype=np.int64)
    bases = df.sparkSession.createDataFrame([(p, int(e) - n) for (p, n), e in zip(totals, ends, strict=True)], "_part int, _base long")
    # one row a partition
    return rows.join(F.broadcast(bases), "_part").withColumn("_before", F.col("_base") + F.col("_local")).drop("_part", "_base", "_local")
