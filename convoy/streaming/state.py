"""State that travels from micro-batch to micro-batch as a small Parquet table.

Batch N reads what batch N-1 wrote and writes its own copy into the other of two slots. A
batch that is replayed after a failure finds its input untouched and overwrites its own
output, so nothing is counted twice; and only two copies ever exist.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convoy.sources.lake import (
    committed_numbers,
    folder_values,
    is_committed,
    read_parquet_or_empty,
    remove_folder,
)


class BatchState:
    def __init__(self, path: str, schema: T.StructType):
        self.path = path
        self.schema = schema

    def _slot(self, batch_id: int) -> str:
        return f"{self.path}/slot{batch_id % 2}"

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """State as the batch before ``batch_id`` left it."""
        if batch_id == 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self._slot(batch_id - 1))

    def write(self, state: DataFrame, batch_id: int) -> None:
        (
            state.select(*self.schema.names)
            .withColumn("state_written", F.current_timestamp())
            .write.mode("overwrite")
            .parquet(self._slot(batch_id))
        )

    def latest(self, spark: SparkSession) -> DataFrame:
        """State after the newest batch, for readers outside the stream.

        Of the slots whose writing has ended the one written last counts: batch numbers start again with
        a new checkpoint, times don't.
        """
        stored = T.StructType([*self.schema.fields, T.StructField("state_written", T.TimestampType())])
        slots = spark.createDataFrame([], stored)
        for slot in (0, 1):
            if is_committed(spark, self._slot(slot)):
                slots = slots.unionByName(read_parquet_or_empty(spark, self._slot(slot), stored))
        newest = slots.agg(F.max("state_written").alias("state_written"))
        return slots.join(newest, "state_written").select(*self.schema.names)


class KeyedState:
    """One row per key, kept as what each batch changed.

    Batch N of a writer adds ``changes/batch=N`` with the keys it touched and nothing else, so its cost
    follows its own keys, however many there are in all. Every ``fold_every`` batches the changes are
    folded into one table, and what the fold before that had already covered is removed: readers that
    began before it find their files. A replayed batch writes its own folder anew. Only folders that were
    written to the end count.

    ``merge`` makes one row per key of the rows of several batches; it sees the column ``state_batch``. ``keep``
    filters what is folded, for a time-to-live.
    """

    def __init__(
        self,
        path: str,
        schema: T.StructType,
        merge: Callable[[DataFrame], DataFrame],
        keep: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        fold_every: int = 100,
    ):
        self.path, self.schema, self.merge, self.keep, self.fold_every = path, schema, merge, keep, fold_every
        self.stored = T.StructType([*schema.fields, T.StructField("state_batch", T.LongType())])

    def _of(self, writer: str) -> str:
        return f"{self.path}/writer={writer}"

    def _rows(self, spark: SparkSession, writer: str, until: int | None) -> DataFrame:
        """Rows of the newest fold and of the changes after it, of batches before ``until``."""
        root = self._of(writer)

        def numbers(kind: str, name: str) -> list[int]:
            return [n for n in committed_numbers(spark, f"{root}/{kind}", name) if until is None or n < until]

        folds = numbers("folded", "upto")[-1:]
        after = folds[0] if folds else -1
        paths = [f"{root}/folded/upto={n}" for n in folds]
        paths += [f"{root}/changes/batch={n}" for n in numbers("changes", "batch") if n > after]
        if not paths:
            return spark.createDataFrame([], self.stored)
        return spark.read.schema(self.stored).parquet(*paths)

    def before(self, spark: SparkSession, batch_id: int, writer: str) -> DataFrame:
        """State as the batches of ``writer`` before ``batch_id`` left it."""
        return self.merge(self._rows(spark, writer, batch_id)).select(*self.schema.names)

    def write(self, changed: DataFrame, batch_id: int, writer: str) -> None:
        """Add the rows of the keys that a batch changed."""
        spark, root = changed.sparkSession, self._of(writer)
        rows = changed.select(*self.schema.names, F.lit(batch_id).cast("long").alias("state_batch"))
        rows.write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")
        if batch_id % self.fold_every == self.fold_every - 1:
            self._fold(spark, batch_id, writer)

    def _fold(self, spark: SparkSession, batch_id: int, writer: str) -> None:
        root = self._of(writer)
        covered = [n for n in committed_numbers(spark, f"{root}/folded", "upto") if n < batch_id]
        rows = self.keep(self.merge(self._rows(spark, writer, batch_id + 1)))
        rows = rows.select(*self.schema.names, F.lit(batch_id).cast("long").alias("state_batch"))
        rows.write.mode("overwrite").parquet(f"{root}/folded/upto={batch_id}")
        for n in covered[:-1]:
            remove_folder(spark, f"{root}/folded/upto={n}")
        for n in committed_numbers(spark, f"{root}/changes", "batch") if covered else []:
            if n <= covered[-1]:
                remove_folder(spark, f"{root}/changes/batch={n}")

    def latest(self, spark: SparkSession) -> DataFrame:
        """State after the newest batches of all writers, for readers outside the stream."""
        writers = folder_values(spark, self.path, "writer")
        rows = [self._rows(spark, w, None) for w in writers] or [spark.createDataFrame([], self.stored)]
        return self.merge(reduce(DataFrame.unionByName, rows)).select(*self.schema.names)
