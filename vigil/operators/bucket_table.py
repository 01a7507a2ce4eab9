"""A keyed parquet table whose writes touch only the buckets of the changed keys.

Rows lie in partitions (bucket, part); the bucket is a hash of the key. A commit
is one row of a small log, written as a single file, and names the writer and,
for a stream, its micro-batch:

* ``reload`` writes a new generation of the table beside the old one;
* ``append`` writes a new part, which readers see once the log names it;
* ``merge`` reads the buckets of the changed keys, writes their new rows to a
  staging folder, commits, and then replaces those partitions by a dynamic
  partition overwrite. If that last step is cut short, the next reader or writer
  does it again from the staging folder.

So a failed write leaves the table as it was, and a micro-batch that a stream
delivers again is skipped: only batches of the same writer count. Writers take
turns; for writers at the same time use a table format with MERGE.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = ("seq long, writer string, batch_id long, generation string, parts array<string>, stage string, "
              "buckets int, next_id long, done boolean")
#: Part of the rows that merges insert.
MERGED = "p0"
#: Buckets of a new table; at 1024 a table of 10^9 keys has some 10^6 in each.
BUCKETS = 64


@dataclass(frozen=True)
class State:
    """The newest commit and the parts that readers see."""

    seq: int = 0
    generation: str = ""            # no generation yet: no rows
    parts: tuple[str, ...] = (MERGED,)  # one for each load since the last reload
    stage: str | None = None
    buckets: int = BUCKETS
    next_id: int = 1
    done: bool = True               # False: rows of the stage may not be in place yet


class BucketTable:
    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets

    # ------------------------------------------------------------------- log

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/_log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # no commit yet
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def _write_log(self, st: State, writer: str, batch_id: int | None) -> None:
        row = dict(seq=st.seq, writer=writer, batch_id=batch_id, generation=st.generation, stage=st.stage,
                   buckets=st.buckets, next_id=st.next_id, done=st.done)
        types = dict(c.split() for c in LOG_SCHEMA.split(", "))
        values = {n: F.lit(v) for n, v in row.items()} | {"parts": F.array(*[F.lit(p) for p in st.parts])}
        entry = self.spark.range(0, 1, 1, 1).select(*[values[n].cast(t).alias(n) for n, t in types.items()])
        entry.write.mode("append").parquet(f"{self.root}/_log")

    def _newest(self, writer: str | None = None) -> tuple[State, int]:
        """The newest commit, and the newest micro-batch of a writer (-1: none).
        A merge that was cut short is put in place first."""
        batch = F.max(F.when(F.col("writer") == writer, F.col("batch_id"))) if writer else F.lit(None)
        got = self._log().agg(F.max_by(F.struct("*"), F.struct("seq", "done")).alias("r"), batch.alias("b")).first()
        last, batch_id = got["r"], -1 if got["b"] is None else got["b"]
        if last is None:
            return State(buckets=self.buckets), batch_id
        st = State(last["seq"], last["generation"], tuple(last["parts"]), last["stage"], last["buckets"], last["next_id"], last["done"])
        return (st if st.done else self._put_in_place(st, last["writer"], last["batch_id"])), batch_id

    def state(self) -> State:
        return self._newest()[0]

    def exists(self) -> bool:
        return self.state().seq > 0

    def last_batch(self, writer: str) -> int:
        """The newest micro-batch of a stream that is in the table, -1 without one; loads have none."""
        return self._newest(writer)[1]

    # ------------------------------------------------------------------ reads

    def _path(self, st: State) -> str:
        return f"{self.root}/data-{st.generation}"

    def _bucket(self, key: Column, st: State) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(st.buckets)).cast("int")

    def _touched(self, keys: DataFrame, key: str, st: State) -> list[int]:
        """Buckets of the keys; at most the table's number of buckets."""
        return [r[0] for r in keys.select(self._bucket(F.col(key), st)).distinct().collect()]

    def _rows(self, st: State) -> DataFrame | None:
        """All visible rows with their bucket and part; None if there are none."""
        if not st.generation:
            return None
        try:
            rows = self.spark.read.parquet(self._path(st))
        except AnalysisException as e:  # every write so far was empty
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
        return rows.filter(F.col("part").isin(*st.parts))

    def read(self) -> DataFrame | None:
        """All rows; None before the first ones."""
        rows = self._rows(self.state())
        return None if rows is None else rows.drop("bucket", "part")

    def read_keys(self, keys: DataFrame, key: str) -> DataFrame | None:
        """The rows of the keys in a column of ``keys``; only their buckets are read."""
        st = self.state()
        rows = self._rows(st)
        if rows is None:
            return None
        rows = rows.filter(F.col("bucket").isin(*self._touched(keys, key, st))).drop("bucket", "part")
        wanted = keys.select(F.col(key).cast("string").alias("_key")).distinct()
        return rows.join(wanted, rows[self.key].cast("string") == F.col("_key"), "left_semi")

    # ----------------------------------------------------------------- writes

    def _write(self, rows: DataFrame, path: str) -> None:
        # rows of a bucket by key: the columns pack well, and the writer sorts by partition anyway
        (rows.sortWithinPartitions("bucket", "part", self.key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "part").parquet(path))

    def _load(self, rows: DataFrame, st: State, part: str) -> None:
        self._write(rows.withColumns({"bucket": self._bucket(F.col(self.key), st), "part": F.lit(part)})
                    .repartition("bucket"), self._path(st))

    def reload(self, rows: DataFrame, next_id: int = 1, writer: str = "load", batch_id: int | None = None) -> None:
        """Replace all rows by a new generation."""
        part = f"p{uuid.uuid4().hex}"
        st = replace(self.state(), generation=part, parts=(MERGED, part), stage=None, next_id=next_id)
        self._load(rows, st, part)
        self._write_log(replace(st, seq=st.seq + 1), writer, batch_id)

    def append(self, rows: DataFrame, next_id: int = 1, writer: str = "load", batch_id: int | None = None) -> None:
        """Add rows of new keys; rows that are there are neither read nor written."""
        st = self.state()
        if not st.generation:
            return self.reload(rows, next_id, writer, batch_id)
        part = f"p{uuid.uuid4().hex}"
        self._load(rows, st, part)
        self._write_log(replace(st, seq=st.seq + 1, parts=(*st.parts, part), stage=None, next_id=next_id), writer, batch_id)

    def merge(self, changes: DataFrame, combine: Callable[[DataFrame | None, DataFrame, State], DataFrame],
              writer: str = "load", batch_id: int | None = None, id_col: str | None = None) -> bool:
        """Replace the rows of the buckets that hold the keys of ``changes``.

        ``combine(current, changes, state)`` gets these buckets' rows (with their
        ``part``; None if there are no rows at all) and gives the rows they become, with
        a null part where a row is new. No row may vanish. False: the batch was in the table."""
        st, last = self._newest(writer)
        if batch_id is not None and batch_id <= last:
            return False
        current = self._rows(st)
        touched = self._touched(changes, self.key, st)
        if current is not None:
            current = current.filter(F.col("bucket").isin(*touched)).drop("bucket")
        rows = combine(current, changes, st)
        rows = rows.withColumns({"part": F.coalesce(F.col("part"), F.lit(MERGED)), "bucket": self._bucket(F.col(self.key), st)})
        stage = f"{self.root}/_stage/{uuid.uuid4().hex}"
        self._write(rows.repartition("bucket"), stage)
        next_id = st.next_id
        if id_col and touched:
            next_id = max(next_id, 1 + (self.spark.read.schema(rows.schema).parquet(stage).agg(F.max(id_col)).first()[0] or 0))
        st = replace(st, seq=st.seq + 1, generation=st.generation or f"p{uuid.uuid4().hex}", stage=stage, next_id=next_id, done=False)
        self._write_log(st, writer, batch_id)
        self._put_in_place(st, writer, batch_id)
        return True

    def _put_in_place(self, st: State, writer: str, batch_id: int | None) -> State:
        """Replace the partitions that a committed stage holds; doing it twice changes nothing."""
        try:
            self._write(self.spark.read.parquet(st.stage), self._path(st))
        except AnalysisException as e:  # a stage without rows
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
        st = replace(st, done=True)
        self._write_log(st, writer, batch_id)
        return st
