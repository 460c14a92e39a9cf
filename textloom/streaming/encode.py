"""ST1 / ST2: forward-only encoding of arriving files.

ST1 is stateless: each arriving line is parsed and turned into a sample with
the same column functions as the batch path, and appended to a parquet sink.
ST2 shards and batches lines as files arrive. Lines are numbered per file (the file source never splits
a file across micro-batches) and go to ranks by their number. :func:`shard_and_batch_per_microbatch` ends batches at
every file; :class:`ContinuousBatches` goes on filling a rank's batch over files and micro-batches, as
one loader reading all files one after the other does: the rows of unfilled batches and every rank's
next step are kept from one micro-batch to the next in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import order as O
from ..operators import sequence as Q
from ..operators.position import scan_line_numbers
from ..session import materialize, remove_table
from ..sources.index import read_if_present


def conversation_stream(spark: SparkSession, src_dir: str, *, schema: str = "conv_id bigint, texts array<string>", max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming JSONL source of conversations (one object per line)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(src_dir).withColumns({"file": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start")})


def encode_stream(stream: DataFrame, ids: Column, max_len: int | None, key_cols=("conv_id",)) -> DataFrame:
    """ST1: per-row Q3 sample (iterable truncation, position ids, labels) on a stream."""
    s = stream.select(*key_cols, ids.alias("ids"))
    return Q.iterable_sample(s, "ids", max_len).drop("ids")


def _wait(q, timeout_s: float | None) -> None:
    """Wait for a query to end: without a limit unless the caller sets one."""
    if timeout_s is None:
        q.awaitTermination()  # raises what ended the query
        return
    if not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError("stream did not finish")


def run_to_parquet(df: DataFrame, sink: str, checkpoint: str, *, timeout_s: float | None = None) -> None:
    """Append to a parquet sink with an ``availableNow`` trigger and wait for it.

    The checkpoint location makes the sink exactly-once across restarts.
    """
    q = (
        df.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    _wait(q, timeout_s)


def shard_and_batch_per_microbatch(
    world_size: int, batch_size: int, sink: str, ids_col: str = "input_ids"
) -> Callable[[DataFrame, int], None]:
    """ST2: a ``foreachBatch`` function - line numbers per file, strided ranks (O7),
    batches per rank (O5, last short batch kept), padding (Q6); appended to ``sink``
    with the micro-batch id, so a replayed micro-batch overwrites nothing twice.
    Lines are numbered by their place in the file (columns ``file`` and ``block`` of the source)."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        lines = scan_line_numbers(batch, "file", "block", "line_no")
        sh = O.line_shard(lines, world_size)
        b = sh.withColumn("batch", F.floor(F.col("step") / batch_size).cast("bigint")).withColumn(
            "slot", (F.col("step") % batch_size).cast("bigint")
        )
        out = Q.collate(b, ("file", "rank", "batch"), pad_cols={ids_col: 0, "attention_mask": 0, "labels": -100})
        (
            out.withColumn("micro_batch", F.lit(epoch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("micro_batch")
            .parquet(sink)
        )

    return run


def run_foreach_batch(df: DataFrame, fn, checkpoint: str, *, timeout_s: float | None = None) -> None:
    q = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    _wait(q, timeout_s)


class ContinuousBatches:
    """ST2 without ends at files or micro-batches: a ``foreachBatch`` function with state.

    The lines of a micro-batch are read file by file in the order of their paths; rank ``i % world_size`` takes line ``i`` of a file, and
    a rank's lines from all files up to now are numbered on. A line's number in its rank is the rank's next step plus its lines in the
    earlier files of the micro-batch (a sum over one row a file) plus ``i // world_size``, so no line is moved to number it. Batches that are full are
    padded and written to ``sink`` under the micro-batch's number; the rows of the others (less than ``batch_size``
    a rank) and the next steps are written to ``state/<micro-batch>``.

    Micro-batch ``n`` reads the state of ``n - 1`` only and writes its own outputs anew, so one that is repeated after a
    failure gives the same, and the checkpoint of the stream brings it back to the right state. :meth:`finish` returns the last short batches.
    """

    def __init__(self, spark: SparkSession, world_size: int, batch_size: int, sink: str, state: str, ids_col: str = "input_ids"):
        self.spark, self.world_size, self.batch_size, self.sink, self.state, self.ids_col = spark, world_size, batch_size, sink.rstrip("/"), state.rstrip("/"), ids_col

    def _rows(self, number: int) -> DataFrame | None:
        return read_if_present(self.spark, f"{self.state}/{number}/rows")

    def _steps(self, number: int) -> dict[int, int]:
        got = read_if_present(self.spark, f"{self.state}/{number}/steps")
        return {} if got is None else {r.rank: r.next for r in got.collect()}  # one row a rank

    def _numbered(self, lines: DataFrame, steps: dict[int, int]) -> tuple[DataFrame, DataFrame]:
        """Lines with their rank and step, and the ranks' next steps."""
        sharded = O.line_shard(lines, self.world_size)
        files = sharded.groupBy("file", "rank").agg((F.max("step") + 1).alias("_n"))
        known = F.create_map(*[F.lit(x) for r, n in sorted(steps.items()) for x in (r, n)]) if steps else F.lit(None).cast("map<bigint,bigint>")
        first = F.coalesce(F.element_at(known, F.col("rank")), F.lit(0)).cast("bigint")
        before = Window.partitionBy("rank").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
        offsets = files.select(F.col("file").alias("_file"), F.col("rank").alias("_rank"), (first + F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_off"))
        out = sharded.join(offsets, (F.col("file") == F.col("_file")) & (F.col("rank") == F.col("_rank")))
        ranks = self.spark.range(self.world_size).select(F.col("id").alias("rank")).join(files.groupBy("rank").agg(F.sum("_n").alias("_n")), "rank", "left")
        return out.withColumn("step", F.col("_off") + F.col("step")).drop("_file", "_rank", "_off", "block", "line_no"), ranks.select("rank", (first + F.coalesce("_n", F.lit(0))).alias("next"))

    def _collated(self, rows: DataFrame) -> DataFrame:
        b = rows.withColumn("batch", F.floor(F.col("step") / self.batch_size).cast("bigint")).withColumn("slot", (F.col("step") % self.batch_size).cast("bigint"))
        return Q.collate(b, ("rank", "batch"), pad_cols={self.ids_col: 0, "attention_mask": 0, "labels": -100})

    def __call__(self, batch: DataFrame, number: int) -> None:
        steps = self._steps(number - 1)
        fresh, ranks = self._numbered(scan_line_numbers(batch, "file", "block", "line_no"), steps)
        ranks.write.mode("overwrite").parquet(f"{self.state}/{number}/steps")
        now = self._steps(number)
        fresh = materialize(fresh, "stream-lines")
        held = self._rows(number - 1)
        rows = fresh if held is None else fresh.unionByName(held.select(fresh.columns))
        # a rank's last batch is open unless it ends where the rank's lines do
        opened = F.create_map(*[F.lit(x) for r, n in sorted(now.items()) for x in (r, n - n % self.batch_size)])
        is_open = F.col("step") >= F.element_at(opened, F.col("rank"))
        rows.filter(is_open).write.mode("overwrite").parquet(f"{self.state}/{number}/rows")
        self._collated(rows.filter(~is_open)).write.mode("overwrite").parquet(f"{self.sink}/micro_batch={number}")
        if number > 1:  # a repeated micro-batch reads the state before it and no older one
            if read_if_present(self.spark, f"{self.state}/{number - 2}/steps") is not None:
                remove_table(f"{self.state}/{number - 2}")

    def finish(self) -> DataFrame:
        """All batches written, and the short ones that nothing has filled."""
        out = self.spark.read.option("basePath", self.sink).parquet(f"{self.sink}/micro_batch=*").drop("micro_batch")
        last = out.sparkSession.read.option("basePath", self.sink).parquet(f"{self.sink}/micro_batch=*").agg(F.max("micro_batch")).first()[0]
        held = None if last is None else self._rows(last)
        return out if held is None else out.unionByName(self._collated(held).select(out.columns))
