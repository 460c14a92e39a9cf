"""User hooks (X1-X5): where a caller plugs in its own per-batch, per-group or metric code.

Built-in column functions are preferred (they stay JVM-side). What SQL cannot express comes in three forms: a
table function that sees ordered groups row by row with state it carries on (X3, X4; no group is held whole unless the function
does so), and a metric in two phases that is reduced inside every task before anything is shuffled (X5).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..constants import LABEL_PAD_ID, PAD_ID


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """A batched table function - a pandas batch in, a batch of any length out."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def apply_per_group(df: DataFrame, keys: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """A collate-style function per group (e.g. per (rank, batch)); groups must be bounded."""
    return df.groupBy(*keys).applyInPandas(fn, schema)


def with_encoder(df: DataFrame, text_col: str, encode: Callable[[Column], Column] | None, out: str = "ids") -> DataFrame:
    """Apply a column-level encoder; ``None`` returns the raw text (the raw-text sample path)."""
    return df.withColumn(out, df[text_col] if encode is None else encode(df[text_col]))


# ---------------------------------------------------------------- X3 / X4: table functions over ordered groups


class GroupFunction:
    """Base of table functions that run over the rows of a group in order.

    A subclass gives ``schema(table, *options)``, the output for a table of this type (so one function serves
    tables of any columns), and the generators ``row(row)`` and ``end()``. What it keeps on ``self`` is carried from row to row of
    one group; rows come and go one at a time, so a group of any size needs only that state.
    """

    @staticmethod
    def schema(table: T.StructType, *options) -> T.StructType:
        raise NotImplementedError

    def row(self, row, *options):
        raise NotImplementedError

    def end(self):
        return iter(())


def run_over_groups(df: DataFrame, function: type[GroupFunction], keys: Sequence[str], order: Sequence[str], *options) -> DataFrame:
    """``function`` over every group of ``keys`` in ``order``; options are constants that it also gets."""

    class Handler(function):
        @staticmethod
        def analyze(table: AnalyzeArgument, *more: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(schema=function.schema(table.dataType, *[m.value for m in more]))

        def eval(self, row, *more):
            yield from self.row(row, *more)

        def terminate(self):
            yield from self.end()

    return F.udtf(Handler)(df.asTable().partitionBy(*keys).orderBy(*order), *[F.lit(o) for o in options])


class PackRows(GroupFunction):
    """Q7 as a table function: a group's ids run into blocks of ``size``; what is left over is dropped unless the group fills no block.

    The table has the columns ``grp`` and ``input_ids``; less than a block is carried from row to row.
    """

    def __init__(self):
        self.left, self.block, self.group = [], 0, None

    @staticmethod
    def schema(table, *options):
        return T.StructType([table["grp"], T.StructField("blk", T.LongType()), table["input_ids"], T.StructField("labels", table["input_ids"].dataType)])

    def row(self, row, size):
        self.group = row["grp"]
        self.left += row["input_ids"]
        at = 0
        while len(self.left) - at >= size:
            ids = self.left[at : at + size]
            yield self.group, self.block, ids, ids
            self.block, at = self.block + 1, at + size
        del self.left[:at]

    def end(self):
        if not self.block and self.left:
            yield self.group, 0, self.left, self.left


class PadRows(GroupFunction):
    """Q5 as a table function: the arrays of a batch padded to its longest. The width is known at the batch's end only, so the rows
    of one batch (``batch_size`` at most) are carried; other columns are passed through, whatever they are."""

    PADS = {"input_ids": PAD_ID, "attention_mask": PAD_ID, "labels": LABEL_PAD_ID}

    def __init__(self):
        self.rows = []

    @staticmethod
    def schema(table, *options):
        return T.StructType([*table.fields, T.StructField("batch_width", T.LongType())])

    def row(self, row):
        self.rows.append(row.asDict())
        yield from ()

    def end(self):
        width = max((len(r["input_ids"]) for r in self.rows), default=0)
        for r in self.rows:
            padded = {c: r[c] + [p] * (width - len(r[c])) for c, p in self.PADS.items() if c in r}
            yield (*(r | padded).values(), width)


# ---------------------------------------------------------------- X5: metrics in two phases


@dataclass
class TwoPhaseMetric:
    """A metric that is reduced per Arrow batch before anything is gathered.

    ``partial`` turns a record batch into a state (a dict that JSON can hold), ``merge`` adds two states and must not depend on their
    order, ``finish`` turns the last one into the columns of ``result`` (a DDL string). A state may not grow with the rows: one beyond ``state_bytes`` is an error.
    """

    partial: Callable[[pa.RecordBatch], dict]
    merge: Callable[[dict, dict], dict]
    finish: Callable[[dict], dict]
    result: str
    state_bytes: int = 1 << 20


_HELD = 1 << 12  # groups a task keeps before it passes their states on


def two_phase(df: DataFrame, metric: TwoPhaseMetric, group_cols: Sequence[str] = ()) -> DataFrame:
    """``(group columns, result columns)``, one row a group (one row in all without groups; none for an empty table).

    Batches are reduced in the tasks that read them, then the states meet in two levels: first about the square root of the tasks' number of
    places for every group, then one. So no task merges the states of all tasks, however many there are or however hot a group is.
    """
    spark, groups = df.sparkSession, list(group_cols)
    keys = [df.schema[g] for g in groups]
    state_schema = T.StructType([*keys, T.StructField("_salt", T.IntegerType()), T.StructField("_state", T.StringType())])
    result_schema = T.StructType([*keys, *T.StructType.fromDDL(metric.result).fields])

    def packed(rows, salt, like):
        arrays = [pa.array([k[i] for k, _ in rows], like.field(g).type) for i, g in enumerate(groups)]
        texts = [json.dumps(s, separators=(",", ":")) for _, s in rows]
        for t in texts:
            if len(t) > metric.state_bytes:
                raise ValueError(f"a metric state of {len(t)} bytes; {metric.state_bytes} are allowed")
        return pa.RecordBatch.from_arrays([*arrays, pa.array([salt] * len(rows), pa.int32()), pa.array(texts, pa.string())], names=[*groups, "_salt", "_state"])

    def split(batch):
        """The batch's rows by group."""
        if not groups:
            yield (), batch
            return
        codes = None
        for g in groups:
            c = batch.column(g).dictionary_encode(null_encoding="encode").indices
            codes = c.cast(pa.int64()) if codes is None else pc.add(pc.multiply(codes, batch.num_rows + 1), c.cast(pa.int64()))
            codes = codes.dictionary_encode().indices.cast(pa.int64())
        for code in pc.unique(codes).to_pylist():
            part = batch.filter(pc.equal(codes, code))
            yield tuple(part.column(g)[0].as_py() for g in groups), part

    def reduce(batches):
        from pyspark import TaskContext

        salt, held, like = TaskContext.get().partitionId(), {}, None
        for b in batches:
            like = b.schema
            if not b.num_rows:
                continue
            for key, part in split(b):
                s = metric.partial(part)
                held[key] = metric.merge(held[key], s) if key in held else s
            if len(held) > _HELD:
                yield packed(list(held.items()), salt, like)
                held = {}
        if held:
            yield packed(list(held.items()), salt, like)

    def merged(last):
        def run(batches):
            key, state, like, out = None, None, None, []

            def done():
                if not last:
                    return packed(out, 0, like)
                rows = [dict(zip(groups, k)) | metric.finish(s) for k, s in out]
                return pa.RecordBatch.from_pylist(rows, schema=pa.schema([*[like.field(g) for g in groups], *result_fields]))

            for b in batches:
                like = b.schema
                names = [b.column(g).to_pylist() for g in groups]
                for i, text in enumerate(b.column("_state").to_pylist()):
                    k = tuple(n[i] for n in names)
                    s = json.loads(text)
                    if state is not None and k == key:
                        state = metric.merge(state, s)
                        continue
                    if state is not None:
                        out.append((key, state))
                    key, state = k, s
                if len(out) > _HELD:
                    yield done()
                    out = []
            if state is not None:
                out.append((key, state))
            if out:
                yield done()

        return run

    result_fields = list(to_arrow_schema(T.StructType.fromDDL(metric.result)))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = max(1, int(n**0.5))
    states = df.mapInArrow(reduce, state_schema).withColumn("_salt", F.col("_salt") % places)
    by = [F.col(g) for g in groups]
    first = states.repartition(n, *by, F.col("_salt")).sortWithinPartitions(*by, "_salt").mapInArrow(merged(False), state_schema)
    return first.repartition(n, *by, F.col("_salt")).sortWithinPartitions(*by, "_salt").mapInArrow(merged(True), result_schema)
