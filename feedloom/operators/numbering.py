"""Row numbers and running totals over a total order, without a global window.

Rows are sorted into ranges of (group, order), so a group of any size is dealt
over many tasks; each task numbers its own range in one pass and the ranges
are landed.  What a range must add to its numbers is the total of the part of
its first group that lies in earlier ranges: one small row a range tells it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

_PART, _ROW, _SALT = "_part", "_row", "_salt"


def _differs(column: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """Which values differ from the one before; null equals null."""
    previous = pa.concat_arrays([pa.array([before.as_py()] if before is not None else [None], column.type), column[:-1]])
    unequal = pc.fill_null(pc.not_equal(column, previous), False)
    return np.asarray(pc.or_(unequal, pc.xor(pc.is_null(column), pc.is_null(previous))))


def _within(values: np.ndarray, start: np.ndarray, new: bool, carry: int, op: np.ufunc) -> tuple[np.ndarray, int]:
    """Running totals that begin anew at each group's start."""
    total = op.accumulate(values)
    begin = np.where(start > 0, total[start - 1], np.int64(0))
    out = total - begin if op is np.add else total ^ begin
    first = np.int64(0 if new else carry)
    held = start == start[0]
    out[held] = op(out[held], first)
    return out, int(out[-1])


def running(df: DataFrame, group: list[str], order: list[str], path: str, index: str = "at",
            sums: dict[str, str] | None = None, xors: dict[str, str] | None = None) -> DataFrame:
    """``df`` with ``index``, each row's number (from 1) in its group by
    ``order`` (nulls first), and for every ``new: column`` of ``sums`` and
    ``xors`` the total, or the exclusive or, of a long column's values up to
    and including the row (null counts as 0).

    The ranges are landed below ``path`` and read back, so numbers stay as
    they are whatever is lost or run again later.  Rows equal in group and
    order get their numbers in an undefined order.  The driver sees one row a
    range (as many as shuffle partitions).
    """
    spark, folds = df.sparkSession, [(n, c, np.add) for n, c in (sums or {}).items()]
    folds += [(n, c, np.bitwise_xor) for n, c in (xors or {}).items()]
    names = [index, *[n for n, _, _ in folds]]
    taken = {_PART, _ROW, _SALT, *names} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} exist already")
    # The salt lets a range border fall between equal rows.
    keys = [*group, *order, _SALT]
    dealt = df.withColumn(_SALT, F.rand(0)).repartitionByRange(*keys).sortWithinPartitions(*keys).drop(_SALT)
    columns, schema = df.columns, StructType([*df.schema.fields, *[StructField(n, LongType()) for n in [*names, _PART, _ROW]]])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, last, carry = TaskContext.get().partitionId(), 0, None, [0] * len(names)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            by = [batch.column(columns.index(g)) for g in group]
            cut = np.zeros(n, dtype=bool)
            for i, column in enumerate(by):
                cut |= _differs(column, last[i] if last else None)
            new = last is None or bool(cut[0])
            cut[0] = True
            start = np.maximum.accumulate(np.where(cut, np.arange(n), 0))
            values = [np.ones(n, dtype=np.int64)]
            values += [np.asarray(pc.fill_null(batch.column(columns.index(c)), 0)).astype(np.int64) for _, c, _ in folds]
            done = [_within(v, start, new, c, op) for v, c, op in zip(values, carry, [np.add, *[op for _, _, op in folds]])]
            carry = [c for _, c in done]
            last = [column[n - 1] for column in by]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(v) for v, _ in done], pa.array(np.full(n, part)), pa.array(np.arange(rows, rows + n))],
                names=[*columns, *names, _PART, _ROW])
            rows += n

    dealt.mapInArrow(number, schema).write.parquet(path)
    landed = spark.read.schema(schema).parquet(path)
    ends = (landed.groupBy(_PART).agg(
        F.min_by(F.struct(*group, F.lit(0).alias("_g")), _ROW).alias("first"),
        F.max_by(F.struct(*group, F.lit(0).alias("_g"), *names), _ROW).alias("last")).orderBy(_PART).collect())
    out, key, totals = [], None, None
    for r in ends:
        first, last = tuple(r["first"]), tuple(r["last"])[:len(group) + 1]
        before = totals if first == key else None
        if before:
            out.append((r[_PART], *before))
        totals = [r["last"][n] for n in names]
        if before and first == last:
            totals = [_plus(a, b, xor) for a, b, xor in zip(before, totals, [False, *[op is not np.add for _, _, op in folds]])]
        key = last
    if not out:
        return landed.drop(_PART, _ROW)
    more = [f"_more_{n}" for n in names]
    firsts = F.broadcast(spark.createDataFrame(out, StructType([StructField(c, LongType()) for c in ["_at_part", *more]])))
    # A row belongs to the carried group if nothing in its range before it began another one.
    heads = [r for r in ends if r[_PART] in {o[0] for o in out}]
    border = F.broadcast(spark.createDataFrame(
        [(r[_PART], tuple(r["first"])[:-1]) for r in heads],
        StructType([StructField("_head_part", LongType()), StructField("_head", StructType([df.schema[g] for g in group]))]))) if group else None
    joined = landed.join(firsts, landed[_PART] == firsts["_at_part"], "left")
    held = F.col("_at_part").isNotNull()
    if group:
        joined = joined.join(border, joined[_PART] == border["_head_part"], "left")
        for g in group:
            held = held & joined[g].eqNullSafe(F.col(f"_head.{g}"))
    adds = [False, *[op is not np.add for _, _, op in folds]]
    return joined.select(*columns, *[
        F.when(held, F.col(n).bitwiseXOR(F.col(m)) if xor else F.col(n) + F.col(m)).otherwise(F.col(n)).alias(n)
        for n, m, xor in zip(names, more, adds)])


def _plus(a: int, b: int, xor: bool) -> int:
    return a ^ b if xor else a + b
