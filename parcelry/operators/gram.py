"""Sums of products of all pairs of many columns, from one pass over the rows.

One expression per pair of columns grows with the square of their number and
soon outgrows what can be compiled. Here each task adds up its Arrow batches
as matrix products, so that it leaves one matrix for each group; their rows are
dealt out by number, added up where they meet, and only the sums reach the
driver: groups times columns squared numbers, whatever the rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from parcelry.session import share_package

#: A task holds one matrix of this many columns for each group and kind of product.
MAX_COLUMNS = 4096
#: Bytes of all matrices of a task together.
MAX_BYTES = 512 << 20


def _check(size, groups, kinds=1):
    if size > MAX_COLUMNS or 8 * size * size * groups * kinds > MAX_BYTES:
        raise ValueError(f"products of {size} columns for {groups} groups exceed what one task may hold")


def matrix_of(batch, first=0):
    """The columns from ``first`` on as a matrix of doubles, missing cells as NaN."""
    columns = [c.to_numpy(zero_copy_only=False).astype(np.float64, copy=False) for c in batch.columns[first:]]
    return np.column_stack(columns) if columns else np.empty((batch.num_rows, 0))


def _rows(sums, group_type):
    """The rows of all matrices, as many at a time as make a batch."""
    names = ["group", "kind", "row", "sums"]
    for (group, kind), matrix in sums.items():
        for a in range(0, len(matrix), 256):
            part = matrix[a : a + 256]
            n = len(part)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * matrix.shape[1], pa.int32()), pa.array(part.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array([group] * n, group_type), pa.array([kind] * n, pa.int32()), pa.array(np.arange(a, a + n), pa.int32()), lists], names=names)


def _added(df, partial, group_field):
    """{(group, kind): matrix}: the matrices that ``partial`` leaves in each task, added up."""
    share_package(df.sparkSession)
    kind = T.StructType([T.StructField("group", group_field), T.StructField("kind", T.IntegerType()), T.StructField("row", T.IntegerType()), T.StructField("sums", T.ArrayType(T.DoubleType()))])

    def add(batches):
        held = {}
        for batch in batches:
            values = batch.column(3)
            flat, edges = values.values.to_numpy(zero_copy_only=False), values.offsets.to_numpy()
            for k, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                part = flat[edges[k] : edges[k + 1]]
                held[key] = held[key] + part if key in held else part.copy()
        if held:
            width = len(next(iter(held.values())))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1) * width, pa.int32()), pa.array(np.concatenate(list(held.values()))))
            columns = list(zip(*held))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.column(0).type), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), lists], names=batch.schema.names)

    found = {}
    for row in df.mapInArrow(partial, kind).repartition("group", "kind", "row").mapInArrow(add, kind).toLocalIterator():
        found.setdefault((row["group"], row["kind"]), {})[row["row"]] = row["sums"]
    return {key: np.array([rows[i] for i in range(len(rows))]) for key, rows in found.items()}


def product_matrices(df, columns, by=None, weight=None, groups=1):
    """{group: matrix of sums of products of (1, columns)} over the rows without a missing cell, weighted if wanted.

    ``by`` holds folds or replicates, a parameter of the caller: ``groups`` of them at most. Without ``by`` the only
    group is None. An empty table has no groups.
    """
    size = len(columns) + 1
    _check(size, groups)
    field = df.schema[by].dataType if by else T.IntegerType()
    rows = df.select(
        (F.col(by) if by else F.lit(0)).alias("group"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
        *[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(columns)],
    )

    def partial(batches):
        sums, kind = {}, pa.int32()
        for batch in batches:
            kind = batch.column(0).type
            x = np.column_stack([np.ones(batch.num_rows), matrix_of(batch, 2)])
            w, group = batch.column(1).to_numpy(zero_copy_only=False), np.array(batch.column(0).to_pylist(), object)
            whole = ~np.isnan(x).any(axis=1) & ~np.isnan(w)
            for g in dict.fromkeys(group.tolist()):
                own = whole & (group == g)
                part = (x[own] * w[own, None]).T @ x[own]
                sums[g, 0] = sums[g, 0] + part if (g, 0) in sums else part
                if len(sums) > groups:
                    raise ValueError(f"more than {groups} groups")
        yield from _rows(sums, kind)

    return {(group if by else None): matrix for (group, _), matrix in _added(rows, partial, field).items()}


def pairwise_sums(df, columns):
    """Six matrices over the rows where both columns of a pair are present: n, sums of a and b, of a², b² and ab.

    The values are taken from the column's mean, which changes no correlation and keeps the digits.
    """
    _check(len(columns), 1, 4)
    values = [F.col(f"`{c}`").cast("double") for c in columns]
    values = [F.when(~F.isnan(v), v) for v in values]
    centre = df.agg(*[F.avg(v).alias(f"m{k}") for k, v in enumerate(values)]).first()
    rows = df.select(*[(v - F.lit(centre[k] if centre[k] is not None else 0.0)).alias(f"x{k}") for k, v in enumerate(values)])
    size = len(columns)

    def partial(batches):
        sums = [np.zeros((size, size)) for _ in range(4)]
        for batch in batches:
            x = matrix_of(batch)
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            there = there.astype(np.float64)
            for total, (a, b) in zip(sums, ((there, there), (x, there), (x * x, there), (x, x))):
                total += a.T @ b
        yield from _rows({(0, k): m for k, m in enumerate(sums)}, pa.int32())

    found = _added(rows, partial, T.IntegerType())
    n, one, square, both = (found.get((0, k), np.zeros((size, size))) for k in range(4))
    return n, one, one.T, square, square.T, both


def correlation_matrix(df, columns):
    """Pearson's r of every pair of columns over the rows where both are present; NaN where either does not vary or n < 1."""
    n, sa, sb, saa, sbb, sab = pairwise_sums(df, columns)
    with np.errstate(invalid="ignore", divide="ignore"):
        cov, va, vb = sab - sa * sb / n, saa - sa * sa / n, sbb - sb * sb / n
        flat = (va <= 1e-12 * saa) | (vb <= 1e-12 * sbb)
        return np.where(flat, np.nan, np.clip(cov / np.sqrt(va * vb), -1.0, 1.0))
