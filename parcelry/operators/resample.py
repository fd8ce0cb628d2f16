"""Resampling with replacement: exactly n draws from n rows, alike under any partitioning.

Rows are dealt into cells by a hash of their content, equal rows folded to one
with a count. The n draws of every replicate are split down a binary tree over
the cells: at a node, a binomial number of them, with the rows on the left as
its share, goes left. Each node has a generator of its own, so any task finds
the draws of its cells by walking down from the root, which needs the counts of
the cells and nothing else; within a cell each draw picks a row.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from parcelry.operators import gram
from parcelry.session import share_package

#: Rows of a cell that are wanted, and the most cells, whose counts every task is told.
CELL_ROWS, MOST_CELLS = 4096, 1 << 16


class Draws:
    """How many draws of each replicate fall to a cell."""

    def __init__(self, counts, replicates, seed):
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.levels = max(len(counts) - 1, 0).bit_length()
        self.seed = seed
        # nodes from the root to the cell asked for last; cells are asked for in order, so most of it is kept
        self.path = [(0, np.full(replicates, self.before[-1], np.int64))]

    def of(self, cell):
        for level in range(1, self.levels + 1):
            index = cell >> (self.levels - level)
            if level < len(self.path) and self.path[level][0] == index:
                continue
            del self.path[level:]
            parent, width = index >> 1, 1 << (self.levels - level)
            low, middle, high = (self.before[min((2 * parent + k) * width, len(self.before) - 1)] for k in range(3))
            draws = self.path[level - 1][1]
            left = self.generator(level, parent).binomial(draws, (middle - low) / (high - low)) if high > low else np.zeros_like(draws)
            self.path.append((index, left if index % 2 == 0 else draws - left))
        return self.path[self.levels][1]

    def generator(self, *where):
        return np.random.default_rng([self.seed & 0xFFFFFFFF, *where])

    def weights(self, cell, copies):
        """For each replicate, how often each row of the cell is drawn; ``copies`` says how many rows each stands for."""
        ends, rng = np.cumsum(copies), self.generator(0, 1, cell)
        for n in self.of(cell):
            yield np.bincount(np.searchsorted(ends, rng.integers(0, ends[-1], n), side="right"), minlength=len(copies))


def _cells(df, columns, replicates, seed):
    """(rows sorted by cell, with cell and copies in front of the columns; the cells' counts)."""
    spark = share_package(df.sparkSession)
    whole = df.select(*[F.col(f"`{c}`") for c in columns])
    mark = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns])
    levels = max((min(whole.count() // CELL_ROWS, MOST_CELLS) - 1), 0).bit_length()
    levels = min(levels, MOST_CELLS.bit_length() - 1)
    cell = F.shiftrightunsigned(mark, 64 - levels).cast("long") if levels else F.lit(0).cast("long")
    counts = np.zeros(1 << levels, np.int64)
    for row in whole.select(cell.alias("cell")).groupBy("cell").count().collect():
        counts[row["cell"]] = row["count"]
    folded = whole.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias("__copies"))
    rows = folded.select(cell.alias("__cell"), "__copies", mark.alias("__mark"), *[F.col(f"`{c}`") for c in columns])
    dealt = rows.repartition("__cell").sortWithinPartitions("__cell", "__mark", *[F.col(f"`{c}`") for c in columns]).drop("__mark")
    return dealt, spark.sparkContext.broadcast(counts)


def _by_cell(batches):
    """(cell, table of its rows) for batches sorted by cell."""
    held = []
    for batch in batches:
        cells = batch.column(0).to_numpy(zero_copy_only=False)
        edges = np.concatenate([[0], np.flatnonzero(cells[1:] != cells[:-1]) + 1, [len(cells)]]) if len(cells) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            part = batch.slice(a, b - a)
            if held and held[0].column(0)[0] != part.column(0)[0]:
                yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)


def resample(df, replicates, seed=42, name="replicate", weight="weight"):
    """Every drawn row with the replicate and how often it was drawn; the weights of a replicate sum to the number of rows.

    Equal rows are returned as one with their draws together. Columns must be of types that can be compared.
    """
    columns = df.columns
    dealt, counts = _cells(df, columns, replicates, seed)

    def run(batches):
        draws = Draws(counts.value, replicates, seed)
        for cell, rows in _by_cell(batches):
            copies = rows.column(1).to_numpy()
            for r, times in enumerate(draws.weights(cell, copies)):
                at = np.flatnonzero(times)
                part = rows.take(pa.array(at)).select(range(2, rows.num_columns))
                part = part.append_column(name, pa.array(np.full(len(at), r), pa.int32())).append_column(weight, pa.array(times[at], pa.int64()))
                yield from part.to_batches()

    kind = T.StructType([*df.schema.fields, T.StructField(name, T.IntegerType()), T.StructField(weight, T.LongType())])
    return dealt.mapInArrow(run, kind)


def resampled_products(df, columns, replicates, seed=42):
    """{replicate: matrix of sums of products of (1, columns)} over n draws of the n rows without a missing cell.

    The draws stay within the task that holds their rows: what is dealt out are the replicates' matrices.
    """
    gram._check(len(columns) + 1, replicates)
    doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(columns)])
    whole = doubles.where(" AND ".join(f"x{k} IS NOT NULL AND NOT isnan(x{k})" for k in range(len(columns))))
    dealt, counts = _cells(whole, whole.columns, replicates, seed)

    def partial(batches):
        draws, size = Draws(counts.value, replicates, seed), len(columns) + 1
        sums = np.zeros((replicates, size, size))
        for cell, rows in _by_cell(batches):
            x = np.column_stack([np.ones(rows.num_rows), *[rows.column(k).to_numpy() for k in range(2, rows.num_columns)]])
            for r, times in enumerate(draws.weights(cell, rows.column(1).to_numpy())):
                sums[r] += (x * times[:, None]).T @ x
        yield from gram._rows({(r, 0): sums[r] for r in range(replicates)}, pa.int32())

    return {r: m for (r, _), m in gram._added(dealt, partial, T.IntegerType()).items()}
