"""Similarity work between blocks of bounded size.

Points are placed in cells around a bounded number of pivots, and a cell is split into as many parts as its row
count asks for, so that no task ever holds more than a block of rows whatever the skew. Pairs of cells that the
triangle inequality rules out are never built. Within a pair of blocks one matrix product does the work, and a
kernel returns a small summary instead of the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from topicloom.functions.vectors import to_matrix, unit
from topicloom.session import materialize

BLOCK_ROWS = 4096
MAX_PIVOTS = 256
ANGLE_SLACK = 1e-6
# Packs of blocks that take in partners, per group, and the size at which a pack is full.
PACKS = 24
PACK_BYTES = 64 * 1024 * 1024
# Similarities that are laid out at once.
STEP_CELLS = 1 << 22

Kernel = Callable[[pa.Table, pa.Table, bool], pa.Table]


def spread_parts(points: DataFrame, rows: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``part`` (block of the row) and ``parts`` (blocks in the table). A table whose size is not known is written first."""
    if rows is None:
        points = materialize(points, "points")
        rows = points.count()
    parts = max(1, -(-rows // block_rows))
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    return points.withColumn("part", part).withColumn("parts", F.lit(parts))


def _meet(left: DataFrame, right: DataFrame, keys: list[str], kernel: Kernel, schema: T.StructType) -> DataFrame:
    names = [f.name for f in schema.fields]
    arrow_types = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(key, a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, arrow_types)})
        by_key = dict(zip(keys, (k.as_py() for k in key)))
        same = by_key.get("cell_a") == by_key.get("cell_b") and by_key["part_a"] == by_key["part_b"] and "cell_a" in by_key
        out = kernel(a.sort_by("id"), b.sort_by("id"), same)
        return pa.table({n: out.column(n).cast(t) for n, t in zip(names, arrow_types)})

    left = left.select(*[F.col(c).alias(c) for c in left.columns])
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def pair_up(left: DataFrame, right: DataFrame, kernel: Kernel, schema: T.StructType) -> DataFrame:
    """Run ``kernel`` on every block of ``left`` against every block of ``right`` (both from ``spread_parts``)."""
    parts_l, parts_r = left.select("parts").first(), right.select("parts").first()
    n_left = parts_l["parts"] if parts_l else 0
    n_right = parts_r["parts"] if parts_r else 0
    if not n_left or not n_right:
        return left.sparkSession.createDataFrame([], schema)
    a = left.withColumnRenamed("part", "part_a").withColumn("part_b", F.explode(F.sequence(F.lit(0), F.lit(n_right - 1))))
    b = right.withColumnRenamed("part", "part_b").withColumn("part_a", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1))))
    return _meet(a.drop("parts"), b.drop("parts"), ["part_a", "part_b"], kernel, schema)


class Cells:
    """Unit vectors laid out in cells and parts, ready for block-by-block self joins within each group."""

    def __init__(self, points: DataFrame, block_rows: int = BLOCK_ROWS):
        """``points``: ``grp``, ``id``, ``embedding`` and any further columns a kernel needs."""
        extra = [c for c in points.columns if c not in ("grp", "id", "embedding")]
        units = materialize(points.select("grp", "id", *extra, unit(F.col("embedding")).alias("vec")), "units")
        self.rows, self.block_rows = units.count(), block_rows
        self.extra = extra
        self.spark = points.sparkSession
        self.pivots = np.zeros((1, 1))
        if self.rows <= block_rows:
            # Everything fits one block, so each group is one cell with one part.
            self.points = units.withColumns({"cell": F.lit(0), "part": F.lit(0)})
            self.sizes = units.select("grp").distinct().withColumns(
                {"cell": F.lit(0), "parts": F.lit(1), "radius": F.lit(float(np.pi))}
            )
            return
        wanted = min(MAX_PIVOTS, -(-self.rows // block_rows))
        picked = units.select("vec", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(wanted).collect()
        self.pivots = np.array([r["vec"] for r in picked])
        placed = self._place(units)
        sizes = placed.groupBy("grp", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"))
        # One row per (group, cell): at most MAX_PIVOTS rows per group. Its size decides the join.
        self.sizes = materialize(sizes.withColumn("parts", F.ceil(F.col("n") / block_rows).cast("int")), "cells")
        self.points = materialize(
            placed.join(self.sizes.select("grp", "cell", "parts"), ["grp", "cell"])
            .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
            .drop("angle", "parts"),
            "placed",
        )

    def _place(self, units: DataFrame) -> DataFrame:
        pivots = self.pivots

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sims = np.clip(to_matrix(batch.column("vec")) @ pivots.T, -1.0, 1.0)
                cell = np.argmax(sims, axis=1)
                angle = np.arccos(sims[np.arange(len(cell)), cell])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell, pa.int32()), pa.array(angle)], names=[*batch.schema.names, "cell", "angle"]
                )

        schema = T.StructType(units.schema.fields + [T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())])
        return units.mapInArrow(place, schema)

    def cell_pairs(self, bounds: DataFrame | None = None, min_sim: float | None = None, own_only: bool = False) -> DataFrame:
        """Pairs of cells of one group that can hold a pair of points as similar as asked for.

        ``bounds`` gives per cell the similarity any useful partner must reach; ``min_sim`` one value for all.
        """
        cells = self.sizes
        if bounds is not None:
            cells = cells.join(bounds, ["grp", "cell"], "left").fillna(-1.0, ["bound"])
        else:
            cells = cells.withColumn("bound", F.lit(-1.0 if min_sim is None else float(min_sim)))
        a = cells.select("grp", *[F.col(c).alias(f"{c}_a") for c in ("cell", "parts", "radius", "bound")])
        b = cells.select("grp", *[F.col(c).alias(f"{c}_b") for c in ("cell", "parts", "radius", "bound")])
        order = F.col("cell_a") == F.col("cell_b") if own_only else F.col("cell_a") <= F.col("cell_b")
        pairs = a.join(b, "grp").where(order).withColumn("reach", F.lit(0.0))
        if len(self.pivots) > 1 and not own_only:
            between = np.arccos(np.clip(self.pivots @ self.pivots.T, -1.0, 1.0))

            @F.arrow_udf(T.DoubleType())
            def pivot_angle(x: pa.Array, y: pa.Array) -> pa.Array:
                return pa.array(between[x.to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False)], pa.float64())

            pairs = pairs.withColumn("reach", -pivot_angle(F.col("cell_a"), F.col("cell_b")))
            gap = -F.col("reach") - F.col("radius_a") - F.col("radius_b")
            best_sim = F.cos(F.greatest(gap - ANGLE_SLACK, F.lit(0.0)))
            own = F.col("cell_a") == F.col("cell_b")
            pairs = pairs.where(own | (best_sim >= F.least("bound_a", "bound_b")))
        pairs = pairs.select("grp", "cell_a", "parts_a", "cell_b", "parts_b", "reach")
        return pairs if len(self.pivots) == 1 else materialize(pairs, "cell-pairs")

    def self_join(self, kernel: Kernel, schema: T.StructType, pairs: DataFrame) -> DataFrame:
        """Run ``kernel`` once per unordered pair of blocks in ``pairs``; ``same`` tells a block meeting itself."""
        types = {f.name: to_arrow_type(f.dataType) for f in schema.fields}
        fields = {f.name: to_arrow_type(f.dataType) for f in self.points.schema.fields}
        return self.streamed(lambda: _Pairwise(kernel, types, fields), schema, pairs, once=True)

    def _packs(self) -> DataFrame:
        """``grp, cell, part, place, pack``: blocks in line, near cells next to each other, and the pack each one is in.

        A group has ``PACKS`` packs at most while these stay below ``PACK_BYTES``.
        """
        blocks = self.sizes.select("grp", "cell", "parts", F.lit(0).cast("long").alias("first"), F.col("parts").cast("long").alias("all"))
        most = 1
        if len(self.pivots) > 1:
            line = F.element_at(F.array(*[F.lit(x) for x in _line(self.pivots)]), F.col("cell") + 1)
            before = Window.partitionBy("grp").orderBy(line).rowsBetween(Window.unboundedPreceding, -1)
            whole = Window.partitionBy("grp")
            blocks = self.sizes.select("grp", "cell", "parts", F.coalesce(F.sum("parts").over(before), F.lit(0)).alias("first"), F.sum("parts").over(whole).alias("all"))
            most = max(1, PACK_BYTES // (8 * self.pivots.shape[1] * self.block_rows))
        place = blocks.select("grp", "cell", F.posexplode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part", "__same"), "first", "all")
        per_pack = F.least(F.ceil(F.col("all") / PACKS), F.lit(most))
        return place.select("grp", "cell", "part", (F.col("first") + F.col("part")).alias("place"), F.floor((F.col("first") + F.col("part")) / per_pack).alias("pack"))

    def streamed(
        self,
        reducer: Callable[[], Reducer],
        schema: T.StructType,
        pairs: DataFrame,
        diagonal: bool = False,
        probes: int | None = None,
        once: bool = False,
        points: DataFrame | None = None,
    ) -> DataFrame:
        """One reducer per pack of blocks: it takes in the partner blocks one after the other and gives its rows at the end.

        A block is sent once to every pack with a block to meet, so copies grow with the number of packs, which stays
        the same until packs are full, and not with the number of blocks. A task holds one pack and one partner at a
        time. ``diagonal`` keeps each block to itself. ``probes`` keeps the partner cells of a cell to that many, those
        with the nearest pivots first (its own among them); without it none is left out. ``once`` gives every unordered
        pair of blocks to one of its packs only. ``points`` stands in for the points of the cells, with further columns.
        """
        rows = self.points if points is None else points
        fields = [c for c in rows.columns if c not in ("grp", "cell", "part", "id", "vec")]
        listed = F.sort_array(F.collect_list(F.struct("id", "vec", *fields))).alias("rows")
        blocks = rows.groupBy("grp", "cell", "part").agg(listed)
        packs = self._packs()
        blocks = materialize(blocks.join(packs, ["grp", "cell", "part"]), "blocks")
        packs = blocks.drop("rows")
        first = blocks.select("grp", "pack", F.lit(0).alias("turn"), "place", "cell", "rows", F.array().cast("array<int>").alias("cells"))
        keys = ["grp", "pack"]
        lined = first
        if not diagonal:
            turned = pairs.where("cell_a <> cell_b").select("grp", F.col("cell_b").alias("cell_a"), F.col("cell_a").alias("cell_b"), "reach")
            both = pairs.select("grp", "cell_a", "cell_b", "reach").unionByName(turned)
            if probes is not None:
                nearest = Window.partitionBy("grp", "cell_a").orderBy((F.col("cell_a") != F.col("cell_b")).cast("int"), F.desc("reach"), "cell_b")
                both = both.withColumn("__rank", F.row_number().over(nearest)).where(F.col("__rank") <= probes)
            owners = packs.select("grp", F.col("cell").alias("cell_a"), F.col("pack").alias("to")).distinct()
            met = both.join(owners, ["grp", "cell_a"]).groupBy("grp", "to", F.col("cell_b").alias("cell")).agg(F.collect_list("cell_a").alias("cells"))
            met = met.join(packs, ["grp", "cell"])
            if once:
                # Of two packs the first or the second has the work, by turns, so that all have about as much.
                met = met.where((F.col("to") == F.col("pack")) | ((F.col("to") < F.col("pack")) == ((F.col("to") + F.col("pack")) % 2 == 0)))
            turn = F.when(F.col("to") == F.col("pack"), 1).otherwise(2)
            partners = met.select("grp", "to", turn.alias("turn"), "place", "cells").join(blocks.select("grp", "place", "cell", "rows"), ["grp", "place"])
            lined = first.unionByName(partners.select("grp", F.col("to").alias("pack"), "turn", "place", "cell", "rows", "cells"))
        lined = lined.repartition(*keys).sortWithinPartitions(*keys, "turn", "place")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pack, now = None, None
            for batch in batches:
                marks = zip(*(batch.column(c).to_pylist() for c in ("grp", "pack", "turn", "place", "cell", "cells")))
                for i, (grp, number, turn, place, cell, cells) in enumerate(marks):
                    rows = batch.column("rows").slice(i, 1).flatten()
                    if turn == 0:
                        if pack is None or pack.key != (grp, number):
                            if pack is not None:
                                now = now or pack.begin(reducer())
                                yield from pack.closed(now, diagonal)
                            pack, now = _Pack((grp, number)), None
                        pack.add(place, cell, rows)
                    else:
                        now = now or pack.begin(reducer())
                        spans, own = pack.facing(turn == 1, place, set(cells), once)
                        if spans:
                            yield from now.meet(rows, to_matrix(rows.field("vec")), spans, own) or ()
            if pack is not None:
                now = now or pack.begin(reducer())
                yield from pack.closed(now, diagonal)

        return lined.mapInArrow(run, schema)


class _Pack:
    """The blocks that a task holds while their partners pass."""

    def __init__(self, key: tuple):
        self.key, self.blocks = key, []

    def add(self, place: int, cell: int, rows: pa.StructArray) -> None:
        start = self.blocks[-1][3] if self.blocks else 0
        self.blocks.append((place, cell, start, start + len(rows), rows))

    def begin(self, reducer: Reducer) -> Reducer:
        rows = pa.concat_arrays([b[4] for b in self.blocks])
        self.blocks = [b[:4] for b in self.blocks]
        self.matrix = to_matrix(rows.field("vec"))
        self.rows = rows
        reducer.begin(self.key[0], rows, self.matrix)
        return reducer

    def facing(self, inside: bool, place: int, cells: set, once: bool) -> tuple[list[tuple[int, int]], int | None]:
        """The stretches of rows that meet the block at ``place``, and where this block is itself, if it is of the pack."""
        spans, own = [], None
        for at, cell, start, stop in self.blocks:
            if inside and at == place:
                own = start
            if cell in cells and not (once and inside and at < place):
                if spans and spans[-1][1] == start:
                    spans[-1] = (spans[-1][0], stop)
                else:
                    spans.append((start, stop))
        return spans, own

    def closed(self, reducer: Reducer, diagonal: bool) -> Iterator[pa.RecordBatch]:
        if diagonal:
            for _, _, start, stop in self.blocks:
                yield from reducer.meet(self.rows.slice(start, stop - start), self.matrix[start:stop], [(start, stop)], start) or ()
        yield from reducer.finish()


class Reducer(Protocol):
    """What a pack does with its partners: ``begin`` with its own group, rows and vectors, ``meet`` each, ``finish``.

    ``meet`` is told which stretches of the pack's rows face the partner, and at which row the partner's rows begin if
    they are rows of the pack. It may give rows already.
    """

    def begin(self, grp: object, rows: pa.StructArray, matrix: np.ndarray) -> None: ...

    def meet(self, rows: pa.StructArray, matrix: np.ndarray, spans: list[tuple[int, int]], own: int | None) -> Iterator[pa.RecordBatch] | None: ...

    def finish(self) -> Iterator[pa.RecordBatch]: ...


def steps(spans: list[tuple[int, int]], width: int, cells: int = STEP_CELLS) -> Iterator[tuple[int, int]]:
    """The stretches cut so that a stretch by ``width`` columns is of bounded size."""
    step = max(1, cells // max(1, width))
    for start, stop in spans:
        for at in range(start, stop, step):
            yield at, min(stop, at + step)


class _Pairwise:
    """A kernel on the rows of two sides; a block that meets itself is one side."""

    def __init__(self, kernel: Kernel, types: dict, fields: dict):
        self.kernel, self.types, self.fields = kernel, types, fields

    def begin(self, grp: object, rows: pa.StructArray, matrix: np.ndarray) -> None:
        self.grp, self.rows = grp, rows

    def _side(self, rows: pa.StructArray) -> pa.Table:
        names = [f.name for f in rows.type]
        return pa.table({"grp": pa.array([self.grp] * len(rows), self.fields["grp"]), **{n: rows.field(i) for i, n in enumerate(names)}})

    def meet(self, rows: pa.StructArray, matrix: np.ndarray, spans: list[tuple[int, int]], own: int | None) -> Iterator[pa.RecordBatch]:
        other = self._side(rows)
        if own is not None:
            # The block itself first, then what stands after or before it.
            end = own + len(rows)
            spans = [s for a, b in spans for s in ((a, min(b, own)), (max(a, end), b)) if s[0] < s[1]]
            yield from self._made(other, other, True)
        for start, stop in steps(spans, len(rows)):
            yield from self._made(self._side(self.rows.slice(start, stop - start)), other, False)

    def _made(self, a: pa.Table, b: pa.Table, same: bool) -> list[pa.RecordBatch]:
        out = self.kernel(a, b, same)
        return pa.table({n: out.column(n).cast(t) for n, t in self.types.items()}).to_batches()

    def finish(self):
        return iter(())


def _line(pivots: np.ndarray) -> list[int]:
    """The place of each pivot in a line that goes on to the most similar one left."""
    sims = pivots @ pivots.T
    places, at = [0] * len(pivots), 0
    left = np.ones(len(pivots), bool)
    for place in range(len(pivots)):
        places[at], left[at] = place, False
        at = int(np.argmax(np.where(left, sims[at], -np.inf)))
    return places


def column_of(table: pa.Table, name: str) -> pa.Array:
    """A column as one Arrow array."""
    column = table.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def pick(values: pa.Array, where: np.ndarray) -> pa.Array:
    """Values at the given positions."""
    return pc.take(values, pa.array(np.asarray(where, dtype=np.int64)))
