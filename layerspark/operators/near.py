"""Nearest place of each point, searched in blocks of the map."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerspark.functions import geo
from layerspark.session import BROADCAST_ROWS, broadcast_if_small, materialize

# Places of one block, unless it is a smallest cell, and points that meet them in one task.
BLOCK_PLACES = 1 << 16
BLOCK_POINTS = 1 << 17
# Rows that one task reads from a shuffle, about.
TASK_ROWS = 1 << 19
# Points searched at once, and pairs of point and place.
POINTS_AT_ONCE, PAIRS_AT_ONCE = 1 << 14, 1 << 20
# Bits of a place within its block, across and up.
BLOCK_BITS = 26
# Rounding of cell borders and of distances, in metres.
MARGIN_M, TIE_M = 1e-3, 1e-6

BLOCK = ["_t", "_bx", "_by"]
POINT = ["_p", "p_lon", "p_lat"]


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to tasks of about ``TASK_ROWS`` of ``rows`` rows.

    Without a number, tasks are as many as cores or bytes make, and compressed bytes say little of rows.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), *keys)


class Grid:
    """Lon/lat grid; a cell of level k is at least radius / 4**k wide and high at the points."""

    def __init__(self, points: DataFrame, radius_m: float, max_levels: int):
        top = points.agg(F.max(F.abs("p_lat"))).first()[0] or 0.0
        west, south, east, north = geo.radius_box(0.0, float(top), radius_m)
        # A little wider, so that rounding cannot hide a neighbour.
        self.columns = max(1, int(360.0 / ((east - west) / 2 * 1.0001)))
        self.rows = max(1, int(180.0 / ((north - south) / 2 * 1.0001)))
        self.max_levels = max_levels

    def cells(self, lon: Column, lat: Column, level: int) -> tuple[Column, Column]:
        across, up = self.columns << (2 * level), self.rows << (2 * level)
        x = F.floor((lon + F.lit(180.0)) / F.lit(360.0) * F.lit(float(across)))
        y = F.floor((lat + F.lit(90.0)) / F.lit(180.0) * F.lit(float(up)))
        top = F.lit(up - 1).cast("long")
        return F.pmod(x, F.lit(across).cast("long")), F.least(F.greatest(y, F.lit(0).cast("long")), top)

    def around(self, points: DataFrame) -> DataFrame:
        """Each point with the 3 x 3 widest cells around it; columns wrap at the antimeridian."""
        x, y = self.cells(F.col("p_lon"), F.col("p_lat"), 0)
        moves = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        near = points.withColumns({"_px": x, "_py": y, "_m": F.explode(F.array(*moves))})
        return near.withColumns(
            {
                "_cx": F.pmod(F.col("_px") + F.col("_m.i"), F.lit(self.columns).cast("long")),
                "_cy": F.col("_py") + F.col("_m.j"),
            }
        ).drop("_px", "_py", "_m")

    def apart(self, level: int) -> Column:
        """Lower bound of the distance from a point to a cell ``_cx, _cy`` of a level."""
        width, height = 360.0 / (self.columns << (2 * level)), 180.0 / (self.rows << (2 * level))
        middle = (F.col("_cx") + F.lit(0.5)) * F.lit(width) - F.lit(180.0)
        turn = F.pmod(F.col("p_lon") - middle + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
        aside = F.least(F.greatest(F.abs(turn) - F.lit(width / 2), F.lit(0.0)), F.lit(90.0))
        south = F.col("_cy") * F.lit(height) - F.lit(90.0)
        beyond = F.greatest(south - F.col("p_lat"), F.col("p_lat") - south - F.lit(height), F.lit(0.0))
        sine = F.sin(F.radians(aside)) * F.abs(F.cos(F.radians("p_lat")))
        return F.lit(geo.EARTH_RADIUS_M) * F.greatest(F.asin(sine), F.radians(beyond)) - F.lit(MARGIN_M)


class Blocks:
    """Cells split 4 x 4 from the whole map down until none but the smallest is crowded.

    Step ``top`` has the cells of level 0; those of earlier steps are wider, so that sparse
    places share a block. Splitting begins at step ``first``. ``counts`` holds, by step, the occupied cells of crowded ones, with one
    of their places.
    """

    def __init__(self, grid: Grid, places: DataFrame, block_places: int):
        self.grid, self.places = grid, places
        self.top = (max(grid.columns, grid.rows).bit_length() - 1) // 2
        self.last = self.top + grid.max_levels
        ends = places.agg(*[f(c) for c in ("_x", "_y") for f in (F.min, F.max)]).first()
        # Steps at which all places lie in a few cells next to each other need no counts.
        self.first = 0
        while self.first < self.top and ends[0] is not None and all(
            (ends[i + 1] >> self.bits(self.first + 1)) - (ends[i] >> self.bits(self.first + 1)) < 4 for i in (0, 2)
        ):
            self.first += 1
        self.crowded, self.counts = {}, {}
        rest = places
        for t in range(self.first, self.last + 1):
            counts = rest.groupBy(*self.cell(t, "_cx", "_cy")).agg(
                F.count(F.lit(1)).alias("n"), F.first("f_lon").alias("f_lon"), F.first("f_lat").alias("f_lat")
            )
            split = (F.col("n") > block_places) & F.lit(t < self.last)
            self.counts[t] = materialize(counts.withColumn("split", split), "blocks")
            crowded = self.counts[t].where("split").select("_cx", "_cy")
            many = crowded.count()
            if not many:
                break
            self.crowded[t] = F.broadcast(crowded) if many <= BROADCAST_ROWS else crowded
            rest = places.join(self._side(t), self._within(t), "left_semi")

    def bits(self, t: int) -> int:
        return 2 * (self.last - t)

    def cell(self, t: int, *names: str) -> list[Column]:
        return [F.shiftright(c, self.bits(t)).alias(n) for c, n in zip(("_x", "_y"), names, strict=True)]

    def _side(self, t: int) -> DataFrame:
        return self.crowded[t].select(F.col("_cx").alias(f"_cx{t}"), F.col("_cy").alias(f"_cy{t}"))

    def _within(self, t: int) -> Column:
        x, y = (F.shiftright(c, self.bits(t)) for c in ("_x", "_y"))
        return (x == F.col(f"_cx{t}")) & (y == F.col(f"_cy{t}"))

    def blocked(self, df: DataFrame, until: int | None = None) -> DataFrame:
        """Rows at ``_x, _y`` with the block they are in: its step ``_t`` and cell ``_bx, _by``."""
        columns, step = df.columns, F.lit(self.first)
        for t in self.crowded:
            if until is not None and t > until:
                break
            df = df.join(self._side(t), self._within(t), "left")
            step = step + F.col(f"_cx{t}").isNotNull().cast("int")
        down = F.lit(2 * self.last) - F.col("_t") * 2
        cell = [F.call_function("shiftright", c, down).alias(n) for c, n in (("_x", "_bx"), ("_y", "_by"))]
        return df.select(*columns, step.alias("_t")).select(*columns, "_t", *cell)

    def others(self, points: DataFrame) -> DataFrame:
        """Each point with the blocks, but its own, that may hold a place within its ``bound``.

        Below level 0 the bound falls to the nearest of one place per occupied cell."""
        own = points.withColumnsRenamed({c: f"own{c}" for c in BLOCK})
        near = self.grid.around(own).where(F.col("_cy").between(0, self.grid.rows - 1))
        near = near.where(self.grid.apart(0) <= F.col("bound"))
        wide = F.lit(1 << 2 * self.grid.max_levels).cast("long")
        near = near.withColumns({"_x": F.col("_cx") * wide, "_y": F.col("_cy") * wide}).drop("_cx", "_cy")
        near = self.blocked(near, self.top).drop("_x", "_y").distinct()
        if self.top not in self.crowded:
            return self._without_own(near)
        out = near.where(F.col("_t") <= self.top)
        down = near.where(F.col("_t") > self.top)
        # Crowded cells of level 0, to whose children they were counted: these follow.
        down = down.withColumns({"_kx": F.shiftright("_bx", 2), "_ky": F.shiftright("_by", 2)})
        for t in range(self.top + 1, max(self.counts) + 1):
            inner = self.counts[t].withColumns({"_kx": F.shiftright("_cx", 2), "_ky": F.shiftright("_cy", 2)})
            down = down.drop(*BLOCK).join(inner, ["_kx", "_ky"]).drop("_kx", "_ky")
            sample = geo.haversine_m(*map(F.col, ("p_lon", "p_lat", "f_lon", "f_lat")))
            nearest = F.min(sample).over(Window.partitionBy(*POINT))
            down = down.withColumn("bound", F.least("bound", nearest + F.lit(MARGIN_M)))
            down = down.where(self.grid.apart(t - self.top) <= F.col("bound")).withColumn("_t", F.lit(t))
            down = down.withColumnsRenamed({"_cx": "_bx", "_cy": "_by"})
            out = out.unionByName(down.where("NOT split").select(*out.columns))
            down = down.where("split").drop("split", "n", "f_lon", "f_lat")
            down = down.withColumns({"_kx": F.col("_bx"), "_ky": F.col("_by")})
        return self._without_own(out)

    @staticmethod
    def _without_own(near: DataFrame) -> DataFrame:
        own = F.lit(True)
        for c in BLOCK:
            own = own & (F.col(c) == F.col(f"own{c}"))
        return near.where(~own).drop(*[f"own{c}" for c in BLOCK])

    def nearest(self, points: DataFrame, places: DataFrame, cell_rows: int, block_points: int) -> DataFrame:
        """Each row of ``points`` with ``best``: distance and id of the block's nearest place within ``bound``.

        The points of a crowded block are dealt into pieces that each meet the block's places.
        """
        x, y = self.grid.cells(F.col("p_lon"), F.col("p_lat"), self.grid.max_levels)
        asked = points.select(*POINT, "bound", *BLOCK, x.alias("_x"), y.alias("_y"))
        pieces = asked.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("_rows"))
        pieces = materialize(pieces.withColumn("_n", F.ceil(F.col("_rows") / F.lit(block_points))), "pieces")
        rows = (pieces.agg(F.sum("_rows")).first()[0] or 0) + self.places.count()
        pieces = broadcast_if_small(pieces.where("_n > 1").drop("_rows"))
        asked = asked.join(pieces, BLOCK, "left")
        piece = F.coalesce(F.pmod(F.xxhash64(*POINT), F.col("_n")), F.lit(0).cast("long"))
        asked = asked.withColumn("_piece", piece).drop("_n")
        every = F.sequence(F.lit(0).cast("long"), F.coalesce("_n", F.lit(1).cast("long")) - 1)
        met = places.join(pieces, BLOCK, "left").withColumn("_piece", F.explode(every)).drop("_n")

        kinds = {f.name: f.dataType.simpleString() for f in asked.schema.fields + met.schema.fields}
        schema = ", ".join(f"`{c}` {kinds[c]}" for c in (*POINT, *BLOCK))
        schema += f", near array<struct<id:{kinds['_f']},lon:{kinds['f_lon']},lat:{kinds['f_lat']}>>"
        keys = [*BLOCK, "_piece"]
        search = searcher(self.grid.columns, self.grid.rows, self.grid.max_levels, self.last, cell_rows)
        asked, met = (spread(side, rows, *keys).groupBy(*keys) for side in (asked, met))
        found = asked.cogroup(met).applyInArrow(search, schema)

        def measured(place: Column) -> Column:
            distance = geo.haversine_m(F.col("p_lon"), F.col("p_lat"), place["lon"], place["lat"])
            return F.struct(distance.alias("distance_m"), place["id"].alias("id"))

        return found.withColumn("best", F.array_min(F.transform("near", measured))).drop("near")


def distance_m(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    half_lat, half_lon = np.sin(np.radians(lat2 - lat1) / 2), np.sin(np.radians(lon2 - lon1) / 2)
    a = half_lat**2 + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * half_lon**2
    return 2 * geo.EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(a, 1)))


def interleaved(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits of x and y in turn, so that a cell of any size is one range of codes."""
    code = np.zeros(len(x), dtype=np.int64)
    for bit in range(BLOCK_BITS):
        code |= ((x >> bit & 1) << (2 * bit + 1)) | ((y >> bit & 1) << (2 * bit))
    return code


def searcher(columns: int, rows: int, max_levels: int, last: int, cell_rows: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Search of one block: its points descend through its occupied cells.

    A point's bound starts at a place next to it in the order of the cells. At each split
    it falls to the nearest of one place per cell, and cells further off are left. Places of the cells
    that remain are measured. The nearest are returned with all as near by rounding.
    """
    across = columns << (2 * max_levels)
    width, height = 360.0 / across, 180.0 / (rows << (2 * max_levels))

    def search(points: pa.Table, places: pa.Table) -> pa.Table:
        kept = [points[c].combine_chunks() for c in (*POINT, *BLOCK)]
        count = points.num_rows
        none = np.zeros(0, dtype=np.int64)
        at, hits = descend(points, places) if count and places.num_rows else (none, none)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=count))]).astype(np.int32)
        found = [places[c].combine_chunks().take(pa.array(hits)) for c in ("_f", "f_lon", "f_lat")]
        near = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(found, ["id", "lon", "lat"]))
        return pa.Table.from_arrays([*kept, near], names=[*POINT, *BLOCK, "near"])

    def descend(points: pa.Table, places: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Row of the point and of the place of each pair found, by point."""
        down = 2 * (last - points["_t"][0].as_py())
        x0, y0 = points["_bx"][0].as_py() << down, points["_by"][0].as_py() << down
        bits = min(down, BLOCK_BITS)
        spare = down - bits
        fx, fy = ((places[c].to_numpy() - start) >> spare for c, start in (("_x", x0), ("_y", y0)))
        code = interleaved(fx, fy)
        order = np.argsort(code, kind="stable")
        code = code[order]
        f_lon, f_lat = (places[c].to_numpy().astype(float)[order] for c in ("f_lon", "f_lat"))
        # Occupied cells of each split and where their places begin, until no cell is crowded.
        splits = []
        for split in range(bits + 1):
            cells, starts = np.unique(code >> (2 * (bits - split)), return_index=True)
            splits.append((cells, np.append(starts, len(code))))
            if np.diff(splits[-1][1]).max() <= cell_rows:
                break

        p_lon, p_lat = (points[c].to_numpy().astype(float) for c in ("p_lon", "p_lat"))
        bound = points["bound"].to_numpy().astype(float).copy()
        px, py = points["_x"].to_numpy() - x0, points["_y"].to_numpy() - y0
        inside = np.clip(px, 0, (1 << down) - 1), np.clip(py, 0, (1 << down) - 1)
        place = np.searchsorted(code, interleaved(*(v >> spare for v in inside)))
        for step in (-1, 0):
            beside = np.clip(place + step, 0, len(code) - 1)
            bound = np.minimum(bound, distance_m(p_lon, p_lat, f_lon[beside], f_lat[beside]))
        cos_lat = np.abs(np.cos(np.radians(p_lat)))

        def apart(i: np.ndarray, cx: np.ndarray, cy: np.ndarray, split: int) -> np.ndarray:
            """Lower bound of the distance of points to cells."""
            size = 1 << (down - split)
            middle = (x0 + (cx + 0.5) * size) * width - 180.0
            turn = np.abs((p_lon[i] - middle + 180.0) % 360.0 - 180.0)
            aside = np.clip(turn - size * width / 2, 0, 90.0)
            south = (y0 + cy * float(size)) * height - 90.0
            beyond = np.maximum(np.maximum(south - p_lat[i], p_lat[i] - south - size * height), 0)
            sine = np.arcsin(np.sin(np.radians(aside)) * cos_lat[i])
            return geo.EARTH_RADIUS_M * np.maximum(sine, np.radians(beyond)) - MARGIN_M

        quarter = np.arange(4)
        at, hits = [], []
        for begin in range(0, len(p_lon), POINTS_AT_ONCE):
            i = np.arange(begin, min(begin + POINTS_AT_ONCE, len(p_lon)))
            cx = cy = cell = np.zeros(len(i), dtype=np.int64)
            index = cell
            for split, (cells, starts) in enumerate(splits[1:], 1):
                i = np.repeat(i, 4)
                cx, cy = (cx[:, None] * 2 + quarter // 2).ravel(), (cy[:, None] * 2 + quarter % 2).ravel()
                cell = (cell[:, None] * 4 + quarter).ravel()
                index = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
                keep = cells[index] == cell
                i, cx, cy, cell, index = (v[keep] for v in (i, cx, cy, cell, index))
                gap = apart(i, cx, cy, split)
                keep = gap <= bound[i]
                i, cx, cy, cell, index, gap = (v[keep] for v in (i, cx, cy, cell, index, gap))
                one = starts[index]
                np.minimum.at(bound, i, distance_m(p_lon[i], p_lat[i], f_lon[one], f_lat[one]))
                keep = gap <= bound[i]
                i, cx, cy, cell, index = (v[keep] for v in (i, cx, cy, cell, index))
            starts = splits[-1][1]
            first, many = starts[index], starts[index + 1] - starts[index]
            before = np.concatenate([[0], np.cumsum(many)])
            some_at, some_hits, some_d = [], [], []
            for low in range(0, int(before[-1]), PAIRS_AT_ONCE):
                # Pairs are numbered through; each finds its cell by the pairs before it.
                pair = np.arange(low, min(low + PAIRS_AT_ONCE, int(before[-1])))
                row = np.searchsorted(before, pair, side="right") - 1
                who, which = i[row], first[row] + pair - before[row]
                d = distance_m(p_lon[who], p_lat[who], f_lon[which], f_lat[which])
                np.minimum.at(bound, who, d)
                keep = d <= bound[who] + TIE_M + d * 1e-9
                some_at.append(who[keep]), some_hits.append(which[keep]), some_d.append(d[keep])
            if some_at:
                who, which, d = map(np.concatenate, (some_at, some_hits, some_d))
                keep = d <= bound[who] + TIE_M + d * 1e-9
                who, which = who[keep], which[keep]
                by_point = np.argsort(who, kind="stable")
                at.append(who[by_point])
                hits.append(order[which[by_point]])
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none, *at]), np.concatenate([none, *hits])

    return search
