"""Linear regrid of large native grids, tile by tile.

The native grid is cut into tiles of rows and columns of nodes. A tile also gets a halo: the first row and column of the
tiles behind it, so every target cell has all its nodes in one tile. Rows are dealt once, by day and tile, and each tile is
a dense array in one task; no group goes over tiles, and a node is never multiplied by the cells it serves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 256


class Axis:
    """For each target coordinate the lower node of its leg and the weight of the upper one. Coordinates of ``src`` ascend or
    descend; targets outside have no leg."""

    def __init__(self, src: np.ndarray, dst: np.ndarray):
        src, dst = np.asarray(src, float), np.asarray(dst, float)
        order = np.argsort(src)
        x = src[order]
        leg = np.minimum(np.searchsorted(x, dst, "right") - 1, len(x) - 1)
        inside = (dst >= x[0]) & (dst <= x[-1])
        upper = np.minimum(leg + 1, len(x) - 1)
        with np.errstate(invalid="ignore", divide="ignore"):
            part = np.where(upper > leg, (dst - x[leg]) / (x[upper] - x[leg]), 0.0)
        low, high = order[leg], order[upper]
        # The leg lies between two neighbouring indices, whichever way the axis runs.
        self.first = np.where(inside, np.minimum(low, high), -1)
        self.second = np.where(part > 0, np.where(low < high, part, 1 - part), (low > self.first).astype(float))
        self.n = len(src)

    def used(self) -> tuple[int, int]:
        """First and last index of a node that any target needs."""
        first = self.first[self.first >= 0]
        return (int(first.min()), int(min(first.max() + 1, self.n - 1))) if len(first) else (0, -1)


def dealt(native: DataFrame, lat: Axis, lon: Axis, tile: int) -> DataFrame:
    """``native`` with ``tile_lat, tile_lon``: a row for each tile that has the node, in its own part or in the halo. Nodes that no target needs
    are left out where the table is read."""
    (la, lb), (oa, ob) = lat.used(), lon.used()
    rows = native.where(F.col("src_lat_idx").between(la, lb) & F.col("src_lon_idx").between(oa, ob))

    def tiles(name: str):
        at = F.floor(F.col(name) / F.lit(tile)).cast("int")
        return F.when((F.col(name) % tile == 0) & (at > 0), F.array(at - 1, at)).otherwise(F.array(at))

    return rows.withColumn("tile_lat", F.explode(tiles("src_lat_idx"))).withColumn("tile_lon", F.explode(tiles("src_lon_idx")))


def regrid_tile(nodes: np.ndarray, row: np.ndarray, col: np.ndarray, w_row: np.ndarray, w_col: np.ndarray) -> np.ndarray:
    """``nodes`` (values, rows, columns) at the targets' legs; NaN where a node with a weight over zero is NaN."""
    out = np.zeros((len(nodes), len(row), len(col)))
    for dr in (0, 1):
        for dc in (0, 1):
            wr, wc = (w_row if dr else 1 - w_row), (w_col if dc else 1 - w_col)
            w = wr[:, None] * wc[None, :]
            corner = nodes[:, np.minimum(row + dr, nodes.shape[1] - 1)][:, :, np.minimum(col + dc, nodes.shape[2] - 1)]
            out += np.where(w > 0, w * corner, 0.0)
    return out


def regrid_tiled(native: DataFrame, values: list[str], src_lat: np.ndarray, src_lon: np.ndarray, dst_lat: np.ndarray, dst_lon: np.ndarray, keys: list[str] | None = None, tile: int = TILE) -> DataFrame:
    """(keys, lat_idx, lon_idx, values): the contract of ``regrid.regrid`` for ``native(keys, src_lat_idx, src_lon_idx, values)``, with the cells that
    can't be made as missing values where a day has any node in their tile.

    The four axes are plain coordinates (thousands of numbers). Of two rows of one node and key the mean is taken, as for
    any missing value: null and NaN are missing. An empty table gives no rows.
    """
    keys = keys or ["date"]
    lat, lon = Axis(src_lat, dst_lat), Axis(src_lon, dst_lon)
    kinds = dict(native.dtypes)
    rows = dealt(native.select(*keys, "src_lat_idx", "src_lon_idx", *(F.col(v).cast("double").alias(v) for v in values)), lat, lon, tile)
    schema = pa.schema([("lat_idx", pa.int32()), ("lon_idx", pa.int32()), *((v, pa.float64()) for v in values)])
    n_keys = len(keys)

    def one(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        at, to = key[n_keys].as_py(), key[n_keys + 1].as_py()
        i = t.column("src_lat_idx").to_numpy() - at * tile
        j = t.column("src_lon_idx").to_numpy() - to * tile
        size = tile + 1
        nodes = np.full((len(values), size, size), np.nan)
        for k, v in enumerate(values):
            x = t.column(v).to_numpy(zero_copy_only=False).astype(float)
            there = ~np.isnan(x)
            place = i[there] * size + j[there]
            count = np.bincount(place, minlength=size * size)
            with np.errstate(invalid="ignore"):
                nodes[k] = np.where(count > 0, np.bincount(place, x[there], size * size) / count, np.nan).reshape(size, size)
        r, c = np.flatnonzero((lat.first >= 0) & (lat.first // tile == at)), np.flatnonzero((lon.first >= 0) & (lon.first // tile == to))
        out = regrid_tile(nodes, lat.first[r] - at * tile, lon.first[c] - to * tile, lat.second[r], lon.second[c])
        cells = len(r) * len(c)
        columns = [pa.array(np.repeat(r, len(c)), pa.int32()), pa.array(np.tile(c, len(r)), pa.int32()), *(pa.array(x.ravel(), mask=np.isnan(x.ravel())) for x in out)]
        made = pa.Table.from_arrays(columns, schema=schema)
        for n, k in enumerate(keys):
            made = made.add_column(n, pa.field(k, key[n].type), pa.array([key[n].as_py()] * cells, key[n].type))
        return made

    kind = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "lat_idx int, lon_idx int", *(f"{v} double" for v in values)])
    return rows.groupBy(*keys, "tile_lat", "tile_lon").applyInArrow(one, kind)
