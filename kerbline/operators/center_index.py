"""Exact nearest centre among thousands: an index of plane cells that each list the centres nearest to some point in them.

The centres' box is quartered again and again. A centre stays a candidate of a cell unless another one is closer at all four
corners, and so, since the difference of two squared distances is linear, everywhere in the cell. A cell with few candidates
is a leaf. Cells are tested a little larger and centres dropped only by a margin, so that rounding never loses a nearest
centre or a tie.

A row looks its cell up at every level that has leaves, which are few; exactly one of them is one. The index is a table of about as many
rows as there are centres, whatever the plan, and the join with it is a broadcast up to ``BROADCAST_CANDIDATES`` centres,
beyond that a shuffle join. A leaf's candidates are columns, so that their distances are a few generated instructions. Small cells that still have more, as in the middle of a circle of centres, hold theirs as a list, and so does the cell
of all that lies far outside the box: there a row is measured against all centres. Rows without coordinates match an empty
cell.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: A cell with at most so many candidates is not quartered further.
LEAF = 8
MAX_LEVEL = 24
#: From so many levels below the one with about as many cells as there are centres, cells with up to ``LISTED`` candidates
#: are leaves too.
DEEPER, LISTED = 5, 64
#: Share of the box by which it is extended on each side.
BORDER = 1.0
#: Largest index that is broadcast: 2 million places of 20 bytes.
BROADCAST_CANDIDATES = 2_000_000
OUTSIDE, NOWHERE = -1, -2


class Cells:
    """Leaf cells with their candidates, made level by level for all cells at once."""

    def __init__(self, centers, border=BORDER):
        points = np.array(centers, float).reshape(-1, 2)
        _, first = np.unique(points, axis=0, return_index=True)
        self.ids = np.sort(first)  # of equal centres the lowest id is the nearest
        self.points = points[self.ids]
        low, high = self.points.min(0), self.points.max(0)
        side = max(float((high - low).max()), 1e-6 * max(1.0, float(np.abs(self.points).max()))) * (1 + 2 * border)
        self.low = (low + high) / 2 - side / 2
        self.side = side
        self.slack = 1e-12 * max(1.0, float(np.abs(self.points).max()), side)
        self.keys, self.lists, self.levels = [], [], []
        rounds = (len(self.points) - 1).bit_length() // 2  # so many times four cells for each centre
        self.first, self.last = rounds, rounds + DEEPER
        self._divide()

    def _divide(self):
        x = y = np.zeros(1, np.int64)
        cell, candidate = np.zeros(len(self.points), np.int64), np.arange(len(self.points))
        for level in range(MAX_LEVEL + 1):
            cell, candidate = self._prune(x, y, level, cell, candidate)
            sizes = np.bincount(cell, minlength=len(x))
            done = (sizes <= (LEAF if level < self.last else LISTED)) & (level >= self.first) | (level == MAX_LEVEL)
            if done.any():
                self.levels.append(level)
                own = done[cell]
                borders = np.cumsum(sizes[done])[:-1]
                self.keys += ((level << 48) + (x[done] << 24) + y[done]).tolist()
                self.lists += np.split(candidate[own], borders)
            if done.all():
                return
            number = np.cumsum(~done) - 1
            open_ = ~done[cell]
            parent, candidate = number[cell[open_]], candidate[open_]
            x, y = x[~done], y[~done]
            x, y = (2 * x[:, None] + [0, 0, 1, 1]).ravel(), (2 * y[:, None] + [0, 1, 0, 1]).ravel()
            cell = (4 * parent[:, None] + np.arange(4)).ravel()
            order = np.argsort(cell, kind="stable")
            cell, candidate = cell[order], np.repeat(candidate, 4)[order]

    def _prune(self, x, y, level, cell, candidate):
        """(cell, candidate) without those that the nearest centre of a corner beats at all corners."""
        width = self.side / 2**level
        near = np.stack([self.low[0] + x * width, self.low[1] + y * width], 1) - self.slack
        far = near + width + 2 * self.slack
        at = self.points[candidate]
        corners = [np.stack([a[:, 0], b[:, 1]], 1) for a in (near, far) for b in (near, far)]
        distance = np.stack([((at - c[cell]) ** 2).sum(1) for c in corners])
        starts = np.flatnonzero(np.diff(cell, prepend=-1))
        margin = 1e-9 * distance.max(0)
        beaten = np.zeros(len(cell), bool)
        for own in distance:
            best = np.flatnonzero(own == np.minimum.reduceat(own, starts)[cell])
            champion = best[np.searchsorted(cell[best], np.arange(len(x)))][cell]
            beaten |= (distance[:, champion] + margin < distance).all(0)
        return cell[~beaten], candidate[~beaten]

    def size(self):
        """Number of places for centres in the table."""
        return LEAF * len(self.keys) + len(self.points) + sum(len(x) for x in self.lists if len(x) > LEAF)

    def table(self, spark):
        """_key and the candidates, by id, of every leaf, of what lies outside, and of nowhere: as _lat0, _lon0, _cid0 and so
        on, or as a list _more (clat, clon, cid)."""
        lists = [*self.lists, np.arange(len(self.points)), np.zeros(0, np.int64)]
        sizes = np.array([len(x) for x in lists])
        few = np.where(sizes <= LEAF, sizes, 0)
        spots = np.full((len(lists), LEAF), -1)
        spots[np.arange(LEAF) < few[:, None]] = np.concatenate([x for x in lists if len(x) <= LEAF])
        held = spots >= 0
        columns = {"_key": pa.array([*self.keys, OUTSIDE, NOWHERE], pa.int64())}
        for i in range(LEAF):
            for name, axis in (("_lat", 0), ("_lon", 1)):
                columns[f"{name}{i}"] = pa.array(np.where(held[:, i], self.points[spots[:, i], axis], np.nan))
            columns[f"_cid{i}"] = pa.array(self.ids[spots[:, i]].astype(np.int32))
        flat = np.concatenate([x for x in lists if len(x) > LEAF] or [np.zeros(0, np.int64)])
        lat, lon = self.points[flat].T
        entries = pa.StructArray.from_arrays(
            [pa.array(lat.copy()), pa.array(lon.copy()), pa.array(self.ids[flat].astype(np.int32))], ["clat", "clon", "cid"]
        )
        borders = np.concatenate([[0], np.cumsum(np.where(sizes > LEAF, sizes, 0))]).astype(np.int32)
        none = pa.array(np.append(sizes <= LEAF, False))
        offsets = pa.array(borders, mask=none.to_numpy(zero_copy_only=False))
        columns["_more"] = pa.ListArray.from_arrays(offsets, entries)
        return spark.createDataFrame(pa.table(columns))

    def key_of(self, lat, lon, known):
        """Array of the cells of a row, one for each level with leaves."""
        steps = [(F.col(c) - float(low)) * (2.0**MAX_LEVEL / self.side) for c, low in zip((lat, lon), self.low)]
        inside = F.lit(True)
        for step in steps:
            inside = inside & (step >= 0) & (step < 2.0**MAX_LEVEL)
        x, y = (F.floor(step) for step in steps)
        keys = [
            F.lit(level << 48)
            + F.shiftright(x, MAX_LEVEL - level) * F.lit(1 << 24)
            + F.shiftright(y, MAX_LEVEL - level)
            for level in self.levels
        ]
        return F.when(~known, F.array(F.lit(NOWHERE).cast("long"))).otherwise(
            F.when(inside, F.array(*keys)).otherwise(F.array(F.lit(OUTSIDE).cast("long")))
        )


def nearest(df, centers, known, lat="lat", lon="lon"):
    """``df`` with ``_best``: struct of the least squared distance and the lowest id that has it, null without coordinates or
    where no distance is finite."""
    cells = Cells(centers)
    table = cells.table(df.sparkSession)
    if cells.size() <= BROADCAST_CANDIDATES:
        table = F.broadcast(table)

    def squared(clat, clon):
        north, east = F.col(lat) - clat, F.col(lon) - clon
        return north * north + east * east

    places = range(LEAF)
    distances = F.array(*[squared(F.col(f"_lat{i}"), F.col(f"_lon{i}")) for i in places])  # NaN, where none, is the greatest
    least = F.array_min(distances)
    cid = F.element_at(F.array(*[F.col(f"_cid{i}") for i in places]), F.array_position(distances, least).cast("int"))
    few = F.struct(least.alias("d2"), cid.alias("cid"))
    listed = F.transform("_more", lambda c: F.struct(squared(c["clat"], c["clon"]).alias("d2"), c["cid"].alias("cid")))
    keyed = df.withColumn("_key", F.explode(cells.key_of(lat, lon, known)))
    best = F.when(F.col("_more").isNull(), few).otherwise(F.array_min(listed))
    own = [F.col(f"`{c}`") for c in df.columns]
    out = keyed.join(table, "_key").select(*own, best.alias("_best"))
    return out.withColumn("_best", F.when(F.col("_best.d2") < float("inf"), F.col("_best")))
