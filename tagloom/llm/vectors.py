"""Embedding near-duplicates by an inverted multi-index.

Two codebooks, one for each half of the vectors, span a grid of cells. A vector is
stored in its own cell and visits the nearest others, in order of how far it would
have to move to enter them, until the share of neighbours that lies farther is below
``1 - recall``. Vectors meet in cells and every pair is verified there, in double
precision. Whether a pair met from one side or both is known from the stored visits,
so links are counted once, in place, and never written out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import slices
from tagloom.llm.graph import components
from tagloom.sources.storage import materialise

#: Vectors that codebooks are fitted on, at most; centroids of a codebook, at most.
FIT_ROWS, MAX_CENTROIDS = 20_000, 1024
#: Vectors aimed at per cell, and members of a cell on either side that one group holds.
PER_CELL, PART = 32, 2048


@dataclass
class Grid:
    """Codebooks of the two halves and the square of the distance up to which cells are visited."""

    books: tuple[np.ndarray, np.ndarray]
    reach: float

    @cached_property
    def apart(self) -> tuple[np.ndarray, ...]:
        """Distances between the centroids of each book, from their products, once in a task."""
        made = []
        for book in self.books:
            squares = (book**2).sum(1)
            made.append(np.sqrt(np.maximum(squares[:, None] + squares - 2 * book @ book.T, 1e-18)))
        return tuple(made)

    def margins(self, unit: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: nearest centroid, and squared distance to the border of each other one."""
        made, cut = [], unit.shape[1] // 2
        for book, apart, half in zip(self.books, self.apart, (unit[:, :cut], unit[:, cut:]), strict=True):
            far = (half**2).sum(1)[:, None] - 2 * half @ book.T + (book**2).sum(1)
            own = far.argmin(1)
            gap = np.maximum(far - far[np.arange(len(far)), own][:, None], 0) / (2 * apart[own])
            made.append((own, gap**2))
        return made

    def visits(self, unit: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Own cell of each vector and all cells it visits, nearest first (its own is one of them)."""
        (own1, gap1), (own2, gap2) = self.margins(unit)
        width = len(self.books[1])
        order1, order2 = gap1.argsort(1, kind="stable"), gap2.argsort(1, kind="stable")
        visited = []
        for i in range(len(unit)):
            a, b = gap1[i, order1[i]], gap2[i, order2[i]]
            rows = np.searchsorted(a, self.reach, "right")
            ends = np.searchsorted(b, self.reach - a[:rows], "right")  # multi-sequence: a prefix for each row
            cells = np.concatenate([order1[i, r] * width + order2[i, :e] for r, e in enumerate(ends)])
            cost = np.concatenate([a[r] + b[:e] for r, e in enumerate(ends)])
            visited.append(cells[cost.argsort(kind="stable")])
        return own1 * width + own2, visited


def _centroids(points: np.ndarray, count: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    book = points[rng.permutation(len(points))[:count]]
    for _ in range(rounds):
        near = ((book**2).sum(1) - 2 * points @ book.T).argmin(1)
        sizes = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, points)
        book = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], book)
    return np.unique(book, axis=0) if points.shape[1] else book[:1]


def fit_grid(sample: np.ndarray, count: int, cosine: float, recall: float, seed: int = 7) -> Grid:
    """Codebooks by k-means on a sample of unit vectors; reach by neighbours drawn at the cosine given.

    The drawn neighbours lie in random directions at the farthest distance that
    still links, so real ones are found at least as often unless their
    differences favour the directions between centroids; recall is therefore
    measured against brute force as well.
    """
    rng = np.random.default_rng(seed)
    cut = sample.shape[1] // 2
    books = tuple(_centroids(half, count, rng) for half in (sample[:, :cut], sample[:, cut:]))
    open_grid = Grid(books, np.inf)
    drawn = sample[rng.integers(0, len(sample), min(4000, 4 * len(sample)))]
    turn = rng.normal(size=drawn.shape)
    turn -= (turn * drawn).sum(1, keepdims=True) * drawn
    turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-18)
    near = cosine * drawn + np.sqrt(max(0.0, 1 - cosine**2)) * turn
    rows = np.arange(len(drawn))
    cost = sum(gap[rows, own] for (_, gap), (own, _) in zip(open_grid.margins(drawn), open_grid.margins(near), strict=True))
    return Grid(books, float(np.quantile(cost, recall)) if len(cost) else 0.0)


def classes_of(rows: DataFrame, key: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Different usable vectors (c, label, v, n, least) with copies counted; all rows (k, label, v).

    ``v`` holds the vector as little-endian doubles, null where it is unusable.
    Equal vectors of a label are one class, made before anything is compared.
    Both are written once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            raw = []
            for x in batch.column(2).to_pylist():
                v = np.array([np.nan if e is None else e for e in x or []], "<f8") + 0.0  # -0 is 0
                raw.append(v.tobytes() if np.isfinite(v).all() and v.any() else None)
            columns = [batch.column(0), batch.column(1), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["k", "label", "v"])

    numbers = F.when(F.col(label).isNotNull(), F.col(vector).cast("array<double>"))
    named = rows.select(F.col(key).alias("k"), F.col(label).alias("label"), numbers.alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in named.schema}
    packed = materialise(named.mapInArrow(run, f"k {kinds['k']}, label {kinds['label']}, v binary"), "vectors")
    grouped = packed.filter("v IS NOT NULL").groupBy("label", "v").agg(F.count("*").alias("n"), F.min("k").alias("least"))
    numbered = grouped.select(F.monotonically_increasing_id().alias("c"), "label", "v", "n", "least")
    return materialise(numbered, "vector-classes"), packed


def _units(raw: list[bytes]) -> np.ndarray:
    made = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    scaled = made / np.abs(made).max(1, keepdims=True)  # squares neither overflow nor vanish
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _dealt(classes: DataFrame, grid: Grid) -> DataFrame:
    """A row for each class and visited cell; its own cell's row is the resident, with all its visits."""
    kind = classes.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            own, visits = grid.visits(_units(batch.column("v").to_pylist()))
            at = np.repeat(np.arange(batch.num_rows), [len(x) for x in visits])
            cell, home, rows = np.concatenate(visits), own[at], pa.array(at)
            lists = pa.array([x.tolist() for x in visits], pa.list_(pa.int32())).take(rows)
            stored = pc.if_else(pa.array(home == cell), lists, pa.scalar(None, pa.list_(pa.int32())))
            columns = [batch.column(name).take(rows) for name in ("c", "label", "v", "n")]
            columns += [pa.array(cell, pa.int32()), pa.array(home, pa.int32()), stored]
            yield pa.RecordBatch.from_arrays(columns, names=["c", "label", "v", "n", "cell", "home", "visits"])

    columns = classes.select("c", "label", "v", "n")
    return columns.mapInArrow(run, f"c bigint, label {kind}, v binary, n bigint, cell int, home int, visits array<int>")


def _verified(table: pa.Table, cosine: float) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Links found in one tile of a cell: how many each class gained, and spanning links."""
    resident = table.filter(table.column("seat"))
    visitor = table.filter(pc.invert(table.column("seat")))
    gained: dict[int, int] = {}
    spanning: list[tuple[int, int]] = []
    if not resident.num_rows or not visitor.num_rows:
        return gained, spanning
    base = _units(resident.column("v").to_pylist())
    names = resident.column("c").to_numpy()
    weight = resident.column("n").to_numpy()
    lists = resident.column("visits").to_pylist()
    seen = np.full((len(lists), max(map(len, lists))), -1, np.int32)
    for k, cells in enumerate(lists):
        seen[k, : len(cells)] = cells
    group = np.arange(len(names))
    back = np.zeros(len(names), np.int64)
    cell = table.column("cell")[0].as_py()
    for part in (visitor.slice(s, 512) for s in range(0, visitor.num_rows, 512)):
        unit = _units(part.column("v").to_pylist())
        ids, homes, copies = (part.column(x).to_numpy() for x in ("c", "home", "n"))
        close = (unit @ base.T >= cosine) & (ids[:, None] != names[None, :])
        total = close @ weight
        for home in np.unique(homes[total > 0]):
            if home != cell:  # residents that do not visit the guest's cell learn of it here
                guests = homes == home
                back += np.where((seen == home).any(1), 0, copies[guests] @ close[guests])
        for k in np.flatnonzero(total):
            gained[int(ids[k])] = gained.get(int(ids[k]), 0) + int(total[k])
            groups = np.unique(group[close[k]])
            spanning.append((int(ids[k]), int(names[groups[0]])))
            for other in groups[1:]:
                spanning.append((int(names[groups[0]]), int(names[other])))
                group[group == other] = groups[0]
    for k in np.flatnonzero(back):
        gained[int(names[k])] = gained.get(int(names[k]), 0) + int(back[k])
    return gained, spanning


def _met(dealt: DataFrame, cosine: float) -> DataFrame:
    """(c, gained, a, b): gains and spanning links of all cells, large cells dealt over tiles."""
    keys = ["label", "dims", "cell"]
    sides = dealt.groupBy(*keys).agg(F.count_if("seat").alias("residents"), F.count("*").alias("members"))
    sides = sides.filter("residents > 0 AND members > 1").select(
        *keys, F.ceil(F.col("residents") / PART).alias("x"), F.ceil(F.col("members") / PART).alias("y")
    )
    spot = F.xxhash64("c")
    here = dealt.join(sides, keys)
    as_resident = F.transform(F.sequence(F.lit(0), F.col("y") - 1), lambda k: F.struct(F.lit(True).alias("seat"), F.pmod(spot, "x").alias("x"), k.alias("y")))
    as_visitor = F.transform(F.sequence(F.lit(0), F.col("x") - 1), lambda k: F.struct(F.lit(False).alias("seat"), k.alias("x"), F.pmod(spot, "y").alias("y")))
    seats = F.when(F.col("seat"), F.concat(as_resident, as_visitor)).otherwise(as_visitor)
    tiles = here.withColumn("tile", F.explode(seats)).select(
        *keys, "tile.seat", "tile.x", "tile.y", "c", "v", "n", "home", F.when(F.col("tile.seat"), F.col("visits")).alias("visits")
    )

    def run(table: pa.Table) -> pa.Table:
        gained, spanning = _verified(table, cosine)
        names = ["c", "gained", "a", "b"]
        empty = [None] * len(spanning)
        blank = [None] * len(gained)
        rows = [[*gained, *empty], [*gained.values(), *empty], [*blank, *(a for a, _ in spanning)], [*blank, *(b for _, b in spanning)]]
        return pa.table([pa.array(r, pa.int64()) for r in rows], names=names)

    return tiles.groupBy(*keys, "x", "y").applyInArrow(run, "c bigint, gained bigint, a bigint, b bigint")


def sample_units(classes: DataFrame, count: int, dims: int) -> np.ndarray:
    """At most ``FIT_ROWS`` vectors of one width, chosen by hash; the only vectors the driver sees."""
    share = F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < int(min(1.0, 0.9 * FIT_ROWS / max(1, count)) * (1 << 20)) + 1
    rows = classes.filter((F.length("v") == 8 * dims) & share).select("v").limit(FIT_ROWS).collect()
    return _units(sorted(bytes(r[0]) for r in rows)) if rows else np.zeros((0, dims))


def near_duplicates(
    rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    cosine: float = 0.98, recall: float = 0.995,
) -> DataFrame:
    """(key, n_links, component_id, kept), one row per input row.

    ``n_links`` counts the other rows of the same label at ``cosine`` or more,
    copies included; ``component_id`` is the smallest key reachable, itself
    included. Rows whose label is null, or whose vector is null, empty, zero, or
    holds null or non-finite numbers, link with nothing. Vectors of different
    lengths are never compared. No pair below ``cosine`` links; ``recall`` is
    the share of pairs aimed at. Repeated keys keep a row each; an empty table
    gives an empty result.
    """
    classes, packed = classes_of(rows, key, vector, label)
    widths = [(r[0] // 8, r[1]) for r in classes.groupBy(F.length("v")).count().collect()]
    gained: DataFrame | None = None
    for dims, count in sorted(widths):
        some = classes.filter(F.length("v") == 8 * dims)
        sample = sample_units(classes, count, dims)
        centroids = max(1, min(MAX_CENTROIDS, len(sample) // 8, round((count / PER_CELL) ** 0.5)))
        grid = fit_grid(sample, centroids, cosine, recall) if len(sample) else Grid((np.zeros((1, dims // 2)), np.zeros((1, dims - dims // 2))), 0.0)
        dealt = materialise(_dealt(some, grid), "visits").withColumn("dims", F.lit(dims))
        met = _met(dealt.withColumn("seat", F.col("home") == F.col("cell")), cosine)
        gained = met if gained is None else gained.unionByName(met)
    alone = packed.filter("v IS NULL").select("k", F.lit(0).cast("bigint").alias("n_links"), F.col("k").alias("component_id"))
    if gained is None:
        judged = alone
    else:
        gained = materialise(gained, "vector-links")
        found = materialise(components(gained.filter("a IS NOT NULL")), "components")
        counts = gained.filter("c IS NOT NULL").groupBy("c").agg(F.sum("gained").alias("gained"))
        nodes = classes.join(found.withColumnRenamed("node", "c"), "c", "left").withColumn("g", F.coalesce("component", "c"))
        # Written, so that the join is a plain one, whose large groups Spark can split.
        least = materialise(nodes.groupBy("g").agg(F.min("least").alias("component_id")), "least")
        links = F.coalesce("gained", F.lit(0)) + F.col("n") - 1
        known = nodes.join(least, "g").join(counts, "c", "left").select("label", "v", links.alias("n_links"), "component_id")
        judged = packed.join(known, ["label", "v"]).select("k", "n_links", "component_id").unionByName(alone)
    return judged.select(
        F.col("k").alias(key), "n_links", "component_id", F.col("k").eqNullSafe(F.col("component_id")).alias("kept")
    )
