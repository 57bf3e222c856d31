"""Near-duplicate embeddings by hashing to E8 lattice points.

In each of several tables a vector of length one is projected to eight dimensions at random and
decoded to the nearest point of the E8 lattice, its home cell; it also probes the neighbouring
cells that lie nearest. Vectors that meet in a cell, one of them at home, are compared by cosine
in double precision. A pair that meets more than once counts where it meets first.

Equal vectors are one class with a count. A cell with many rows is compared block by block in
different tasks, and tasks return the number of links of each vector and a spanning forest, so
pairs are never listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gneiss.llm.common import SALTS, components, salted_join, shuffle_width, stored

TABLES, PROBES = 4, 10
#: Scale of the projection against the lattice, whose nearest points are sqrt(2) apart.
SCALE = 0.8
#: Rows of a cell that one task compares with as many others.
BLOCK = 2048
CHUNK = 256


@lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of the lattice."""
    whole = []
    for i in range(8):
        for j in range(i):
            for a, b in product((-1, 1), repeat=2):
                v = np.zeros(8)
                v[i], v[j] = a, b
                whole.append(v)
    half = [np.array(v) / 2 for v in product((-1, 1), repeat=8) if np.prod(v) > 0]
    return np.array(whole + half)


def nearest_even(y: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum."""
    point = np.rint(y)
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    off = y[odd] - point[odd]
    worst = np.abs(off).argmax(axis=1)
    at = np.arange(len(odd))
    point[odd, worst] += np.where(off[at, worst] >= 0, 1, -1)
    return point


def nearest_lattice(y: np.ndarray) -> np.ndarray:
    """The nearest points of E8: even integer points, or the same shifted by one half."""
    a, b = nearest_even(y), nearest_even(y - 0.5) + 0.5
    return np.where(((y - a) ** 2).sum(axis=1, keepdims=True) <= ((y - b) ** 2).sum(axis=1, keepdims=True), a, b)


def _numbers(points: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Cell numbers of lattice points, by hash, together with a salt for each row."""
    x = salt.astype(np.uint64).reshape(-1, *[1] * (points.ndim - 2)).copy() * np.ones(points.shape[:-1], np.uint64)
    for k in range(8):
        x = (x ^ (np.rint(2 * points[..., k]).astype(np.int64).view(np.uint64) + np.uint64(k))) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return x.view(np.int64)


def cells(units: np.ndarray, salt: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """Cell numbers (row, table, 1 + probes) of vectors of length one; the first is the home cell."""
    out = np.empty((len(units), tables, probes + 1), np.int64)
    for t in range(tables):
        rng = np.random.default_rng([units.shape[1], t])
        y = SCALE * (units @ rng.standard_normal((units.shape[1], 8))) + rng.random(8)
        home = nearest_lattice(y)
        order = np.argpartition(-((y - home) @ neighbours().T), probes - 1, axis=1)[:, :probes]
        points = np.concatenate([home[:, None], home[:, None] + neighbours()[order]], axis=1)
        out[:, t] = _numbers(points, salt + np.int64(t))
    return out


def _matrix(column, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _units(x: np.ndarray) -> np.ndarray:
    # Scaling by the largest component first keeps squares finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _meetings(nodes: DataFrame) -> DataFrame:
    """Rows (tab, cell, node, home) of the cells that the vectors are in or probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = np.array([len(v) for v in batch.column("embedding")])
            for w in np.unique(width):
                part = batch.take(pa.array(np.flatnonzero(width == w)))
                found = cells(_units(_matrix(part.column("embedding"), w)), part.column("salt").to_numpy())
                n, tables, each = found.shape
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.tile(np.repeat(np.arange(tables), each), n).astype(np.int32)), pa.array(found.ravel()),
                    pa.array(np.repeat(part.column("node").to_numpy(), tables * each)),
                    pa.array(np.tile(np.arange(each) == 0, n * tables))], ["tab", "cell", "node", "home"])

    return nodes.select("node", "salt", "embedding").mapInArrow(run, "tab int, cell long, node long, home boolean")


def compare(table: pa.Table, cosine: float) -> pa.Table:
    """The links that count here, of some whole cells or of two blocks of one: rows (node, links, other).

    A row has the links of a node as a number of vectors, or an edge to another node.
    """
    tab = table.column("tab")[0].as_py()
    table = table.sort_by([("width", "ascending"), ("cell", "ascending")])
    split = table.column("low")[0].as_py() != table.column("high")[0].as_py()
    nodes, links, edges = [], [], []
    width, cell = table.column("width").to_numpy(), table.column("cell").to_numpy()
    for w in np.unique(width):
        part = table.slice(int(np.searchsorted(width, w)), int((width == w).sum()))
        found = _compare_cells(part, cell[width == w], tab, split, cosine, int(w))
        nodes, links, edges = nodes + found[0], links + found[1], edges + found[2]
    a, b = np.array(edges, np.int64).reshape(-1, 2).T
    return pa.table({
        "node": np.concatenate([np.array(nodes, np.int64), a]), "links": np.concatenate([np.array(links, np.int64), np.zeros(len(a), np.int64)]),
        "other": pa.array(np.concatenate([np.zeros(len(nodes), np.int64), b]), mask=np.arange(len(nodes) + len(a)) < len(nodes))})


def _compare_cells(table: pa.Table, cell: np.ndarray, tab: int, split: bool, cosine: float, width: int) -> tuple[list, list, list]:
    """Compare the rows of each cell, which stand together; vectors have one length."""
    home = table.column("home").to_numpy()
    block, copies, ids, salt = (table.column(c).to_numpy() for c in ("block", "copies", "node", "salt"))
    u = _units(_matrix(table.column("embedding"), width))
    nodes, links, edges = [], [], []
    bounds = [*np.flatnonzero(np.diff(cell, prepend=cell[0] - 1)).tolist(), len(cell)]
    for start, stop in zip(bounds, bounds[1:]):
        count, label = np.zeros(stop - start, np.int64), np.arange(stop - start)
        v, cells_of = u[start:stop], None
        for lo in range(0, stop - start, CHUNK):
            i, j = np.nonzero(v[lo : lo + CHUNK] @ v.T >= cosine)
            i += lo
            pick = i < j
            if not pick.any():
                continue
            i, j = i[pick], j[pick]
            pick = home[start + i] | home[start + j]
            if split:
                pick &= block[start + i] != block[start + j]
            i, j = i[pick], j[pick]
            # Only pairs that link need the cells of the other tables.
            if cells_of is None:
                cells_of = cells(v, salt[start:stop])[:, : tab + 1]
            meets = np.zeros((len(i), tab + 1), bool)
            for a, b in ((i, j), (j, i)):
                meets |= (cells_of[a] == cells_of[b][:, :, :1]).any(axis=2)
            mine = ~meets[:, :tab].any(axis=1)
            # Within the table a pair may meet in the home cell of either; the smaller number counts.
            for a, b in ((i, j), (j, i)):
                here = cells_of[b][:, tab, 0]
                mine &= ~((cells_of[a][:, tab] == here[:, None]).any(axis=1) & (here < cell[start]))
            i, j = i[mine], j[mine]
            np.add.at(count, i, copies[start + j])
            np.add.at(count, j, copies[start + i])
            for a in np.unique(i):
                for other in np.setdiff1d(label[j[i == a]], label[a]):
                    edges.append((ids[start + a], ids[start + other]))
                    label[label == other] = label[a]
        for k in np.flatnonzero(count):
            nodes.append(ids[start + k])
            links.append(count[k])
    return nodes, links, edges


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Per row: vec_id, n_links, component_id and kept, for links within equal labels.

    Vectors that are null, empty or zero, hold null or non-finite components, or have no label
    link with nothing; so do vectors of different lengths. A null vec_id takes part, and gets the
    smallest id of its component, null if there is none. Repeated rows are vectors of their own
    and link with each other. An empty table gives no rows.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("node", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", "embedding")))
    nodes = rows.where("node IS NOT NULL").groupBy("node", "label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    nodes = stored(nodes.withColumn("salt", F.xxhash64("label", F.size("embedding"))), "vectors")

    meetings = stored(_meetings(nodes), "meetings")
    counts = meetings.groupBy("tab", "cell").agg(F.count("*").alias("n"), F.count_if("home").alias("homes"))
    shared = counts.where("homes > 0 AND n > 1").select("tab", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    # A hot cell is spread over salts; then its rows are dealt to blocks, and each pair of blocks is a task's.
    spread = shared.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rest = meetings.withColumn("part", F.pmod("node", F.lit(SALTS)).cast("int")).join(spread, ["tab", "cell", "part"])
    rest = rest.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rest = rest.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select("tab", "cell", "node", "home", "block", "blocks", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"))
    full = rest.join(nodes.select("node", "salt", "embedding", F.size("embedding").alias("width"), "copies"), "node")
    # Many cells of one block share a task's call; each pair of blocks of a hot cell has one of its own.
    whole = F.col("blocks") == 1
    full = full.withColumn("batch", F.when(whole, F.pmod("cell", F.lit(16 * shuffle_width(vectors)))).otherwise(F.col("cell")))
    found = full.drop("blocks").groupBy("tab", "batch", "low", "high").applyInArrow(lambda t: compare(t, cosine), "node long, links long, other long")
    found = stored(found, "links")

    links = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.where("other IS NOT NULL").select("node", "other"))
    known = nodes.select("node", "copies", "first").join(groups, "node", "left").join(links, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    firsts = known.groupBy("component").agg(F.min("first").alias("component_id"))
    known = stored(salted_join(known, firsts, ["component"], "node").select(
        "node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "known")
    out = rows.join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
