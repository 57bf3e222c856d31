"""Near-duplicate documents by SimHash fingerprints in a vantage-point tree.

A fingerprint has 64 bits; a bit is set if it is set in over half of the hashes of the
document's shingles. Distinct fingerprints are dealt to the leaves of a vantage-point tree
by Hamming distance. A fingerprint near the border of a branch also visits the other side,
as the triangle inequality demands, in a shard of the border's own, so every pair within the
radius meets in some leaf.

The tree is fitted on a bounded sample of fingerprints; it only shapes the shards, and the
result doesn't depend on it. Within a leaf each connected group yields a spanning forest
rather than all its pairs, and a leaf that is larger than a block is compared block by block.

Where links also ask for a similarity of shingle sets, a sketch picks the candidates, well below
the similarity; the sets themselves are then compared within each component of candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from gneiss.llm.common import components, row_key, salted_join, stored

#: Fingerprints that shape the tree, members wished for in a leaf, rows compared in one task.
SAMPLE, LEAF, BLOCK = 8192, 8192, 16384
#: Texts compared by their shingle sets in one task.
TEXTS = 1024
#: Slots of the sketch that estimates the similarity of shingle sets, four bits each.
SLOTS = 128
HASH_SEED = 42
FACTORS, SHIFTS = (np.random.default_rng(HASH_SEED).integers(0, 2**32, (2, SLOTS), np.uint32) | np.array([[1], [0]], np.uint32))


def shingle_hashes(words: list[bytes], width: int, distinct: bool, seed: int = HASH_SEED) -> np.ndarray:
    """XXH64 of each run of ``width`` words; fewer words are one shingle, no words none."""
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    width = min(width, len(words))
    starts = [0, *ends[: len(words) - width].tolist()]
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], np.uint64)
    return np.unique(hashes) if distinct else hashes


def fingerprint(hashes: np.ndarray) -> int:
    """The 64 majority bits of the hashes as a signed number; zero if there are none."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[k : k + (1 << 16)])
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def remixed(hashes: np.ndarray, number: int) -> np.ndarray:
    """The hashes for the fingerprint of that number; those of number 0 are the hashes themselves."""
    if not number:
        return hashes
    x = hashes * np.uint64(2 * number + 1) + np.uint64(number * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sketch(hashes: np.ndarray) -> bytes:
    """Min-wise sketch of a set of hashes: for each slot's permutation four bits of the least value."""
    least = np.full(SLOTS, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(hashes), 4096):
        part = (hashes[k : k + 4096] >> np.uint64(32)).astype(np.uint32)
        least = np.minimum(least, (part[:, None] * FACTORS + SHIFTS).min(axis=0))
    bits = ((least * np.uint32(0x9E3779B1)) >> np.uint32(28)).astype(np.uint8)
    return (bits[0::2] | (bits[1::2] << 4)).tobytes()


def agreement(sketches: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The estimated similarity of each of the sketches to another; slots agree by chance once in 16."""
    differ = sketches ^ other
    same = ((differ & 15) == 0).sum(axis=-1) + ((differ >> 4) == 0).sum(axis=-1)
    return (same / SLOTS - 1 / 16) / (15 / 16)


def fingerprints(docs: DataFrame, shingle: int = 3, distinct: bool = False, sketch_shingle: int | None = None, number: int = 1) -> DataFrame:
    """Per document row: doc_id, key (number of the row's content), ``number`` fingerprints, and the sketch and a number for the shingle set if asked for.

    A-Z are lower-cased, other characters stay. A null or empty text has no words and the
    fingerprint zero. Rows come out as they came in, repeated ones too.
    """
    schema = "doc_id long, key long, fps array<long>, sketch binary, shingles long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sketches, sets = [], [], []
            for text in batch.column("text"):
                words = (text.as_py() or b"").lower().split()
                hashes = shingle_hashes(words, shingle, distinct)
                fps.append([fingerprint(remixed(hashes, i)) for i in range(number)])
                shingles = shingle_hashes(words, sketch_shingle, True) if sketch_shingle else None
                sketches.append(None if shingles is None else sketch(shingles))
                sets.append(None if shingles is None else xxhash.xxh3_64_intdigest(shingles.tobytes()) >> 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(fps, pa.list_(pa.int64())), pa.array(sketches, pa.binary()), pa.array(sets, pa.int64())],
                ["doc_id", "key", "fps", "sketch", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long"), row_key().alias("key"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, schema)


class Node(NamedTuple):
    """An inner node of the tree (vantage point, radius, children) or a leaf (number).

    ``border`` is the shard of the pairs that cross the border; nodes below it have none.
    """

    point: int = 0
    radius: int = 0
    inner: "Node | None" = None
    outer: "Node | None" = None
    border: "Node | None" = None
    leaf: int = -1


def fit_tree(sample: np.ndarray, total: int, reach: int, leaf_size: int = LEAF) -> tuple[Node, int]:
    """A vantage-point tree whose leaves would hold about ``leaf_size`` of ``total`` fingerprints.

    The radius is the quantile near the middle with the fewest fingerprints near the border.
    A node whose children would each be nearly as large as itself stays a leaf. Returns the root
    and the number of leaves.
    """
    share, leaves = max(1, total) / max(1, len(sample)), 0

    def split(part: np.ndarray) -> tuple[float, int, int]:
        best = (1.0, 0, 0)
        for point in part[:: max(1, len(part) // 16)][:16]:
            by = np.bincount(np.bitwise_count(part ^ point), minlength=65)
            below = np.cumsum(by)
            for radius in np.flatnonzero((below >= 0.3 * len(part)) & (below <= 0.7 * len(part))):
                near = by[max(0, radius - reach + 1) : radius + reach + 1].sum() / len(part)
                best = min(best, (near, int(point), int(radius)))
        return best

    def grow(members: np.ndarray, visitors: np.ndarray | None) -> Node:
        nonlocal leaves
        part = members if visitors is None else np.concatenate([members, visitors])
        if len(part) * share > leaf_size and len(part) >= 32:
            _, point, radius = split(part)
            m = np.bitwise_count(members ^ np.uint64(point)).astype(int)
            inside, outside = members[m <= radius], members[m > radius]
            if visitors is None:
                if max(len(inside), len(outside)) < 0.9 * len(part):
                    border = grow(members[(m > radius) & (m <= radius + reach)], members[(m <= radius) & (m > radius - reach)])
                    return Node(point, radius, grow(inside, None), grow(outside, None), border)
            else:
                v = np.bitwise_count(visitors ^ np.uint64(point)).astype(int)
                in_too, out_too = visitors[v <= radius + reach], visitors[v > radius - reach]
                if max(len(inside) + len(in_too), len(outside) + len(out_too)) < 0.9 * len(part):
                    return Node(point, radius, grow(inside, in_too), grow(outside, out_too))
        leaves += 1
        return Node(leaf=leaves - 1)

    return grow(sample, None), leaves


def route(node: Node, points: np.ndarray, reach: int) -> list[tuple[int, np.ndarray, bool]]:
    """For each leaf the indices of its members (True) and of its visitors (False).

    Of a pair within ``reach`` either both points lie on one side of a border, or one lies
    inside and one outside and both near it. Such pairs meet in the border's own shard, where
    the outer point is a member and the inner one visits whatever its ball overlaps.
    """
    found, nobody = [], np.empty(0, np.int64)
    stack = [(node, np.arange(len(points)), nobody)]
    while stack:
        at, members, visitors = stack.pop()
        if at.leaf >= 0:
            found += [(at.leaf, members, True), (at.leaf, visitors, False)]
            continue
        point = np.uint64(at.point)
        m, v = np.bitwise_count(points[members] ^ point).astype(int), np.bitwise_count(points[visitors] ^ point).astype(int)
        if at.border:
            outside = members[(m > at.radius) & (m <= at.radius + reach)]
            stack.append((at.border, outside, members[(m <= at.radius) & (m > at.radius - reach)]))
        stack.append((at.inner, members[m <= at.radius], visitors[v <= at.radius + reach]))
        stack.append((at.outer, members[m > at.radius], visitors[v > at.radius - reach]))
    return [x for x in found if len(x[1])]


def forest(points: np.ndarray, member: np.ndarray, reach: int, sketches: np.ndarray | None, similarity: float) -> list[tuple[int, int]]:
    """Index pairs that connect whatever links of members with members or visitors connect.

    A breadth-first walk: each reached point is compared with all points not reached yet.
    """
    edges = []
    rest = {True: np.flatnonzero(member), False: np.flatnonzero(~member)}
    while len(rest[True]):
        first, rest[True] = rest[True][0], rest[True][1:]
        queue = [first]
        while queue:
            at = queue.pop()
            for kind in (True, False) if member[at] else (True,):
                others = rest[kind]
                near = np.bitwise_count(points[others] ^ points[at]) <= reach
                if sketches is not None and near.any():
                    hits = np.flatnonzero(near)
                    near[hits] = agreement(sketches[others[hits]], sketches[at]) >= similarity
                if near.any():
                    new = others[near]
                    edges += [(int(at), int(x)) for x in new]
                    queue += new.tolist()
                    rest[kind] = others[~near]
    return edges


def links(nodes: DataFrame, reach: int, similarity: float | None = None, block: int = BLOCK, leaf_size: int = LEAF) -> DataFrame:
    """Edges (a, b) between ``node`` numbers that connect all nodes linked by fingerprint.

    ``nodes`` has node, fps and sketch, once per node. Two nodes link if one of their fingerprints
    differs in at most ``reach`` bits and, with ``similarity``, their sketches agree in that share
    of slots. Each number of fingerprint has a tree of its own; all trees are searched in one job.
    """
    head = nodes.select("fps").orderBy(F.xxhash64("fps")).limit(SAMPLE).collect()
    columns = np.array([r.fps for r in head], np.int64).view(np.uint64).T if head else []
    total, trees, first = nodes.count(), [], 0
    for column in columns:
        tree, leaves = fit_tree(np.unique(column), total, reach, leaf_size)
        trees.append((tree, first))
        first += leaves

    def dealt(parts: dict[int, int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                every = batch.column("fps").flatten().to_numpy().reshape(-1, len(trees))
                ids = batch.column("node").to_numpy()
                rest = batch.select(["node", "sketch"])
                for (tree, first), column in zip(trees, every.T):
                    points = np.ascontiguousarray(column)
                    for leaf, index, member in route(tree, points.view(np.uint64), reach):
                        k = parts.get(first + leaf, 1)
                        own = ids[index] % k
                        # Blocks i and j of a large leaf meet in the task (i, j); a leaf of one block is the task (0, 0).
                        for other in range(k):
                            pick = index if k == 1 else index[own != other]
                            if len(pick):
                                mine = ids[pick] % k
                                low, high = np.minimum(mine, other), np.maximum(mine, other)
                                rows = rest.take(pa.array(pick))
                                yield pa.RecordBatch.from_arrays(
                                    [pa.array(np.full(len(pick), first + leaf)), pa.array(low * k + high), pa.array(np.full(len(pick), member)),
                                     *rows.columns, pa.array(points[pick])], ["leaf", "pair", "member", "node", "sketch", "fp"])
        return run

    rows = nodes.select("node", "fps", "sketch")
    schema = "leaf long, pair long, member boolean, node long, sketch binary, fp long"
    # One row for each leaf; the sample bounds their number.
    sizes = rows.select("node", "fps", F.lit(None).cast("binary").alias("sketch")).mapInArrow(dealt({}), schema).groupBy("leaf").count().collect()
    parts = {r["leaf"]: -(-2 * r["count"] // block) for r in sizes if r["count"] > block}

    def join(table: pa.Table) -> pa.Table:
        points = table.column("fp").to_numpy().view(np.uint64)
        member = table.column("member").to_numpy()
        ids = table.column("node").to_numpy()
        sketches = None
        if similarity is not None:
            sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SLOTS // 2)
        pairs = forest(points, member, reach, sketches, similarity or 0)
        a, b = np.array(pairs, np.int64).reshape(-1, 2).T
        return pa.table({"a": ids[a], "b": ids[b]})

    return rows.mapInArrow(dealt(parts), schema).groupBy("leaf", "pair").applyInArrow(join, "a long, b long")


def overlaps(shingles: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """The Jaccard similarity of a sorted set of hashes to each of the others; two empty sets are equal."""
    sizes = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(shingles, flat), max(0, len(shingles) - 1))
    hit = shingles[at] == flat if len(shingles) else np.zeros(len(flat), bool)
    shared = np.diff(np.concatenate([[0], np.cumsum(hit)])[np.concatenate([[0], np.cumsum(sizes)])])
    union = len(shingles) + sizes - shared
    return np.where(union > 0, shared / np.maximum(union, 1), 1.0)


def exact_forest(sketches: np.ndarray, sets: list[np.ndarray], loose: float, similarity: float) -> list[tuple[int, int]]:
    """Index pairs that connect whatever pairs of at least that similarity connect; sketches only spare comparisons."""
    edges, rest = [], np.arange(len(sets))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = agreement(sketches[rest], sketches[at]) >= loose
            if near.any():
                near[near] = overlaps(sets[at], [sets[i] for i in rest[near]]) >= similarity - 1e-9
                new = rest[near]
                edges += [(int(at), int(x)) for x in new]
                queue += new.tolist()
                rest = rest[~near]
    return edges


def exact_links(docs: DataFrame, nodes: DataFrame, groups: DataFrame, similarity: float, loose: float, shingle: int, block: int = TEXTS) -> DataFrame:
    """Edges (a, b) that connect the nodes of each component whose shingle sets are that similar.

    ``nodes`` has node, sketch and the key of one of its rows, ``groups`` the node and component of
    candidates. Each text moves to its component; one of more than ``block`` is compared in pairs of blocks.
    """
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    members = salted_join(groups, sizes, ["component"], "node").join(nodes.select("node", "sketch", "key"), "node")
    members = members.withColumn("k", F.when(F.col("n") > block, F.ceil(2 * F.col("n") / block)).otherwise(1).cast("int")).drop("n")
    texts = docs.select(row_key().alias("key"), F.col("text").cast("binary").alias("text"))
    rows = texts.join(members, "key").dropDuplicates(["node"])
    own = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("k") - 1), lambda i: (F.col("k") == 1) | (i != own))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(others))
    rows = rows.withColumn("pair", F.least("own", "other").cast("long") * F.col("k") + F.greatest("own", "other"))

    def join(table: pa.Table) -> pa.Table:
        ids = table.column("node").to_numpy()
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SLOTS // 2)
        sets = [shingle_hashes((t.as_py() or b"").lower().split(), shingle, True) for t in table.column("text")]
        a, b = np.array(exact_forest(sketches, sets, loose, similarity), np.int64).reshape(-1, 2).T
        return pa.table({"a": ids[a], "b": ids[b]})

    return rows.select("component", "pair", "node", "sketch", "text").groupBy("component", "pair").applyInArrow(join, "a long, b long")


def near_groups(docs: DataFrame, shingle: int = 3, distinct: bool = False, bits: int = 2, number: int = 1,
                similarity: float | None = None, similarity_shingle: int = 5, margin: float = 0.15) -> DataFrame:
    """Per document row: doc_id, key, fp and component_id, the smallest doc_id reachable by links.

    Rows link if one of ``number`` fingerprints differs in at most ``bits`` bits. With ``similarity``
    such links are candidates if an estimate of their shingle sets' similarity falls short by ``margin``
    at most, and of the rows that candidates connect those link whose sets are that similar.
    Rows that agree in all fingerprints (and the shingle set) always link. Rows with a null doc_id take part and get the
    smallest id of their group, null if it has none. Repeated rows are all returned. An empty
    table gives no rows.
    """
    rows = stored(fingerprints(docs, shingle, distinct, similarity_shingle if similarity else None, number), "fingerprints")
    rows = rows.withColumn("fp", F.get("fps", F.lit(0)))
    rows = rows.withColumn("node", F.xxhash64("fps", "sketch", "shingles") if similarity or number > 1 else F.col("fp"))
    nodes = stored(rows.groupBy("node", "fps", "sketch").agg(F.min("doc_id").alias("first"), F.min("key").alias("key")), "nodes")
    groups = components(links(nodes, bits, similarity - margin if similarity else None))
    if similarity:
        groups = components(exact_links(docs, nodes, stored(groups, "candidates"), similarity, similarity - margin, similarity_shingle))
    grouped = nodes.join(groups, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "first")
    named = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    names = stored(salted_join(grouped, named, ["component"], "node").select("node", "component_id"), "names")
    return rows.join(names, "node").select("doc_id", "key", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The documents without near copies: of each group the row with the smallest id stays.

    Options as for :func:`near_groups`. Columns stay as they are. Of repeated rows one stays;
    a group of null ids keeps one row, by the number of its content.
    """
    groups = near_groups(docs, **options)
    keep = groups.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("kept"))
    keep = keep.select(F.col("kept.doc_id").alias("keep_id"), F.col("kept.key").alias("keep_key"))
    keyed = docs.withColumn("__key", row_key())
    picked = keyed.join(keep, keyed["__key"].eqNullSafe(keep["keep_key"]) & keyed["doc_id"].eqNullSafe(keep["keep_id"]), "left_semi")
    return picked.dropDuplicates(["doc_id", "__key"]).select(*docs.columns)
