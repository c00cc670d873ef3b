"""Nearest neighbours through a hierarchical k-means tree (operator 7).

* The tree is fitted on a bounded sample: spherical k-means splits a node into
  ``BRANCH`` children until a node holds ``LEAF_SAMPLE`` sampled vectors or fewer.
* Every row goes down the tree, at each node to the most similar centre, into a leaf.
* A query walks the tree best bin first: a priority queue holds the nodes met so far by
  the similarity of their centres, the best is opened, and leaves are visited in the
  order in which they come out.
* How many leaves are visited is calibrated: for a bounded sample of queries the true
  neighbours are found by comparing with all rows, and visits are widened until the
  share of them that lie in visited leaves reaches ``recall``. A query also goes on
  until its leaves hold ``k`` rows besides itself, so all rows are found where they are
  fewer.
* Small neighbouring leaves share a bin of at most ``ROW_BLOCK`` rows, and a query visits
  whole bins. For the search, neighbouring bins make up a part; a bin larger than a part is
  dealt to several. Each row goes to one part, each query once to every part in which it
  visits a bin, with a bit for each bin. A part holds as many rows as there are queries, so
  queries sent outweigh rows only where a part's memory (``PART``) limits it, or up to
  ``OUTWEIGH`` times for parts enough for all cores. A task holds one part's rows and lets
  the queries stream past.
* Blocks of queries and bins are compared in single precision; what may be among the best
  ``k`` within the rounding of that is compared again in double precision.

Nearness is the cosine in double precision on the original vectors, the same for equal
vectors wherever they lie; ties go to the smaller vec_id.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite
components take no part. Vectors of different lengths are not compared. Each query row
excludes itself only, so a repeated row is a neighbour of its copies. Rows without
vec_id are candidates (last among ties) and never queries. Other columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from pricelake.llm.common import received, saved, sent
from pricelake.llm.vectors import cosines, doubles, matrix, unit, usable

K = 5
RECALL = 0.97
SAMPLE = 20_000  # rows that the tree is fitted on
CALIBRATION = 256  # queries that the number of visits is calibrated on
BRANCH = 16
LEAF_SAMPLE = 64
ITERATIONS = 8
ROW_BLOCK, QUERY_BLOCK = 2048, 2048
TILE, PIECES, PIECE = 512, 8, 256  # queries and pieces that are compared at once, rows of a piece
PART = 2**24  # components of the rows that a task holds
OUTWEIGH = 16
UNIT_BLOCK = 2**20  # components that are scaled or compared in double precision at once
NO_ID = 2**63 - 1  # sorts rows without vec_id last


@dataclass
class Tree:
    """Nodes by number; node 0 is the root, a node without children a leaf."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[np.ndarray] = field(default_factory=list)

    def add(self, points: np.ndarray, rng: np.random.Generator) -> int:
        node = len(self.children)
        self.children.append(np.zeros(0, np.int64))
        self.centres.append(np.zeros((0, points.shape[1])))
        if len(points) > LEAF_SAMPLE:
            centres, owner = kmeans(points, BRANCH, rng)
            parts = np.unique(owner)
            if len(parts) > 1:
                self.centres[node] = centres[parts]
                self.children[node] = np.array([self.add(points[owner == p], rng) for p in parts])
        return node

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(self.children[node]):
                leaf[rows] = node
                continue
            best = (x[rows] @ self.centres[node].T).argmax(axis=1)
            for b in np.unique(best):
                todo.append((int(self.children[node][b]), rows[best == b]))
        return leaf

    def walk(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue = [(-2.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not len(self.children[node]):
                yield node
            else:
                near = self.centres[node] @ query
                for similarity, child in zip(near.tolist(), self.children[node].tolist(), strict=True):
                    heapq.heappush(queue, (-similarity, child))

    def leaves(self) -> np.ndarray:
        return np.array([n for n, below in enumerate(self.children) if not len(below)], np.int64)

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All centres, and for each leaf the numbers of those on its way, root first, -1 behind the last."""
        ways, centres, todo = {}, [np.zeros((0, self.centres[0].shape[1]))], [(0, [])]
        below = 0
        while todo:
            node, way = todo.pop()
            if not len(self.children[node]):
                ways[node] = way
            centres.append(self.centres[node])
            for i, child in enumerate(self.children[node].tolist()):
                todo.append((child, [*way, below + i]))
            below += len(self.children[node])
        out = np.full((len(ways), max(1, *map(len, ways.values())) if len(ways) > 1 else 1), -1, np.int64)
        for i, leaf in enumerate(sorted(ways)):
            out[i, : len(ways[leaf])] = ways[leaf]
        return np.concatenate(centres), out


def first_in_walk(near: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` leaves of the walk of each query, as a mask.

    ``near``: similarities of the centres on each leaf's way (queries x leaves x depth, infinite
    behind the last). A node comes out of the queue when no better one is left, so leaves come
    out by the least similarity on their way; those that share it lie below the node that has it
    and come out by the least one further down, and so on.
    """
    least = near.min(axis=2)
    leaves = least.shape[1]
    if n >= leaves:
        return np.ones(least.shape, bool)
    last = np.partition(least, leaves - n, axis=1)[:, leaves - n, None]
    out = least > last
    level = least == last
    missing = n - out.sum(axis=1)
    whole = level.sum(axis=1) == missing
    out[whole] |= level[whole]
    for q in np.flatnonzero(~whole):
        among = np.flatnonzero(level[q])
        way, keys = near[q, among], []
        depth = np.arange(way.shape[1])
        for _ in depth:
            keys.append(-way.min(axis=1))
            lowest = depth[-1] - way[:, ::-1].argmin(axis=1)
            way = np.where(depth <= lowest[:, None], np.inf, way)
        out[q, among[np.lexsort(keys[::-1])[: missing[q]]]] = True
    return out


def kmeans(points: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    owner = np.zeros(len(points), np.int64)
    for _ in range(ITERATIONS):
        owner = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, points)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres, (points @ centres.T).argmax(axis=1)


def fit(sample: pd.DataFrame) -> dict[int, Tree]:
    """A tree for each vector length."""
    trees = {}
    for dim, rows in sample.groupby(sample.embedding.map(len)):
        tree = trees[int(dim)] = Tree()
        tree.add(unit(matrix(rows.embedding)), np.random.default_rng(7))
    return trees


def _by_dim(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places and matrix of the vectors of each length."""
    dims = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        own = vectors if len(rows) == len(dims) else vectors.take(pa.array(rows))
        yield int(dim), rows, own.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim)


def _leaf_of(trees: dict[int, Tree], dim: int, x: np.ndarray) -> np.ndarray:
    """-1 for vectors of a length that the sample does not hold."""
    return trees[dim].leaf_of(unit(x.astype(np.float64))) if dim in trees else np.full(len(x), -1, np.int64)


LEAVES = "dim int, leaf long, n long, asking long"


def _leaves(trees) -> Callable:
    """Rows and queries of each leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(trees)
        for batch in batches:
            asks = batch["asks"].to_numpy(zero_copy_only=False)
            for dim, rows, x in _by_dim(batch["embedding"]):
                leaf, at = np.unique(_leaf_of(own, dim, x), return_inverse=True)
                n, asking = np.bincount(at), np.bincount(at, weights=asks[rows]).astype(np.int64)
                columns = [np.full(len(leaf), dim, np.int32), leaf, n, asking]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["dim", "leaf", "n", "asking"])

    return run


def bins_of(sizes: dict[int, int], block: int) -> dict[int, int]:
    """The bin of each leaf: leaves in order, together while they hold at most ``block`` rows."""
    out, current, held = {}, -1, block
    for leaf in sorted(sizes):
        if held + sizes[leaf] > block:
            current, held = current + 1, 0
        held += sizes[leaf]
        out[leaf] = current
    return out


@dataclass
class Layout:
    """Where rows and queries of one vector length go."""

    leaves: np.ndarray  # sorted; those that hold rows
    sizes: np.ndarray  # their rows
    bins: np.ndarray  # their bins
    first: np.ndarray  # of each bin: its first part, the number of its parts, its place in them
    parts: np.ndarray
    place: np.ndarray
    spans: list[tuple[int, int, int]]  # number, first bin and the bin behind the last of each part
    least: int  # leaves that a query visits


def layout_of(sizes: dict[int, int], least: int, part_rows: int, number: int) -> Layout:
    """Parts are numbered from ``number`` on."""
    leaves = np.array(sorted(sizes), np.int64)
    bin_of = bins_of(sizes, ROW_BLOCK)
    bins = np.array([bin_of[leaf] for leaf in leaves.tolist()])
    rows = np.array([sizes[leaf] for leaf in leaves.tolist()])
    held = np.bincount(bins, weights=rows).astype(np.int64).tolist()
    first, parts, place, spans, room = [], [], [], [], 0
    for b, n in enumerate(held):
        if n > room:
            parts.append(max(1, -(-n // part_rows)))
            first.append(number)
            spans += [(number + i, b, b + 1) for i in range(parts[-1])]
            number += parts[-1]
            room = part_rows - n if parts[-1] == 1 else 0
            place.append(0)
        else:
            room -= n
            parts.append(1)
            first.append(spans[-1][0])
            place.append(b - spans[-1][1])
            spans[-1] = (*spans[-1][:2], b + 1)
    return Layout(leaves, rows, bins, np.array(first), np.array(parts), np.array(place), spans, least)


def _bins_visited(tree: Tree | None, layout: Layout, x: np.ndarray, rows: int) -> np.ndarray:
    """Queries x bins: the first ``least`` leaves, and further ones until they hold ``rows`` rows."""
    out = np.zeros((len(x), int(layout.bins[-1]) + 1), bool)
    if tree is None:
        return ~out
    x = unit(x.astype(np.float64))
    centres, ways = tree.paths()
    at = np.searchsorted(tree.leaves(), layout.leaves)
    for lo in range(0, len(x), 64):
        some = x[lo : lo + 64]
        near = np.concatenate([some @ centres.T, np.full((len(some), 1), np.inf)], axis=1)[:, ways]
        n = layout.least
        left = np.arange(len(near))
        while len(left):  # nearly always once
            visited = first_in_walk(near[left], n)[:, at]
            enough = (visited @ layout.sizes >= rows) | (n >= len(ways))
            q, leaf = np.nonzero(visited[enough])
            out[lo + left[enough][q], layout.bins[leaf]] = True
            left, n = left[~enough], n + 1
    return out


def _placed(trees, layouts, k: int, schema: pa.Schema) -> Callable:
    """Each row for its part, each query for the parts in which it visits a bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_dim, own = received(trees), received(layouts)

        def out(batch, rows, part, kind, place, bits):
            some = batch.take(pa.array(rows))
            n = len(rows)
            columns = [
                pa.array(np.broadcast_to(part, n).astype(np.int64)),
                pa.array(np.full(n, kind, np.int32)),
                pa.array(np.broadcast_to(place, n).astype(np.int32)),
                pa.nulls(n, pa.binary()) if bits is None else pa.array([b.tobytes() for b in bits], pa.binary()),
                *(some[c] for c in ("vec_id", "row", "embedding")),
            ]
            columns = [c.cast(f.type) for c, f in zip(columns, schema, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            asks = batch["asks"].to_numpy(zero_copy_only=False)
            row = batch["row"].to_numpy()
            for dim, rows, x in _by_dim(batch["embedding"]):
                if dim not in own:  # nobody asks
                    continue
                layout = own[dim]
                at = np.searchsorted(layout.leaves, _leaf_of(by_dim, dim, x)).clip(max=len(layout.leaves) - 1)
                b = layout.bins[at]
                mixed = (row[rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                part = layout.first[b] + (mixed % layout.parts[b].astype(np.uint64)).astype(np.int64)
                yield out(batch, rows, part, 0, layout.place[b], None)
                asking = np.flatnonzero(asks[rows])
                if not len(asking):
                    continue
                visited = _bins_visited(by_dim.get(dim), layout, x[asking], k + 1)
                for number, lo, hi in layout.spans:
                    there = visited[:, lo:hi].any(axis=1)
                    if there.any():
                        yield out(batch, rows[asking[there]], number, 1, -1, np.packbits(visited[there, lo:hi], axis=1))

    return run


def distinct(x: np.ndarray, bins: np.ndarray, vec_id: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows by bin; of equal vectors in a bin the first k + 1, as no other is ever among the best k."""
    words = np.ascontiguousarray(x).view(np.uint32)
    odd = np.random.default_rng(1).integers(0, 2**63, words.shape[1], dtype=np.uint64) | np.uint64(1)
    key = np.einsum("ij,j->i", words, odd)
    order = np.lexsort((row, vec_id, key, bins))
    again = (bins[order][1:] == bins[order][:-1]) & (key[order][1:] == key[order][:-1])
    step = max(1, UNIT_BLOCK // words.shape[1])
    same = np.flatnonzero(again)
    for i in range(0, len(same), step):
        at = same[i : i + step]
        again[at] = (words[order[at]] == words[order[at + 1]]).all(axis=1)
    number = np.arange(len(order))
    start = np.maximum.accumulate(np.where(np.concatenate([[False], again]), 0, number))
    return order[number - start <= k]


class Block:
    """Rows of one vector length, for which queries find the best."""

    def __init__(self, held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], k: int):
        """``held``: vectors, bins, vec_ids and row numbers, some at a time; empty afterwards, as memory counts."""
        x, bins, vec_id, row = (np.concatenate([some[c] for some in held]) for c in range(4))
        held.clear()
        kept = distinct(x, bins, vec_id, row, k)
        x, bins = x[kept], bins[kept]
        self.k, self.x, self.vec_id, self.row = k, x, vec_id[kept], row[kept]
        self.unit = np.empty(x.shape, np.float32)
        step = max(1, UNIT_BLOCK // x.shape[1])
        for i in range(0, len(x), step):
            self.unit[i : i + step] = unit(x[i : i + step].astype(np.float64))
        starts = np.searchsorted(bins, np.arange(bins[-1] + 2))
        pieces = [np.arange(lo, hi, PIECE) for lo, hi in zip(starts[:-1], starts[1:], strict=True)]
        self.pieces = np.concatenate([*pieces, [len(x)]])  # where each begins; none holds rows of two bins
        self.bins = np.searchsorted(self.pieces, starts)  # the first piece of each bin
        # twice what a product of two such vectors may be off by
        self.margin = np.float32((x.shape[1] + 4) * 2.0**-23)
        self.room = np.empty(0, np.float32)

    def highest(self, queries: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """The largest product of each query with the rows of each piece from ``lo`` to ``hi``."""
        start, end = self.pieces[lo], self.pieces[hi]
        n = len(queries) * (end - start)
        if len(self.room) < n:
            self.room = np.empty(n, np.float32)
        near = np.matmul(self.unit[start:end], queries.T, out=self.room[:n].reshape(-1, len(queries)))
        whole = (end - start) // PIECE
        out = near[: whole * PIECE].reshape(whole, PIECE, len(queries)).max(axis=1)
        return out if whole == hi - lo else np.concatenate([out, near[None, whole * PIECE :].max(axis=1)])

    def best(self, x: np.ndarray, row: np.ndarray, visited: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, place and score of the best k rows for each query in the bins it visits.

        A query's k + 1 best pieces hold as many rows, itself perhaps among them, so none of its
        best k is below the least of their largest products. Few pieces have rows above that.
        """
        queries = unit(x.astype(np.float64)).astype(np.float32)
        top = np.full((len(self.pieces) - 1, len(x)), -np.inf, np.float32)
        for b in range(min(len(self.bins) - 1, visited.shape[1])):
            lo, hi = self.bins[b : b + 2].tolist()
            asking = np.flatnonzero(visited[:, b]) if lo < hi else ()
            for a in range(0, len(asking), TILE):
                some = asking[a : a + TILE]
                for c in range(lo, hi, PIECES):
                    d = min(c + PIECES, hi)
                    top[c:d, some] = self.highest(queries[some], c, d)
        cut = np.full(len(x), -np.inf, np.float32)
        if len(top) > self.k:
            cut = np.partition(top.T, len(top) - self.k - 1, axis=1)[:, len(top) - self.k - 1] - self.margin
        piece, query = np.nonzero((top >= cut) & ~np.isneginf(top))
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        new, held = [], 0
        change = np.flatnonzero(np.diff(piece, prepend=-1)).tolist()
        for lo, hi in zip(change, [*change[1:], len(piece)], strict=True):
            start, end = self.pieces[piece[lo] : piece[lo] + 2].tolist()
            asking = query[lo:hi]
            near = queries[asking] @ self.unit[start:end].T
            i, j = np.divmod(np.flatnonzero(near >= cut[asking, None]), end - start)
            new.append((asking[i], j + start))
            held += len(i)
            if held > UNIT_BLOCK:
                found, new, held = self.better(x, row, found, new), [], 0
        return self.better(x, row, found, new)

    def better(self, x, row, found, new) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best k rows for each query among those found and new ones, which have no score yet."""
        i, j = (np.concatenate([pair[a] for pair in new] or [found[0][:0]]) for a in (0, 1))
        other = row[i] != self.row[j]
        i, j = i[other], j[other]
        step = max(1, UNIT_BLOCK // x.shape[1])
        score = [
            cosines(x[i[a : a + step]].astype(np.float64), self.x[j[a : a + step]].astype(np.float64))
            for a in range(0, len(i), step)
        ]
        i, j, score = (np.concatenate([a, *b]) for a, b in zip(found, ([i], [j], score), strict=True))
        order = np.lexsort((self.row[j], self.vec_id[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        number = np.arange(len(i))
        best = number - np.searchsorted(i, i) < self.k
        return i[best], j[best], score[best]


FOUND = "query long, query_id long, vec_id long, row long, score double"


def _found(query, query_id, block: Block, i, j, score, **more) -> pa.RecordBatch:
    columns = {"query": query[i], "query_id": query_id[i], "vec_id": block.vec_id[j], "row": block.row[j], "score": score}
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in (columns | more).items()})


def _all_rows(trees, queries, k: int) -> Callable:
    """The best k of each batch for the calibration queries, with their leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, probes = received(trees), received(queries)
        for batch in batches:
            vec_id, row = batch["vec_id"].to_numpy(), batch["row"].to_numpy()
            for dim, rows, x in _by_dim(batch["embedding"]):
                same = probes[probes.embedding.map(len) == dim]
                if len(same):
                    block = Block([(x, np.zeros(len(x), np.int64), vec_id[rows], row[rows])], k)
                    ids = same.row.to_numpy()
                    i, j, score = block.best(matrix(same.embedding), ids, np.ones((len(same), 1), bool))
                    leaf = _leaf_of(own, dim, block.x[j])
                    yield _found(ids, same.vec_id.to_numpy(), block, i, j, score, leaf=leaf)

    return run


def _search(k: int) -> Callable:
    """The best k rows of each part for each of its queries; rows come before queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, block = None, [], None
        for batch in batches:
            part, kind = batch["part"].to_numpy(), batch["kind"].to_numpy()
            change = np.flatnonzero((part[1:] != part[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *change.tolist()], [*change.tolist(), len(part)], strict=True):
                if lo == hi:
                    continue
                if part[lo] != current:
                    current, held, block = part[lo], [], None
                if kind[lo] == 0:
                    some = batch.slice(lo, hi - lo)
                    [(_, _, x)] = _by_dim(some["embedding"])
                    held.append((x, *(some[c].to_numpy() for c in ("bin", "vec_id", "row"))))
                    continue
                if held:
                    block = Block(held, k)
                for a in range(lo, hi, QUERY_BLOCK) if block else ():
                    asked = batch.slice(a, min(QUERY_BLOCK, hi - a))
                    [(_, _, x)] = _by_dim(asked["embedding"])
                    bits = np.frombuffer(b"".join(asked["bits"].to_pylist()), np.uint8).reshape(len(x), -1)
                    query = asked["row"].to_numpy()
                    i, j, score = block.best(x, query, np.unpackbits(bits, axis=1).astype(bool))
                    yield _found(query, asked["vec_id"].to_numpy(), block, i, j, score)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def calibrate(trees: dict[int, Tree], truth: pd.DataFrame, queries: pd.DataFrame, recall: float) -> dict[int, int]:
    """Leaves to visit, by vector length, so that ``recall`` of the true neighbours lie in them."""
    least = dict.fromkeys(trees, 1)
    leaves = truth.groupby("query").leaf.apply(list)
    for dim, tree in trees.items():
        places = []
        for row, v in zip(queries.row, queries.embedding, strict=True):
            if len(v) == dim and row in leaves:
                place = {leaf: i + 1 for i, leaf in enumerate(tree.walk(unit(np.array(v)[None])[0]))}
                places += [place[leaf] for leaf in leaves[row]]
        if places:
            least[dim] = int(np.sort(places)[max(0, int(np.ceil(recall * len(places))) - 1)])
    return least


def first_by_hash(rows: DataFrame, n: int) -> pd.DataFrame:
    """The ``n`` rows whose ``row`` comes first by its hash; all of them where there are fewer.

    Each task would send its own first ``n``. So rows are cut off first at a hash that little
    more than ``n`` of all rows lie below, and later at higher ones if fewer lie there.
    """
    order = F.xxhash64("row")
    total = rows.count()
    wanted = n + 8 * math.isqrt(n) + 16
    while True:
        below = -(2**63) + 2**64 * wanted // max(total, 1)
        least = rows if wanted >= total else rows.where(order < F.lit(below))
        out = least.orderBy(order, "row").limit(n).toPandas()
        if len(out) == min(n, total):
            return out
        wanted *= 2


def nearest(
    rows: DataFrame, is_query: str, k: int = K, recall: float = RECALL, sample: int = SAMPLE
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows for which the SQL text ``is_query`` holds.

    ``rows`` has (vec_id, embedding); all of them are candidates.
    """
    spark = rows.sparkSession
    no_id = F.lit(NO_ID)
    some = rows.where(usable())
    kind = "float" if isinstance(rows.schema["embedding"].dataType.elementType, FloatType) else "double"
    valid = (some if kind == "float" else doubles(some)).select(
        F.coalesce(F.expr(f"vec_id is not null and ({is_query})"), F.lit(False)).alias("asks"),
        F.coalesce(F.col("vec_id").cast("long"), no_id).alias("vec_id"),
        "embedding",
    )
    valid = saved(valid.withColumn("row", F.monotonically_increasing_id()), "vectors")
    trees = fit(first_by_hash(valid.select("row", "embedding"), sample))
    shared = sent(spark, trees)
    counts = valid.select("asks", "embedding").mapInArrow(_leaves(shared), LEAVES).groupBy("dim", "leaf")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("asking").alias("asking")).toPandas()  # nodes of the trees
    asking = valid.where("asks").drop("asks")
    probes = first_by_hash(asking, CALIBRATION)
    truth = valid.mapInArrow(_all_rows(shared, sent(spark, probes), k), f"{FOUND}, leaf long")
    least = calibrate(trees, _ranked(truth, k).toPandas(), probes, recall)
    layouts, number, tasks = {}, 0, 4 * spark.sparkContext.defaultParallelism
    for dim, own in counts.groupby("dim"):
        queries = int(own.asking.sum())
        if queries:
            part_rows = max(ROW_BLOCK, queries // OUTWEIGH, min(queries, -(-int(own.n.sum()) // tasks)))
            part_rows = max(1, min(part_rows, PART // max(int(dim), 64)))
            sizes = dict(zip(own.leaf.tolist(), own.n.tolist(), strict=True))
            layouts[int(dim)] = layout_of(sizes, least.get(int(dim), 1), part_rows, number)
            number = layouts[int(dim)].spans[-1][0] + 1
    columns = f"part long, kind int, bin int, bits binary, vec_id long, row long, embedding array<{kind}>"
    vector = pa.list_(pa.float32() if kind == "float" else pa.float64())
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), vector]
    schema = pa.schema([(c.split()[0], t) for c, t in zip(columns.split(", "), types, strict=True)])
    placed = valid.mapInArrow(_placed(shared, sent(spark, layouts), k, schema), columns)
    # more tasks than parts, as parts are dealt by their hash
    dealt = placed.repartition(3 * max(number, 1), "part").sortWithinPartitions("part", "kind")
    found = dealt.mapInArrow(_search(k), FOUND)
    return _ranked(found, k).select(
        "query_id",
        "rank",
        F.when(F.col("vec_id") != no_id, F.col("vec_id")).alias("vec_id"),
        "score",
    )
