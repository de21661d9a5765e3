"""Near-duplicate vectors by cover trees: all pairs at or above a cosine, found by dual traversal.

Unit vectors at cosine c are sqrt(2 - 2c) apart, so the threshold is a distance. The upper part of
the tree is a net of centres from a bounded sample; every vector is dealt to its nearest centre and
the covering radii are taken over all vectors. Cells are dealt into blocks, each with a cover tree
whose levels are nested and halve their radii. Pairs of blocks whose cells can reach each other
are traversed together: a pair of nodes farther apart than the threshold and both covering radii is
pruned, a pair nearer than the threshold less both radii is linked as a whole, leaves are compared
vector by vector in double precision.

Products of centres are first taken of a few principal directions with the length of the rest, which
bounds the cosine from above; only rows that pass are multiplied in full.

Equal vectors are one node with a multiplicity. Blocks are stored once, several to a row, and a task
reads the two sets of rows whose blocks it compares: nothing is shuffled for a pair of blocks. A task
returns, for each vector with a link, its number of links and a spanning star, never the pairs. Where
vectors lie in no clusters at all, covering radii prune little and the work nears all pairs of blocks;
results do not change.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing and are their own component; so do vectors of different lengths; null ids never name a
component; labels and other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ticketlens.llm.common import bounded_batches, components, discard, label_components, store, swept_shuffles

SAMPLE = 2048
CENTRES = 256
BLOCK = 2048
# Blocks in one stored row at most; a small table has at least about so many rows.
_TOGETHER, _ROWS = 8, 16
# A node of so few vectors that is wider than this prunes less than it costs; its parts take its place.
_FEW, _WIDE = 16, 0.5
# Numbers of a vector's sketch: principal directions and the length of the rest.
_SKETCH = 24
# Where a cosine of so much is asked for, sketches are multiplied first and survivors measured again.
_STEEP = 0.85
# Levels end where a node's pairs are all far within the threshold of the default cosine.
_LEAF = 0.0625
# Bounds give way by this much, far above the rounding of a distance.
_SLACK = 1e-6


def unit(values) -> np.ndarray | None:
    """The vector over its length, or None if it has no direction."""
    if values is None or len(values) == 0 or any(v is None for v in values):
        return None
    x = np.asarray(values, np.float64)
    largest = np.abs(x).max()
    if not np.isfinite(largest) or largest == 0:
        return None
    x = x / largest
    return x / np.sqrt(x @ x)


def by_length(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, vectors as rows) of each length in a column of lists without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat, starts = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, flat[starts[at][:, None] + np.arange(size)]


def units(raw: np.ndarray) -> np.ndarray:
    """Rows with a direction over their lengths, as :func:`unit`."""
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return x


def _directions(sample: np.ndarray) -> np.ndarray | None:
    """The principal directions that sketches keep, or None where they would hardly be shorter."""
    if sample.shape[1] < 2 * _SKETCH:
        return None
    return np.ascontiguousarray(np.linalg.eigh(sample.T @ sample)[1][:, ::-1][:, : _SKETCH - 1])


class Tree:
    """A cover tree over the rows of one block: nodes with a contiguous range of rows each.

    ``order`` permutes the block's rows so that a node's rows are start..end-1 and its centre is the
    first of them; children stand next to each other, the first with the same centre.
    """

    def __init__(self, x: np.ndarray) -> None:
        gram = x @ x.T
        self.order: list[int] = []
        self.start, self.end, self.radius, self.child, self.children = [], [], [], [], []
        self._add(gram, [(np.arange(len(x)), 2.0)])
        self.order = np.array(self.order)
        self.start, self.end = np.array(self.start), np.array(self.end)
        self.radius, self.child, self.children = np.array(self.radius), np.array(self.child), np.array(self.children)
        del gram

    def _add(self, gram: np.ndarray, roots: list[tuple[np.ndarray, float]]) -> None:
        """Nodes level by level; members of a node are kept in order, centre first."""
        level = [(members, r, 0) for members, r in roots]
        self._node(gram, *level[0])
        queue = [(0, *level[0][:2])]
        done = 0
        while done < len(queue):
            node, members, r = queue[done]
            done += 1
            if len(members) == 1 or self.radius[node] <= _LEAF:
                self.order.extend(())  # leaves keep their members as they are
                self._leaf(node, members)
                continue
            while True:
                r /= 2
                groups = self._groups(gram, members, r)
                if len(groups) > 1 or r <= _LEAF / 2:
                    break
            self.child[node], at = len(self.start), self.start[node]
            waiting = [(group, r) for group in reversed(groups)]
            while waiting:
                group, r = waiting.pop()
                if 1 < len(group) <= _FEW and gram[group[0], group].min() < 1 - _WIDE * _WIDE / 2:
                    waiting.extend((part, r / 2) for part in reversed(self._groups(gram, group, r / 2)))
                    continue
                self._node(gram, group, r, at)
                queue.append((len(self.start) - 1, group, r))
                at += len(group)
            self.children[node] = len(self.start) - self.child[node]

    @staticmethod
    def _groups(gram: np.ndarray, members: np.ndarray, r: float) -> list[np.ndarray]:
        """Each first member that is left with all others within ``r`` of it."""
        close = gram[np.ix_(members, members)] >= 1 - r * r / 2
        np.fill_diagonal(close, True)
        alone = close.sum(axis=1) == 1  # near no other, whatever is taken first
        taken = [(at, members[at : at + 1]) for at in np.flatnonzero(alone).tolist()]
        left = np.flatnonzero(~alone)
        while len(left):
            near = close[left[0], left]
            taken.append((int(left[0]), members[left[near]]))
            left = left[~near]
        return [group for _, group in sorted(taken, key=lambda t: t[0])]

    def _node(self, gram: np.ndarray, members: np.ndarray, r: float, start: int) -> None:
        lowest = float(gram[members[0], members].min())
        self.start.append(start)
        self.end.append(start + len(members))
        self.radius.append(0.0 if len(members) == 1 else float(np.sqrt(max(0.0, 2 - 2 * lowest))))
        self.child.append(0)
        self.children.append(0)

    def _leaf(self, node: int, members: np.ndarray) -> None:
        need = self.end[node] - len(self.order)
        if need > 0:
            self.order.extend([-1] * need)
        self.order[self.start[node] : self.end[node]] = members.tolist()


class Block:
    """A block's vectors in tree order, as a worker compares them."""

    def __init__(self, held: tuple, directions: np.ndarray | None) -> None:
        self.nodes, self.weights, raw, self.tree = held
        self.x = units(raw)
        self.x32, self.sketch = self.x.astype(np.float32), None
        self.classes = _radius_class(self.tree[2])
        if directions is not None and len(directions) == self.x.shape[1]:
            kept = self.x @ directions
            rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", kept, kept)))
            self.sketch = np.column_stack([kept, rest]).astype(np.float32)


def pack_block(nodes: np.ndarray, weights: np.ndarray, raw: np.ndarray) -> tuple:
    """A block's rows in tree order with their tree; vectors as they came, which single precision halves."""
    tree = Tree(units(raw))
    arrays = (tree.start, tree.end, tree.radius, tree.child, tree.children)
    return nodes[tree.order], weights[tree.order], raw[tree.order], arrays


class _Found:
    """Links found so far: weighted counts per row, and edges that span them."""

    def __init__(self, n: int) -> None:
        self.counts, self.a, self.b, self.n = np.zeros(n, np.int64), [], [], 0

    def edges(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.n += len(a)
        if self.n > 1 << 20:  # keep a star per component
            roots = self.roots()
            nodes = np.flatnonzero(roots != np.arange(len(roots)))
            self.a, self.b, self.n = [nodes], [roots[nodes]], 0

    def roots(self) -> np.ndarray:
        none = np.empty(0, np.int64)
        return label_components(len(self.counts), np.concatenate([none, *self.a]), np.concatenate([none, *self.b]))


def _radius_class(radius: np.ndarray) -> np.ndarray:
    """0 for single vectors, then one class for every halving of the radius."""
    return np.where(radius > 0, np.ceil(np.log2(np.maximum(radius, _LEAF / 4))) + 8, 0)


def _runs(classes: np.ndarray) -> list[np.ndarray]:
    """Positions of each class."""
    order = np.argsort(classes, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(classes[order])) + 1)


def merged(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Several results of :func:`traverse` as one: counts added up, a star per component of them all."""
    nodes, counts, roots = (np.concatenate(part) for part in zip(*found))
    ids, at = np.unique(np.concatenate([nodes, roots]), return_inverse=True)
    total = np.zeros(len(ids), np.int64)
    np.add.at(total, at[: len(nodes)], counts)
    return ids, total, ids[label_components(len(ids), at[: len(nodes)], at[len(nodes) :])]


def _at_least(left: np.ndarray, right: np.ndarray, bound: np.float32) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs whose product is at least the bound; few rows at a time, so that products stay in the cache."""
    us, vs, width = [], [], len(right)
    rows = max(1, (1 << 19) // width)
    out = np.empty((min(rows, len(left)), width), np.float32)
    for at in range(0, len(left), rows):
        part = left[at : at + rows]
        product = np.matmul(part, right.T, out=out[: len(part)])
        some = np.flatnonzero(product.max(axis=1) >= bound)
        if len(some):
            i, j = np.nonzero(product[some] >= bound)
            us.append(some[i] + at)
            vs.append(j)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *us]), np.concatenate([none, *vs])


def traverse(left: Block, right: Block | None, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, link counts, star centres) of the linked rows of two blocks, or of one with itself."""
    same = right is None
    right = left if same else right
    (ids_a, w_a, x), (ids_b, w_b, y) = (left.nodes, left.weights, left.x), (right.nodes, right.weights, right.x)
    (s_a, e_a, r_a, c_a, k_a), (s_b, e_b, r_b, c_b, k_b) = left.tree, right.tree
    tau, shift = np.sqrt(2 - 2 * cosine), 0 if same else len(ids_a)
    found = _Found(len(ids_a) if same else len(ids_a) + len(ids_b))

    def whole(i: int, j: int) -> None:
        a, b = np.arange(s_a[i], e_a[i]), np.arange(s_b[j], e_b[j]) + shift
        if same and i == j:
            found.counts[a] += w_a[a].sum() - w_a[a]
            found.edges(a[1:], np.full(len(a) - 1, a[0]))
        else:
            found.counts[a] += w_b[b - shift].sum()
            found.counts[b] += w_a[a].sum()
            found.edges(np.concatenate([a, b]), np.concatenate([np.full(len(a), b[0]), np.full(len(b), a[0])]))

    def leaves(i: int, j: int) -> None:
        linked = x[s_a[i] : e_a[i]] @ y[s_b[j] : e_b[j]].T >= cosine
        if same and i == j:
            np.fill_diagonal(linked, False)
            found.counts[s_a[i] : e_a[i]] += linked @ w_a[s_a[i] : e_a[i]]
        else:
            found.counts[s_a[i] : e_a[i]] += linked @ w_b[s_b[j] : e_b[j]]
            found.counts[s_b[j] + shift : e_b[j] + shift] += linked.T @ w_a[s_a[i] : e_a[i]]
        p, q = np.nonzero(linked)
        found.edges(p + s_a[i], q + s_b[j] + shift)

    x32, y32, class_a, class_b = left.x32, right.x32, left.classes, right.classes
    sketch_a, sketch_b = left.sketch, right.sketch

    def near(p: np.ndarray, q: np.ndarray, wanted: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Wanted pairs of nodes that are not pruned, with the distance of their centres.

        Nodes of one radius class share a bound, which one comparison of single-precision products
        (with room for their rounding) applies, of sketches first where it is steep: their product is
        never below that of the vectors. Survivors are measured in double precision where the bound is
        steep or nodes may be linked as a whole; others are taken to be anywhere, and their children compared.
        """
        us, vs, measured = [], [], []
        for some in _runs(class_a[p]):
            for other in _runs(class_b[q]):
                reach = tau + r_a[p[some]].max() + r_b[q[other]].max()
                bound = np.float32(1 - reach * reach / 2 - 1e-5)
                rows, cols = s_a[p[some]], s_b[q[other]]
                steep = sketch_a is not None and bound >= _STEEP
                if steep:
                    i, j = _at_least(sketch_a[rows], sketch_b[cols], bound)
                if not steep or len(i) * 64 > len(rows) * len(cols):
                    i, j = _at_least(x32[rows], y32[cols], bound)
                i, j = some[i], other[j]
                asked = wanted(i, j)
                us.append(p[i[asked]])
                vs.append(q[j[asked]])
                measured.append(np.full(len(us[-1]), bound >= _STEEP or reach <= 2 * tau))
        u, v, told = np.concatenate(us), np.concatenate(vs), np.concatenate(measured)
        apart, at = np.full(len(u), np.inf), np.flatnonzero(told)
        for some in np.split(at, range(65536, len(at), 65536)):
            cosines = np.einsum("ij,ij->i", x[s_a[u[some]]], y[s_b[v[some]]])
            apart[some] = np.sqrt(np.maximum(0, 2 - 2 * cosines))
        stays = ~told | (apart <= tau + _SLACK + r_a[u] + r_b[v])
        return u[stays], v[stays], apart[stays]

    def children(first: np.ndarray, number: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of all nodes, and the position of each one's parent among the nodes."""
        n = number[nodes]
        return np.repeat(first[nodes] - np.cumsum(n) + n, n) + np.arange(n.sum()), np.repeat(np.arange(len(nodes)), n)

    def below(nodes: np.ndarray) -> tuple:
        """All pairs of children of one parent."""
        kids, parent = children(c_a, k_a, nodes)
        return kids, kids, lambda i, j: (parent[i] == parent[j]) & (i <= j)

    def across(u: np.ndarray, v: np.ndarray, first: bool) -> tuple:
        """Children of the nodes of one side with the nodes that their parents are paired with."""
        (rows, i), (cols, j) = np.unique(u, return_inverse=True), np.unique(v, return_inverse=True)
        paired = np.zeros((len(rows), len(cols)), bool)
        paired[i, j] = True
        kids, parent = children(c_a, k_a, rows) if first else children(c_b, k_b, cols)
        if first:
            return kids, cols, lambda i, j: paired[parent[i], j]
        return rows, kids, lambda i, j: paired[i, parent[j]]

    root = np.zeros(1, np.int64)
    todo = [(root, root, lambda i, j: i <= j)] if len(ids_a) and len(ids_b) else []
    while todo:
        u, v, apart = near(*todo.pop())
        itself = (u == v) if same else np.zeros(len(u), bool)
        own = u[itself]
        own = own[e_a[own] - s_a[own] > 1]  # a single vector has no other
        close = 2 * r_a[own] <= tau - _SLACK
        for node in own[close].tolist():
            whole(node, node)
        own = own[~close]
        for node in own[k_a[own] == 0].tolist():
            leaves(node, node)
        if (k_a[own] > 0).any():
            todo.append(below(own[k_a[own] > 0]))
        u, v, apart = u[~itself], v[~itself], apart[~itself]
        single = (e_a[u] - s_a[u] == 1) & (e_b[v] - s_b[v] == 1)
        one, other = s_a[u[single]], s_b[v[single]]
        linked = np.einsum("ij,ij->i", x[one], y[other]) >= cosine
        one, other = one[linked], other[linked]
        np.add.at(found.counts, one, w_b[other])
        np.add.at(found.counts, other + shift, w_a[one])
        found.edges(one, other + shift)
        u, v, apart = u[~single], v[~single], apart[~single]
        sure = apart + r_a[u] + r_b[v] <= tau - _SLACK
        for i, j in zip(u[sure].tolist(), v[sure].tolist()):
            whole(i, j)
        u, v = u[~sure], v[~sure]
        # The wider node of a pair goes down first, so that the other meets all its children in one product.
        left = (k_a[u] > 0) & ((k_b[v] == 0) | (r_a[u] >= r_b[v]))
        right_ = (k_b[v] > 0) & ~left
        for i, j in zip(u[~left & ~right_].tolist(), v[~left & ~right_].tolist()):
            leaves(i, j)
        if left.any():
            todo.append(across(u[left], v[left], True))
        if right_.any():
            todo.append(across(u[right_], v[right_], False))
    roots, linked = found.roots(), np.flatnonzero(found.counts)
    ids = ids_a if same else np.concatenate([ids_a, ids_b])
    return ids[linked], found.counts[linked], ids[roots[linked]]


def _centres(sample: np.ndarray, most: int) -> np.ndarray:
    """Centres of the finest net that still has at most ``most``: radii halve, levels are nested."""
    chosen, r = [0], 2.0
    gram = sample @ sample.T
    while len(chosen) < most and r > _LEAF:
        r /= 2
        lowest = gram[chosen].max(axis=0)
        while len(chosen) < most and lowest.min() < 1 - r * r / 2:
            chosen.append(int(np.argmin(lowest)))
            lowest = np.maximum(lowest, gram[chosen[-1]])
    return sample[chosen]


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.95,
    sample: int = SAMPLE,
    centres: int = CENTRES,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: id, ``n_links`` (other rows at or above the cosine) and ``component_id``."""
    bounded_batches(vectors.sparkSession)
    with swept_shuffles(vectors.sparkSession):
        keys, named = _named(vectors, id_col, vector_col, cosine, sample, centres, block)
    if named is None:
        return keys.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return keys.join(named, ["h1", "h2"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("c")).alias("component_id"),
    )


def _named(
    vectors: DataFrame, id_col: str, vector_col: str, cosine: float, sample: int, centres: int, block: int
) -> tuple[DataFrame, DataFrame | None]:
    """(id, hashes) of all rows, and (hashes, ``n_links``, component) of all different usable vectors."""
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    # Single-precision vectors stay so on disk; every use widens them, which loses nothing.
    given = vectors.select(vector_col).schema[0].dataType
    narrow = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType)
    kept = F.col(vector_col) if narrow else v
    rows = store(
        vectors.select(F.col(id_col).alias("id"), F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(1), v).alias("h2"), kept.alias("v")), "rows"
    )
    usable = rows.where(F.size("v") > 0).where(
        ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists("v", lambda c: c != 0)
    )
    distinct = usable.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.any_value("v").alias("v"))
    nodes = store(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    keys = store(rows.select("id", "h1", "h2"), "keys")
    discard(rows)
    wide = F.col("v").cast("array<double>")
    told = [unit(r["v"]) for r in nodes.select("v").orderBy(F.xxhash64(wide), wide).limit(sample).collect()]
    if not told:
        return keys, None
    sizes = [len(t) for t in told]
    dim = max(set(sizes), key=lambda d: (sizes.count(d), -d))
    known = np.stack([t for t in told if len(t) == dim])
    net, directions = _centres(known, centres), _directions(known)

    def nearest(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each vector and its distance from the centre."""
        cells, apart = np.full(len(column), -1), np.zeros(len(column))
        for at, raw in by_length(column):
            if raw.shape[1] == dim:
                cosines = units(raw) @ net.T
                cells[at] = cosines.argmax(axis=1)
                apart[at] = np.sqrt(np.maximum(0, 2 - 2 * cosines.max(axis=1)))
        return cells, apart

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, radius = np.zeros(len(net) + 1, np.int64), np.zeros(len(net) + 1)
        for batch in batches:
            cells, apart = nearest(batch.column("v"))
            np.add.at(number, cells, 1)
            np.maximum.at(radius, cells, apart)
        cells = np.flatnonzero(number)
        told = [pa.array(np.where(cells == len(net), -1, cells)), pa.array(number[cells]), pa.array(radius[cells])]
        yield pa.RecordBatch.from_arrays(told, ["cell", "n", "r"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest(batch.column("v"))[0])], [*batch.schema.names, "cell"])

    surveyed = nodes.select("v").mapInArrow(survey, "cell long, n long, r double")
    cells = {r["cell"]: r for r in surveyed.groupBy("cell").agg(F.sum("n").alias("n"), F.max("r").alias("r")).collect()}
    together = int(min(_TOGETHER, max(1, sum(c["n"] for c in cells.values()) // (block * _ROWS))))
    groups, first, parts = _groups(cells, block * together)
    reach = np.zeros((len(parts), len(parts)), bool)
    for g, h in _reachable(cells, groups, net, np.sqrt(2 - 2 * cosine)):
        reach[g, h] = reach[h, g] = True
    of_cell = spark.createDataFrame(
        [(c, g, first[g], parts[g]) for c, g in groups.items()], "cell long, held_group long, first long, parts long"
    )
    form = f"node long, n long, v array<{'float' if narrow else 'double'}>, cell long"
    placed = (
        nodes.select("node", "n", "v")
        .mapInArrow(deal, form)
        .join(F.broadcast(of_cell), "cell")
        .withColumn("held", F.col("first") + F.pmod(F.xxhash64("node"), F.col("parts")))
        .select("held", "held_group", "cell", "node", "n", "v")
    )

    def build(table: pa.Table) -> pa.Table:
        cell, ids, weights = (table.column(c).to_numpy() for c in ("cell", "node", "n"))
        blocks = []
        for at, raw in by_length(table.column("v")):
            order = np.argsort(cell[at], kind="stable")
            for some in np.array_split(order, -(-len(order) // block)):
                blocks.append(pack_block(ids[at[some]], weights[at[some]], raw[some]))
        group = table.column("held_group")[0].as_py()
        told = [[group], [np.flatnonzero(reach[group]).tolist()], [pickle.dumps(blocks, protocol=5)]]
        return pa.table([table.column("held").slice(0, 1), *map(pa.array, told)], names=["held", "group", "reach", "blocks"])

    blocks = store(placed.groupBy("held").applyInArrow(build, "held long, group long, reach array<long>, blocks binary"), "blocks")
    names = store(nodes.select("h1", "h2", "node", "n", "rep"), "names")
    discard(nodes)
    # A product of stored tables without a shuffle: a task reads one partition of each. Of the two orders of a pair
    # one is taken, by turns, so that every task has about as much to do.
    side = lambda name: blocks.select(*(F.col(c).alias(f"{c}_{name}") for c in blocks.columns))
    a, b = F.col("held_a"), F.col("held_b")
    turn = (a == b) | (F.when(a < b, 0).otherwise(1) == (a + b) % 2)
    met = side("a").join(side("b").hint("shuffle_replicate_nl"), turn & F.array_contains("reach_a", F.col("group_b")))
    loaded = met.select("held_a", "blocks_a", "held_b", "blocks_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found, n = (None, []), [], 0
        opened = lambda data: [Block(one, directions) for one in pickle.loads(data.as_buffer())]
        for batch in batches:
            for row in range(batch.num_rows):
                i, j = batch.column("held_a")[row].as_py(), batch.column("held_b")[row].as_py()
                if held[0] != i:
                    held = i, opened(batch.column("blocks_a")[row])
                others = held[1] if i == j else opened(batch.column("blocks_b")[row])
                for p, left in enumerate(held[1]):
                    for right in others[p:] if i == j else others:
                        if left.x.shape[1] == right.x.shape[1]:
                            found.append(traverse(left, None if left is right else right, cosine))
                            n += len(found[-1][0])
                if n > 1 << 20:
                    found = [merged(found)]
                    n = 0
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in merged(found)], ["node", "n", "root"])

    links = store(loaded.mapInArrow(run, "node long, n long, root long"), "links")
    counts = links.groupBy("node").agg(F.sum("n").alias("n_links"))
    roots = store(components(links.select("node", "root")), "roots")
    # Kept as a table: a join with an aggregate could not split the rows of a large component.
    lowest = store(names.join(roots, "node").groupBy("root").agg(F.min("rep").alias("lowest")), "lowest")
    named = store(
        names.join(counts, "node", "left")
        .join(roots, "node", "left")
        .join(lowest, "root", "left")
        .select("h1", "h2", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("lowest", "rep").alias("c")),
        "named",
    )
    discard(names, blocks, links, roots, lowest)
    return keys, named


def _groups(cells: dict, block: int) -> tuple[dict[int, int], list[int], list[int]]:
    """Cells to groups of about ``block`` vectors, large cells alone in several parts; first part and parts per group.

    Vectors of another length (cell -1) are a group of their own.
    """
    groups, first, parts, total, held = {}, [], [], 0, 0
    for cell in sorted(cells):
        n = cells[cell]["n"]
        if not parts or held + n > block or -1 in groups and len(groups) == 1:
            first.append(total)
            parts.append(max(1, -(-n // block)))
            total, held = total + parts[-1], 0
        groups[cell], held = len(parts) - 1, held + n
    return groups, first, parts


def _reachable(cells: dict, groups: dict[int, int], net: np.ndarray, tau: float) -> list[tuple[int, int]]:
    """Pairs of groups with a pair of cells whose vectors can be within the threshold."""
    known = [c for c in sorted(cells) if c >= 0]
    radius = np.array([cells[c]["r"] for c in known])
    apart = np.sqrt(np.maximum(0, 2 - 2 * (net[known] @ net[known].T)))
    p, q = np.nonzero(apart <= tau + radius[:, None] + radius + _SLACK)
    found = {tuple(sorted((groups[known[i]], groups[known[j]]))) for i, j in zip(p.tolist(), q.tolist())}
    return sorted(found | ({(groups[-1], groups[-1])} if -1 in groups else set()))
