"""Pairs of vectors above a cosine threshold, by dual traversal of cover trees.

On the unit sphere a cosine of at least c is a distance of at most sqrt(2 - 2c). The vectors of a label are divided
by levels of centres with halving radii, in Spark rounds, until a node fits a block; node pairs
whose centres are further apart than the threshold and both covering radii are dropped, level by level, and the
blocks of the others meet by joins on the node names. Inside a block the levels go on down to single vectors, and
two blocks are traversed together: a node pair is dropped by the same bound, taken as a whole when even
its furthest members are near enough, and otherwise replaced by the pairs of its children. Single vectors are compared by
their cosine. Covering radii are measured, so the result is exact however well the centres fit.

Equal vectors of a label are one vector with a count. Links are not listed: a block pair gives each vector's
number of links and, for the components, at most one link per vector.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillgauge.llm.common import ready
from rillgauge.llm.components import components
from rillgauge.session import materialised

BLOCK_VALUES = 8192 * 64  # numbers in a block of vectors, at most
FAN = 32  # centres of a node in a Spark level, at most
SAMPLE = 1024  # vectors of a node that its centres are chosen from
LEVELS = 8  # Spark levels; a node that is still too large then is cut into blocks as it is
SHARE = 20_000  # vectors assigned to centres by one task
FINEST = 2.0**-5  # radius of the last level inside a block above single vectors
MARGIN = 1e-6  # of distances, far above rounding errors; closer cases are decided by cosines
PAIRS = 2_000_000  # node pairs looked at together


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of all rows of a with all rows of b."""
    return (a @ b.T) / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :])


def distances(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def net(rows: np.ndarray, radius: float, most: int) -> list[int]:
    """Centres more than ``radius`` apart, the first row first; the furthest row is the next, ``most`` at most."""
    chosen = [0]
    far = distances(cosines(rows, rows[:1])[:, 0])
    while len(chosen) < most:
        k = int(far.argmax())
        if far[k] <= radius:
            break
        chosen.append(k)
        far = np.minimum(far, distances(cosines(rows, rows[k : k + 1])[:, 0]))
    return chosen


@dataclass
class Tree:
    """Nested levels over the rows in ``order``; a node covers a range of it.

    Per level: the centres (rows), first and last place of each node's range, its covering radius, and where its
    children begin in the next level. The last level has single rows.
    """

    rows: np.ndarray
    order: np.ndarray
    centre: list[np.ndarray]
    start: list[np.ndarray]
    end: list[np.ndarray]
    radius: list[np.ndarray]
    child: list[np.ndarray]


def tree(rows: np.ndarray) -> Tree:
    """Levels of radius 2, 1, 1/2, ... FINEST and single rows; a child's centre may be its parent's."""
    n = len(rows)
    norms = np.linalg.norm(rows, axis=1)
    nodes = [(0, np.arange(n))]  # centre and members, in order
    built = []
    radius = 2.0
    while True:
        cover = [
            float(distances((rows[m] @ rows[c]) / (norms[m] * norms[c])).max()) if len(m) > 1 else 0.0 for c, m in nodes
        ]
        built.append((np.array([c for c, _ in nodes]), np.array([len(m) for _, m in nodes]), np.array(cover)))
        if all(len(m) == 1 for _, m in nodes):
            break
        radius = radius / 2 if radius > FINEST else 0.0
        below, kids = [], []
        for centre, members in nodes:
            kids.append(len(below))
            left = members
            if radius == 0.0:
                below += [(int(i), np.array([i])) for i in left]
                continue
            while len(left):
                near = distances((rows[left] @ rows[centre]) / (norms[left] * norms[centre])) <= radius
                near |= left == centre
                below.append((int(centre), left[near]))
                left = left[~near]
                if len(left):
                    centre = left[0]
        built[-1] += (np.array([*kids, len(below)]),)
        nodes = below
    order = np.concatenate([m for _, m in nodes])
    ends = [np.cumsum(b[1]) for b in built]
    return Tree(
        rows, order, [b[0] for b in built], [e - b[1] for e, b in zip(ends, built)], ends, [b[2] for b in built],
        [b[3] for b in built[:-1]],
    )


def _center_cosines(a: Tree, b: Tree, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of row pairs: by a product of matrices when they fill much of it, else one by one."""
    ux, ix = np.unique(x, return_inverse=True)
    uy, iy = np.unique(y, return_inverse=True)
    if len(ux) * len(uy) <= 8 * len(x):
        return cosines(a.rows[ux], b.rows[uy])[ix, iy]
    p, q = a.rows[x], b.rows[y]
    return np.einsum("ij,ij->i", p, q) / (np.linalg.norm(p, axis=1) * np.linalg.norm(q, axis=1))


def traverse(a: Tree, b: Tree, weight_a: np.ndarray, weight_b: np.ndarray, least: float, same: bool):
    """Numbers of links of the rows of a and of b, and links that connect what is linked.

    ``same``: both are the same block, and each pair of rows counts once. Returned links are row numbers, those of b
    after those of a.
    """
    limit = float(np.sqrt(2.0 - 2.0 * least))
    shift = 0 if same else len(a.rows)
    count = np.zeros(shift + len(b.rows), dtype=np.int64)
    links: list[np.ndarray] = []
    ordered_a, ordered_b = np.cumsum(np.r_[0, weight_a[a.order]]), np.cumsum(np.r_[0, weight_b[b.order]])
    change_a, change_b = np.zeros(len(a.rows) + 1, dtype=np.int64), np.zeros(len(b.rows) + 1, dtype=np.int64)
    stack = [(0, 0, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while stack:
        la, lb, x, y = stack.pop()
        if len(x) > PAIRS:
            for at in range(0, len(x), PAIRS):
                stack.append((la, lb, x[at : at + PAIRS], y[at : at + PAIRS]))
            continue
        last_a, last_b = la == len(a.centre) - 1, lb == len(b.centre) - 1
        cosine = _center_cosines(a, b, a.centre[la][x], b.centre[lb][y])
        if last_a and last_b:
            hit = cosine >= least
            if same:
                hit &= a.order[x] != b.order[y]
            i, j = a.order[x[hit]], b.order[y[hit]]
            np.add.at(count, i, weight_b[j])
            np.add.at(count, j + shift, weight_a[i])
            links.append(np.stack([i, j + shift], axis=1))
            continue
        apart, reach = distances(cosine), a.radius[la][x] + b.radius[lb][y]
        own = (x == y) if same and la == lb else np.zeros(len(x), dtype=bool)
        apart[own] = 0.0
        whole = apart + reach <= limit - MARGIN
        for i, j, self_pair in zip(x[whole].tolist(), y[whole].tolist(), own[whole].tolist()):
            p, q = a.order[a.start[la][i] : a.end[la][i]], b.order[b.start[lb][j] : b.end[lb][j]]
            if self_pair:
                total = ordered_a[a.end[la][i]] - ordered_a[a.start[la][i]]
                count[p] += total - weight_a[p]
                links.append(np.stack([np.full(len(p), p[0]), p], axis=1))
                continue
            change_a[[a.start[la][i], a.end[la][i]]] += np.array([1, -1]) * (ordered_b[b.end[lb][j]] - ordered_b[b.start[lb][j]])
            change_b[[b.start[lb][j], b.end[lb][j]]] += np.array([1, -1]) * (ordered_a[a.end[la][i]] - ordered_a[a.start[la][i]])
            links.append(np.stack([np.full(len(q), p[0]), q + shift], axis=1))
            links.append(np.stack([p, np.full(len(p), q[0] + shift)], axis=1))
        open_ = (apart - reach <= limit + MARGIN) & ~whole
        x, y = x[open_], y[open_]
        if not len(x):
            continue
        down_a, down_b = not last_a, not last_b
        if down_a:
            x, y = _children(a.child[la], x, y)
        if down_b:
            y, x = _children(b.child[lb], y, x)
        if same:
            ahead = x <= y
            x, y = x[ahead], y[ahead]
        stack.append((la + down_a, lb + down_b, x, y))
    count[a.order] += np.cumsum(change_a[:-1])
    count[shift + b.order] += np.cumsum(change_b[:-1])
    return count, _forest(np.concatenate([*links, np.empty((0, 2), dtype=np.int64)]), len(count))


def _children(first: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every child of each x, with its y."""
    many = first[x + 1] - first[x]
    place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(first[x], many) + place, np.repeat(y, many)


def _forest(links: np.ndarray, n: int) -> np.ndarray:
    """At most one link per row that connects the same rows."""
    root = np.arange(n)
    while len(links):
        low = np.minimum(root[links[:, 0]], root[links[:, 1]])
        before = root.copy()
        np.minimum.at(root, root[links[:, 0]], low)
        np.minimum.at(root, root[links[:, 1]], low)
        root = root[root]
        if (root == before).all():
            break
    rows = np.flatnonzero(root != np.arange(n))
    return np.stack([rows, root[rows]], axis=1)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def _centres(radius: float, most: int):
    """Chooses the centres of a node from its sample."""

    def centres(group: pa.Table) -> pa.Table:
        rows, n = _matrix(group["row"]), group["n"][0].as_py()
        chosen = rows[net(rows, radius, min(FAN, max(2, 2 * n // most + 1)))]
        return pa.table({
            "node": pa.array([group["node"][0].as_py()] * len(chosen)), "number": pa.array(range(len(chosen)), pa.int32()),
            "centre": pa.array(chosen.tolist(), pa.list_(pa.float64())),
            "shares": pa.array([n // SHARE + 1] * len(chosen), pa.int32()),
        })

    return centres


def _divided(points: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """Vectors with the name of their block (``node``), and each level's nodes (node, parent, centre, radius)."""
    done, levels = [], []
    radius = 1.0
    for _ in range(LEVELS):
        sizes = points.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        large = materialised(sizes.where(F.col("n") > most), "large")
        if large.isEmpty():
            break
        done.append(points.join(large, "node", "left_anti"))
        rest = points.join(large, "node").withColumn(
            "share", F.expr(f"cast(pmod(xxhash64(vec), n div {SHARE} + 1) as int)")
        )
        rest = materialised(rest, "points")
        drawn = Window.partitionBy("node").orderBy(F.xxhash64("vec"), "vec")
        sample = rest.select("node", "vec", "row", "n").withColumn("k", F.row_number().over(drawn)).where(F.col("k") <= SAMPLE)
        found = sample.groupBy("node").applyInArrow(
            _centres(radius, most), "node string, number int, centre array<double>, shares int"
        )
        found = materialised(found, "centres")
        asked = found.withColumn("share", F.explode(F.expr("sequence(0, shares - 1)")))

        def assigned(group: pa.Table, near: pa.Table) -> pa.Table:
            near = near.sort_by("number")
            rows, mid = _matrix(group["row"]), _matrix(near["centre"])
            cosine = cosines(rows, mid)
            best = cosine.argmax(axis=1)
            parent = group["node"][0].as_py()
            return pa.table({
                "node": pa.array([f"{parent}.{k}" for k in best.tolist()]), "vec": group["vec"], "copies": group["copies"],
                "row": group["row"], "parent": group["node"],
                "far": pa.array(distances(cosine[np.arange(len(rows)), best])),
            })

        points = materialised(
            rest.groupBy("node", "share").cogroup(asked.groupBy("node", "share")).applyInArrow(
                assigned, "node string, vec bigint, copies bigint, row array<float>, parent string, far double"
            ),
            "points",
        )
        radii = points.groupBy("node", "parent").agg(F.max("far").alias("radius"))
        named = found.select(F.concat_ws(".", "node", "number").alias("node"), "centre")
        levels.append(materialised(radii.join(named, "node"), "nodes"))
        points = points.select("node", "vec", "copies", "row")
        radius /= 2
    done.append(points)
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole, levels


def _near_nodes(roots: DataFrame, levels: list[DataFrame], least: float) -> DataFrame:
    """Pairs of nodes (``a`` <= ``b``) that may hold links, from the roots down."""
    limit = float(np.sqrt(2.0 - 2.0 * least)) + MARGIN
    pairs = roots.select(F.col("node").alias("a"), F.col("node").alias("b"))
    known = None
    for nodes in levels:
        known = nodes if known is None else known.unionByName(nodes)
        kids = nodes.select("parent", "node")

        def side(pairs: DataFrame, name: str, kids=kids) -> DataFrame:
            return pairs.join(kids.select(F.col("parent").alias(name), F.col("node").alias("kid")), name, "left").select(
                F.coalesce("kid", name).alias(name), *[c for c in pairs.columns if c != name]
            )

        spread = side(side(pairs.withColumn("same", F.col("a") == F.col("b")), "a"), "b")
        spread = spread.where("NOT same OR a <= b")

        def ends(name: str, known=known) -> DataFrame:
            return known.select(
                F.col("node").alias(name), F.col("centre").alias(f"c_{name}"), F.col("radius").alias(f"r_{name}")
            )

        full = spread.join(ends("a"), "a", "left").join(ends("b"), "b", "left")
        dot = F.expr("aggregate(zip_with(c_a, c_b, (p, q) -> p * q), 0D, (s, x) -> s + x)")

        def norm(name: str):
            return F.expr(f"sqrt(aggregate(c_{name}, 0D, (s, x) -> s + x * x))")

        apart = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot / (norm("a") * norm("b"))))
        near = (F.col("a") == F.col("b")) | apart.isNull() | (apart - F.col("r_a") - F.col("r_b") <= limit)
        pairs = materialised(full.where(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "pairs")
    return pairs


def near_vectors(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: the id, ``n_links``, ``component_id`` and ``kept``.

    Vectors of equal labels, not null, and of equal length link when their cosine is ``least`` or more (0 to
    1). ``n_links`` counts the other rows linked directly, copies too; ``component_id`` is the smallest id reached. A vector that is
    null, empty, zero or holds a null or a number that is not finite links with nothing. Rows that repeat an id and
    vector are copies of each other; rows that repeat an id with another vector or label are vectors of their own, each
    with its own links and component. A null id takes no part. An empty table gives no rows. Ids are integers. Other
    columns are not read.
    """
    spark = vectors.sparkSession
    ready(spark)
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<float>").alias("row"),
    )
    finite = F.expr("size(row) > 0 AND forall(row, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < float('infinity')) AND exists(row, x -> x != 0)")
    usable = rows.where("vec IS NOT NULL AND label IS NOT NULL AND row IS NOT NULL").where(finite)
    # Different vectors can have one id, so a number stands for each inside; it is stored with it.
    distinct = materialised(
        usable.groupBy("label", "row").agg(F.min("vec").alias("least_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("vec", F.monotonically_increasing_id()),
        "distinct",
    )
    width = distinct.agg(F.max(F.size("row"))).first()[0] or 1
    most = max(16, BLOCK_VALUES // width)
    roots = distinct.select(
        F.concat_ws("/", F.length("label").cast("string"), "label", F.size("row").cast("string")).alias("node"), "vec", "copies", "row"
    )
    points, levels = _divided(roots, most)
    pairs = _near_nodes(roots.select("node").distinct(), levels, least)

    # A node that could not be divided further is several blocks.
    sizes = points.groupBy("node").agg(F.expr(f"cast(ceil(count(1) / {most}) as int)").alias("parts"))
    in_block = points.join(sizes, "node").withColumn("part", F.expr("cast(pmod(xxhash64(vec), parts) as int)"))

    def block(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec")
        return pa.table({
            "node": group["node"][:1], "part": group["part"][:1], "parts": group["parts"][:1],
            "vecs": pa.array([group["vec"].to_pylist()], pa.list_(pa.int64())),
            "copies": pa.array([group["copies"].to_pylist()], pa.list_(pa.int64())),
            "data": pa.array([_matrix(group["row"]).astype("<f4").tobytes()], pa.binary()),
        })

    blocks = materialised(
        in_block.select("node", "part", "parts", "vec", "copies", "row").groupBy("node", "part").applyInArrow(
            block, "node string, part int, parts int, vecs array<bigint>, copies array<bigint>, data binary"
        ),
        "blocks",
    )

    def side(name: str) -> DataFrame:
        return blocks.select(*(F.col(c).alias(f"{c}_{name}") for c in blocks.columns)).withColumnRenamed(f"node_{name}", name)

    met = pairs.join(side("a"), "a").join(side("b"), "b").where("a != b OR part_a <= part_b")
    met = met.select("a", "part_a", "vecs_a", "copies_a", "data_a", "b", "part_b", "vecs_b", "copies_b", "data_b")

    def links(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                a, part_a, va, wa, da, b, part_b, vb, wb, db = (x[0] for x in batch.slice(i, 1).to_pydict().values())
                same = (a, part_a) == (b, part_b)
                left = tree(np.frombuffer(da, "<f4").reshape(len(va), -1).astype(np.float64))
                right = left if same else tree(np.frombuffer(db, "<f4").reshape(len(vb), -1).astype(np.float64))
                count, forest = traverse(left, right, np.array(wa), np.array(wb), least, same)
                names = np.array(va if same else va + vb, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(names), pa.array(count)], names=["a", "b", "n"]
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[forest[:, 0]]), pa.array(names[forest[:, 1]]), pa.array(np.zeros(len(forest), np.int64))],
                    names=["a", "b", "n"],
                )

    found = materialised(met.repartition("a", "part_a", "b", "part_b").mapInArrow(links, "a bigint, b bigint, n bigint"), "links")
    counts = found.where("a = b").groupBy(F.col("a").alias("vec")).agg(F.sum("n").alias("direct"))
    reached = materialised(components(found.where("a != b").select("a", "b")), "reached").withColumnRenamed("node", "vec")
    lowest = distinct.select("vec", "least_id").join(reached, "vec").groupBy("root").agg(F.min("least_id").alias("lowest"))
    by_vector = (
        distinct.join(counts, "vec", "left").join(reached.join(lowest, "root").select("vec", "lowest"), "vec", "left")
        .select("label", "row", "copies", F.coalesce("direct", F.lit(0)).alias("direct"), F.coalesce("lowest", "least_id").alias("root"))
    )
    keyed = rows.withColumn("usable", F.coalesce(F.expr("vec IS NOT NULL AND label IS NOT NULL AND row IS NOT NULL") & finite, F.lit(False)))
    linked = keyed.where("usable").join(by_vector, ["label", "row"]).select(
        "vec", (F.col("direct") + F.col("copies") - 1).alias("n_links"), F.col("root").alias("component_id")
    )
    alone = keyed.where("NOT usable").select("vec", F.lit(0).cast("bigint").alias("n_links"), F.col("vec").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("vec").alias(id_col), "n_links", "component_id", (F.col("vec") == F.col("component_id")).alias("kept")
    )
