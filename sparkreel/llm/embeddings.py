"""Near-duplicate vectors by cosine: tiles in PCA order, leading dimensions first.

Equal vectors collapse to classes. The classes' unit vectors are turned to the principal axes of
their second-moment matrix, so that the first few products carry most of a cosine, and are dealt to
the leaves of a k-d tree over the leading axes. A vector visits those leaves alone whose boxes of
coordinates let it reach the threshold. Each tile of a leaf, with its visitors, is one Spark group:
it adds up leading dimensions, bounds what is left of the product by the norms of the suffixes, and stops for
pairs that can't reach the threshold. Only counts per vector and links that join two components
leave the group, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, materialise
from .components import connected_components, join_labels

THRESHOLD = 0.9
#: Vectors in a tile, about: ``TILE_ROOT`` times the root of their number, so that copies and groups
#: both grow with the root where nothing can be pruned; at least, and at most in bytes of a tile.
TILE_ROOT, MIN_TILE_ROWS, TILE_BYTES = 16, 1024, 16 << 20
#: How many times as many visitors a group has at most, about.
VISITORS = 4
#: The k-d tree is fitted on so many vectors at most; every vector is dealt out and compared.
SAMPLE_ROWS = 16384
#: Leaves of the tree at most, which bounds the boxes (1 MB) that the driver gathers and tasks carry. Larger leaves have several tiles.
MAX_LEAVES = 4096
#: Leading axes in the boxes and splits.
LEAD = 16
_EPS = 1e-9


def usable(vector):
    """Neither null nor zero, and without null or non-finite components."""
    vector = vector.cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def principal_axes(classes: DataFrame, dim: int) -> np.ndarray:
    """Columns: eigenvectors of the unit vectors' second-moment matrix, largest first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = _unit(_matrix(batch.column(0)))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], ["k", "v"])

    sums = map_rows(classes.select("embedding"), "k long, v double", moments).groupBy("k").agg(F.sum("v").alias("v"))
    total = np.zeros(dim * dim)
    for k, v in sums.collect():  # dim * dim numbers
        total[k] = v
    return np.ascontiguousarray(np.linalg.eigh(total.reshape(dim, dim))[1][:, ::-1])


def _grow_tree(x: np.ndarray, leaves: int) -> list[tuple[int, float]]:
    """A complete k-d tree as (axis, cut) in heap order; ``leaves`` is a power of two."""
    nodes, level = [], [x]
    while len(level) < leaves:
        below = []
        for part in level:
            axis = int(part.var(axis=0).argmax()) if len(part) else 0
            cut = float(np.median(part[:, axis])) if len(part) else 0.0
            nodes.append((axis, cut))
            low = part[:, axis] < cut
            below += [part[low], part[~low]]
        level = below
    return nodes


def _leaf_of(x: np.ndarray, nodes: list[tuple[int, float]]) -> np.ndarray:
    if not nodes:
        return np.zeros(len(x), np.int64)
    axis, cut = np.array([n[0] for n in nodes]), np.array([n[1] for n in nodes])
    at = np.zeros(len(x), np.int64)
    while True:
        inner = at < len(nodes)
        if not inner.any():
            return at - len(nodes)
        i = at[inner]
        at[inner] = 2 * i + 1 + (x[inner, axis[i]] >= cut[i])


def _near(x: np.ndarray, y: np.ndarray, raw_x: np.ndarray, raw_y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs with cosine >= threshold; x, y are unit rows in principal order."""
    dim = x.shape[1]
    cuts = [c for c in (8, 16, 32, 64, 128, 256, 512, 1024) if c < dim] + [dim]
    tail = lambda v: np.sqrt(np.maximum(np.cumsum((v * v)[:, ::-1], axis=1)[:, ::-1], 0))
    tail_x, tail_y = (np.hstack((tail(v), np.zeros((len(v), 1)))) for v in (x, y))
    dots = x[:, : cuts[0]] @ y[:, : cuts[0]].T
    a = b = s = None
    for at, upto in zip(cuts, [*cuts[1:], None]):
        if a is None:
            open_ = dots + np.outer(tail_x[:, at], tail_y[:, at]) >= threshold - _EPS
            if upto is None or np.count_nonzero(open_) < 0.1 * open_.size:
                a, b = np.nonzero(open_)
                s = dots[a, b]
            else:
                dots += x[:, at:upto] @ y[:, at:upto].T
                continue
        else:
            near = s + tail_x[a, at] * tail_y[b, at] >= threshold - _EPS
            a, b, s = a[near], b[near], s[near]
        if upto is not None:
            for i in range(0, len(a), 1 << 16):
                p, q = a[i : i + (1 << 16)], b[i : i + (1 << 16)]
                s[i : i + (1 << 16)] += np.einsum("ij,ij->i", x[p, at:upto], y[q, at:upto])
    sure = s >= threshold + _EPS
    for i in np.flatnonzero(~sure & (s >= threshold - _EPS)):  # at the threshold itself: the plain formula decides
        p, q = raw_x[a[i]], raw_y[b[i]]
        sure[i] = float(p @ q) / (float(np.sqrt(p @ p)) * float(np.sqrt(q @ q))) >= threshold
    return a[sure], b[sure]


def _tile(axes: np.ndarray, threshold: float):
    """What the members of a tile link with among themselves and among the visitors."""

    def run(table: pa.Table) -> pa.Table:
        visits = table.column("visits").to_numpy()
        ids, weight = table.column("id").to_numpy(), table.column("n").to_numpy()
        raw = _matrix(table.column("embedding").combine_chunks())
        turned = _unit(raw) @ axes
        members = np.flatnonzero(~visits)
        links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for second, own in ((members, True), (np.flatnonzero(visits), False)):
            if own and not table.column("first")[0].as_py():
                continue  # another chunk of the tile's visitors has compared the members
            for i in range(0, len(members), 512):
                rows = members[i : i + 512]
                for j in range(i if own else 0, len(second), 2048):
                    cols = second[j : j + 2048]
                    a, b = _near(turned[rows], turned[cols], raw[rows], raw[cols], threshold)
                    a, b = rows[a], cols[b]
                    if own:
                        a, b = a[a < b], b[a < b]
                    links += np.bincount(a, weight[b], len(ids)).astype(np.int64) + np.bincount(b, weight[a], len(ids)).astype(np.int64)
                    label = join_labels(label, a, b)
        got = np.flatnonzero(links)
        return pa.table({"id": ids[got], "links": links[got], "root": ids[label[got]]})

    return run


class Leaves:
    """Boxes of the leaves' vectors, and which leaves a vector can reach."""

    def __init__(self, boxes: list, lead: int, threshold: float, tile_rows: int):
        boxes = sorted(boxes, key=lambda b: b["leaf"])
        self.lead, self.threshold = lead, threshold
        self.leaf = np.array([b["leaf"] for b in boxes], np.int64)
        self.low = np.array([[b[f"lo{k}"] for k in range(lead)] for b in boxes]).reshape(-1, lead)
        self.high = np.array([[b[f"hi{k}"] for k in range(lead)] for b in boxes]).reshape(-1, lead)
        self.rest = np.array([b["rest"] for b in boxes])
        self.tiles = np.array([-(-b["rows"] // tile_rows) for b in boxes], np.int64)
        self.chunks = np.ones(len(boxes), np.int64)

    def home(self, x: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """The place of each row's leaf, or, where rounding put the row over a cut this time, of one whose box holds it."""
        place = np.minimum(np.searchsorted(self.leaf, leaf), len(self.leaf) - 1)
        lead, eps = x[:, : self.lead], _EPS / 10
        fits = (self.leaf[place] == leaf) & (lead >= self.low[place] - eps).all(axis=1) & (lead <= self.high[place] + eps).all(axis=1)
        for i in np.flatnonzero(~fits):
            place[i] = np.flatnonzero((lead[i] >= self.low - eps).all(axis=1) & (lead[i] <= self.high + eps).all(axis=1))[0]
        return place

    def reached(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, place of a leaf) for the leaves later than home that hold vectors a row may link with.

        The most that a product over the leading axes can be in a box, and the product of the norms
        of what is left, bound the cosine.
        """
        lead = x[:, : self.lead]
        rest = np.sqrt(np.maximum((x[:, self.lead :] ** 2).sum(axis=1), 0))
        best = np.maximum(lead, 0) @ self.high.T + np.minimum(lead, 0) @ self.low.T + np.outer(rest, self.rest)
        return np.nonzero((best >= self.threshold - _EPS) & (np.arange(len(self.leaf))[None] > home[:, None]))


def _compare(classes: DataFrame, dim: int, threshold: float, tile_rows: int | None) -> DataFrame:
    """``(id, links, root)``: what each tile found, for the classes of one dimension.

    A vector is a member of one tile of its leaf, and visits the other tiles it may have links in:
    the later tiles of its own leaf and all tiles of the later leaves that it can reach. So a pair
    meets once, and what is shuffled is in proportion to what can be reached. A tile's visitors are dealt out
    in chunks of about ``VISITORS`` times its rows, each with a copy of the members.
    """
    axes, lead = principal_axes(classes, dim), min(LEAD, dim)
    leaves, count = 1, classes.count()
    tile_rows = tile_rows or max(1, min(max(MIN_TILE_ROWS, int(TILE_ROOT * count**0.5)), TILE_BYTES // (8 * dim)))
    while leaves < min(MAX_LEAVES, count / tile_rows):
        leaves *= 2
    picked = classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("embedding").toArrow()
    tree = _grow_tree((_unit(_matrix(picked.column(0).combine_chunks())) @ axes)[:, :lead], leaves)
    kind = classes.schema["embedding"].dataType.simpleString()

    def boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The box of each leaf over the vectors of a task."""
        rows, rest, low, high = np.zeros(leaves, np.int64), np.zeros(leaves), np.full((leaves, lead), np.inf), np.full((leaves, lead), -np.inf)
        for batch in batches:
            if batch.num_rows:
                x = _unit(_matrix(batch.column(0))) @ axes
                leaf = _leaf_of(x[:, :lead], tree)
                np.add.at(rows, leaf, 1)
                np.maximum.at(rest, leaf, np.sqrt((x[:, lead:] ** 2).sum(axis=1)))
                np.minimum.at(low, leaf, x[:, :lead])
                np.maximum.at(high, leaf, x[:, :lead])
        at = np.flatnonzero(rows)
        columns = {"leaf": at, "rows": rows[at], "rest": rest[at], **{f"lo{k}": low[at, k] for k in range(lead)}, **{f"hi{k}": high[at, k] for k in range(lead)}}
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))

    edges = [f"{n}{k}" for n in ("lo", "hi") for k in range(lead)]
    parts = map_rows(classes.select("embedding"), "leaf long, rows long, rest double, " + ", ".join(f"{e} double" for e in edges), boxed)
    found = parts.groupBy("leaf").agg(F.sum("rows").alias("rows"), F.max("rest").alias("rest"), *[(F.min if e[0] == "l" else F.max)(e).alias(e) for e in edges])
    boxes = Leaves(found.collect(), lead, threshold, tile_rows)  # MAX_LEAVES rows at most

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(boxes.leaf), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _unit(_matrix(batch.column(0))) @ axes
                total += np.bincount(boxes.reached(x, boxes.home(x, _leaf_of(x[:, :lead], tree)))[1], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "n"])

    for at, n in map_rows(classes.select("embedding"), "at long, n long", visited).groupBy("at").agg(F.sum("n")).collect():
        # Members of a leaf with several tiles visit the later ones too.
        boxes.chunks[at] = 1 + (n + (boxes.tiles[at] - 1) * tile_rows) // (VISITORS * tile_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x, ids = _unit(_matrix(part.column(2))) @ axes, part.column(0).to_numpy()
                home = boxes.home(x, _leaf_of(x[:, :lead], tree))
                draw = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                tile = (draw % boxes.tiles[home].astype(np.uint64)).astype(np.int64)
                each = np.arange(len(ids))
                rows, places = boxes.reached(x, home)
                later = boxes.tiles[home] - tile - 1
                # As a member, for each chunk of visitors; as a visitor of later tiles at home; as one of other leaves' tiles.
                who = [np.repeat(each, boxes.chunks[home]), np.repeat(each, later), np.repeat(rows, boxes.tiles[places])]
                where = [home[who[0]], home[who[1]], np.repeat(places, boxes.tiles[places])]
                number = [np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n) for w, n in zip(who, (boxes.chunks[home], later, boxes.tiles[places]))]
                tiles = [tile[who[0]], tile[who[1]] + 1 + number[1], number[2]]
                chunk = [number[0], *((draw[w] >> np.uint64(5)).astype(np.int64) % boxes.chunks[p] for w, p in zip(who[1:], where[1:]))]
                who_, visits = np.concatenate(who), np.arange(sum(map(len, who))) >= len(who[0])
                task = pa.StructArray.from_arrays([pa.array(np.concatenate(c)) for c in (where, tiles, chunk)], ["leaf", "tile", "chunk"])
                for lo in range(0, len(who_), 4096):
                    take = pa.array(who_[lo : lo + 4096])
                    yield pa.RecordBatch.from_arrays([task.slice(lo, 4096), pa.array(visits[lo : lo + 4096]), pa.array(np.concatenate(chunk)[lo : lo + 4096] == 0), *(part.column(k).take(take) for k in range(3))], ["task", "visits", "first", "id", "n", "embedding"])

    fields = f"task struct<leaf:bigint,tile:bigint,chunk:bigint>, visits boolean, first boolean, id long, n long, embedding {kind}"
    rows = map_rows(classes.select("id", "n", "embedding"), fields, deal)
    return rows.groupBy("task").applyInArrow(_tile(axes, threshold), "id long, links long, root long")


def near_duplicate_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    tile_rows: int | None = None,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per vector, whatever its other columns.

    * Vectors that are null, empty or zero, or hold null or non-finite components, link with
      nothing: no links, their own component, kept. Vectors of different lengths never link.
    * Equal vectors link with each other like any others. Repeated rows stay and count as vectors.
    * A null vec_id keeps its row, counts as a partner and never names a component unless all ids
      of the component are null. ``kept`` is ``vec_id`` equal to ``component_id`` (nulls equal).
    * An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    # Vectors move as they are stored, four bytes a component where they are floats; work on them is in double precision.
    kind = vectors.schema[vector_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind if kind == "array<float>" else "array<double>").alias("embedding"))
    rows = rows.withColumn("usable", usable(F.col("embedding")))
    good = rows.where("usable").select("vec_id", "embedding")
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    classes = materialise(classes.withColumn("id", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")), "classes")
    found = spark.createDataFrame([], "id long, links long, root long")
    for (dim,) in classes.select("dim").distinct().orderBy("dim").collect():  # the lengths that occur
        found = found.unionByName(_compare(classes.where(F.col("dim") == dim), dim, threshold, tile_rows))
    found = materialise(found, "found")
    roots = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = (
        classes.select("id", "least", "n")
        .join(roots, F.col("id") == roots.node, "left")
        .join(links, "id", "left")
        .select("id", "least", "n", F.coalesce("component", "id").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    named = materialise(named, "named")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = materialise(
        named.join(ids, "root").join(classes.select("id", "embedding"), "id")
        .select("embedding", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id"),
        "lookup",
    )
    linked = good.join(lookup, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
