"""Near-duplicate vectors by an exact metric range join over a tree of pivot cells.

Vectors are scaled to unit length; cosine >= c is a distance of at most
``sqrt(2 - 2c)``.  The vectors of a label and length are cut into cells by
pivots of their own (each vector's home is its nearest pivot), and a cell of
more vectors than a block holds is cut again by pivots drawn from inside it.
Where a node has clusters (a tenth of its vectors lie within NEAR radii of a
pivot), the vectors further off share one cell of their own, so that clusters
without a pivot stay whole until one of the next pivots is theirs.
A cell keeps the interval of its vectors' distances to every pivot of its
node.  A vector is copied from its home to a later cell only if a vector there
can be in range: by the triangle inequality its distance to each of the pivots
lies within the cell's interval widened by the radius, and it lies within the
radius of the plane that bounds the cell.  Copies go down the tree by the same
test.  Every pair within range so meets in exactly one leaf.

Leaves are joined independently, and no task gets an unbounded group: a leaf
that pivots can't divide (LEVELS deep, or a node whose vectors all have one
home) is cut into hash blocks, each met by all copies and by the blocks before
it; the copies that meet a block are dealt over slices, each holding the
block's vectors anew.  A task holds one block while copies stream past it, and
the cosine in double precision decides.

Equal vectors of a label are one class first, so many copies of a vector are
one row of the join.  Blocks put out link counts and spanning links, never all
pairs.

Defined results: a vector that is null, empty, zero or holds null or
non-finite components, or whose label is null, links with nothing and is its
own component; vectors of different length never link; rows without a vec_id
take part and are kept only if their component has no vec_id; repeated rows
are separate vectors that link; equally small vec_ids are one component_id; an
empty table gives no row; columns besides vec_id, embedding and label are
ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardlake.llm.common import components, discard, pick, stored
from boardlake.llm.simhash import _flatten, unite

COSINE = 0.93
#: Pivots of a node (at most), components that a block holds (16 MiB of doubles), and levels of the tree.
PIVOTS, BLOCK_VALUES, LEVELS = 16, 1 << 21, 8
#: Radii around a pivot that count as near, and the share of near vectors that makes a node clustered.
NEAR, CLUSTERED = 2, 0.1
#: Copies that meet a block in one task, in blocks; and scalar products worked out at once.
SLICE_BLOCKS, PRODUCTS = 8, 1 << 22
#: Tables of pivots, cells or leaves up to this size are broadcast, larger ones joined.
BROADCAST_BYTES = 32 << 20
#: Guard against rounding in the cell bounds (a distance near zero is known to 2e-8); the cosine test itself has none.
SLACK = 1e-7
NODE = ["label", "dim", "path"]


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, safe for very large and very small components."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def vector_classes(rows: DataFrame) -> DataFrame:
    """Each row with ``key``, equal for equal vectors of a label, null for one that can't link."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    plain = F.transform("embedding", lambda x: x + 0.0)  # no negative zero
    key = F.concat(F.hex(F.xxhash64("label", plain)), F.lit("-"), F.hex(F.xxhash64(plain, "label", F.lit(1))))
    return rows.withColumn("key", F.when(F.coalesce(usable, F.lit(False)), key))


def unit_vectors(classes: DataFrame) -> DataFrame:
    """(key, label, n, dim, unit, path, own): the classes at the root of their tree."""
    def run(batches):
        for batch in batches:
            lists = batch.column("embedding")
            dims = lists.value_lengths().to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                x = unit_rows(part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim))
                unit = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * dim, pa.int32()), pa.array(x.ravel()))
                yield pa.record_batch([*(part.column(c) for c in ("key", "label", "n")),
                                       pa.array(np.full(len(at), dim), pa.int32()), unit],
                                      ["key", "label", "n", "dim", "unit"])

    label = classes.schema["label"].dataType.simpleString()
    units = classes.select("key", "label", "n", "embedding").mapInArrow(
        run, f"key string, label {label}, n long, dim int, unit array<double>")
    return units.withColumns({"path": F.lit(""), "own": F.lit(True)})


def _distances(x: Column, pivots: Column) -> Column:
    """Distances of a unit vector to each pivot."""
    def one(p: Column) -> Column:
        cosine = F.aggregate(F.zip_with(x, p, lambda a, b: a * b), F.lit(0.0), lambda total, y: total + y)
        return F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * cosine))
    return F.transform(pivots, one)


def _hint(df: DataFrame, size: int) -> DataFrame:
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _split(vectors: DataFrame, radius: float, pivots: int, capacity: Column) -> tuple[DataFrame, list[DataFrame]] | None:
    """The visits of ``vectors`` to the children of their nodes, and tables to discard after use."""
    own = vectors.where("own")
    sizes = own.groupBy(*NODE).agg(F.count(F.lit(1)).alias("node_rows"))
    wanted = F.least(F.lit(pivots), F.greatest(F.lit(2), F.ceil(2 * F.col("node_rows") / capacity)))
    order = Window.partitionBy(*NODE).orderBy(F.xxhash64("key"), "key")
    first = own.select(*NODE, "key", "unit").withColumn("place", F.row_number().over(order)).where(F.col("place") <= pivots)
    found = first.join(sizes, NODE).where(F.col("place") <= wanted).groupBy(*NODE, "node_rows").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "unit"))), lambda p: p["unit"]).alias("pivots"))
    chosen = stored(found, "vector-pivots")
    # Upper bound of what a join with the pivots, or with the cells' intervals, ships.
    k = F.size("pivots").cast("long")
    size = chosen.agg(F.sum(k * (F.col("dim") + 3 * k) * 8 + 200)).first()[0]
    if size is None:
        return None
    measured = stored(vectors.join(_hint(chosen.select(*NODE, "pivots"), size), NODE).withColumn(
        "dists", _distances(F.col("unit"), F.col("pivots"))).drop("pivots"), "vector-distances")
    far = F.array_min("dists") > NEAR * radius
    kinds = stored(measured.where("own").groupBy(*NODE).agg((F.avg((~far).cast("int")) >= CLUSTERED).alias("clustered")), "vector-kinds")
    nearest = F.array_position("dists", F.array_min("dists")).cast("int") - 1
    at_home = measured.join(_hint(kinds, size), NODE).withColumn("nearest", nearest).withColumn(
        "home", F.when(F.col("clustered") & far, F.size("dists")).otherwise(F.col("nearest")))
    ends = [F.array(*(end(F.get("dists", F.lit(i))) for i in range(pivots))).alias(name)
            for end, name in ((F.min, "low"), (F.max, "high"))]
    cells = at_home.where("own").groupBy(*NODE, "home").agg(F.count(F.lit(1)).alias("rows"), *ends)
    apart = _distances(F.get("pivots", F.col("home")), F.col("pivots")).alias("apart")
    cells = cells.join(chosen, NODE).select(*NODE, "node_rows", F.struct("home", "rows", "low", "high", apart).alias("cell"))
    cells = stored(cells.groupBy(*NODE, "node_rows").agg(F.collect_list("cell").alias("cells")), "vector-cells")
    reach = radius + SLACK

    def meets(cell: Column) -> Column:
        def near(i: Column) -> Column:
            dist = F.get("dists", i)
            return (dist + reach >= F.get(cell["low"], i)) & (dist - reach <= F.get(cell["high"], i))
        own_dist, cell_dist = F.array_min("dists"), F.get("dists", cell["home"])
        plane = cell_dist * cell_dist - own_dist * own_dist <= 2 * radius * F.get(cell["apart"], F.col("nearest")) + SLACK
        # The cell of the vectors far from every pivot has no plane.
        return F.coalesce(plane, F.lit(True)) & F.forall(F.sequence(F.lit(0), F.size("dists") - 1), near)

    # A vector at home goes to its own cell and to later ones, a copy to all.
    open_ = F.filter("cells", lambda c: F.when(F.col("own") & (c["home"] <= F.col("home")), c["home"] == F.col("home"))
                     .otherwise(meets(c)))
    visits = at_home.join(_hint(cells, size), NODE).withColumn("cell", F.explode(open_)).select(
        "key", "label", "n", "dim", "unit", F.concat_ws(".", "path", F.col("cell.home")).alias("path"),
        (F.col("own") & (F.col("cell.home") == F.col("home"))).alias("own"),
        F.col("cell.rows").alias("rows"), "node_rows")
    return visits, [chosen, measured, kinds, cells]


def _leaves(classes: DataFrame, radius: float, pivots: int, capacity: Column) -> DataFrame:
    """(key, label, n, dim, unit, path, own, rows): every class in its leaf, and its copies in others."""
    current, leaves = stored(unit_vectors(classes), "vector-units"), []
    for level in range(LEVELS):
        split = _split(current, radius, pivots, capacity)
        if split is None:
            break
        visits, used = split
        visits = stored(visits, "vector-visits")
        for table in used:
            discard(table)
        again = (F.col("rows") > capacity) & (F.col("rows") < F.col("node_rows")) & F.lit(level + 1 < LEVELS)
        leaves.append(visits.where(~again).drop("node_rows"))
        current = visits.where(again).drop("rows", "node_rows")
    if not leaves:  # an empty table
        return current.withColumn("rows", F.lit(0).cast("long"))
    return functools.reduce(DataFrame.unionByName, leaves)


def _deal(leaves: DataFrame, capacity: Column) -> DataFrame:
    """Leaves cut into blocks, and the copies that meet a block into slices."""
    counts = stored(leaves.groupBy(*NODE).agg(F.count_if(~F.col("own")).alias("copies"), F.max("rows").alias("held")), "vector-leaves")
    blocks = F.ceil(F.col("rows") / capacity)
    # Earlier blocks of a leaf are copies to the later ones.
    met = F.col("copies") + F.when(blocks > 1, F.col("rows")).otherwise(F.lit(0))
    slices = F.greatest(F.lit(1), F.ceil(met / (SLICE_BLOCKS * capacity)))
    dealt = leaves.join(_hint(counts.select(*NODE, "copies"), counts.count() * 200), NODE)
    dealt = dealt.withColumns({"blocks": blocks.cast("int"), "slices": slices.cast("int")})
    dealt = dealt.withColumn("own_block", F.pmod(F.xxhash64("key", F.lit(2)), F.col("blocks")).cast("int"))
    into = F.sequence(F.when(F.col("own"), F.col("own_block")).otherwise(F.lit(0)), F.col("blocks") - 1)
    dealt = dealt.withColumn("block", F.explode(into)).withColumn("own", F.col("own") & (F.col("block") == F.col("own_block")))
    one = F.array(F.pmod(F.xxhash64("key", F.lit(3)), F.col("slices")).cast("int"))
    every = F.sequence(F.lit(0), F.col("slices") - 1)
    return dealt.withColumn("slice", F.explode(F.when(F.col("own"), every).otherwise(one))).select(
        "key", "label", "n", "dim", "unit", "path", "own", "block", "slice")


def _join_blocks(dealt: DataFrame, cosine: float) -> DataFrame:
    """(key, links, to): link counts of classes and one link of each, by block and slice."""
    names = [*NODE, "block", "slice"]

    class Block:
        def __init__(self, inner: bool):
            self.keys, self.parts, self.sizes, self.x, self.inner = [], [], [], None, inner

        def hold(self, keys, sizes, x):
            self.keys += keys
            self.sizes.append(sizes)
            self.parts.append(x)

        def close(self):
            """Links among the held vectors, found in the first slice alone."""
            self.x, self.n = np.concatenate(self.parts), np.concatenate(self.sizes)
            self.parts, self.step = [], max(1, PRODUCTS // len(self.n))
            self.links, self.roots = np.zeros(len(self.n), np.int64), np.arange(len(self.n))
            for a in range(0, len(self.n) if self.inner else 0, self.step):
                i, j = np.nonzero(self.x[a:a + self.step] @ self.x[a:].T >= cosine)
                i, j = (i + a)[i < j], (j + a)[i < j]
                self.count(self.links, i, self.n[j])
                self.count(self.links, j, self.n[i])
                unite(self.roots, i, j)

        @staticmethod
        def count(links, at, n):
            links += np.bincount(at, weights=n, minlength=len(links)).astype(np.int64)

        def meet(self, keys, sizes, x):
            if self.x is None:
                self.close()
            for a in range(0, len(keys), self.step):
                i, j = np.nonzero(x[a:a + self.step] @ self.x.T >= cosine)
                if not len(i):
                    continue
                i += a
                links = np.zeros(len(keys), np.int64)
                self.count(links, i, self.n[j])
                self.count(self.links, j, sizes[i])
                some, first = np.unique(i, return_index=True)
                to = j[first]
                unite(self.roots, j, to[np.searchsorted(some, i)])
                yield self.batch([keys[k] for k in some], links[some], [self.keys[k] for k in to])

        @staticmethod
        def batch(keys, links, to):
            return pa.record_batch([pa.array(keys, pa.string()), pa.array(links, pa.int64()), pa.array(to, pa.string())],
                                   ["key", "links", "to"])

        def rest(self):
            if self.x is None:
                self.close()
            _flatten(self.roots, np.arange(len(self.roots)))
            some = np.flatnonzero((self.links > 0) | (self.roots != np.arange(len(self.roots))))
            return self.batch([self.keys[k] for k in some], self.links[some], [self.keys[k] for k in self.roots[some]])

    def run(batches):
        held, at = None, None
        for batch in batches:
            keys, own = batch.column("key").to_pylist(), batch.column("own").to_numpy(zero_copy_only=False)
            sizes, units = batch.column("n").to_numpy(), batch.column("unit")
            where = list(zip(*(batch.column(c).to_pylist() for c in names)))
            cuts = [0, *(k for k in range(1, len(where)) if where[k] != where[k - 1] or own[k] != own[k - 1]), len(where)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if where[a] != at:
                    if held:
                        yield held.rest()
                    held, at = None, where[a]
                x = units.slice(a, b - a).flatten().to_numpy().reshape(b - a, -1)
                if own[a]:
                    held = held or Block(where[a][-1] == 0)
                    held.hold(keys[a:b], sizes[a:b], x)
                elif held:  # a block may get copies only
                    yield from held.meet(keys[a:b], sizes[a:b], x)
        if held:
            yield held.rest()

    dealt = dealt.repartition(*names).sortWithinPartitions(*names, F.col("own").desc())
    return dealt.mapInArrow(run, "key string, links long, to string")


def range_links(classes: DataFrame, cosine: float = COSINE, pivots: int = PIVOTS, block_rows: int | None = None) -> DataFrame:
    """(key, links, to) over ``classes(key, label, embedding, n)``: parts of link counts, and spanning links.

    A block holds ``block_rows`` vectors, BLOCK_VALUES components where that is not given.
    """
    radius = float(np.sqrt(2 - 2 * cosine))
    capacity = F.lit(block_rows) if block_rows else F.greatest(F.lit(1), F.floor(F.lit(BLOCK_VALUES) / F.col("dim")))
    return _join_blocks(_deal(_leaves(classes, radius, pivots, capacity), capacity), cosine)


def vector_components(vectors: DataFrame, cosine: float = COSINE, pivots: int = PIVOTS, block_rows: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors(vec_id, embedding, label)``."""
    rows = vector_classes(pick(vectors, vec_id="vec_id", embedding="embedding", label="label"))
    classes = stored(rows.where("key IS NOT NULL").groupBy("key", "label", "embedding").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least")), "vector-classes")
    links = stored(range_links(classes, cosine, pivots, block_rows), "vector-links")
    comps = components(links.select(F.col("key").alias("u"), F.col("to").alias("v")), "vector-components")
    counts = links.groupBy("key").agg(F.sum("links").alias("links"))
    tagged = classes.select("key", "n", "least").join(counts, "key", "left").join(
        comps, F.col("key") == F.col("node"), "left").select(
        "key", "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "key").alias("component"))
    least = tagged.groupBy("component").agg(F.min("least").alias("component_id"))
    found = stored(tagged.join(least, "component").select(F.col("key").alias("class"), "n_links", "component_id"), "vector-found")
    own = rows.select("vec_id", "key").join(found, F.col("key") == F.col("class"), "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return own.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
