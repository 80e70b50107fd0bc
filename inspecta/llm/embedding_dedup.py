"""Near-duplicate vectors by product quantisation over inverted lists, without loss.

Equal vectors of a label are one point that counts its copies.  A coarse k-means and
codebooks of the residuals' subspaces are fitted on a bounded sample of points
(``SAMPLE_BYTES``); every point is indexed: its list is its nearest coarse centroid,
its code names the nearest codeword of each subspace, and ``err`` is the distance
from the point to what its code stands for.

A link of cosine c is a distance of at most t = sqrt(2 - 2c) between unit vectors.

* Probes.  If x lies in list c, and a is the centroid nearest to q, then x is on c's
  side of the plane halfway between a and c, and within the list's radius of c.  So q
  probes just the lists with |qc|^2 - |qa|^2 <= 2 t |ac| and |qc| <= radius + t:
  these probes are sufficient, no linked x lies elsewhere.
* Scan.  Squared distances to codes are sums of table lookups, one per subspace
  (asymmetric: q itself is not coded).  |qx| is at least that distance less ``err``,
  so x is a candidate only if it is at most t + err.  Again no link is lost.
* Rerank.  Candidates are compared by their exact cosine in double precision.

The unit of work is a tile: up to ``BLOCK`` rows of a list of one label, and a share of
up to ``QUERIES`` of the rows that probe it.  A hot label or list only makes more
tiles.  Each ordered pair meets in exactly one tile, which returns the number of links
per query and a spanning forest of its links, never all pairs; the forests go through
``components``.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing.  Vectors of different
lengths link with nothing in each other.  Rows that repeat a vec_id are vectors of
their own; a row without a vec_id is linked but names no component unless all rows of
its component are without.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inspecta.llm.base import map_rows, stored
from inspecta.llm.components import components

COSINE = 0.98
SUB = 8                       # dimensions of a subspace
WORDS = 256                   # codewords of a subspace
SAMPLE_BYTES = 32 << 20       # of the points, as doubles, that the index is fitted on
MAX_LISTS = 1024
BLOCK = 4096                  # indexed rows of a tile
QUERIES = 65_536              # probing rows of a tile, about
ROUNDS = 8                    # of k-means
SLACK = 1e-3                  # added to distances, far above the error of single precision
MAX_SIZES = 100_000           # (label, list) pairs whose sizes may be broadcast


class Index(NamedTuple):
    centroids: np.ndarray     # (lists, width)
    words: np.ndarray         # (subspaces, WORDS, SUB)
    radius: np.ndarray        # (lists,), infinite until known


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of a and b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = np.concatenate([squares(x[a:a + 8192], c).argmin(1) for a in range(0, len(x), 8192)])
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def fit_index(sample: np.ndarray, lists: int) -> Index:
    """Coarse centroids and codebooks of unit vectors ``sample`` (rows, width)."""
    centroids = k_means(sample, lists, 1)
    near = np.concatenate([squares(sample[a:a + 8192], centroids).argmin(1) for a in range(0, len(sample), 8192)])
    rest = sample - centroids[near]
    words = []
    for m in range(sample.shape[1] // SUB):
        w = k_means(rest[:, m * SUB:(m + 1) * SUB], WORDS, 2 + m)
        words.append(np.concatenate([w, np.repeat(w[:1], WORDS - len(w), axis=0)]))
    return Index(centroids, np.stack(words), np.full(len(centroids), np.inf))


def coded(x: np.ndarray, near: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(codes, err) of unit vectors x in the lists ``near``."""
    rest = x - index.centroids[near]
    codes = np.zeros((len(x), len(index.words)), np.uint8)
    err = np.zeros(len(x))
    for m, w in enumerate(index.words):
        d = squares(rest[:, m * SUB:(m + 1) * SUB], w)
        codes[:, m] = d.argmin(1)
        err += d.min(1)
    return codes, np.sqrt(err)


def sufficient_probes(x: np.ndarray, index: Index, t: float) -> np.ndarray:
    """(rows, lists) boolean: the lists that may hold a vector within t."""
    d = squares(x, index.centroids)
    near = d.argmin(1)
    apart = np.sqrt(squares(index.centroids, index.centroids))[near]
    return ((d - d[np.arange(len(x)), near][:, None] <= 2 * (t + SLACK) * apart + SLACK)
            & (np.sqrt(d) <= index.radius[None] + t + SLACK))


# ---- rows and points -----------------------------------------------------------
def vector_rows(df: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """vec_id, key (null: links with nothing), dim, v (the numbers, little-endian)."""
    kind = df.schema[vector_col].dataType.elementType
    single = isinstance(kind, T.FloatType)
    label = df[label_col].cast("string") if label_col else F.lit("")
    rows = df.select(df[id_col].cast("long").alias("vec_id"), label.alias("label"),
                     df[vector_col].cast("array<float>" if single else "array<double>").alias("v"))
    form = "<f4" if single else "<f8"

    def run(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        lists = batch.column(2)
        size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(form)      # a null is not a number
        at = np.cumsum(size) - size
        names = batch.column(1).to_pylist()
        key, v = [None] * n, [None] * n
        for dim in np.unique(size[size > 0]).tolist():
            who = np.flatnonzero(size == dim)
            x = flat[at[who][:, None] + np.arange(dim)] + np.zeros(1, form)     # -0.0 becomes 0.0
            ok = np.isfinite(x).all(1) & (x != 0).any(1)
            for i, row in zip(who[ok].tolist(), x[ok]):
                if names[i] is not None:
                    v[i] = row.tobytes()
                    key[i] = hashlib.blake2b(v[i], digest_size=16, key=hashlib.sha256(names[i].encode()).digest()).digest()
        return {"vec_id": batch.column(0), "label": batch.column(1), "dim": size, "key": key, "v": v}
    return map_rows(rows, run, "vec_id long, label string, dim long, key binary, v binary", max_rows=4096), form


def units(v: list[bytes], form: str, width: int) -> np.ndarray:
    """Unit vectors of equal or different lengths, with zeros up to ``width``."""
    out = np.zeros((len(v), width))
    for i, b in enumerate(v):
        x = np.frombuffer(b, form).astype(float)
        x = x / np.abs(x).max()        # squares of very large or small numbers stay finite
        out[i, :len(x)] = x / math.sqrt(x @ x)
    return out


# ---- comparison of tiles -------------------------------------------------------
class Tile:
    """Indexed rows of a tile; counts links of queries and joins what is linked."""

    def __init__(self, p, copies, x, codes, err, centroid, index: Index, cosine: float):
        self.p, self.copies, self.x, self.codes = p, copies, x, codes
        self.reach = (math.sqrt(max(0.0, 2 - 2 * cosine)) + err + SLACK).astype(np.float32) ** 2
        self.centroid, self.words, self.cosine = centroid, index.words, cosine
        self.up = np.arange(len(p))      # union-find over the indexed rows

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def scan(self, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Links per query, weighted by copies, and edges that join the linked points."""
        rest = q - self.centroid
        near = np.zeros((len(q), len(self.p)), np.float32)
        for m, w in enumerate(self.words):
            near += squares(rest[:, m * SUB:(m + 1) * SUB], w).astype(np.float32)[:, self.codes[:, m]]
        a, b = np.nonzero(near <= self.reach[None])
        keep = p[a] != self.p[b]
        a, b = a[keep], b[keep]
        ok = np.concatenate([np.einsum("ij,ij->i", q[a[i:i + 65536]], self.x[b[i:i + 65536]]) >= self.cosine
                             for i in range(0, len(a), 65536)] or [np.zeros(0, bool)])
        a, b = a[ok], b[ok]
        number = np.bincount(a, self.copies[b], minlength=len(q)).astype(np.int64)
        edges = []
        if len(a):
            start = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            edges = list(zip(p[a[start]].tolist(), self.p[b[start]].tolist()))
            head = np.repeat(b[start], np.diff(np.concatenate([start, [len(a)]])))
            joins = np.unique(np.stack([head, b], 1)[head != b], axis=0)
            for i, j in joins.tolist():
                ri, rj = self.root(i), self.root(j)
                if ri != rj:
                    self.up[max(ri, rj)] = min(ri, rj)
                    edges.append((int(self.p[i]), int(self.p[j])))
        return number, edges


def compare(tiles: DataFrame, index, form: str, width: int, cosine: float) -> DataFrame:
    """(p, n, other): links of a query in a tile (other null), or an edge (n null).
    ``tiles`` is sorted by tile, its indexed rows first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, tile = None, [], None
        idx = index.value

        def ready():
            v, codes = [x for h in held for x in h[2]], b"".join(c for h in held for c in h[3])
            return Tile(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]).astype(float),
                        units(v, form, width), np.frombuffer(codes, np.uint8).reshape(len(v), -1),
                        np.concatenate([h[4] for h in held]), idx.centroids[held[0][5]], idx, cosine)
        for batch in batches:
            name = np.array(batch.column("tile").to_pylist(), object)
            kind = batch.column("kind").to_numpy()
            cut = np.flatnonzero((name[1:] != name[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(name)]):
                part = batch.slice(a, b - a)
                if name[a] != now:
                    now, held, tile = name[a], [], None
                if kind[a] == 0:
                    held.append((part.column("p").to_numpy(), part.column("copies").to_numpy(), part.column("v").to_pylist(),
                                 part.column("codes").to_pylist(), part.column("err").to_numpy(), part.column("list")[0].as_py()))
                elif held:
                    tile = tile or ready()
                    p, v = part.column("p").to_numpy(), part.column("v").to_pylist()
                    for i in range(0, len(p), 256):
                        number, edges = tile.scan(p[i:i + 256], units(v[i:i + 256], form, width))
                        hit = np.flatnonzero(number)
                        e = np.array(edges, np.int64).reshape(-1, 2)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.concatenate([p[i:i + 256][hit], e[:, 0]])),
                            pa.array([*number[hit].tolist(), *[None] * len(e)], pa.int64()),
                            pa.array([*[None] * len(hit), *e[:, 1].tolist()], pa.int64())], names=["p", "n", "other"])
    return tiles.mapInArrow(run, "p long, n long, other long")


def _sized(df: DataFrame, sizes: DataFrame, small: bool) -> DataFrame:
    return df.join(F.broadcast(sizes) if small else sizes, ["label", "dim", "list"])


def link_points(points: DataFrame, form: str, cosine: float = COSINE, lists: int | None = None,
                block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """(p, n, other) as of ``compare`` for ``points`` (p, label, dim, v, copies), which is stored."""
    sc = points.sparkSession.sparkContext
    size, widest = points.agg(F.count(F.lit(1)), F.max("dim")).first()
    width = -(-(widest or 1) // SUB) * SUB
    t = math.sqrt(max(0.0, 2 - 2 * cosine))
    # a bounded sample by hash, whatever the order and number of points
    bound = max(1, min(size or 1, SAMPLE_BYTES // (8 * width)))
    grain = 1 << 30
    chosen = points.where(F.pmod(F.xxhash64("v"), F.lit(grain)) <= int(grain * bound / max(1, size))).select("v").limit(bound)
    sample = units([r["v"] for r in chosen.toLocalIterator()], form, width)
    if not len(sample):
        sample = np.zeros((1, width))
    lists = lists or max(1, min(MAX_LISTS, int(math.sqrt(size) / 8)))
    fitted = sc.broadcast(fit_index(sample, lists))

    def place(batch: pa.RecordBatch) -> dict:
        idx, v = fitted.value, batch.column(2).to_pylist()
        x = units(v, form, width)
        d = squares(x, idx.centroids)
        near = d.argmin(1)
        codes, err = coded(x, near, idx)
        return {"p": batch.column(0), "label": batch.column(3), "dim": batch.column(1), "copies": batch.column(4), "v": v,
                "list": near, "codes": [c.tobytes() for c in codes], "err": err, "far": np.sqrt(d.min(1))}
    rows = stored(map_rows(points.select("p", "dim", "v", "label", "copies"), place,
                           "p long, label string, dim long, copies long, v binary, list int, codes binary, err double, far double",
                           max_rows=1024), "vector-index")
    radius = np.zeros(len(fitted.value.centroids))
    for k, r in rows.groupBy("list").agg(F.max("far")).collect():      # one row a list
        radius[k] = r
    index = sc.broadcast(fitted.value._replace(radius=radius))

    def probe(batch: pa.RecordBatch) -> dict:
        v = batch.column(2).to_pylist()
        who, where = np.nonzero(sufficient_probes(units(v, form, width), index.value, t))
        return {"p": batch.column(0).take(pa.array(who)), "label": batch.column(3).take(pa.array(who)),
                "dim": batch.column(1).take(pa.array(who)), "v": batch.column(2).take(pa.array(who)), "list": where}
    probes = map_rows(rows.select("p", "dim", "v", "label"), probe, "p long, label string, dim long, v binary, list int", max_rows=1024)
    key = ["label", "dim", "list"]
    sizes = stored(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
                   .join(probes.groupBy(*key).agg(F.count(F.lit(1)).alias("q")), key)
                   .select(*key, F.ceil(F.col("n") / block).cast("int").alias("xs"), F.ceil(F.col("q") / queries).cast("int").alias("qs")),
                   "vector-sizes")
    small = sizes.count() <= MAX_SIZES
    pick = lambda n: F.pmod(F.xxhash64("p"), F.col(n)).cast("int")      # noqa: E731
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))      # noqa: E731
    none = F.lit(None)
    indexed = (_sized(rows, sizes, small).withColumn("x", pick("xs")).withColumn("y", every("qs"))
               .select(*key, "x", "y", F.lit(0).alias("kind"), "p", "copies", "v", "codes", "err"))
    asking = (_sized(probes, sizes, small).withColumn("y", pick("qs")).withColumn("x", every("xs"))
              .select(*key, "x", "y", F.lit(1).alias("kind"), "p", none.cast("long").alias("copies"), "v",
                      none.cast("binary").alias("codes"), none.cast("double").alias("err")))
    tile = F.concat_ws("/", "dim", "list", "x", "y", "label")
    both = (indexed.unionByName(asking).withColumn("tile", tile).drop("label", "dim", "x", "y")
            .repartition("tile").sortWithinPartitions("tile", "kind"))
    return compare(both, index, form, width, cosine)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
                    cosine: float = COSINE, lists: int | None = None, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``vectors``.  Without a
    ``label_col`` all vectors are compared."""
    rows, form = vector_rows(vectors, id_col, vector_col, label_col)
    rows = stored(rows, "vectors")
    points = stored(rows.where("key is not null").groupBy("key")
                    .agg(F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("v").alias("v"),
                         F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
                    .withColumn("p", F.monotonically_increasing_id()), "vector-points")
    found = stored(link_points(points, form, cosine, lists, block, queries), "vector-links")
    number = found.where("n is not null").groupBy("p").agg(F.sum("n").alias("n"))
    roots = components(found.where("other is not null").select(F.col("p").alias("a"), F.col("other").alias("b")))
    named = points.join(roots, points.p == roots.node, "left").withColumn("root", F.coalesce("root", "p"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = (named.select("key", "p", "root", "copies").join(lowest, "root").join(number, "p", "left")
               .select("key", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")))
    alone = rows.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.where("key is not null").select("vec_id", "key").join(classes, "key").select("vec_id", "n_links", "component_id")
    return (linked.unionByName(alone)
            .select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")))
