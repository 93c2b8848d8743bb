"""Near-duplicate vectors by a pivot-permutation index.

A bounded sample gives the pivots; of sampled vectors that are near each other
one is a pivot, so that a family of near vectors, however large, meets in one
list instead of being dealt over as many equally near pivots as its share of the
rows.  A vector is described by its PREFIX nearest pivots in order, the prefix of
its permutation of them, and stands in the inverted lists of the first LISTS.
Where two vectors meet in a list, the pivots that their prefixes share are
counted through inverted lists of the prefixes; only pairs that share SHARED or
more are verified, and link if their cosine reaches the threshold.  A pair that
meets in several lists counts in the first only.

Equal vectors are one class before anything is compared.  Long lists are cut
into blocks, and a task gets one pair of blocks, so that no task holds a whole
list; no pair is written, only counts and one edge for each linked vector.

Defined results: vectors that are null, empty, zero or hold a null, NaN or
infinite component link with nothing and are kept; so do rows without an id
(their component is null and they are not kept); vectors of different length
never link; rows that repeat an id and vector count as links of each other; rows
that share an id share its component.
An empty table gives an empty frame.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import components, hashed_sample, local_roots, stash
from salesmart.llm.topk import valid

#: Bounds of the number of sampled pivots (about 2 * sqrt(rows) between them) and of their
#: bytes, the largest cosine of two pivots, and the rows of a block.
LEAST, MOST, PIVOT_BYTES, APART, BLOCK = 16, 65_536, 64 << 20, 0.8, 1_024
#: Pivots that describe a vector, the lists it stands in, and the pivots a pair must share.
PREFIX, LISTS, SHARED = 12, 4, 3


def spread(x: np.ndarray, apart: float = APART) -> np.ndarray:
    """The unit vectors among `x` that have at most cosine `apart` with each one taken before."""
    kept = np.zeros((0, x.shape[1]))
    for s in range(0, len(x), 256):
        part = x[s:s + 256]
        part = part[(part @ kept.T <= apart).all(1)]
        near = part @ part.T > apart
        taken: list[int] = []
        for i in range(len(part)):
            if not near[i, taken].any():
                taken.append(i)
        kept = np.concatenate([kept, part[taken]])
    return kept


def _describe(pivots: dict[int, np.ndarray]):
    def run(batches):
        for batch in batches:
            dims = batch.column(3).to_numpy()
            values = batch.column(2)
            flat, offs = values.flatten().to_numpy(), values.offsets.to_numpy()
            offs = offs - offs[0]
            near = [None] * len(dims)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = flat[offs[at][:, None] + np.arange(d)]
                own = pivots.get(int(d))
                if own is None:   # no pivot of this length: one list holds them all
                    for i in at:
                        near[i] = [-1]
                    continue
                k = min(PREFIX, len(own))
                step = max(1, min(1024, (1 << 22) // len(own)))
                for s in range(0, len(at), step):
                    far = -((x[s:s + step] / np.linalg.norm(x[s:s + step], axis=1)[:, None]) @ own.T)
                    top = np.sort(np.argpartition(far, k - 1, axis=1)[:, :k], axis=1)
                    top = np.take_along_axis(top, np.argsort(np.take_along_axis(far, top, 1), axis=1, kind="stable"), 1)
                    for i, t in zip(at[s:s + step], top.tolist()):
                        near[i] = t
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(near, pa.list_(pa.int32()))],
                names=["cls", "n", "v", "dims", "near"])
    return run


def shared_pivots(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """How many pivots each row of `p` shares with each row of `q` (no row repeats one)."""
    by = np.argsort(q, axis=None, kind="stable")
    pivot, row = q.reshape(-1)[by], by // q.shape[1]      # the inverted lists, one after the other
    start, end = (np.searchsorted(pivot, p.reshape(-1), side) for side in ("left", "right"))
    size = end - start
    place = np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)
    asked = np.repeat(np.arange(p.size) // p.shape[1], size)
    return np.bincount(asked * len(q) + row[place], minlength=len(p) * len(q)).reshape(len(p), len(q))


def _compare(least: float):
    def run(key, t):
        dims, pivot, a, b = (x.as_py() for x in key)
        cls, n, block = (t.column(c).to_numpy() for c in ("cls", "n", "block"))
        v = t.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dims)
        v = v / np.linalg.norm(v, axis=1)[:, None]
        near = np.array(t.column("near").combine_chunks().flatten().to_numpy()).reshape(len(cls), -1)
        links = np.zeros(len(cls), np.int64)
        left, right = (np.flatnonzero(block == x) for x in (a, b))
        ii, jj = [], []
        for s in range(0, len(left), 128):
            l = left[s:s + 128]
            ok = shared_pivots(near[l], near[right]) >= min(SHARED, near.shape[1])
            if a == b:
                ok &= l[:, None] < right[None, :]
            if np.count_nonzero(ok) * 16 > ok.size:          # many: one product, whose last bits depend on the block
                ok &= v[l] @ v[right].T >= least - 1e-9
            i, j = np.nonzero(ok)
            i, j = l[i], right[j]
            for c in range(0, len(i), 1 << 17):              # then the cosine of each pair
                x, y = i[c:c + (1 << 17)], j[c:c + (1 << 17)]
                hit = np.einsum("ij,ij->i", v[x], v[y]) >= least
                x, y = x[hit], y[hit]
                p, q = near[x, :LISTS], near[y, :LISTS]
                both = (p[:, :, None] == q[:, None, :]).any(2)
                first = np.where(both, p, np.iinfo(np.int32).max).min(1) == pivot   # count a pair in one list only
                x, y = x[first], y[first]
                links += np.bincount(x, n[y], len(cls)).astype(np.int64) + np.bincount(y, n[x], len(cls)).astype(np.int64)
                ii.append(x)
                jj.append(y)
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (ii, jj))
        root = local_roots(cls, i, j)
        at = np.flatnonzero(links)
        return pa.table([pa.array(cls[at]), pa.array(links[at]), pa.array(root[at])], names=["cls", "links", "root"])
    return run


def near_duplicates(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id",
                    column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    nonzero = F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    own = own.withColumn("fine", valid(F.col("v")) & nonzero & F.col("vec_id").isNotNull())
    own = own.select("vec_id", "v", "fine", F.xxhash64("v").alias("h1"), F.hash("v").alias("h2"))
    classes = (own.where("fine").groupBy("h1", "h2")
               .agg(F.min("vec_id").alias("cls"), F.count("*").alias("n"), F.min("v").alias("v"))
               .withColumn("dims", F.size("v")))
    classes = stash(classes, "vec-classes")
    total, longest = classes.agg(F.count("*"), F.coalesce(F.max("dims"), F.lit(1))).first()
    most = max(LEAST, min(MOST, PIVOT_BYTES // (8 * longest)))
    size = int(min(most, max(LEAST, 2 * total ** 0.5)))
    sample = hashed_sample(classes, ["h1", "h2"], size, total).select("h1", "h2", "v").collect()
    pivots: dict[int, list] = {}
    for r in sorted(sample, key=lambda r: (r["h1"], r["h2"])):
        pivots.setdefault(len(r["v"]), []).append(r["v"])
    table = {d: spread((p := np.array(x)) / np.linalg.norm(p, axis=1)[:, None]) for d, x in pivots.items()}

    described = stash(classes.select("cls", "n", "v", "dims").mapInArrow(
        _describe(table), "cls long, n long, v array<double>, dims int, near array<int>"), "vec-near")
    listed = described.withColumn("pivot", F.explode(F.slice("near", 1, LISTS)))
    sizes = listed.groupBy("dims", "pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    # a list's rows go to every pair of blocks that has their own
    cut = (listed.join(F.broadcast(sizes), ["dims", "pivot"])   # one row for each pivot, at most 4 * MOST and one a length
           .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")}))
    found = stash(cut.groupBy("dims", "pivot", "a", "b").applyInArrow(
        _compare(least), "cls long, links long, root long"), "vec-links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found, "cls", "root")
    per_class = (classes.select("h1", "h2", "cls", "n").join(links, "cls", "left")
                 .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
                 .select("h1", "h2", F.lit(True).alias("fine"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                         F.coalesce("root", "cls").alias("component_id")))
    out = own.select("vec_id", "h1", "h2", "fine").join(per_class, ["h1", "h2", "fine"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"))
