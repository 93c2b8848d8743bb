"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import checkpoint_dir, ship_package

#: Bytes of text that a task turns into numpy arrays at once.
SLICE_BYTES = 1 << 20

#: Fixed odd multipliers of the hashes below.
B1 = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    ship_package(spark)
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


#: Spark's setting that deletes an execution's shuffle files as it ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: cuts the
    lineage in files that outlive any executor.  What was shuffled to write
    them goes at once, not when the driver collects its garbage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stash_folder = path
    return out


def discard(*stashed: DataFrame) -> None:
    """Deletes the files of stashed frames; nothing may read them any more."""
    for df in stashed:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.stash_folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def unused(columns: list[str], *names: str) -> list[str]:
    """Each of `names` with as many underscores before it as make it unlike all
    of `columns`, whatever their case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def hashed_sample(df: DataFrame, keys: list[str], bound: int, total: int) -> DataFrame:
    """About `bound` of the `total` rows, chosen by a hash of `keys`; all if
    there are no more.  The limit only holds where rows repeat a chosen key."""
    part = F.pmod(F.xxhash64(*keys, F.lit("sample")), F.lit(1 << 40))
    return df.where(part <= F.lit(int((1 << 40) * min(1.0, bound / max(total, 1))))).limit(4 * bound)


def text_slices(batch: pa.RecordBatch, column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with at most `limit`
    bytes of UTF-8 (one row may be longer).  Null is empty."""
    arr = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
    n = len(arr)
    if n == 0:
        return
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        yield a, b, data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        a = b


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit hashes (splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * MIX1
    h = (h ^ (h >> np.uint64(27))) * MIX2
    return h ^ (h >> np.uint64(31))


_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B1**i and B1**-i modulo 2**64 for i < n (kept for the largest n asked)."""
    if not _POW or len(_POW[0][0]) < n:
        size = max(n, SLICE_BYTES + 1024)
        inv = pow(int(B1), -1, 1 << 64)
        with np.errstate(over="ignore"):
            up = np.full(size, B1, np.uint64)
            up[0] = 1
            down = np.full(size, np.uint64(inv), np.uint64)
            down[0] = 1
            _POW[0] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POW[0][0][:n], _POW[0][1][:n]


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range data[start:end]: equal ranges of equal
    length have equal hashes wherever they stand."""
    n = len(data)
    up, down = powers(n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * MIX1)


#: Bytes that separate words of `[^\x20\x09-\x0D]+`, and the map A-Z to a-z.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def word_spans(space: np.ndarray, offs: np.ndarray,
               cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of bytes that are not separators;
    no word crosses a row's border.  `space`: whether each byte separates;
    `cut`: whether a word ends before each byte though none does."""
    n = len(space)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    first = np.zeros(n + 1, bool)   # a byte that begins a row
    first[offs[:-1]] = True
    if cut is not None:
        first[:n] |= cut
    inside = ~space
    begins = inside.copy()
    begins[1:] &= space[:-1] | first[1:n]
    ends = inside.copy()
    ends[:-1] &= space[1:] | first[1:n]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def shingles(data: np.ndarray, offs: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of `width` words of each row, as often as it
    stands; a row with fewer words has its whole sequence as the only one."""
    data = LOWER[data]
    start, end, row = word_spans(IS_SPACE[data], offs)
    if len(start) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = range_hashes(data, start, end)
    count = np.bincount(row, minlength=len(offs) - 1)
    with np.errstate(over="ignore"):
        out = np.zeros(len(words), np.uint64)
        for k in range(width):
            shifted = np.zeros(len(words), np.uint64)
            same = np.zeros(len(words), bool)
            same[:len(words) - k] = row[k:] == row[:len(words) - k]
            shifted[:len(words) - k] = words[k:]
            out = np.where(same, mix(out * MIX2 + shifted), out)
    base = np.concatenate([[0], np.cumsum(count)])[row]
    keep = (np.arange(len(words)) - base) <= np.maximum(count[row] - width, 0)
    return out[keep], row[keep]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable from each node of an edge
    table with integer ends.  Alternating large and small stars; each half
    round is written to the shared folder.  Minima are aggregated before the
    shuffle and joined back, so a hub's rows can be split between tasks."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = stash(e, "cc")
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, e = e, stash(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "cc")
        discard(old)
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before == now:
            break
        before = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def local_roots(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each position the smallest id it is linked to by the edges (i, j)."""
    label = ids.copy()
    if len(i) == 0:
        return label
    while True:
        low = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        if (after == label).all():
            return label
        label = after
