"""Exact Jaccard self-join of documents' word n-gram sets, as classes.

1. A fixed-size table of counters over hashed shingles (all documents) gives a
   global order, rare first.  It only orders; any table gives the same links.
2. Documents with equal sets are one class.  A set's prefix is its first
   n - ceil(t * n) + 1 shingles: sets that link share one of them.
3. Prefix shingles are sorted by (shingle, size).  The place of the shingle in
   a set bounds the size of the sets it can link with there; neighbours inside
   such a bound whose parity bitmaps are as near as those of linked sets become
   edges, whose components hold every possible link.
4. A task gets whole small components, or one pair of blocks of a large one,
   and joins them with set relations: index lists stand by size, so that the
   sizes that cannot link are skipped as blocks, and the answers of a set that
   is close to one already answered are derived from that one's counts by the
   shingles in which they differ.

No pair is written: tasks return counts and one edge for each linked set.

Defined results: null or wordless texts have the empty set and link with
nothing; repeated rows link with each other; rows without an id take no part in
links and have a null component; an empty table gives an empty frame.  Only
`doc_id` and `text` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import components, discard, shingles, stash, text_slices

#: Counters of the order table (fixed size), and the shingles a joining task holds.
COUNTERS_LOG2, TASK_SHINGLES = 22, 2_000_000
PARTS = 64


def _count_shingles(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTERS_LOG2, np.int64)
        shift = np.uint64(64 - COUNTERS_LOG2)
        for batch in batches:
            for _, _, data, offs in text_slices(batch):
                h, _ = shingles(data, offs, width)
                total += np.bincount((h >> shift).astype(np.int64), minlength=len(total))
        parts = np.minimum(total, 2**31 - 1).astype(np.int32).reshape(PARTS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts])],
                                         names=["part", "counts"])
    return run


def _add_counts(t):
    whole = sum(np.frombuffer(zlib.decompress(x.as_py()), np.int32).astype(np.int64) for x in t.column("counts"))
    return pa.table([t.column("part").slice(0, 1), pa.array([zlib.compress(np.minimum(whole, 2**31 - 1).astype(np.int32).tobytes(), 1)])],
                    names=["part", "counts"])


def order_table(docs: DataFrame, width: int) -> np.ndarray:
    """How often shingles of each hash bucket stand in the corpus."""
    rows = (docs.select("text").mapInArrow(_count_shingles(width), "part int, counts binary")
            .groupBy("part").applyInArrow(_add_counts, "part int, counts binary").collect())
    out = np.zeros((PARTS, (1 << COUNTERS_LOG2) // PARTS), np.int32)
    for r in rows:
        out[r["part"]] = np.frombuffer(zlib.decompress(r["counts"]), np.int32)
    return out.reshape(-1)


def ordered_sets(data: np.ndarray, offs: np.ndarray, width: int, table: np.ndarray):
    """(shingles of all rows, each row's distinct and in the global order; row
    of each; borders of the rows)."""
    h, row = shingles(data, offs, width)
    seen = np.minimum(table[(h >> np.uint64(64 - COUNTERS_LOG2)).astype(np.int64)], (1 << 24) - 1).astype(np.uint64)
    key = (seen << np.uint64(40)) | (h & np.uint64((1 << 40) - 1))
    order = np.lexsort((h, key, row))
    h, row = h[order], row[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[fresh], row[fresh]
    return h, row, np.searchsorted(row, np.arange(len(offs)))


def _digest(h: np.ndarray) -> tuple[int, int]:
    raw = xxhash.xxh3_128_digest(h.tobytes())
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _bitmaps(h: np.ndarray, row: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of all rows, start of each row's, how many): a bit is the parity of
    the shingles whose low bits name it; a row of n has 2 n bits at least, by
    powers of two, so that a longer bitmap folds to a shorter one."""
    size = np.int64(1) << np.ceil(np.log2(np.maximum(n, 32) / 32)).astype(np.int64)
    start = np.cumsum(size) - size
    bit = start[row] * 64 + (h & (size[row] * 64 - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(bit, minlength=int(size.sum()) * 64) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64), start, size


def _apart(words: np.ndarray, start: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many bits the bitmaps of rows a[i] and b[i] differ, the longer
    folded: never more than the shingles that only one of them has."""
    out = np.zeros(len(a), np.int64)
    kinds, kind = np.unique(size[a] << 32 | size[b], return_inverse=True)
    for k, (x, y) in enumerate(zip((kinds >> 32).tolist(), (kinds & 0xFFFFFFFF).tolist())):
        least, at = min(x, y), np.flatnonzero(kind == k)
        step = max(1, (1 << 19) // max(x, y))
        for part in (at[i:i + step] for i in range(0, len(at), step)):
            p, q = (np.bitwise_xor.reduce(words[start[ends][:, None] + np.arange(long)].reshape(len(part), -1, least), axis=1)
                    for ends, long in ((a[part], x), (b[part], y)))
            out[part] = np.bitwise_count(p ^ q).sum(axis=1)
    return out


def _may_differ(total: np.ndarray, percent: int) -> np.ndarray:
    """The most shingles that only one of two linked sets has, of so many in both sizes."""
    return total * (100 - percent) // (100 + percent)


SETS = ("doc_id long, h long, d1 long, d2 long, n int, tokens array<long>, tops array<int>, near array<long>, "
        "bits binary, slack int, most int")
#: How often a slice's rows of a shingle look for one to stand for them.
ROUNDS = 8


def _prefixes(width: int, percent: int, table):
    """One row for each document.  Of a slice's rows of one shingle the smallest
    stands in the shuffle for those whose bitmaps are as near as those of linked
    sets (`tops`: the largest size any of them can link with); they become edges
    (`near`).  `slack` and `most`: how far their bitmaps are from its own at
    most, and the largest size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offs in text_slices(batch, column="text"):
                h, row, at = ordered_sets(data, offs, width, table.value)
                n = np.diff(at)
                digests = [_digest(h[s:e]) if e > s else (0, 0) for s, e in zip(at, at[1:])]
                d1 = np.array([d[0] for d in digests], np.int64)
                first = {}
                own = np.array([first.setdefault(d, i) == i for i, d in enumerate(digests)])   # of equal sets one is enough
                words, start, size = _bitmaps(h, row, n)
                length = n - (n * percent + 99) // 100 + 1
                place = np.arange(len(h)) - at[row]
                keep = (place < length[row]) & own[row]
                token, doc, place = h[keep].view(np.int64), row[keep], place[keep]
                # the largest size with which a set can link if this is the first shingle they share
                top = (n[doc] - place) * (100 + percent) // percent - n[doc]
                order = np.lexsort((doc, -top, n[doc], token))
                token, doc, top = token[order], doc[order], top[order]
                fresh = np.ones(len(token) + 1, bool)
                fresh[1:-1] = token[1:] != token[:-1]
                lead, reach = np.arange(len(token)), top.copy()
                slack, most = np.zeros(len(n), np.int64), n.copy()
                rest = np.flatnonzero(~(fresh[:-1] & fresh[1:]))        # rows of shingles that several have
                for _ in range(ROUNDS):
                    new = np.ones(len(rest), bool)
                    new[1:] = token[rest[1:]] != token[rest[:-1]]
                    head = rest[np.flatnonzero(new)][np.cumsum(new) - 1][~new]
                    rest = rest[~new]
                    if not len(rest):
                        break
                    pair, which = np.unique(doc[head] * len(n) + doc[rest], return_inverse=True)
                    x, y = pair // len(n), pair % len(n)
                    gap = _apart(words, start, size, x, y)
                    close = (gap <= _may_differ(n[x] + n[y], percent))[which] & (n[doc[rest]] <= top[head])
                    lead[rest[close]] = head[close]
                    np.maximum.at(reach, head[close], top[rest[close]])
                    np.maximum.at(slack, doc[head[close]], gap[which[close]])
                    np.maximum.at(most, doc[head[close]], n[doc[rest[close]]])
                    rest = rest[~close]
                head = np.flatnonzero(lead == np.arange(len(token)))
                gone = np.flatnonzero(lead != np.arange(len(token)))
                edge = np.unique(np.stack([doc[gone], doc[lead[gone]]], 1), axis=0)
                owner = doc[head]
                by = np.argsort(owner, kind="stable")
                cut = np.searchsorted(owner[by], np.arange(len(offs)))
                ecut = np.searchsorted(edge[:, 0], np.arange(len(offs)))
                shown = np.diff(cut) > 0
                raw = words.view(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                    pa.array(d1), pa.array([d[1] for d in digests], pa.int64()), pa.array(n.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(token[head][by])),
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(reach[head][by].astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(ecut, pa.int32()), pa.array(d1[edge[:, 1]])),
                    pa.array([raw[s * 8:(s + w) * 8] if k else None for s, w, k in zip(start.tolist(), size.tolist(), shown)],
                             pa.binary()),
                    pa.array(slack.astype(np.int32)), pa.array(most.astype(np.int32)),
                ], names=["doc_id", "h", "d1", "d2", "n", "tokens", "tops", "near", "bits", "slack", "most"])
    return run


def _near_pairs(percent: int):
    """Pairs of which some sets that their ends stand for can link, by the bitmaps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
            k = batch.num_rows
            if k == 0:
                continue
            bits = [x for c in ("u_bits", "v_bits") for x in col[c].to_pylist()]
            size = np.array([len(x) // 8 for x in bits], np.int64)
            gap = _apart(np.frombuffer(b"".join(bits), np.uint64), np.cumsum(size) - size, size, np.arange(k), k + np.arange(k))
            slack, most = ((col[f"u_{c}"].to_numpy() + col[f"v_{c}"].to_numpy()).astype(np.int64) for c in ("slack", "most"))
            yield pa.RecordBatch.from_arrays([col["u"], col["v"]], names=["u", "v"]).filter(
                pa.array(gap - slack <= _may_differ(most, percent)))
    return run


#: Neighbours with which a row of a shingle is compared; longer runs are linked whole.
NEIGHBOURS = 16


def _possible(sets: DataFrame) -> DataFrame:
    """(u, v, sure): edges whose components hold every link that documents'
    `near` does not; those that are not sure have yet to be compared.

    Rows that no other row of their shingle can link with go first.  A pair is
    left out at a shingle if it was met at the one before, by the same shingle
    in both documents; rows that could link beyond NEIGHBOURS are linked with
    all between them."""
    rows = sets.select("d1", "n", F.explode(F.arrays_zip("tokens", "tops")).alias("p"))
    rows = rows.select("d1", "n", F.col("p.tokens").alias("token"), F.col("p.tops").alias("top"))
    along = Window.partitionBy("token").orderBy("n", "d1", F.desc("top"))
    so_far = along.rowsBetween(Window.unboundedPreceding, -1)
    shared = (rows.withColumns({"prev": F.lag("d1").over(along), "after": F.lead("n").over(along),
                                "reach": F.max("top").over(so_far)})
              .where("(n <= reach OR after <= top) AND (prev IS NULL OR prev <> d1)").select("token", "d1", "n", "top"))
    of_doc = Window.partitionBy("d1").orderBy("token")
    shared = shared.withColumns({"before": F.lag("token").over(of_doc), "before_top": F.lag("top").over(of_doc)})
    along = Window.partitionBy("token").orderBy("n", "d1")
    so_far = along.rowsBetween(Window.unboundedPreceding, -1)
    far = F.lead("n", NEIGHBOURS + 1).over(along)
    shared = (shared.withColumn("span", F.when(far <= F.col("top"), F.col("top")))
              .withColumn("sure", F.coalesce(F.max("span").over(so_far) >= F.col("n"), F.lit(False)))
              .withColumn("run", F.sum((~F.col("sure")).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("prev", F.lag("d1").over(along))
              .withColumn("others", F.collect_list(F.struct("d1", "n", "top", "before", "before_top", "run"))
                          .over(along.rowsBetween(-NEIGHBOURS, -1))))
    met = """p -> p.run <> run AND n <= p.top AND p.n <= top
        AND NOT coalesce(p.before = before AND n <= p.before_top AND p.n <= before_top, false)"""
    pairs = shared.select("d1", F.explode(F.expr(f"""concat(
        transform(filter(others, {met}), p -> struct(p.d1 AS other, false AS sure)),
        CASE WHEN sure THEN array(struct(prev AS other, true AS sure)) ELSE array() END)""")).alias("p"))
    return (pairs.groupBy(F.greatest("d1", "p.other").alias("u"), F.least("d1", "p.other").alias("v"))
            .agg(F.max("p.sure").alias("sure")))


#: Bits of the table (fixed size) of the keys that a join will find.
MARKS_LOG2 = 24


def _met(rows: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """The rows whose columns `names` stand in `keys`, and the few others that
    share their bits: they need not be moved to be told apart."""
    place = F.shiftrightunsigned(F.xxhash64(*names), 64 - MARKS_LOG2)
    marks = (keys.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, int(place & 63)))").alias("marks")))
    return (rows.withColumn("place", place).join(F.broadcast(marks), F.shiftright("place", 6) == F.col("word"))
            .where("getbit(marks, int(place & 63)) = 1").drop("place", "word", "marks"))


def _edges(sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): edges whose components hold every possible link."""
    pairs = stash(_possible(sets), "set-pairs")
    open_ = pairs.where("NOT sure")
    ends = open_.select(F.explode(F.array("u", "v")).alias("d1"))
    bits = _met(sets.where("bits IS NOT NULL").select("d1", "bits", "slack", "most"), ends, "d1").groupBy("d1")
    bits = stash(bits.agg(F.max("slack").alias("slack"), F.max("most").alias("most"), F.any_value("bits").alias("bits")),
                 "set-bits")
    of = {c: bits.select(F.col("d1").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in ("slack", "most", "bits"))) for c in "uv"}
    near = stash(open_.drop("sure").join(of["u"], "u").join(of["v"], "v").mapInArrow(_near_pairs(percent), "u long, v long"),
                 "near-pairs")
    discard(bits)
    return near.union(pairs.where("sure").select("u", "v")).union(sets.select("d1", F.explode("near").alias("other")))


def _whole_sets(width: int, table):
    """The sets of representatives, where the text is the one the class has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["grp", "blocks", "cls", "d1", "d2", "m"]
        for batch in batches:
            col = {c: batch.column(batch.schema.get_field_index(c)) for c in names}
            d1, d2 = col["d1"].to_numpy(), col["d2"].to_numpy()
            for a, b, data, offs in text_slices(batch, column="text"):
                h, _, at = ordered_sets(data, offs, width, table.value)
                same = np.array([_digest(h[s:e]) == (x, y) for s, e, x, y in zip(at, at[1:], d1[a:b], d2[a:b])], bool)
                sets = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))
                out = [col[c].slice(a, b - a) for c in ("grp", "blocks", "cls", "m")] + [sets]
                yield pa.RecordBatch.from_arrays(out, names=["grp", "blocks", "cls", "m", "tokens"]).filter(pa.array(same))
    return run


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Concatenated ranges start..end."""
    size = end - start
    if not len(size) or not size.sum():
        return np.zeros(0, np.int64)
    ends = np.cumsum(size)
    return np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(start, size)


class Lists:
    """Index lists of the shingles that several sets have.  The sets stand by
    size, so one search in (list, rank) skips the block of sets too small, and
    another that of those too large."""

    def __init__(self, ident: np.ndarray, owner: np.ndarray, sets: int):
        by = np.lexsort((owner, ident))
        self.sets, self.post = sets, owner[by]
        size = np.bincount(ident, minlength=int(ident.max(initial=-1)) + 1)
        self.shared = size > 1
        self.place = np.repeat(np.arange(len(size)), size) * sets + self.post

    def __call__(self, t: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """The sets from `lo` to before `hi` that have a shingle of `t`, once for each."""
        return self.post[_ranges(np.searchsorted(self.place, t * self.sets + lo),
                                 np.searchsorted(self.place, t * self.sets + hi))]


def _tally(post: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(sets in order, how often each stands in `post`)."""
    if len(post) * 4 < hi - lo:
        return np.unique(post, return_counts=True)
    c = np.bincount(post - lo, minlength=hi - lo)
    at = np.flatnonzero(c)
    return at + lo, c[at]


def _among(post: np.ndarray, sets: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """How often each of `sets` (in order) stands in `post`."""
    if len(post) * 4 >= hi - lo:
        return np.bincount(post - lo, minlength=hi - lo)[sets - lo]
    at = np.searchsorted(sets, post)
    at = at[sets[np.minimum(at, len(sets) - 1)] == post] if len(sets) else at[:0]
    return np.bincount(at, minlength=len(sets))


def answers(tokens: np.ndarray, offs: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(set, the sets not yet asked of which 100 * common >= percent * union)
    for each set, smallest first.

    A leader keeps the counts of the sets that a follower could link with, and
    no others: a follower adds at most the shingles that the leader lacks.  It
    drops them when its last follower has been answered."""
    n = np.diff(offs)
    order = np.argsort(n, kind="stable")
    rank = np.empty(len(n), np.int64)
    rank[order] = np.arange(len(n))
    size = n[order]
    _, ident = np.unique(tokens, return_inverse=True)
    lists = Lists(ident, rank[np.repeat(np.arange(len(n)), n)], len(n))
    end = np.searchsorted(size, size * 100 // percent, "right")     # sets from here on are too large

    def own(x: int) -> np.ndarray:
        t = ident[offs[order[x]]:offs[order[x] + 1]]
        return np.sort(t[lists.shared[t]])

    close, leader = np.zeros(len(n)), np.full(len(n), -1)
    kept: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}   # leader: its shingles, sets, counts
    followers = np.zeros(len(n), np.int64)
    for x in range(len(n)):
        hi, w, t = int(end[x]), int(leader[x]), own(x)
        if w >= 0:
            base, sets, got = kept[w]
            at = slice(*np.searchsorted(sets, [x + 1, hi]))
            sets, got = sets[at], got[at]
            less, more = np.setdiff1d(base, t, assume_unique=True), np.setdiff1d(t, base, assume_unique=True)
            got = got - _among(lists(less, x + 1, hi), sets, x + 1, hi) + _among(lists(more, x + 1, hi), sets, x + 1, hi)
        else:
            sets, got = _tally(lists(t, x + 1, hi), x + 1, hi)
        union = size[x] + size[sets] - got
        hit = 100 * got >= percent * union
        found = sets[hit]
        if w < 0 and len(found):
            ratio = got[hit] / union[hit]
            better = ratio > np.maximum(close[found], 0.75)
            mine = found[better]
            added = int((size[mine] - got[hit][better]).max(initial=0))
            # two sets link if 100 + percent times their common shingles reach percent times their sizes
            if len(mine) and (100 + percent) * added < percent * 2 * size[x]:
                old = leader[mine]
                np.subtract.at(followers, old[old >= 0], 1)
                for y in np.unique(old[old >= 0]).tolist():
                    if not followers[y]:
                        kept.pop(y, None)
                close[mine], leader[mine] = ratio[better], x
                followers[x] = len(mine)
                # a follower is larger, and so are the sets that it can link with
                more, count = _tally(lists(t, hi, far := int(end[mine.max()])), hi, far)
                sets, got = np.concatenate([sets, more]), np.concatenate([got, count])
                near = (100 + percent) * (got + added) >= percent * (size[x] + size[sets])
                kept[x] = t, sets[near], got[near]
        if w >= 0:
            followers[w] -= 1
            if not followers[w]:
                kept.pop(w)
        yield int(order[x]), order[found]


def join_sets(tokens: np.ndarray, offs: np.ndarray, percent: int, weight: np.ndarray, ids: np.ndarray,
              side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(weight of the sets that each links with, smallest id reachable by links);
    with `side`, the block of each set, only links of different blocks count."""
    links = np.zeros(len(ids), np.int64)
    up = np.arange(len(ids))        # a set on the way to its component's

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = int(up[x])
        return x

    for x, found in answers(tokens, offs, percent):
        if side is not None:
            found = found[side[found] != side[x]]
        if len(found):
            links[x] += weight[found].sum()
            links[found] += weight[x]
            above = up[found]
            if (above != above[0]).any() or up[x] != above[0]:
                tops = {top(y) for y in np.unique(above).tolist()} | {top(x)}
                best = min(tops, key=lambda y: ids[y])
                up[list(tops)] = best
                up[found] = best
    while (up[up] != up).any():
        up = up[up]
    return links, ids[up]


def _join(percent: int):
    def run(key, t):
        cls, m, block = (t.column(c).to_numpy() for c in ("cls", "m", "block"))
        keep = np.unique(cls, return_index=True)[1]           # repeated rows of a representative
        t = t.take(pa.array(keep))
        cls, m, block = cls[keep], m[keep], block[keep]
        sets = t.column("tokens").combine_chunks()
        offs = sets.offsets.to_numpy().astype(np.int64)
        links, root = join_sets(sets.flatten().to_numpy(), offs - offs[0], percent, m, cls,
                                None if key[1].as_py() == key[2].as_py() else block)
        at = np.flatnonzero(links)
        return pa.table([pa.array(cls[at]), pa.array(links[at]), pa.array(root[at])], names=["cls", "links", "root"])
    return run


def _prepared(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def link(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles, n_links, component_id."""
    spark = docs.sparkSession
    own = _prepared(docs)
    table = spark.sparkContext.broadcast(order_table(own, width))   # 16 MB, whatever the corpus
    sets = stash(own.mapInArrow(_prefixes(width, percent, table), SETS), "sets")

    groups = components(_edges(sets, percent), "u", "v")
    ids = stash(sets.select("doc_id", "h", "d1", "d2", "n"), "set-ids")
    discard(sets)

    classes = (ids.where("n > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2")
               .agg(F.min(F.struct("doc_id", "h")).alias("rep"), F.count("*").alias("m"), F.first("n").alias("n")))
    classes = stash(classes.select("d1", "d2", F.col("rep.doc_id").alias("cls"), F.col("rep.h").alias("h"), "m", "n"),
                    "set-classes")
    member = stash(classes.join(groups.withColumnRenamed("node", "d1"), "d1"), "set-groups")
    sizes = member.groupBy("root").agg(F.sum("n").alias("total"), F.count("*").alias("k")).where("k > 1")
    bins = 1 + (sizes.agg(F.sum("total")).first()[0] or 0) // TASK_SHINGLES
    blocks = F.ceil(F.col("total") * 2 / TASK_SHINGLES).cast("int")
    sizes = sizes.withColumn("blocks", F.when(F.col("total") <= TASK_SHINGLES, 1).otherwise(blocks))
    grp = F.when(F.col("blocks") == 1, F.concat(F.lit("s"), F.pmod(F.xxhash64("root"), F.lit(bins)))).otherwise(
        F.concat(F.lit("l"), "root"))
    asked = member.join(sizes, "root").select(grp.alias("grp"), "blocks", "cls", "h", "d1", "d2", "m")
    whole = (_met(own.withColumnRenamed("doc_id", "cls"), asked, "cls", "h").join(asked, ["cls", "h"])
             .select("grp", "blocks", "cls", "d1", "d2", "m", "text")
             .mapInArrow(_whole_sets(width, table), "grp string, blocks int, cls long, m long, tokens array<long>"))
    dealt = (whole.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")}))
    found = stash(dealt.select("grp", "a", "b", "cls", "m", "block", "tokens").groupBy("grp", "a", "b").applyInArrow(
        _join(percent), "cls long, links long, root long"), "set-links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found, "cls", "root").withColumnRenamed("node", "cls")
    per = (classes.join(links, "cls", "left").join(roots, "cls", "left")
           .select("d1", "d2", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                   F.coalesce("root", "cls").alias("component_id")))
    out = ids.join(per, ["d1", "d2"], "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    return out.select("doc_id", "h", F.col("n").cast("long").alias("n_shingles"),
                      F.when(alone, 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
                      F.when(alone, F.col("doc_id")).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """The documents whose id is the smallest of their component, one row each;
    those with an empty set and those without an id stay as they are."""
    found = link(docs, width, percent)
    stay = found.where((F.col("component_id") == F.col("doc_id")) | F.col("doc_id").isNull())
    # a hash of the id is never null, so the join and the removal of repeated rows share one shuffle
    key = F.xxhash64(F.col("doc_id").cast("long")).alias("id")
    stay = stay.select(key, "h").distinct()
    # the row stands aside as one column, so that no name of its own can clash
    kept = docs.select(F.struct("*").alias("row"), key, F.xxhash64(F.col("text").cast("string")).alias("h"))
    return kept.join(stay, ["id", "h"], "left_semi").dropDuplicates(["id", "h"]).select("row.*")
