"""Hard negatives by the threshold algorithm over sorted lists.

For each anchor its best rows of the same label are its positives; for each
positive the best rows of other labels whose score lies in a window of
percentages of the positive's score are its hard negatives.  Scores are integer
inner products of quantised vectors.

Rows are dealt into tiles, anchors into groups, and a task gets one tile and one
group.  In a tile every dimension has a list of the rows sorted by its value.
An anchor reads the lists in parallel, from the top where its own component is
positive and from the bottom where it is negative; a row that turns up for the
first time is scored whole by random access.  No row that has not turned up can
score above the threshold, the sum of the anchor's components times the values
reached.  An anchor is done when the threshold is strictly below the k-th best
score that it waits for (so that ties are all seen) or below all scores that
its windows admit.  Positives are searched first, in tiles of whole labels (a
label of more than TILE rows is split); their scores give the windows of the
second search, which runs over tiles of all rows and leaves out the anchor's
own label.

Defined results: rows with a null id, a null label, or a vector that is null,
empty or holds a null or non-finite component take no part; vectors of different
length are never compared; a row is told from others with the same id, so
repeated rows are anchors, positives and negatives each on their own; ties go to
the smaller id; a positive with a score of 0 admits scores of 0, one with a
negative score admits none; an empty table gives an empty frame; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stash
from salesmart.llm.topk import valid

#: Rows of a tile, anchors of a group, entries of each list read in the first round.
TILE, GROUP, FIRST = 16_384, 4_096, 32


class SortedLists:
    """A tile's rows and, for each dimension, their order by its value."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.upright = np.ascontiguousarray(rows.T)
        self.order = np.argsort(self.upright, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(self.upright, self.order, axis=1)

    def rounds(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(rows seen for the first time, their scores, threshold of the unseen)
        after each round of accesses; a round reads twice as deep as the last."""
        n = len(self.rows)
        up, down = np.flatnonzero(anchor < 0), np.flatnonzero(anchor > 0)
        if len(up) + len(down) == 0:
            down = np.zeros(1, np.int64)      # a zero anchor scores 0 with every row of any list
        seen = np.zeros(n, bool)
        depth, step = 0, FIRST
        while depth < n:
            stop = min(n, depth + step)
            turned = np.zeros(n, bool)
            turned[self.order[up, depth:stop]] = True
            turned[self.order[down, n - stop:n - depth]] = True
            turned &= ~seen
            seen |= turned
            new = np.flatnonzero(turned)
            bound = anchor[up] @ self.values[up, stop - 1] + anchor[down] @ self.values[down, n - stop]
            yield new, self.rows[new] @ anchor, int(bound)
            depth, step = stop, 2 * step


def best(lists: SortedLists, ids: np.ndarray, anchor: np.ndarray, k: int, skip: int = -1):
    """(positions, scores) of the k best rows but row `skip`; ties to smaller ids."""
    at, score = np.zeros(0, np.int64), np.zeros(0, anchor.dtype)
    for new, more, bound in lists.rounds(anchor):
        mine = new != skip
        at, score = np.concatenate([at, new[mine]]), np.concatenate([score, more[mine]])
        top = np.lexsort((ids[at], -score))[:k]
        at, score = at[top], score[top]
        if len(at) == k and bound < score[-1]:
            break
    return at, score


def best_in_windows(lists: SortedLists, ids: np.ndarray, other: np.ndarray, anchor: np.ndarray,
                    low: np.ndarray, high: np.ndarray, k: int):
    """For each window [low, high] of scores the (positions, scores) of its k
    best rows among those with `other`; ties to smaller ids."""
    found = [(np.zeros(0, np.int64), np.zeros(0, anchor.dtype))] * len(low)
    waits = [w for w in range(len(low)) if low[w] <= high[w]]
    if not waits:
        return found
    for new, score, bound in lists.rounds(anchor):
        mine = other[new]
        new, score = new[mine], score[mine]
        still = []
        for w in waits:
            inside = (score >= low[w]) & (score <= high[w])
            at, own = np.concatenate([found[w][0], new[inside]]), np.concatenate([found[w][1], score[inside]])
            top = np.lexsort((ids[at], -own))[:k]
            found[w] = at[top], own[top]
            done = bound < low[w] or (len(top) == k and bound < found[w][1][-1])
            if not done:
                still.append(w)
        waits = still
        if not waits:
            break
    return found


def _exact(rows: np.ndarray, anchors: np.ndarray) -> type:
    """The faster type in which all inner products sum exactly."""
    size = float(np.abs(rows).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * rows.shape[1]
    return np.float64 if size < 2**53 else np.int64


def _matrix(t: pa.Table, dims: int) -> np.ndarray:
    return t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _numbers(t: pa.Table, *names: str) -> list[np.ndarray]:
    return [t.column(c).to_numpy() for c in names]


def _table(columns: list[list], names: list[str]) -> pa.Table:
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def _search_positives(k: int):
    def run(key, tile: pa.Table, group: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        dims = key[0].as_py()
        if tile.num_rows and group.num_rows:
            uid, ids, label = _numbers(tile, "uid", "id", "label")
            asked, wanted = _numbers(group, "uid", "label")
            rows, anchors = _matrix(tile, dims), _matrix(group, dims)
            kind = _exact(rows, anchors)
            for own in np.unique(wanted).tolist():
                at = np.flatnonzero(label == own)
                if len(at) == 0:
                    continue
                lists, of_label = SortedLists(rows[at].astype(kind)), uid[at]
                place = {u: i for i, u in enumerate(of_label.tolist())}
                for i in np.flatnonzero(wanted == own).tolist():
                    hit, score = best(lists, ids[at], anchors[i].astype(kind), k, place.get(int(asked[i]), -1))
                    out[0].extend([int(asked[i])] * len(hit))
                    out[1].extend(of_label[hit].tolist())
                    out[2].extend(ids[at][hit].tolist())
                    out[3].extend(int(s) for s in score)
        return _table(out, ["anchor", "positive", "positive_id", "positive_score"])
    return run


def _search_negatives(k: int):
    def run(key, tile: pa.Table, group: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        dims = key[0].as_py()
        if tile.num_rows and group.num_rows:
            ids, label = _numbers(tile, "id", "label")
            asked, own = _numbers(group, "uid", "label")
            rows, anchors = _matrix(tile, dims), _matrix(group, dims)
            kind = _exact(rows, anchors)
            lists = SortedLists(rows.astype(kind))
            low, high = group.column("low").to_pylist(), group.column("high").to_pylist()
            for i, anchor in enumerate(anchors.astype(kind)):
                found = best_in_windows(lists, ids, label != own[i], anchor, low[i], high[i], k)
                for w, (hit, score) in enumerate(found):
                    out[0].extend([int(asked[i])] * len(hit))
                    out[1].extend([low[i][w]] * len(hit))
                    out[2].extend([high[i][w]] * len(hit))
                    out[3].extend(ids[hit].tolist())
                    out[4].extend(int(s) for s in score)
        return _table(out, ["anchor", "low", "high", "negative_id", "negative_score"])
    return run


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         id_col: str = "vec_id", label_col: str = "label", column: str = "embedding", scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each anchor (rows where `is_anchor` holds, a condition on the column
    `id`) and each of its `positives` best rows of the same label, the
    `negatives` best rows of other labels with low * positive_score <=
    100 * negative_score <= high * positive_score."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(column).cast("array<double>").alias("x"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & valid(F.col("x")))
    rows = stash(rows.select(F.monotonically_increasing_id().alias("uid"), "id", "label",
                             F.transform("x", lambda c: F.floor(c * scale)).alias("v"), F.size("x").alias("dims"),
                             F.coalesce(is_anchor, F.lit(False)).alias("asked")), "vectors")
    n, nq = rows.agg(F.count("*"), F.count(F.when(F.col("asked"), 1))).first()
    tiles, groups = max(1, -(-n // TILE)), max(1, -(-nq // GROUP))
    # columns of their own, so that anchors and rows can meet in one plan
    anchors = rows.where("asked").select(*(F.col(c).alias(c) for c in ("uid", "id", "label", "v", "dims")))
    by = F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int")
    each_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))

    # tiles of whole labels; a label of more than TILE rows is split evenly
    sizes = rows.groupBy("dims", "label").agg(F.ceil(F.count("*") / TILE).cast("int").alias("splits"))
    bucket = F.pmod(F.xxhash64("label"), F.lit(tiles)).cast("int").alias("bucket")
    left = rows.join(sizes, ["dims", "label"]).select(
        "uid", "id", "label", "v", "dims", bucket,
        F.pmod(F.xxhash64("uid"), F.col("splits")).cast("int").alias("split"), each_group.alias("part"))
    right = anchors.join(sizes, ["dims", "label"]).select(
        "uid", "label", "v", "dims", bucket, F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"), by.alias("part"))
    keys = ("dims", "bucket", "split", "part")
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _search_positives(positives), "anchor long, positive long, positive_id long, positive_score long")
    place = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive")
    near = near.withColumn("r", F.row_number().over(place)).where(F.col("r") <= positives)
    score = F.col("positive_score").cast("decimal(20,0)")     # times a percentage it may pass 64 bits
    least = F.ceil(score * low / F.lit(100).cast("decimal(3,0)")).cast("long")
    most = F.floor(score * high / F.lit(100).cast("decimal(3,0)")).cast("long")
    near = stash(near.withColumns({"low": least, "high": most}).drop("r"), "positives")

    # the scores of the positives are the windows of the second search
    windows = near.where("low <= high").groupBy("anchor").agg(F.sort_array(F.collect_set(F.struct("low", "high"))).alias("w"))
    asked = anchors.join(windows, anchors.uid == windows.anchor).select(
        "uid", "label", "v", "dims", F.col("w.low").alias("low"), F.col("w.high").alias("high"),
        F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), by.alias("part"))
    left = rows.select("id", "label", "v", "dims", F.pmod(F.xxhash64("uid"), F.lit(tiles)).cast("int").alias("tile"),
                       each_group.alias("part"))
    keys = ("dims", "tile", "part")
    hard = left.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        _search_negatives(negatives), "anchor long, low long, high long, negative_id long, negative_score long")
    found = near.join(hard, ["anchor", "low", "high"])
    place = Window.partitionBy("anchor", "positive").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= negatives)
    own = anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(own, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
