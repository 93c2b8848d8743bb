"""Phrase collocations by vertical partitioning of a word suffix tree.

A text is split into pieces and words; the suffix that starts at each word,
truncated to a depth of `longest` words, is a leaf of the tree, and the count of
a phrase is the total of the leaves below its node.

1. Words are counted in a table of COUNTERS counters by their hash, then pairs of
   words that may be frequent, and so on to the depth.  A run of words whose
   counter is below `least` is certainly rarer than that, and so is every phrase
   that holds it: a suffix is cut short where its next run is.  The tables only
   save work, equal hashes cost rows and no results.
2. Each task writes the suffixes of its slices with their counts, equal ones
   added up before the shuffle: the leaves.
3. Vertical partitioning: leaves are counted by their first word (in buckets of
   its hash); a bucket of more than `budget` leaves is counted again by two
   words, and so on to the full depth, where a bucket holds few leaves because
   all leaves differ.  Buckets are packed into groups of at most twice the
   budget, each group one task's memory, so that no frequent word makes a large
   task.
4. Each group sorts its leaves word by word and reads the count of every node as
   the sum of its run of leaves.  Nodes above the depth by which a group was
   chosen may lie in several groups; their parts are added up.
5. Nodes of at least `least` are the frequent phrases; candidates are joined with
   their parts' counts for each cut.  A longer phrase that holds a candidate as
   often as it stands also holds it in a phrase of one word more, so only those
   are looked at.

Scores are exact: products are decimals of 38 digits, the division is integral.

Defined results: a null text is empty; a null language counts as `und`; rows with
equal ids or texts count each; pieces never cross documents; a cut's ties go to
the smallest k; an empty table gives an empty frame; only the text and language
columns are read, so names of other columns never matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import LOWER, MIX2, mix, range_hashes, stash, text_slices, word_spans

#: Counters of runs of words, leaves of a group, bytes of text of a slice.
COUNTERS, BUDGET, SLICE = 1 << 22, 150_000, 1 << 19
#: Bytes that end a piece, and bytes that end a word.
ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
ENDS_WORD = ENDS_PIECE.copy()
ENDS_WORD[[0x20, 0x09]] = True


def _languages(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(code of each row, names, a hash of each name) of the language column."""
    lang = batch.column(batch.schema.get_field_index("lang")).cast(pa.string()).fill_null("und").dictionary_encode()
    names = lang.dictionary.to_pylist()
    keys = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names]
    return lang.indices.to_numpy(zero_copy_only=False).astype(np.int64), names, np.array(keys, np.uint64)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all ranges that begin at `start`, one after the other."""
    at = np.repeat(start - (np.cumsum(size) - size), size)
    at += np.arange(len(at))
    return at


class Words:
    """The words of a slice of texts."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, codes: np.ndarray, keys: np.ndarray):
        self.data = LOWER[data]
        self.start, self.end, row = word_spans(ENDS_WORD[self.data], offs)
        self.code = codes[row]
        n = len(self.start)
        marks = np.concatenate([[0], np.cumsum(ENDS_PIECE[self.data])])
        self.paired = np.zeros(n, bool)      # whether the next word stands in the same piece
        if n > 1:
            self.paired[:-1] = (row[1:] == row[:-1]) & (marks[self.start[1:]] == marks[self.end[:-1]])
        self.hash = mix(range_hashes(self.data, self.start, self.end) ^ keys[self.code]) if n else np.zeros(0, np.uint64)

    def runs(self, frequent: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1, 2, ... words: (whether a run of so many begins at each word that
        may be frequent as far as shorter runs tell, its counter).  The last of
        them has no table in `frequent` yet."""
        alive, h = np.ones(len(self.hash), bool), self.hash
        for size in range(1, len(frequent) + 2):
            if size > 1:
                shorter = alive & frequent[size - 2][counter]
                alive = shorter & self.paired
                alive[:-1] &= shorter[1:]
                after = np.zeros(len(h), np.uint64)
                after[:max(len(h) - size + 1, 0)] = self.hash[size - 1:]
                with np.errstate(over="ignore"):
                    h = mix(h * MIX2 + after)
            counter = (h & np.uint64(COUNTERS - 1)).astype(np.int64)
            yield alive, counter

    def leaves(self, frequent: list[np.ndarray]) -> tuple[np.ndarray, pa.Array]:
        """(language code, phrase) of the truncated suffix of every word; the
        phrase is empty where the word itself is rare."""
        n = len(self.start)
        depth = np.zeros(n, np.int64)
        for (alive, counter), table in zip(self.runs(frequent), frequent):
            depth += alive & table[counter]
        size = self.end - self.start
        place = np.concatenate([[0], np.cumsum(size + 1)])     # words joined by single blanks
        text = np.full(place[-1], 0x20, np.uint8)
        text[_ranges(place[:-1], size)] = self.data[_ranges(self.start, size)]
        length = np.where(depth > 0, place[np.arange(n) + depth] - 1 - place[:-1], 0)
        offs = np.concatenate([[0], np.cumsum(length)])
        raw = text[_ranges(place[:-1], length)]
        return self.code, pa.LargeStringArray.from_buffers(n, pa.py_buffer(offs), pa.py_buffer(raw))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[Words, list[str]]]:
    codes, names, keys = _languages(batch)
    for a, b, data, offs in text_slices(batch, "text", SLICE):
        yield Words(data, offs, codes[a:b], keys), names


def _tables(bits: list[bytes]) -> list[np.ndarray]:
    return [np.unpackbits(np.frombuffer(x, np.uint8), bitorder="little").astype(bool) for x in bits]


def _count_runs(bits: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, total = _tables(bits), np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for words, _ in _slices(batch):
                *_, (alive, counter) = words.runs(frequent)
                np.add.at(total, counter[alive], 1)
        for i in range(0, COUNTERS, 1 << 17):
            at = i + np.flatnonzero(total[i:i + (1 << 17)])
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["counter", "n"])
    return run


def frequent_counters(docs: DataFrame, least: int, longest: int) -> list[bytes]:
    """For runs of 1 to `longest` words one bit for each counter: whether it
    reaches `least`.  A pass over the texts for each length; the driver gets
    COUNTERS bits a pass, whatever the size of the corpus."""
    word = F.shiftrightunsigned("counter", 6).alias("word")
    bit = F.expr("shiftleft(1L, CAST(counter % 64 AS INT))")
    found: list[bytes] = []
    for _ in range(longest):
        counts = docs.mapInArrow(_count_runs(found), "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
        bits = np.zeros(COUNTERS // 64, np.int64)
        for r in counts.where(F.col("n") >= least).groupBy(word).agg(F.bit_or(bit).alias("bits")).collect():
            bits[r["word"]] = r["bits"]
        found.append(bits.tobytes())
    return found


def _write_leaves(bits: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = _tables(bits)
        for batch in batches:
            for words, names in _slices(batch):
                if len(words.start) == 0:
                    continue
                code, phrase = words.leaves(frequent)
                t = pa.table([pa.array(code), phrase], names=["code", "phrase"])
                t = t.group_by(["code", "phrase"]).aggregate([([], "count_all")])
                lang = pa.array(names, pa.string()).take(t.column("code").combine_chunks())
                yield from pa.table([lang, t.column("phrase").cast(pa.string()), t.column("count_all")],
                                    names=["lang", "phrase", "n"]).to_batches(max_chunksize=50_000)
    return run


def _bucket(depth: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64("lang", F.substring_index("phrase", " ", depth)), F.lit(buckets)).alias(f"b{depth}")


def group_leaves(leaves: DataFrame, budget: int, longest: int) -> DataFrame:
    """`leaves` with the depth of the prefix that chose their group and the group."""
    spark = leaves.sparkSession
    rows = leaves.count()
    buckets = 1 << min(20, max(4, (4 * rows // budget).bit_length()))
    routes, at, left = [], 0, leaves
    for depth in range(1, longest + 1):
        sizes = left.groupBy(_bucket(depth, buckets)).count().collect()     # at most `buckets` rows
        light = sorted((r[0], r[1]) for r in sizes if r[1] <= budget or depth == longest)
        heavy = [(r[0],) for r in sizes if r[1] > budget and depth < longest]
        used = 0
        route = []
        for b, n in light:
            if used + n > budget and used:
                at, used = at + 1, 0
            used += n
            route.append((b, depth, at))
        at += 1
        routes.append(spark.createDataFrame(route, f"b{depth} long, depth{depth} int, group{depth} int"))
        if not heavy:
            break
        more = spark.createDataFrame(heavy, f"b{depth} long")
        left = left.withColumn(f"b{depth}", _bucket(depth, buckets)).join(F.broadcast(more), f"b{depth}", "left_semi") \
            .select("lang", "phrase")
    out = leaves
    for i, route in enumerate(routes, 1):     # each route has at most `buckets` rows
        out = out.withColumn(f"b{i}", _bucket(i, buckets)).join(F.broadcast(route), f"b{i}", "left")
    own = range(1, len(routes) + 1)
    return out.select("lang", "phrase", "n", F.coalesce(*(f"depth{i}" for i in own)).alias("depth"),
                      F.coalesce(*(f"group{i}" for i in own)).alias("group"))


def subtree(t: pa.Table, least: int, longest: int) -> pa.Table:
    """(lang, phrase, words, n) of the nodes of the tree over a group's leaves:
    those of at least `least`, and all above the depth of the group's prefix."""
    lists = pc.split_pattern(t.column("phrase").combine_chunks().cast(pa.large_string()), " ")
    words = lists.flatten().dictionary_encode()
    vocabulary = words.dictionary.to_pylist()
    offs = np.asarray(lists.offsets)
    size = np.diff(offs)
    codes = words.indices.to_numpy(zero_copy_only=False)
    grid = np.full((len(size), longest), -1, np.int64)
    row = np.repeat(np.arange(len(size)), size)
    grid[row, np.arange(len(codes)) - (offs[:-1] - offs[0])[row]] = codes
    lang = t.column("lang").combine_chunks().dictionary_encode()
    code = lang.indices.to_numpy(zero_copy_only=False)
    order = np.lexsort([grid[:, d] for d in range(longest - 1, -1, -1)] + [code])
    grid, code, size = grid[order], code[order], size[order]
    n, upper = t.column("n").to_numpy()[order], t.column("depth").to_numpy()[order]
    names, out = lang.dictionary.to_pylist(), ([], [], [], [])
    new = np.ones(len(size), bool)           # where a run of equal prefixes begins
    new[1:] = code[1:] != code[:-1]
    for d in range(1, longest + 1):
        new[1:] |= grid[1:, d - 1] != grid[:-1, d - 1]
        begin = np.flatnonzero(new)
        total = np.add.reduceat(n, begin)
        # leaves shorter than d form runs of their own; they end above
        keep = (size[begin] >= d) & ((total >= least) | (upper[begin] > d))
        for i, c in zip(begin[keep].tolist(), total[keep].tolist()):
            out[0].append(names[code[i]])
            out[1].append(" ".join([vocabulary[x] for x in grid[i, :d].tolist()]))
            out[2].append(d)
            out[3].append(c)
    return pa.table([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32()),
                     pa.array(out[3], pa.int64())], names=["lang", "phrase", "words", "n"])


def frequent_phrases(leaves: DataFrame, least: int, longest: int, budget: int) -> DataFrame:
    """(lang, phrase, words, n) of all phrases that stand at least `least` times."""
    def run(t: pa.Table) -> pa.Table:
        return subtree(t, least, longest)
    nodes = group_leaves(leaves, budget, longest).groupBy("group").applyInArrow(
        run, "lang string, phrase string, words int, n long")
    return nodes.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def mine(docs: DataFrame, least: int = 100, longest: int = 5, percent: int = 100, top: int = 2000,
         text_col: str = "text", lang_col: str = "lang", budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of 2 to
    `longest` words that stand at least `least` times and in no longer such phrase
    with `percent` of their count."""
    own = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    leaves = own.mapInArrow(_write_leaves(frequent_counters(own, least, longest)), "lang string, phrase string, n long")
    leaves = stash(leaves.groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "leaves")
    nodes = stash(frequent_phrases(leaves.where("phrase <> ''"), least, longest, budget), "phrases")

    word = F.split("phrase", " ")
    inside = nodes.where("words > 2").select("lang", "n", F.explode(F.array(
        F.array_join(F.slice(word, F.lit(1), F.col("words") - 1), " "),
        F.array_join(F.slice(word, F.lit(2), F.col("words") - 1), " "))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = nodes.where("words > 1").withColumnRenamed("n", "a").join(inside, ["lang", "phrase"], "left")
    kept = kept.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * percent))
    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice(word, F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice(word, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    part = nodes.select("lang", "phrase", "n")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = cuts.join(leaves.groupBy("lang").agg(F.sum("n").alias("n")), "lang")     # each word begins one leaf
    long = "CAST({} AS DECIMAL(19, 0))"
    score = F.expr(f"(1000BD * {long.format('a')} * {long.format('n')}) div ({long.format('l')} * {long.format('r')})")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("c"))
    scored = scored.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
