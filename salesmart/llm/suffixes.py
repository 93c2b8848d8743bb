"""Remove repeated passages: byte strings of `length` that start more than once.

A text's windows are its strings of `length` bytes.  Tasks find the anchor of
each window: its substring of GRAM bytes with the smallest hash, the rightmost
if several are equal.  Equal windows have equal anchors at equal places, so
everything about a window can be decided where its anchor's hash is.  Windows
that stand next to each other and have the same anchor are one run.

1. Runs with equal bytes are one class; a class with two runs is repeated whole.
2. Where an anchor has runs of several classes, the bytes of one run of each
   class go to the anchor's task.  It sorts the suffixes that begin a window by
   prefix doubling up to `length`, takes the common prefixes of neighbours, and
   finds each suffix's previous and next smaller place in suffix order; the
   longer of what it shares with the two is its longest previous factor.  A
   window whose factor reaches `length` stands earlier.  An anchor with very many
   classes has its runs cut by how far windows begin before it: what all windows
   of a piece share, its core, must be equal where windows are, so pieces meet
   core by core and one whose core nobody shares needs no more work.  A core with
   very many pieces is dealt to several tasks, of whose windows one each is then
   matched by a 128-bit hash.
3. Each document's repeated windows are cut out: with keep="none" all of them,
   with keep="first" all but those at the first (document, place).

Positions are judged on the input.  Matches never cross documents.

With words=True all of this is done on words instead of bytes: a text is the
sequence of its words' 64-bit hashes, `length` counts words, and what is cut goes
from the first byte of a stretch's first word to the last byte of its last.
What stands between words is not compared.  Letters of scripts written without
spaces are a word each; a longer word counts as one for each LONG bytes.

Defined results: null text is empty and loses nothing; texts shorter than
`length` lose nothing; repeated rows are separate documents that repeat each
other (with keep="first", rows with equal id and text keep the same bytes); an
empty table gives an empty frame.  Only `doc_id` and `text` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesmart.llm.common import powers, mix, range_hashes, stash, text_slices, unused

#: Bytes of an anchor; windows cut from one text at once; classes of one anchor that a task holds; pieces of a run.
GRAM, STARTS, TASK_CLASSES, PIECES = 100, 1 << 20, 4_000, 8
#: Bytes of a word, or of a piece of a longer one.
LONG = 32

#: Bytes that words consist of; those of multi-byte characters but for the punctuation in words_of().
_IN_WORD = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])

RUNS = "doc_id long, h long, lo long, hi long, gram long, c1 long, c2 long"
OPEN = "doc_id long, h long, gram long, c1 long, parts long, lo long, bytes binary"
PIECE = "doc_id long, h long, c1 long, core long, k1 long, k2 long, lo long, bytes binary"
MATCHES = "doc_id long, h long, lo long, a long, b long, w1 long, w2 long, place long"


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of each substring of `size` bytes, by its first byte."""
    n = len(data)
    up, down = powers(n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        return mix((total[size:] - total[:n + 1 - size]) * down[:n + 1 - size])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def runs_of(data: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """(row, first start, last start, anchor hash) of the runs of each row's
    windows; starts are counted in `data`."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    hashes = gram_hashes(data, gram)
    # the high bits order, the low bits name the place: the rightmost of equal grams is smallest
    bits = np.uint64(max(1, int(len(hashes)).bit_length()))
    place = np.arange(len(hashes), dtype=np.uint64)
    low = sliding_min((hashes >> bits << bits) | (np.uint64(len(hashes)) - place), length - gram + 1)
    anchor = len(hashes) - (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row = np.searchsorted(offs, np.arange(len(low)), "right") - 1
    ok = np.arange(len(low)) + length <= offs[row + 1]
    start = np.flatnonzero(ok)
    if not len(start):
        return none, none, none, none
    a, r = anchor[start], row[start]
    new = np.ones(len(start), bool)
    new[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(start)) - 1
    return r[head], start[head], start[tail], hashes[a[head]].view(np.int64)


def words_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end byte) of the words of UTF-8 texts, and each text's place among them."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    word = _IN_WORD[data]
    after = np.append(data[1:], np.uint8(0))
    two = np.flatnonzero(data == 0xC2)                       # U+0080..U+00BF
    three = np.flatnonzero(((data == 0xE2) & ((after == 0x80) | (after == 0x81))) | ((data == 0xE3) & (after == 0x80)))
    for at, size in ((two, 2), (three, 3)):
        for k in range(size):
            word[at + k] = False
    first = word.copy()
    first[1:] &= ~word[:-1]
    heads = offs[:-1][offs[:-1] < len(data)]
    first[heads] = word[heads]
    # Thai to Tibetan, Myanmar, Khmer, kana and Han, and what lies beyond the BMP
    alone = np.flatnonzero(word & (((data == 0xE0) & (after >= 0xB8)) | ((data == 0xE1) & ((after <= 0x82) | (after == 0x9E) | (after == 0x9F)))
                                   | ((data >= 0xE3) & (data <= 0xE9)) | (data >= 0xF0)))
    first[alone] = True
    then = alone + np.where(data[alone] >= 0xF0, 4, 3)
    then = then[then < len(data)]
    first[then] = word[then]
    last = word.copy()
    last[:-1] &= ~word[1:] | first[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    parts = -(-(end - start) // LONG)
    if len(start) and parts.max() > 1:
        of = np.repeat(np.arange(len(start)), parts)
        k = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        start, end = start[of] + k * LONG, np.minimum(start[of] + (k + 1) * LONG, end[of])
    return start, end, np.searchsorted(start, offs)


def _symbols(data: np.ndarray, offs: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, or the hashes of their words, and the texts' borders among them."""
    if not words:
        return data, offs
    start, end, cuts = words_of(data, offs)
    out = np.zeros(len(start), np.uint64)
    border = np.append(np.searchsorted(start, np.arange(0, len(data), STARTS)), len(start))
    for a, b in zip(border, border[1:]):
        if a < b:
            base = start[a]
            out[a:b] = range_hashes(data[base:end[b - 1]], start[a:b] - base, end[a:b] - base)
    return out, cuts


def _pieces(data: np.ndarray, offs: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A slice as it is, or a text too long for one in overlapping parts:
    (first row, start in the text, bytes, offsets).  A cut only ends a run early."""
    if len(offs) > 2 or len(data) <= STARTS + length:
        yield 0, 0, data, offs
        return
    for s in range(0, len(data) - length + 1, STARTS):
        part = data[s:s + STARTS + length - 1]
        yield 0, s, part, np.array([0, len(part)])


def _runs(length: int, gram: int, words: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, data, offs in text_slices(batch):
                data, offs = _symbols(data, offs, words)
                for _, base, part, cuts in _pieces(data, offs, length):
                    row, lo, hi, grams = runs_of(part, cuts, length, gram)
                    if not len(row):
                        continue
                    view, size = memoryview(part.view(np.uint8)), part.itemsize
                    raw = b"".join([xxhash.xxh3_128_digest(view[s:e]) for s, e in zip((lo * size).tolist(), ((hi + length) * size).tolist())])
                    cls = np.frombuffer(raw, np.int64).reshape(-1, 2)
                    start, at = cuts[row] - base, pa.array(a + row)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(1).take(at)]
                        + [pa.array(x) for x in (lo - start, hi - start, grams, cls[:, 0], cls[:, 1])],
                        names=["doc_id", "h", "lo", "hi", "gram", "c1", "c2"])
    return run


def prefix_ranks(symbols: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of the first k symbols of every suffix, for k = 1, 2, 4, ... below
    `length` and `length` itself (bytes begin at 8), by prefix doubling.  A suffix
    that is shorter than k counts as if a symbol smaller than all followed."""
    n = len(symbols)
    if symbols.dtype == np.uint8 and length >= 8:
        padded = np.concatenate([symbols, np.zeros(8, np.uint8)])
        k, key = 8, np.zeros(n, np.uint64)
        for i in range(8):
            key = (key << np.uint64(8)) | padded[i:i + n]
    else:
        k, key = 1, symbols.astype(np.uint64)
    # a rank is the number of suffixes that are smaller, so a group's members keep their
    # ranks' order when the group is split, and suffixes that are alone need no more work
    rank, todo = np.zeros(n, np.uint64), np.arange(n)
    out: list[tuple[int, np.ndarray]] = []
    while True:
        by = np.argsort(key)
        sorted_ = key[by]
        new = np.ones(len(by), bool)
        new[1:] = sorted_[1:] != sorted_[:-1]
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(by)))
        todo = todo[by]
        if out:       # within their old group
            old = rank[todo]
            first = np.ones(len(by), bool)
            first[1:] = old[1:] != old[:-1]
            within = begin - np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))[begin]
            rank[todo] = old + np.repeat(within, size).astype(np.uint64)
        else:
            rank[todo] = np.repeat(begin, size).astype(np.uint64)
        out.append((k, rank.astype(np.uint32)))
        if k >= length:
            return out
        todo = todo[np.repeat(size > 1, size)]
        step = min(k, length - k)
        after = np.zeros(len(todo), np.uint64)
        inside = todo + step < n
        after[inside] = rank[todo[inside] + step] + np.uint64(1)
        key = (rank[todo] << np.uint64(32)) | after
        k += step


def common_prefixes(symbols: np.ndarray, ranks: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """How many symbols the suffixes at a and b share, `length` at most."""
    done = np.where(ranks[-1][1][a] == ranks[-1][1][b], length, 0)
    open_ = np.flatnonzero(done == 0)
    x, y, have = a[open_], b[open_], np.zeros(len(open_), np.int64)
    for k, rank in reversed(ranks[:-1]):
        same = (have + k <= length) & (rank[np.minimum(x + have, len(rank) - 1)] == rank[np.minimum(y + have, len(rank) - 1)])
        have += k * same
    for _ in range(ranks[0][0] - 1):       # less than the first step is left
        same = (have < length) & (symbols[np.minimum(x + have, len(symbols) - 1)] == symbols[np.minimum(y + have, len(symbols) - 1)])
        have += same
        if not same.any():
            break
    done[open_] = np.minimum(have, length)
    return done


def previous_factors(place: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Longest previous factors in suffix order: for each suffix the most that it
    shares with one at a smaller place.  `place`: the places in suffix order;
    `shared`: common prefix of each with the one before it.  The nearest smaller
    places before and after a suffix in this order are its best earlier matches;
    a stack holds the suffixes whose next smaller place is not known yet, each
    with what it shares with its previous smaller one."""
    out = [0] * len(place)
    stack: list[tuple[int, int, int]] = []        # (place, index, shared with the previous smaller place)
    for i, (p, common) in enumerate(zip(place.tolist(), shared.tolist())):
        while stack and stack[-1][0] > p:
            _, top, before = stack.pop()
            out[top] = before if before > common else common
            common = before if before < common else common
        stack.append((p, i, common if stack else 0))
    for _, top, before in stack:
        out[top] = before
    return np.array(out, np.int64)


def suffix_order(symbols: np.ndarray, starts: np.ndarray, place: np.ndarray, length: int):
    """(`starts` in the order of the `length` symbols that begin there, equal ones
    by `place`; what each shares with the one before it)."""
    ranks = prefix_ranks(symbols, length)
    order = np.lexsort((place, ranks[-1][1][starts]))
    shared = np.zeros(len(order), np.int64)
    if len(order) > 1:
        own = starts[order]
        shared[1:] = common_prefixes(symbols, ranks, own[:-1], own[1:], length)
    return order, shared


def _extract(length: int, words: bool = False):
    """The bytes, or the words' hashes, of the chosen runs of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column(3)
            for a, b, data, offs in text_slices(batch):
                data, offs = _symbols(data, offs, words)
                raw, size, rows, taken = data.tobytes(), data.itemsize, [], []
                for i, own in enumerate(runs.slice(a, b - a).to_pylist()):
                    for r in own:
                        rows.append(a + i)
                        taken.append((r["gram"], r["c1"], r["parts"], r["lo"],
                                      raw[(offs[i] + r["lo"]) * size:(offs[i] + r["hi"] + length) * size]))
                if rows:
                    cols = list(zip(*taken))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)),
                         *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())],
                        names=["doc_id", "h", "gram", "c1", "parts", "lo", "bytes"])
    return run


def _pieces_of(length: int, gram: int, size: int, texts: bool):
    """Runs in pieces by their starts' distance to the anchor, with the hash of the
    piece's core: the bytes that every window at these distances holds, the anchor
    among them.  The pieces' bytes are null without `texts`."""
    span = length - gram + 1
    step = -(-span // PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {c: batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "h", "gram", "c1", "lo", "bytes")}
            rows, core, lows, hashes, taken = [], [], [], [], []
            for i, (g, lo, raw) in enumerate(zip(own["gram"].to_pylist(), own["lo"].to_pylist(), own["bytes"].to_pylist())):
                data = np.frombuffer(raw, np.uint8 if size == 1 else np.uint64)
                anchor = int(np.flatnonzero(gram_hashes(data[:length], gram).view(np.int64) == g)[-1])
                last = len(data) - length
                for k in range((anchor - last) // step, anchor // step + 1):
                    near, far = k * step, min((k + 1) * step, span) - 1
                    a, b = max(0, anchor - far), min(last, anchor - near)
                    rows.append(i)
                    core.append(k)
                    lows.append(lo + a)
                    hashes.append(xxhash.xxh3_128_digest(raw[(anchor - near) * size:(anchor - far + length) * size]))
                    taken.append(raw[a * size:(b + length) * size] if texts else None)
            at, both = pa.array(rows, pa.int64()), np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [own[c].take(at) for c in ("doc_id", "h", "c1")]
                + [pa.array(core, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(lows, pa.int64()), pa.array(taken, pa.binary())],
                names=["doc_id", "h", "c1", "core", "k1", "k2", "lo", "bytes"])
    return run


def _match(length: int, keep_first: bool, size: int = 1):
    """The windows of a bucket's runs to remove, as stretches a..b of starts
    counted in the run; of split cores also the first place of each window
    here, with its hash, for the core's other tasks.  `size`: bytes of a symbol."""
    def run(t):
        doc, h, lo = (t.column(c).combine_chunks().fill_null(-2**63).to_numpy() for c in ("doc_id", "h", "lo"))
        by = np.lexsort((lo, h, doc))          # rows that repeat id and text bring a run twice
        new = np.ones(len(by), bool)
        new[1:] = (doc[by][1:] != doc[by][:-1]) | (h[by][1:] != h[by][:-1]) | (lo[by][1:] != lo[by][:-1])
        once = by[new]
        t = t.take(pa.array(once)).combine_chunks()
        doc, h, lo = doc[once], h[once], lo[once]
        split = t.column("split").to_numpy()
        texts = t.column("bytes").chunk(0).cast(pa.large_binary())
        offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)
        count = np.diff(offs) // size - length + 1
        of = np.repeat(np.arange(len(count)), count)
        ends = np.cumsum(count)
        at = np.arange(ends[-1]) - np.repeat(ends - count, count)
        starts = offs[of] // size + at
        by = np.lexsort((lo[of] + at, h[of], doc[of]))
        place = np.empty(len(by), np.int64)      # documents by id, places in a document
        place[by] = np.arange(len(by))
        symbols = data if size == 1 else data.view(np.uint64)
        order, shared = suffix_order(symbols, starts, place, length)
        factor = np.empty(len(order), np.int64)
        factor[order] = previous_factors(place[order], shared)
        earlier = factor >= length            # an equal window stands before it
        if keep_first:
            drop = earlier
        else:                                 # or after it
            drop = np.empty(len(order), bool)
            drop[order] = np.maximum(shared, np.append(shared[1:], 0)) >= length
        new = np.ones(len(drop), bool)        # neighbouring starts of a run are one stretch
        new[1:] = ~(drop[1:] & drop[:-1] & (of[1:] == of[:-1]))
        head = np.flatnonzero(new & drop)
        last = np.append(np.flatnonzero(new)[1:], len(drop)) - 1
        tail = last[np.searchsorted(last, head)] if len(head) else head
        more = np.flatnonzero(split[of] & ~earlier)
        raw = data.tobytes()
        begin = (offs[of] + at * size)[more].tolist()
        w = np.frombuffer(b"".join([xxhash.xxh3_128_digest(raw[s:s + length * size]) for s in begin]), np.int64).reshape(-1, 2)
        row = np.concatenate([of[head], of[more]])
        none = [None] * len(head)
        return pa.table([
            t.column("doc_id").take(pa.array(row)), pa.array(h[row]), pa.array(lo[row]),
            pa.array(np.concatenate([at[head], at[more]])), pa.array(np.concatenate([at[tail], at[more]])),
            pa.array(none + w[:, 0].tolist(), pa.int64()), pa.array(none + w[:, 1].tolist(), pa.int64()),
            pa.array(lo[row] + np.concatenate([at[head], at[more]]))],
            names=["doc_id", "h", "lo", "a", "b", "w1", "w2", "place"])
    return run


def _prepared(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def repeated_spans(docs: DataFrame, length: int = 400, keep: str = "first", gram: int = GRAM,
                   words: bool = False) -> DataFrame:
    """doc_id, h (hash of the text), spans: ranges of bytes, or of words, to remove
    of each document that has any; ranges may overlap."""
    if keep not in ("first", "none"):
        raise ValueError(f"keep is first or none, not {keep}")
    gram = min(gram, max(1, length // 4))
    own = _prepared(docs)
    runs = stash(own.mapInArrow(_runs(length, gram, words), RUNS), "runs")
    classes = stash(runs.groupBy("gram", "c1", "c2").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "h", "lo", "hi")).alias("rep")), "run-classes")
    anchors = (classes.groupBy("gram").agg(F.count("*").alias("k"), F.min("n").alias("least"))
               .where("k > 1" + (" AND least = 1" if keep == "none" else "")))
    anchors = anchors.withColumn("parts", F.ceil(F.col("k") / TASK_CLASSES).cast("long"))
    open_ = classes.join(anchors, "gram").select("rep.*", F.struct("gram", "c1", "parts", "rep.lo", "rep.hi").alias("run"))
    open_ = open_.groupBy("doc_id", "h").agg(F.collect_list("run").alias("runs"))   # at most one for each byte of a text
    chosen = _with_text(own, open_).mapInArrow(_extract(length, words), OPEN)
    sizes = {r["wide"]: r["k"] for r in anchors.groupBy((F.col("parts") > 1).alias("wide")).agg(F.sum("k").alias("k")).collect()}
    total = sum(sizes.values())
    if True in sizes:
        chosen, size, keys = stash(chosen, "open-runs"), 8 if words else 1, ["core", "k1", "k2"]
        wide = chosen.where("parts > 1")
        cores = wide.mapInArrow(_pieces_of(length, gram, size, False), PIECE).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
        cores = stash(cores.withColumn("parts", F.ceil(F.col("n") / TASK_CLASSES).cast("long")), "shared-cores")
        total = sizes.get(False, 0) + (cores.agg(F.sum("n")).first()[0] or 0)
        near = chosen.where("parts = 1").withColumnRenamed("gram", "key")
        chosen = near.unionByName(wide.mapInArrow(_pieces_of(length, gram, size, True), PIECE).join(cores, keys).select(
            "doc_id", "h", F.xxhash64(*keys).alias("key"), "c1", "parts", "lo", "bytes"))
    else:
        chosen = chosen.withColumnRenamed("gram", "key")
    buckets = 1 + total // TASK_CLASSES
    salted = F.when(F.col("parts") > 1, F.pmod(F.col("c1"), F.col("parts"))).otherwise(F.lit(0))
    chosen = chosen.select("doc_id", "h", F.pmod(F.xxhash64("key", salted), F.lit(buckets)).alias("bucket"),
                        (F.col("parts") > 1).alias("split"), "lo", "bytes")
    found = stash(chosen.groupBy("bucket").applyInArrow(_match(length, keep == "first", 8 if words else 1), MATCHES), "matches")

    direct = found.where("w1 IS NULL").select("doc_id", "h", "lo", "a", "b")
    cross = found.where("w1 IS NOT NULL")
    seen = cross.groupBy("w1", "w2").agg(F.count("*").alias("k"), F.min(F.struct("doc_id", "h", "place")).alias("lead"))
    own_place = F.struct("doc_id", "h", "place")
    repeated = (~own_place.eqNullSafe(F.col("lead"))) if keep == "first" else F.col("k") > 1
    cross = cross.join(seen.where("k > 1"), ["w1", "w2"]).where(repeated).select("doc_id", "h", "lo", "a", "b")
    edges = direct.union(cross).select("doc_id", "h", (F.col("lo") + F.col("a")).alias("s"),
                                       (F.col("lo") + F.col("b") + length).alias("e"))
    whole = runs.join(classes.where("n > 1").select("c1", "c2", "rep"), ["c1", "c2"])
    if keep == "first":
        whole = whole.where(~F.struct("doc_id", "h", "lo", "hi").eqNullSafe(F.col("rep")))
    spans = edges.union(whole.select("doc_id", "h", F.col("lo").alias("s"), (F.col("hi") + length).alias("e")))
    return spans.groupBy("doc_id", "h").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def _with_text(own: DataFrame, more: DataFrame, how: str = "inner") -> DataFrame:
    """The documents' doc_id, h, text and the columns of `more` for them."""
    more = more.withColumnsRenamed({"doc_id": "_id", "h": "_h"})
    same = own["doc_id"].eqNullSafe(more["_id"]) & (own["h"] == more["_h"])
    return own.join(more, same, how).drop("_id", "_h")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Ranges in order, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column(3)
        for a, b, data, offs in text_slices(batch):
            rows, raw = [], data.tobytes()
            for i, own in enumerate(spans.slice(a, b - a).to_pylist()):
                text, cut = raw[offs[i]:offs[i + 1]], merged(own)
                kept = b"".join(text[s:e] for s, e in zip([0] + [e for _, e in cut], [s for s, _ in cut] + [len(text)]))
                rows.append((len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a)] + [pa.array(c) for c in zip(*rows)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removed(docs: DataFrame, length: int = 400, keep: str = "none") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    spans = repeated_spans(docs, length, keep)
    return _with_text(_prepared(docs), spans, "left").select("doc_id", "h", "text", "spans").mapInArrow(
        _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_characters(text: bytes, cut: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges without characters that they hold in part."""
    out = []
    for s, e in cut:
        while s < e and s < len(text) and text[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(text) and text[e] & 0xC0 == 0x80:
            e -= 1
        if e > s:
            out.append((s, e))
    return out


def _bytes_of(text: bytes, cut: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as ranges of bytes."""
    start, end, _ = words_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    return [(int(start[s]), int(end[e - 1])) for s, e in cut]


def _cut_texts(words: bool):
    """The last column holds the spans to cut, and goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {c: batch.schema.get_field_index(c) for c in ("text", "n_chars")}
            texts, sizes = [], []
            for text, n, spans in zip(batch.column(at["text"]).to_pylist(),
                                      batch.column(at["n_chars"]).to_pylist() if at["n_chars"] >= 0 else [None] * batch.num_rows,
                                      batch.column(batch.num_columns - 1).to_pylist()):
                if spans:
                    raw = text.encode()
                    cut = whole_characters(raw, _bytes_of(raw, merged(spans)) if words else merged(spans))
                    text = b"".join(raw[s:e] for s, e in zip([0] + [e for _, e in cut], [s for s, _ in cut] + [len(raw)])).decode()
                    n = len(text)
                texts.append(text)
                sizes.append(n)
            cols = list(batch.columns)
            cols[at["text"]] = pa.array(texts, pa.string())
            if at["n_chars"] >= 0:
                cols[at["n_chars"]] = pa.array(sizes, cols[at["n_chars"]].type)
            yield pa.RecordBatch.from_arrays(cols[:-1], names=batch.schema.names[:-1])
    return run


def cut_repeats(docs: DataFrame, length: int = 400, keep: str = "first", words: bool = False) -> DataFrame:
    """The documents without their repeated passages of `length` bytes or words
    (whole characters only), n_chars brought up to date; all rows stay."""
    own_id, own_hash, doc_id, h, cut = unused(docs.columns, "_k", "_t", "_id", "_h", "_spans")
    spans = repeated_spans(docs, length, keep, words=words).withColumnsRenamed({"doc_id": doc_id, "h": h, "spans": cut})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.withColumns({own_id: F.col("doc_id").cast("long"), own_hash: F.xxhash64(text)})
    same = marked[own_id].eqNullSafe(spans[doc_id]) & (marked[own_hash] == spans[h])
    joined = marked.join(spans, same, "left").select(*docs.columns, cut)
    return joined.mapInArrow(_cut_texts(words), StructType(docs.schema.fields))
