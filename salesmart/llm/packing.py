"""Pack tokenised documents into as few fixed-length sequences as possible.

1. Tasks tokenise whole documents and cut only those longer than a sequence.
2. The histogram of piece lengths (at most `capacity` rows) goes to the driver,
   which solves the configuration linear program: columns are sets of lengths
   that fit a sequence.  Multiplicative weights hold a price for each length; a
   knapsack dynamic program finds the column of the highest price.
3. Columns are rounded down to whole sequences, and what is left is filled
   largest length first, whole columns at a time, so that the plan has at most
   a few thousand columns however many pieces there are.
4. Tasks number the pieces of each length and look their place up in the plan.

Defined results: null text is empty and packs its end id alone; repeated rows
are separate documents; an empty table gives an empty frame.  Only `doc_id` and
`text` are read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import LOWER, range_hashes, stash, text_slices, word_spans

CAPACITY, END_ID = 2048, 0
#: Pricing rounds of the linear program, and the share of a column's widest step taken in each.
ROUNDS, STEP = 400, 0.5
#: Distinct chunks whose ids a worker keeps, and chunks given to the tokenizer at once.
KEPT_CHUNKS, BATCH = 600_000, 10_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ordinal long, ids binary"


# Classes of bytes: where two neighbours of different words' classes meet, or two
# digits, the tokenizer always begins a new word, so that the parts may be
# tokenised alone.  Apostrophes and bytes beyond ASCII stay with their neighbours.
_LETTER, _DIGIT, _MARK, _SPACE, _OTHER = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_KIND[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = _MARK
_KIND[[0x20, 0x09, 0x0A, 0x0D]] = _SPACE
_SPLITS = np.zeros((5, 5), bool)
_SPLITS[:3, :3] = ~np.eye(3, dtype=bool)
_SPLITS[_DIGIT, _DIGIT] = True


class ChunkTokenizer:
    """Ids of texts by a tokenizer that drops white space and lower-cases: a
    text's ids are those of its chunks (parts of words, see above), and the ids
    of chunks seen are kept, sorted by hash."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # a task is one thread
        from tokenizers import Tokenizer
        self.own = Tokenizer.from_file(path)
        vocabulary = self.own.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)      # ids that end a word
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.number = np.zeros(0, np.int64)
        self.offsets = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _ids(self, chunks: list[str], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks in order, their number for each chunk).  A `plain`
        chunk of letters a-z is one word, whose last id is the only one that ends
        a word, so that many of them can be given to the tokenizer as one text."""
        size = np.zeros(len(chunks), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []      # (places of chunks, their ids)
        rest = [np.flatnonzero(~plain)]
        at = np.flatnonzero(plain)
        for i in range(0, len(at), BATCH):
            own = at[i:i + BATCH]
            ids = np.array(self.own.encode(" ".join([chunks[j] for j in own.tolist()]), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) != len(own):       # a vocabulary without such marks
                rest.append(own)
                continue
            size[own] = np.diff(ends, prepend=-1)
            parts.append((own, ids))
        for at in rest:
            for i in range(0, len(at), BATCH):
                own = at[i:i + BATCH]
                ids = [e.ids for e in self.own.encode_batch_fast([chunks[j] for j in own.tolist()], add_special_tokens=False)]
                size[own] = np.fromiter(map(len, ids), np.int64, len(ids))
                parts.append((own, np.array(list(chain.from_iterable(ids)), np.uint32)))
        begin = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), np.uint32)
        for own, ids in parts:
            n = size[own]
            flat[np.arange(len(ids)) + np.repeat(begin[own] - (np.cumsum(n) - n), n)] = ids
        return flat, size

    def _add(self, hashes: np.ndarray, chunks: list[str], plain: np.ndarray) -> np.ndarray:
        flat, size = self._ids(chunks, plain)
        number = len(self.offsets) - 1 + np.arange(len(chunks))
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(size)])
        self.flat = np.concatenate([self.flat, flat])
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.number = np.insert(self.number, at, number)
        return number

    def __call__(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text) of UTF-8 bytes."""
        if len(self.known) > KEPT_CHUNKS:
            self._clear()
        raw = data.tobytes()
        cut = None
        if b"<|" not in raw:   # else a special token, known as a whole and in this case only, may be there
            data = LOWER[data]
            raw = data.tobytes()
            cut = np.zeros(len(data), bool)
            cut[1:] = _SPLITS[_KIND[data[:-1]], _KIND[data[1:]]]
        kind = _KIND[data]
        start, end, row = word_spans(kind == _SPACE, offs, cut)
        # each distinct chunk of the slice is looked up once, in the order of the table
        h, first, inverse = np.unique(range_hashes(data, start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, h)
        at[at == len(self.known)] = 0
        hit = self.known[at] == h if len(self.known) else np.zeros(len(h), bool)
        number = np.zeros(len(h), np.int64)
        number[hit] = self.number[at[hit]]
        if not hit.all():
            where = first[~hit]
            letters = np.concatenate([[0], np.cumsum((data >= 0x61) & (data <= 0x7A))])
            plain = letters[end[where]] - letters[start[where]] == end[where] - start[where]
            number[~hit] = self._add(h[~hit], [raw[s:e].decode() for s, e in zip(start[where].tolist(), end[where].tolist())], plain)
        number = number[inverse]
        base = self.offsets[number]
        count = self.offsets[number + 1] - base
        ends = np.concatenate([[0], np.cumsum(count)])
        ids = self.flat[np.arange(ends[-1]) + np.repeat(base - ends[:-1], count)]
        return ids, ends[np.searchsorted(row, np.arange(len(offs)))]


_KEPT: dict[str, ChunkTokenizer] = {}


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _KEPT:   # stays for a worker's later tasks
            _KEPT[path] = ChunkTokenizer(path)
        encode, ordinal = _KEPT[path], 0
        for batch in batches:
            docs = batch.column(0)
            for a, b, data, borders in text_slices(batch):
                ids, offs = encode(data, borders)
                rows: list[tuple] = []
                for i, doc in enumerate(docs.slice(a, b - a).to_pylist()):
                    own = np.append(ids[offs[i]:offs[i + 1]], np.uint32(end_id)).astype("<u4")
                    for k, s in enumerate(range(0, len(own), capacity)):
                        raw = own[s:s + capacity].tobytes()
                        rows.append((doc, k, s, len(raw) // 4, zlib.crc32(raw), ordinal, raw if with_ids else None))
                        ordinal += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                                                                 pa.int64(), pa.int64(), pa.binary()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ordinal", "ids"])
    return run


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
               with_ids: bool = False) -> DataFrame:
    """Pieces of each document's ids followed by `end_id`; `ids` holds them as
    little-endian 32-bit numbers if asked for."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_cut(tokenizer, capacity, end_id, with_ids), PIECES)


def price(lengths: np.ndarray, value: np.ndarray, capacity: int) -> list[int]:
    """Positions of the lengths of the column of the highest total value
    (unbounded knapsack over every capacity)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    back = np.arange(capacity + 1)
    for c in range(1, capacity + 1):
        k = fits[c]
        best[c], back[c] = best[c - 1], c - 1
        if k:
            total = value[:k] + best[c - lengths[:k]]
            j = int(total.argmax())
            if total[j] > best[c]:
                best[c], pick[c], back[c] = total[j], j, c - lengths[j]
    out, c = [], capacity
    while c > 0:
        if pick[c] >= 0:
            out.append(int(pick[c]))
        c = int(back[c])
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS,
         step: float = STEP) -> tuple[list[tuple[dict[int, int], int]], float]:
    """([(column: {length: times}, sequences)], lower bound of the program)."""
    lengths = np.array(sorted(histogram), np.int64)
    if len(lengths) == 0:
        return [], 0.0
    count = np.array([histogram[x] for x in lengths], np.int64)
    used: dict[tuple, float] = {}
    bound = float((lengths * count).sum()) / capacity   # the prices length / capacity are dual feasible
    covered, y = np.zeros(len(lengths)), lengths / capacity
    for _ in range(rounds):
        live = covered < 1
        if not live.any():
            break
        column = np.bincount(price(lengths, np.where(live, y, 0), capacity), minlength=len(lengths))
        if live.all():   # all prices as they are: their sum over the best column's is a bound
            bound = max(bound, float((y * count).sum()) / max(float((y * column).sum()), 1.0))
        column = np.minimum(column, count)
        at = np.flatnonzero(column)
        wide = float((count[at] / column[at]).min())
        x = step * wide
        key = tuple((int(i), int(column[i])) for i in at)
        used[key] = used.get(key, 0.0) + x
        gain = x * column[at] / count[at]
        covered[at] += gain
        y[at] *= np.exp(-0.1 * gain / step)
    left, out = count.copy(), []
    for key, x in sorted(used.items(), key=lambda kv: -kv[1]):
        n = min(int(x), *(int(left[i]) // k for i, k in key))
        if n > 0:
            out.append(({int(lengths[i]): k for i, k in key}, n))
            for i, k in key:
                left[i] -= n * k
    while left.any():   # fill the rest largest first, as often as a whole column repeats
        room, column = capacity, np.zeros(len(lengths), np.int64)
        top = int(np.flatnonzero(left)[-1])
        while room > 0:
            ok = np.flatnonzero((left[:top + 1] > column[:top + 1]) & (lengths[:top + 1] <= room))
            if not len(ok):
                break
            i = int(ok[-1])
            take = min(int(left[i] - column[i]), room // int(lengths[i]))
            column[i] += take
            room -= take * int(lengths[i])
        at = np.flatnonzero(column)
        n = int((left[at] // column[at]).min())
        out.append(({int(lengths[i]): int(column[i]) for i in at}, n))
        left[at] -= n * column[at]
    return out, bound


def _places(columns: list[tuple[dict[int, int], int]]):
    """For each length the runs of its ranks: (first rank, first sequence, times, offset)."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for column, n in columns:
        offset = 0
        for length, times in sorted(column.items(), reverse=True):
            runs.setdefault(length, []).append((taken.get(length, 0), sequence, times, offset))
            taken[length] = taken.get(length, 0) + n * times
            offset += length * times
        sequence += n
    flat = [(length << 44 | r[0], *r) for length in sorted(runs) for r in runs[length]]
    table = np.array(flat, np.int64).reshape(-1, 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(table[:, 0], length << 44 | rank, "right") - 1]
            own = rank - row[:, 1]
            keep = [batch.column(batch.schema.get_field_index(c))
                    for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")]
            yield pa.RecordBatch.from_arrays(
                keep + [pa.array(row[:, 2] + own // row[:, 3]), pa.array(row[:, 4] + own % row[:, 3] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False, bucket_rows: int = 5_000) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset of every piece."""
    pieces = stash(cut_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    histogram = {int(r["length"]): int(r["n"]) for r in   # at most `capacity` rows
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    columns, _ = plan(histogram, capacity)
    # a length's pieces are numbered bucket by bucket, so that a frequent length is not one group
    buckets = 1 + sum(histogram.values()) // bucket_rows
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "ordinal"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ordinal", "ids_crc32")
    ranked = (dealt.withColumn("own", F.row_number().over(inside) - 1).join(sizes, ["length", "bucket"])
              .withColumn("rank", F.col("base") + F.col("own")))
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "rank").mapInArrow(
        _places(columns), out)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves, of a frame packed with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))   # at most `capacity` pieces
    return (packed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids")))
