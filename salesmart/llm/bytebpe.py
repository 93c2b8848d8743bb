"""Byte-level BPE encoding and decoding by overlapping chunks.

Encoding.  A text of more than CHUNK characters is cut into chunks that overlap
by OVERLAP characters; chunks are rows of their own, so a long text is worked on
by many tasks.  Each chunk is pre-tokenised from its first character, wherever
that stands.  Two neighbours resynchronise at a pre-token border that both find
in their overlap: a match of the pattern depends only on what follows its start,
so from a common border on both go on alike.  The piece between two such borders
is encoded by its own task and the pieces' ids are joined in order.  A shorter
text is one piece.

What counts as a border of the earlier chunk: one that stands MARGIN characters
before the chunk's end (no match or look-ahead reaches further) and follows a
character that is not white space (a run of white space is split by what comes
after it).  Where a character is followed by a blank, the border holds whatever
came before; other common borders count only if the earlier chunk itself began
at a proven one.  Neighbours without a common border (a pre-token longer than
the overlap) are joined and encoded as one piece, so no text is lost.

Decoding concatenates the raw bytes of the ids.

Defined results: a null or empty text has no ids; special tokens are not
recognised, their strings are ordinary text; repeated ids and rows are encoded
each on their own; an empty table gives an empty frame; only the id and the text
column are read, so names of other columns never matter.  The ids of a text are
little-endian unsigned 32-bit integers; decoding refuses an id that the
vocabulary lacks.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stash

#: Characters of a chunk, of its overlap with the next, and of a match's look-ahead.
CHUNK, OVERLAP, MARGIN = 32_768, 1_024, 4
#: Bytes of results that a task hands over at once.
OUT_BYTES = 4 << 20

_KEPT: dict[tuple[str, str], object] = {}


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def _encoder(path: str, pattern: str):
    if (path, pattern) not in _KEPT:   # stays for a worker's later tasks
        import tiktoken
        _KEPT[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})
    return _KEPT[path, pattern]


def _vocabulary(path: str) -> list[bytes | None]:
    if (path, "") not in _KEPT:
        ranks = _ranks(path)
        table: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for raw, i in ranks.items():
            table[i] = raw
        _KEPT[path, ""] = table
    return _KEPT[path, ""]


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(c)) for c in names]


def cut_chunks(text: str) -> Iterator[tuple[int, int, str]]:
    """(number, first character, chunk with its overlap) of a text."""
    for k, s in enumerate(range(0, max(len(text), 1), CHUNK)):
        yield k, s, text[s:s + CHUNK + OVERLAP]


def borders(chunk: str, first: int, pattern) -> tuple[list[int], list[int], list[int]]:
    """Borders of a chunk that begins at character `first` of its text: those in
    its overlap with the chunk before; those in the overlap with the next that
    hold if the chunk began at one; and of these the ones that always hold."""
    ends = [m.end() for m in pattern.finditer(chunk)]
    head = [first] + [first + e for e in ends if e <= OVERLAP]
    last = len(chunk) - MARGIN
    tail = [e for e in ends if CHUNK <= e <= last and not chunk[e - 1].isspace()]
    sure = [first + e for e in tail if chunk[e] in " \t\n\r"]
    return head, [first + e for e in tail], sure


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("rid", pa.string()), ("doc", pa.string()), ("k", pa.int64()), ("first", pa.int64()),
                        ("chunk", pa.string())])
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for doc, text in zip(*(c.to_pylist() for c in _columns(batch, ["doc", "text"]))):
            rid = uuid.uuid4().hex   # rows of the same id are texts of their own
            for k, first, chunk in cut_chunks(text):
                rows.append((rid, doc, k, first, chunk))
                size += len(chunk)
                if size >= OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _pretokenise(pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        own = regex.compile(pattern)
        kind = pa.list_(pa.int64())
        for batch in batches:
            first, chunk = (c.to_pylist() for c in _columns(batch, ["first", "chunk"]))
            found = [borders(c, f, own) for c, f in zip(chunk, first)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([x[i] for x in found], kind) for i in range(3))],
                names=[*batch.schema.names, "head", "tail", "sure"])
    return run


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, pattern).encode_ordinary
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts, rest = batch.column(at), [i for i in range(batch.num_columns) if i != at]
            a = 0
            while a < batch.num_rows:
                ids, size, b = [], 0, a
                while b < batch.num_rows and size < OUT_BYTES:
                    ids.append(np.array(encode(texts[b].as_py() or ""), "<u4").tobytes())
                    size += len(ids[-1])
                    b += 1
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in rest),
                     pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=[*(batch.schema.names[i] for i in rest), "n_tokens", "ids"])
                a = b
    return run


def _pieces(chunks: DataFrame) -> DataFrame:
    """(rid, doc, piece, text): chunks cut at the borders where they resynchronise."""
    along = Window.partitionBy("rid").orderBy("k")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    thin = chunks.select("rid", "k", "first", "head", "tail", "sure")   # a few kB a chunk
    thin = thin.select(
        "rid", "k", "first",
        F.array_min(F.array_intersect("head", F.lag("sure").over(along))).alias("always"),
        F.array_min(F.array_intersect("head", F.lag("tail").over(along))).alias("agreed"))
    proven = F.max(F.when((F.col("k") == 0) | F.col("always").isNotNull(), F.col("k"))).over(upto)
    broken = F.max(F.when((F.col("k") > 0) & F.col("agreed").isNull(), F.col("k"))).over(upto)
    thin = thin.withColumn("sound", proven > F.coalesce(broken, F.lit(-1)))
    thin = thin.withColumn("begin", F.when(F.col("sound"), F.coalesce("always", "agreed", "first")).otherwise(F.col("first")))
    thin = thin.select("rid", "k", "begin", F.lead("begin").over(along).alias("end"),
                       F.max(F.when(F.col("sound"), F.col("k"))).over(upto).alias("piece"))
    own = chunks.select("rid", "doc", "k", "first", "chunk").join(thin, ["rid", "k"])
    until = F.coalesce("end", F.col("first") + F.length("chunk"))
    own = own.select("rid", "doc", "piece", "k", F.col("chunk").substr(
        (F.col("begin") - F.col("first") + 1).cast("int"), (until - F.col("begin")).cast("int")).alias("part"))
    return (own.groupBy("rid", "doc", "piece").agg(F.sort_array(F.collect_list(F.struct("k", "part"))).alias("parts"))
            .select("rid", "doc", "piece", F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("text")))


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col`, n_tokens, ids of every row of `docs`."""
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).cast("string").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    run, schema = _encode(vocabulary, pattern), "doc string, n_tokens long, ids binary"
    short = own.where(F.length("text") <= CHUNK).mapInArrow(run, schema)
    cut = own.where(F.length("text") > CHUNK).mapInArrow(
        _explode, "rid string, doc string, k long, first long, chunk string").repartition("rid", "k")
    cut = stash(cut.mapInArrow(_pretokenise(pattern), "rid string, doc string, k long, first long, chunk string, "
                               "head array<long>, tail array<long>, sure array<long>"), "chunks")
    done = _pieces(cut).mapInArrow(run, "rid string, doc string, piece long, n_tokens long, ids binary")
    done = done.groupBy("rid", "doc").agg(F.sum("n_tokens").alias("n_tokens"),
                                          F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("parts"))
    whole = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), ""))
    return (short.unionByName(done.select("doc", "n_tokens", whole.alias("ids")))
            .select(F.col("doc").cast(kind).alias(id_col), "n_tokens", "ids"))


def decode(encoded: DataFrame, vocabulary: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """`encoded` with the raw bytes of its ids in the new column `out`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _vocabulary(vocabulary)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(column))
            a = 0
            while a < batch.num_rows:
                raw, size, b = [], 0, a
                while b < batch.num_rows and size < OUT_BYTES:
                    own = ids[b].as_py()
                    raw.append(b"".join([table[i] for i in np.frombuffer(own or b"", "<u4").tolist()]))
                    size += len(raw[-1])
                    b += 1
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array(raw, pa.binary())],
                                                 names=[*batch.schema.names, out])
                a = b
    if out in encoded.columns:
        raise ValueError(f"the input has a column {out} already")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, `{out}` binary")
