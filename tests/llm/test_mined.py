"""Collocations, byte-level BPE and hard negatives against brute force."""

import base64
import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from salesmart.llm import bytebpe, collocations, negatives
from tests_llm_data import DOC_SCHEMA, prose, row

VOCAB = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# --- collocations -----------------------------------------------------------------
def brute_phrases(rows, least, longest, percent, top):
    counts: dict[str, Counter] = {}
    for _, text, lang, *_ in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(words)):
                for k in range(1, longest + 1):
                    if i + k <= len(words):
                        own[tuple(words[i:i + k])] += 1
    out = set()
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cands = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        scored = []
        for p, a in cands.items():
            if any(len(q) > len(p) and 100 * c >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, c in cands.items()):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for r, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, r, p.decode(), -a, left, right, n, -s))
    return out


def spoken(seed=3, n=150):
    """Texts of few words, so that phrases repeat, with odd separators and bytes."""
    rnd = random.Random(seed)
    words = ["the", "The", "a", "of", "new", "york", "city", "é", "ab\x01c", "a\x01", "x" * 300, "zé", "ÀB", "b-c", "\x00"]
    rows = []
    for i in range(n):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"])
                       for _ in range(rnd.randint(0, 120)))
        if i % 3 == 0:
            text += " in the city of new york" * rnd.randint(1, 4)
        rows.append(row(i, text, rnd.choice(["en", "en", "de", None])))
    return rows + [row(n, None), row(n + 1, ""), row(n + 2, " \t\n"), row(n + 3, "...", None), row(5, rows[5][1]), row(None, "new york"),
                   row(n + 4, "la la " * 30000, "fr"), row(n + 5, "one,", "only")]


@pytest.mark.parametrize("least,longest,percent,top", [(10, 5, 100, 2000), (10, 5, 70, 8), (3, 3, 100, 50)])
def test_collocations_match_brute_force(docs, least, longest, percent, top):
    rows = spoken()
    got = collocations.mine(docs(rows), least=least, longest=longest, percent=percent, top=top, budget=60).collect()
    want = brute_phrases(rows, least, longest, percent, top)
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 20


def test_collocations_one_group_or_many_agree(docs):
    rows = spoken(9, 60)
    runs = [{tuple(r) for r in collocations.mine(docs(rows), least=5, budget=b).collect()} for b in (7, 1_000_000)]
    assert runs[0] == runs[1] != set()


ALL_FREQUENT = [b"\xff" * (collocations.COUNTERS // 8)] * 5


def leaves_of(texts, per_batch):
    for i in range(0, len(texts), per_batch):
        part = texts[i:i + per_batch]
        yield pa.RecordBatch.from_pydict({"text": part, "lang": ["en", None][i // per_batch % 2:][:1] * len(part)},
                                         schema=pa.schema([("text", pa.string()), ("lang", pa.string())]))


def test_leaves_of_long_texts_take_little_memory():
    """Every suffix has its full depth, so phrases hold five times the text."""
    text = " ".join(f"w{i % 997:03d}" for i in range(400_000))
    list(collocations._write_leaves(ALL_FREQUENT)(leaves_of(["warm up"], 1)))
    texts = [text[i:i + 10_000] for i in range(0, len(text), 10_000)]
    tracemalloc.start()
    rows = sum(len(b) for b in collocations._write_leaves(ALL_FREQUENT)(leaves_of(texts, 1000)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > 997 and peak < 100e6


def test_groups_stay_within_twice_the_budget(docs):
    leaves = docs([]).sparkSession.createDataFrame(
        [("en", f"the w{i} w{j} x", 1) for i in range(40) for j in range(20)] + [("en", "a b", 5), ("de", "the w1", 2)],
        "lang string, phrase string, n long")
    sizes = {r["group"]: r["count"] for r in collocations.group_leaves(leaves, 50, 5).groupBy("group").count().collect()}
    assert sum(sizes.values()) == 802 and None not in sizes and max(sizes.values()) <= 100


def test_collocation_scores_pass_64_bits(spark):
    """Products of counts at the target size: 1000 * a * n needs more than 64 bits."""
    a, n, left, right = 10**12, 9 * 10**15, 3 * 10**12 + 1, 2 * 10**12 + 7
    got = spark.sql(f"SELECT (1000BD * CAST({a} AS DECIMAL(19, 0)) * CAST({n} AS DECIMAL(19, 0))) div "
                    f"(CAST({left} AS DECIMAL(19, 0)) * CAST({right} AS DECIMAL(19, 0))) AS s").first()["s"]
    assert got == 1000 * a * n // (left * right)


def test_collocations_of_nothing_and_with_clashing_columns(spark, docs):
    assert collocations.mine(docs([])).count() == 0
    assert collocations.mine(docs([row(1, None), row(2, "")]), least=1).count() == 0
    rows = [("New York is new york", "en", 1, 2, "x", "y")] * 3
    df = spark.createDataFrame(rows, "text string, lang string, n int, phrase int, b1 string, `group` string")
    got = {(r["phrase"], r["a"]) for r in collocations.mine(df, least=3).collect()}
    assert got == {("new york is new york", 3), ("new york", 6)}


# --- byte-level BPE ---------------------------------------------------------------
@pytest.fixture(scope="module")
def reference_encoder():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCAB, "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def odd_texts():
    rnd = random.Random(11)
    marks = ["don't", "we'll", "'s's", "l'", "  ", "\n\n", "\t ", "\r\n", "12345", "été", "日本語テキスト", "🙂🙂", "<|endoftext|>", "\x1c", "\x85",
             "​", " ", "—", "ñandú", "a", "Ω", "١٢", "é", "\U0001f468‍\U0001f469"]
    mixed = ["".join(rnd.choice(marks) + rnd.choice(["", " ", "", "  "]) for _ in range(rnd.randint(1, 400))) for _ in range(60)]
    return mixed + ["x" * 700, " " * 900, "'" * 500, "a1" * 600, "日" * 800, "é " * 500, " \n" * 400, "'ll" * 300, "x" * 150 + " y" * 300,
                    "," + "z" * 400 + ", " + "9" * 400 + " end", "", " ", None, prose(rnd, 3000)]


@pytest.mark.parametrize("chunk,overlap", [(64, 24), (50, 40), (40, 5), (32_768, 1_024)])
def test_encoding_equals_the_library_and_round_trips(docs, reference_encoder, monkeypatch, chunk, overlap):
    monkeypatch.setattr(bytebpe, "CHUNK", chunk)
    monkeypatch.setattr(bytebpe, "OVERLAP", overlap)
    texts = odd_texts()
    rows = [row(i, t) for i, t in enumerate(texts)] + [row(1, "other text of the same id " * 9), row(None, "no id " * 30)]
    for k, t in enumerate(texts):   # pieces are cut where the method says, without Spark
        if t and len(t) > chunk:
            assert "".join(c[:chunk] for _, _, c in bytebpe.cut_chunks(t)) == t
    encoded = bytebpe.encode(docs(rows), VOCAB, public_tokenizers.PATTERN)
    got = Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in bytebpe.decode(encoded, VOCAB).collect())
    want = Counter()
    for i, t, *_ in rows:
        ids = reference_encoder(t or "")
        want[(i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode())] += 1
    assert got == want


def test_long_text_is_cut_at_resynchronised_borders(spark, docs, reference_encoder):
    rnd = random.Random(5)
    texts = [prose(rnd, 40_000), "x" * 80_000 + " and " + prose(rnd, 9_000), "日本語、テキスト。" * 9_000, "no-blank," * 9_000]
    assert all(len(t) > 2 * bytebpe.CHUNK for t in texts)
    got = {r["doc_id"]: r for r in bytebpe.encode(docs([row(i, t) for i, t in enumerate(texts)]), VOCAB, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        assert bytes(got[i]["ids"]) == np.array(reference_encoder(t), "<u4").tobytes()
    import regex
    own = regex.compile(public_tokenizers.PATTERN)
    chunks = [(*c[:2], *bytebpe.borders(c[2], c[1], own)) for c in bytebpe.cut_chunks(texts[0])]
    for before, after in zip(chunks, chunks[1:]):   # neighbours find common borders
        assert set(before[3]) & set(after[2])


def test_encoding_of_nothing_and_with_clashing_columns(spark, docs):
    assert bytebpe.decode(bytebpe.encode(docs([]), VOCAB, public_tokenizers.PATTERN), VOCAB).count() == 0
    df = spark.createDataFrame([("k", "hello there", "x", 1, 2)], "doc_id string, text string, doc string, rid int, ids int")
    r = bytebpe.decode(bytebpe.encode(df, VOCAB, public_tokenizers.PATTERN), VOCAB).first()
    assert (r["doc_id"], bytes(r["decoded"])) == ("k", b"hello there")
    with pytest.raises(ValueError):
        bytebpe.decode(df, VOCAB, out="doc")


def test_query_digests(spark, reference_encoder):
    from salesmart.llm.queries import op12_bytebpe
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op12_bytebpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = reference_encoder(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


# --- hard negatives -----------------------------------------------------------------
SCHEMA = "vec_id long, embedding array<float>, label int"


def fine(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def brute_negatives(rows, is_anchor, positives=5, negs=3):
    own = [(i, y, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v, y in rows
           if i is not None and y is not None and fine(v)]
    out = Counter()
    for p, (i, y, v) in enumerate(own):
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, z) for q, (j, z, w) in enumerate(own) if q != p and len(w) == len(v)]
        for s, j, _ in sorted(x for x in scored if x[2] == y)[:positives]:
            good = sorted(x for x in scored if x[2] != y and 50 * -s <= 100 * -x[0] <= 95 * -s)[:negs]
            for r, (t, m, _) in enumerate(good, 1):
                out[(i, j, r, m, -s, -t)] += 1
    return out


def spread(seed=2, n=500, dims=12):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, dims))
    rows = []
    for i in range(n):
        y = 0 if i % 3 == 0 else int(rnd.integers(0, 6))       # a third of the rows has one label
        rows.append((i, (centres[y] * 0.4 + rnd.normal(size=dims) * 0.3).astype(np.float32).tolist(), y))
    rows += [(600, [0.0] * dims, 1), (601, [0.0] * dims, 2), (650, [0.0] * dims, 2), (700, None, 1), (701, [], 1),
             (702, [1.0, None] + [0.0] * (dims - 2), 1), (750, [float("nan")] * dims, 1), (800, [1.0] * dims, None), (None, [1.0] * dims, 1),
             (850, [1.0, 2.0], 1), (851, [1.0, 2.0], 1), (852, [0.7, 1.4], 2), (853, [0.7, 1.4], 3), (900, [-1.0] * dims, 9),
             (50, rows[50][1], rows[50][2]), (50, rows[50][1], 5), (61, rows[60][1], 4), (62, rows[60][1], 4), (63, rows[60][1], 4)]
    return rows


@pytest.mark.parametrize("tile,group,first", [(16_384, 4_096, 32), (60, 3, 4)])
def test_negatives_match_brute_force(spark, monkeypatch, tile, group, first):
    for name, v in (("TILE", tile), ("GROUP", group), ("FIRST", first)):
        monkeypatch.setattr(negatives, name, v)
    rows = spread()
    got = Counter(tuple(r) for r in negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") % 50 == 0).collect())
    want = brute_negatives(rows, lambda i: i % 50 == 0)
    assert got == want and sum(want.values()) > 50


def test_threshold_stops_early_and_strictly():
    """Correlated rows: the lists are left long before their end; a tie at the
    threshold is still read."""
    rnd = np.random.default_rng(0)
    x = np.floor(256 * (np.abs(rnd.normal(size=(5000, 1))) + rnd.normal(size=(5000, 8)) * 0.05))
    lists, ids, anchor = negatives.SortedLists(x), np.arange(5000), x[17]
    read = sum(len(new) for _, (new, _, bound) in zip(range(3), lists.rounds(anchor)))
    at, score = negatives.best(lists, ids, anchor, 5)
    full = x @ anchor
    assert read < 2500 and list(at) == sorted(range(5000), key=lambda i: (-full[i], i))[:5] and (score == full[at]).all()
    tied = np.ones((200, 2))
    at, _ = negatives.best(negatives.SortedLists(tied), np.arange(200)[::-1], np.ones(2), 3)
    assert list(at) == [199, 198, 197]     # ids run backwards: the smallest ids stand last


def test_negatives_of_large_values_are_exact(spark):
    rows = [(0, [2e6, 3.0], 0), (1, [2e6, 5.0], 0), (2, [1.8e6, 1.0], 1), (3, [1.8e6, 1.0], 1), (4, [1.8e6, 2.0], 1)]
    got = Counter(tuple(r) for r in negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") == 0).collect())
    assert got == brute_negatives(rows, lambda i: i == 0) and len(got) == 3


def test_negatives_of_nothing_and_with_clashing_columns(spark):
    assert negatives.mine(spark.createDataFrame([], SCHEMA), F.col("id") % 50 == 0).count() == 0
    rows = spread(4, 120)
    plain = Counter(tuple(r) for r in negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") % 50 == 0).collect())
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("id", "uid", "v", "x", "dims", "asked", "tile", "part", "anchor", "low", "high", "rank", "bucket", "split"):
        df = df.withColumn(c, F.lit("clash"))
    assert Counter(tuple(r) for r in negatives.mine(df, F.col("id") % 50 == 0).collect()) == plain
