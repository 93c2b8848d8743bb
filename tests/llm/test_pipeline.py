"""The pipeline's stages and the registry."""

import os
import random

import numpy as np

import corpus_pipeline
from salesmart.llm import queries, suffixes
from salesmart.session import checkpoint_dir
from tests_llm_data import DOC_SCHEMA, prose, row


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_stages_on_a_small_corpus(spark, docs, corpus, tmp_path):
    frame = docs(corpus)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frame, "unused")
        path = str(tmp_path / str(i))
        out.write.parquet(path)
        before, frame = frame, spark.read.parquet(path)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert frame.columns == [c.split()[0] for c in DOC_SCHEMA.split(", ")]
        if name == "language ID":
            gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in frame.collect()}
            assert gone == {150, 151, 152, 155, 159}
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(frame.columns) and frame.count() > 0


def test_stages_on_an_empty_table(spark, docs):
    frame = docs([])
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, "unused")
        assert frame.count() == 0
        frame = docs([])


def test_passages_of_more_than_50_words_are_cut(spark, docs):
    rnd = random.Random(5)
    short = [rnd.choice("abcdefghij") + rnd.choice("klm") for _ in range(51)]
    fifty = [rnd.choice("nopqrst") + rnd.choice("uvw") for _ in range(50)]
    rows = [row(i, f"{prose(rnd, 60)} x{i}, {' '.join(short)}; y{i} {prose(rnd, 60)} z{i} {' '.join(fifty)} q{i}") for i in range(8)]
    han = "".join(chr(0x4E00 + rnd.randrange(2000)) for _ in range(60))
    rows += [row(20 + i, f"{prose(rnd, 20)} {i}{han}{i} é{i}") for i in range(2)]
    got = {r.doc_id: r for r in corpus_pipeline.cut_passages(spark, docs(rows), "unused").collect()}
    for i, text, *_ in rows:
        passage = " ".join(short) if i < 20 else han
        assert got[i].text == (text if i in (0, 20) else text.replace(passage, "")) and got[i].n_chars == len(got[i].text)


def test_words_of_texts():
    texts = ["", "ab,c  d\u2019e\u00a0f", "\u4e00\u4e8cx \u0e01\u0e02.", "a" * 70, "\u00e9t\u00e9 \U0001f600z", "b"]
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0] + [len(t) for t in raw])
    data = b"".join(raw)
    start, end, cuts = suffixes.words_of(np.frombuffer(data, np.uint8), offs)
    got = [[data[start[k]:end[k]].decode() for k in range(a, b)] for a, b in zip(cuts, cuts[1:])]
    assert got == [[], ["ab", "c", "d", "e", "f"], ["\u4e00", "\u4e8c", "x", "\u0e01", "\u0e02"],
                   ["a" * 32, "a" * 32, "a" * 6], ["\u00e9t\u00e9", "\U0001f600", "z"], ["b"]]


def test_near_copies_leave_no_sets_or_bitmaps_in_the_shared_folder(spark, docs, corpus):
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    assert corpus_pipeline.drop_near_copies(spark, docs(corpus), "").count() > 0
    left = {f.rsplit("-", 1)[0] for f in set(os.listdir(folder)) - before if f.startswith("llm-")}
    assert "llm-set-ids" in left and not left & {"llm-sets", "llm-set-bits"}
