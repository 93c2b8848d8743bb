"""Extra columns with the names that operators and stages use inside."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salesmart.llm import (bytebpe, collocations, common, jaccard, langid, licenses, mainhtml, mixing, negatives, packing, pivots, queries,
                           suffixes, topk, warc)

NAMES = ["_id", "_h", "h", "id", "row", "_k", "_t", "_spans", "spans", "_lang", "_domain", "_source", "domain", "_epochs", "epochs", "_bound",
         "bound", "_copies", "copies", "_copy", "col", "_score", "score", "_lang_pred", "lang_pred", "tokens", "n", "size", "part", "key", "piece",
         "ordinal", "length", "start", "bucket", "rank", "v", "q", "cls", "near", "dims", "pivot", "block", "a", "b", "fine", "label_", "body",
         "payload", "digest", "offset", "sequence_id", "component_id", "n_links", "value", "node", "root", "d1", "d2", "Spans", "__id"]
NAMES = list({n.lower(): n for n in reversed(NAMES)}.values())


def more(frame, names=NAMES):
    """`frame` with a column of text for each name that it lacks."""
    have = {c.lower() for c in frame.columns}
    return frame.withColumns({n: F.lit(f"x{n}") for n in names if n.lower() not in have})


def rows_of(frame, columns):
    return sorted((repr(tuple(r)) for r in frame.select(*columns).collect()))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_keep_clashing_columns(spark, docs, corpus, name, stage):
    plain, wide = docs(corpus), more(docs(corpus))
    want, got = stage(spark, plain, "unused"), stage(spark, wide, "unused")
    if name == corpus_pipeline.STAGES[-1][0]:
        columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
        assert rows_of(got, columns) == rows_of(want, columns)
        return
    assert got.columns == wide.columns and got.dtypes == wide.dtypes
    got = common.stash(got, "test")
    assert rows_of(got, plain.columns) == rows_of(want, plain.columns)
    added = [c for c in wide.columns if c not in plain.columns]
    assert got.select(*added).distinct().collect() == wide.select(*added).distinct().collect()


DOCUMENTS = {
    "op1": lambda d: langid.identify(d, langid.train(d)).select("doc_id", "lang_pred", "score"),
    "op2": lambda d: mixing.select(d.withColumn("level", F.col("source")), ["level"], [F.lit(1)]).select("doc_id", "level", "copies"),
    "op4": lambda d: packing.pack(d, queries.WORD_BPE).select("doc_id", "piece", "length", "ids_crc32"),
    "op6": lambda d: suffixes.removed(d, 100),
    "op8": lambda d: jaccard.link(d).select("doc_id", "n_shingles", "n_links", "component_id"),
    "op9": lambda d: licenses.scan(d).drop("spans"),
    "op11": lambda d: collocations.mine(d, least=2),
    "op12": lambda d: bytebpe.encode(d, queries.BYTE_BPE, queries.public_tokenizers.PATTERN),
}


@pytest.mark.parametrize("name", DOCUMENTS)
def test_document_operators_ignore_clashing_columns(docs, corpus, name):
    apply = DOCUMENTS[name]
    want = apply(docs(corpus))
    assert rows_of(apply(more(docs(corpus))), want.columns) == rows_of(want, want.columns)


VECTORS = {
    "op5": lambda v: topk.top_k(v, F.col("id") % 50 == 0, k=5),
    "op10": lambda v: pivots.near_duplicates(v),
    "op13": lambda v: negatives.mine(v, F.col("id") % 50 == 0),
}


@pytest.mark.parametrize("name", VECTORS)
def test_vector_operators_ignore_clashing_columns(spark, name):
    rnd = random.Random(3)
    rows = [(i, [rnd.random() for _ in range(8)], i % 4) for i in range(160)]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = VECTORS[name](plain)
    assert rows_of(VECTORS[name](more(plain)), want.columns) == rows_of(want, want.columns)


def test_page_operators_ignore_clashing_columns(spark):
    page = "<html><body><nav>Menu</nav><article><p>{0} one two three.</p></article></body></html>"
    rows = [(i, f"http://x/{i}", page.format(i % 7)) for i in range(30)]
    plain = spark.createDataFrame(rows, "page_id long, url string, html string")
    for apply in (lambda p: mainhtml.extract(p, mainhtml.learn(p)).select("page_id", "url", "text"),
                  lambda p: warc.read_records(warc.write_archive(p)).select("page_id", "payload_digest", "record_type", "refers_to")):
        want = apply(plain)
        assert rows_of(apply(more(plain)), want.columns) == rows_of(want, want.columns)
