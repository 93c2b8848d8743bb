"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; what it returns is written as Parquet and read again as the next one's
docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import jaccard, langid, mixing, packing, suffixes
from salesmart.llm.common import stash
from salesmart.llm.queries import DOMAIN, DOMAIN_WEIGHTS, LANG_WEIGHTS, WORD_BPE
from salesmart.session import apply_session_conf, ship_package

#: Share of the letters that a document's main language must have: mixed texts stay, jumbles of all go.
LANG_SHARE = 0.35
#: Words of a shingle, per cent of common shingles, words of a repeated passage (more than 50).
SHINGLE, SIMILAR, PASSAGE = 5, 75, 51
#: Share of the tokens to keep in the mixture, epochs of a source at most, seed.
SHARE, EPOCHS, SEED = 0.8, 2, 7


def _ready(spark: SparkSession) -> None:
    apply_session_conf(spark)
    ship_package(spark)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those without a main language."""
    _ready(spark)
    return langid.keep(docs, langid.train(docs), LANG_SHARE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each linked group."""
    _ready(spark)
    return jaccard.keep_first(docs, SHINGLE, SIMILAR)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages but for their first place; all documents stay."""
    _ready(spark)
    return suffixes.cut_repeats(docs, PASSAGE, keep="first", words=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's documents to its weight; those wanted twice come twice."""
    _ready(spark)
    weights = [mixing.weight_of("_domain", DOMAIN_WEIGHTS), mixing.weight_of("_lang", LANG_WEIGHTS), F.lit(1)]
    levels = {"domain": F.expr(DOMAIN), "lang": F.col("lang"), "source": F.col("source")}
    return mixing.mixed(docs, levels, weights, SHARE, EPOCHS, SEED)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 2048 tokens."""
    _ready(spark)
    return packing.pack(docs, WORD_BPE).drop("ids")


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_passages),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The stages learn models, join by similarity and tokenise: no SQL for run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stash(stage(spark, docs, sf_dir), f"stage{i + 1}")
    return docs
