"""Language identification of whole, possibly mixed, texts.

1. A letter's Unicode range names its script.  The scripts a language was seen
   to use narrow the candidates of each word.
2. A word's score under each candidate is the mean log-probability of its
   hashed letter n-grams (with word ends) plus that of the word itself.
3. Viterbi over the words with a penalty for each switch of language labels
   spans of the text.  The language with the most letters is the prediction,
   its share of the letters the score.

Defined results: a null text, or one without a letter, is `und` with score 0;
words of a script no learned language uses carry no evidence: their letters count
for no language and lower the score, to 0 if there are no others; ties go to the
language that sorts first; without labelled rows every text is `und`.  Repeated
rows are predicted alike.  Only `doc_id`, `text` and, to learn, `lang` are read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import B1, MIX2, mix, range_hashes, text_slices, unused

#: Bound of the labelled sample: documents for each language, chosen by a hash of their id.
TRAIN_DOCS_PER_LANG = 4000
#: Hash buckets of n-grams, the lengths of n-grams, and the switching penalty in nats.
BUCKETS, GRAMS, SWITCH = 1 << 15, (1, 2, 3, 4), 6.0
#: A script belongs to a language if it has this share of the letters seen with it.
SCRIPT_SHARE = 0.02
UNKNOWN = "und"
#: Bytes of text whose words are labelled together.
SLICE = 2 << 20
#: Distinct words whose scores or counts a task keeps.
KEPT_WORDS = 150_000

# First code point of each range and the script that holds there.
SCRIPT_RANGES = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "thaana"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "other"), (0x20000, "han"),
]
_STARTS = [a for a, _ in SCRIPT_RANGES]

_WORDS = re.compile(r"[^\W\d_]{1,64}")


def script_of(word: str) -> str | None:
    """Script of the word's first letter; None without a letter."""
    if word.isascii() and word.isalpha():
        return "latin"
    for ch in word:
        if ch.isalpha():
            return SCRIPT_RANGES[bisect_right(_STARTS, ord(ch)) - 1][1]
    return None


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, bucket) of every n-gram of the words with a space at either
    end, and the bucket of each word as a whole."""
    text = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    space = text == 32
    number = np.cumsum(space) - 1                        # of the word after the last space
    rows, buckets = [], []
    with np.errstate(over="ignore"):
        wide = mix(text.astype(np.uint64) + B1)
        for n in GRAMS:
            m = len(text) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            inner = np.zeros(m, bool)
            for k in range(n):
                h = mix(h * MIX2 + wide[k:k + m])
                if 0 < k < n - 1:
                    inner |= space[k:k + m]
            ok = ~inner & ~(space[:m] & space[n - 1:])   # a space may only stand at one end or both ends of letters
            if n > 2:
                ok = ~inner
            rows.append(number[:m][ok])
            buckets.append((h[ok] % np.uint64(BUCKETS)).astype(np.int64))
    edge = np.flatnonzero(space)
    whole = range_hashes(text, edge[:-1] + 1, edge[1:])
    return np.concatenate(rows), np.concatenate(buckets), (whole % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    langs: list[str]                  # sorted
    logp: np.ndarray                  # (bucket, language) log-probabilities
    scripts: dict[str, np.ndarray]    # script -> which languages use it

    def score(self, words: list[str]) -> np.ndarray:
        """(word, language) scores; a row of NaN for a word without a letter."""
        row, bucket, whole = features(words)
        size = np.maximum(np.bincount(row, minlength=len(words)), 1)
        out = np.stack([np.bincount(row, self.logp[bucket, j], len(words)) / size * 4 + self.logp[whole, j]
                        for j in range(len(self.langs))], 1)
        kinds = np.array([script_of(w) or "" for w in words])
        for script in np.unique(kinds):
            at = np.flatnonzero(kinds == script)
            may = self.scripts.get(str(script))
            if not script:
                out[at] = np.nan
            elif may is None:
                out[at] = 0
            else:
                out[at] = np.where(may, out[at] - out[at][:, may].max(1)[:, None], -50.0)
        return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str, Counter] = {}
    table: dict[str, np.ndarray] = {}
    scripts: Counter = Counter()

    def flush() -> None:
        for lang, seen in words.items():
            own = table.setdefault(lang, np.zeros(BUCKETS, np.int64))
            seen = {w: n for w, n in seen.items() if script_of(w) is not None}
            if not seen:
                continue
            row, bucket, whole = features(list(seen))
            n = np.fromiter(seen.values(), np.int64, len(seen))
            own += np.bincount(bucket, n[row], BUCKETS).astype(np.int64) + np.bincount(whole, n, BUCKETS).astype(np.int64)
            for w, k in seen.items():
                scripts[lang, script_of(w)] += len(w) * k
        words.clear()

    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words.setdefault(lang, Counter()).update(_WORDS.findall((text or "").lower()))
            if sum(map(len, words.values())) > KEPT_WORDS:
                flush()
    flush()
    for lang, own in table.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array([""] * len(at)),
                                          pa.array(at), pa.array(own[at])], names=["lang", "script", "bucket", "n"])
    rows = [(lg, s, -1, n) for (lg, s), n in scripts.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["lang", "script", "bucket", "n"])


def train(docs: DataFrame, per_lang: int = TRAIN_DOCS_PER_LANG) -> Model:
    """Learn from text and non-null lang of the documents that aren't held out,
    at most about `per_lang` of each language.  What reaches the driver is one
    number for each language and bucket."""
    own = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    own = own.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = own.groupBy("lang").agg(F.count("*").alias("size"))
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("train")), F.lit(1_000_000))
    sample = (own.withColumn("part", part).join(F.broadcast(sizes), "lang")   # one row for each language
              .where(F.col("part") * F.col("size") < F.lit(per_lang * 1_000_000)))
    counts = (sample.select("text", "lang").mapInArrow(_count, "lang string, script string, bucket long, n long")
              .groupBy("lang", "script", "bucket").agg(F.sum("n").alias("n"))).toPandas()
    langs = sorted(counts["lang"].unique())
    place = {x: i for i, x in enumerate(langs)}
    grams = counts[counts["bucket"] >= 0]
    table = np.zeros((BUCKETS, len(langs)))
    table[grams["bucket"].to_numpy(int), grams["lang"].map(place).to_numpy(int)] = grams["n"]
    table += 0.5
    logp = np.log(table / table.sum(0)) if langs else table
    seen = counts[counts["bucket"] < 0].copy()
    share = seen["n"] / seen.groupby("lang")["n"].transform("sum")
    scripts: dict[str, np.ndarray] = {}
    for s, lang in zip(seen["script"][share >= SCRIPT_SHARE], seen["lang"][share >= SCRIPT_SHARE]):
        scripts.setdefault(s, np.zeros(len(langs), bool))[place[lang]] = True
    return Model(langs, logp, scripts)


def viterbi(scores: np.ndarray, word: np.ndarray, offs: np.ndarray, switch: float) -> np.ndarray:
    """Language of each word: scores[word] are the words' scores, offs the
    texts' borders.  All texts of a slice advance together, longest first."""
    sizes = np.diff(offs)
    order = np.argsort(-sizes, kind="stable")
    start, sizes = offs[:-1][order], sizes[order]
    n_lang = scores.shape[1]
    kept = np.zeros((len(word), n_lang), np.int16)   # previous language of the best way to each
    longest = int(sizes[0]) if len(sizes) else 0
    live = np.searchsorted(-sizes, -np.arange(longest), "left")   # texts with more than t words
    own = np.arange(n_lang, dtype=np.int16)
    v = np.zeros((len(sizes), n_lang))
    for t in range(longest):
        n = live[t]
        at = start[:n] + t
        if t:
            top = v[:n].argmax(1)
            jump = v[np.arange(n), top][:, None] - switch
            stay = v[:n] >= jump
            kept[at] = np.where(stay, own, top[:, None])
            v[:n] = np.where(stay, v[:n], jump)
        v[:n] += scores[word[at]]
    path = np.zeros(len(word), np.int16)
    state = v.argmax(1).astype(np.int16)
    for t in range(longest - 1, -1, -1):
        n = live[t]
        at = start[:n] + t
        path[at] = state[:n]
        state[:n] = kept[at, state[:n]]
    return path


class Labeller:
    """Labels the words of texts; keeps the scores of words seen."""

    def __init__(self, model: Model, switch: float):
        self.model, self.switch = model, switch
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, max(len(self.model.langs), 1)))
        self.known = np.zeros(0, bool)    # words of a script that a learned language uses

    def __call__(self, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray, np.ndarray, np.ndarray]:
        """(words with a letter of each text, borders, language of each word,
        whether a learned language uses its script)."""
        if len(self.index) > KEPT_WORDS:
            self._clear()
        words = [_WORDS.findall(t.lower()) if t else [] for t in texts]
        fresh = list({w for x in words for w in x}.difference(self.index))
        if fresh:
            found = self.model.score(fresh)
            self.index.update(zip(fresh, range(len(self.scores), len(self.scores) + len(fresh))))
            self.scores = np.concatenate([self.scores, found])
            self.known = np.concatenate([self.known, np.array([script_of(w) in self.model.scripts for w in fresh], bool)])
        if np.isnan(self.scores[:, 0]).any():   # words without a letter
            none = {w for w, i in self.index.items() if np.isnan(self.scores[i, 0])}
            words = [[w for w in x if w not in none] for x in words]
        offs = np.concatenate([[0], np.cumsum([len(x) for x in words], dtype=np.int64)])
        get = self.index.__getitem__
        at = np.fromiter((get(w) for x in words for w in x), np.int64, int(offs[-1]))
        return words, offs, viterbi(self.scores, at, offs, self.switch), self.known[at]


def _predict(model: Model, switch: float, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = Labeller(model, switch)
        for batch in batches:
            texts = batch.column(1)
            for a, b, _, _ in text_slices(batch, limit=SLICE):
                own = texts.slice(a, b - a).to_pylist()
                words, offs, path, known = label(own) if model.langs else ([[]] * (b - a), np.zeros(b - a + 1, np.int64), None, None)
                lang, score, found = [], [], []
                for i, x in enumerate(words):
                    if not x:
                        lang.append(UNKNOWN)
                        score.append(0.0)
                        found.append([])
                        continue
                    p = path[offs[i]:offs[i + 1]]
                    size = np.fromiter(map(len, x), np.int64, len(x))
                    share = np.bincount(p, size * known[offs[i]:offs[i + 1]], len(model.langs))
                    top = int(share.argmax())
                    lang.append(model.langs[top])
                    score.append(float(share[top] / size.sum()))
                    if spans:
                        cut = np.concatenate([[0], np.flatnonzero(np.diff(p)) + 1, [len(p)]])
                        found.append([{"first_word": int(s), "end_word": int(e), "lang": model.langs[p[s]]}
                                      for s, e in zip(cut, cut[1:])])
                out = [batch.column(0).slice(a, b - a), pa.array(lang), pa.array(score, pa.float64())]
                names = ["doc_id", "lang_pred", "score"]
                if spans:
                    kind = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("lang", pa.string())]))
                    out.append(pa.array(found, kind))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def identify(docs: DataFrame, model: Model, switch: float = SWITCH, spans: bool = True) -> DataFrame:
    """doc_id, lang_pred, score and, if asked for, the labelled spans as word ranges."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    more = ", spans array<struct<first_word: long, end_word: long, lang: string>>" if spans else ""
    return own.mapInArrow(_predict(model, switch, spans), "doc_id long, lang_pred string, score double" + more)


def keep(docs: DataFrame, model: Model, least: float = 0.5, switch: float = SWITCH) -> DataFrame:
    """The documents with a learned language that has at least `least` of the
    letters, with all their columns; rejects texts without letters, jumbles and
    texts in scripts that no learned language uses."""
    from pyspark.sql.types import StructField, StringType, DoubleType, StructType

    lang, score = unused(docs.columns, "_lang_pred", "_score")
    schema = StructType(docs.schema.fields + [StructField(lang, StringType()), StructField(score, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = _predict(model, switch, False)
        for batch in batches:
            at = [batch.schema.get_field_index(c) for c in ("doc_id", "text")]
            pair = pa.RecordBatch.from_arrays([batch.column(i) for i in at], names=["doc_id", "text"])
            for a, part in _numbered(predict(iter([pair]))):
                yield pa.RecordBatch.from_arrays(
                    [c.slice(a, part.num_rows) for c in batch.columns] + [part.column(1), part.column(2)],
                    names=schema.names)

    found = docs.mapInArrow(run, schema)
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).drop(lang, score)


def _numbered(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    at = 0
    for p in parts:
        yield at, p
        at += p.num_rows
