"""Language ID, licenses, mixing, packing: on odd rows, against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from salesmart.llm import langid, licenses, mixing, packing
from tests_llm_data import DOC_SCHEMA, prose, row

BPE = public_tokenizers.path("word_bpe_49k.json")
FRENCH = "la de que è ou eau tre ment ç en re aux on ai le"


@pytest.fixture()
def two_languages(docs):
    rnd = random.Random(2)
    rows = []
    for i in range(160):
        fr = i % 2
        rows.append(row(i, prose(rnd, 60, FRENCH) if fr else prose(rnd, 60), "fr" if fr else "en"))
    rows += [row(160, "привет мир это русский текст", "ru"), row(161, "ещё один русский текст", "ru"),
             row(162, "снова слова на русском", "ru"), row(163, "и ещё слова русские", "ru"), row(164, "слова и слова", "ru")]
    return docs(rows)


def test_langid_held_out_and_odd_texts(spark, docs, two_languages):
    model = langid.train(two_languages)
    assert model.langs == ["en", "fr", "ru"]
    found = langid.identify(two_languages, model).join(two_languages.select("doc_id", "lang"), "doc_id")
    held = found.where(langid.held_out(F.col("doc_id"))).collect()
    assert held and all(r.lang_pred == r.lang for r in held)
    odd = docs([row(1, None), row(2, ""), row(3, "12 !! 3"), row(4, "слово"), row(None, "the", None), row(6, "中文字")])
    got = [tuple(r) for r in langid.identify(odd, model, spans=False).collect()]
    assert got[:3] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert got[3][1] == "ru" and got[4][0] is None and got[5][1] in model.langs
    assert all(0 <= r[2] <= 1 for r in got)


def test_langid_spans_of_mixed_text(docs, two_languages):
    model, rnd = langid.train(two_languages), random.Random(3)
    text = prose(rnd, 40) + " " + prose(rnd, 30, FRENCH) + " " + prose(rnd, 40)
    spans = langid.identify(docs([row(1, text)]), model).first().spans
    assert [s.lang for s in spans] == ["en", "fr", "en"]
    assert abs(spans[1].first_word - 40) <= 3 and abs(spans[1].end_word - 70) <= 3


def test_langid_viterbi_is_the_best_path():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 7):
        scores = rnd.normal(size=(n, 3)) * 3
        offs = np.array([0, n])
        path = langid.viterbi(scores, np.arange(n), offs, 2.0)
        value = lambda p: sum(scores[t, s] for t, s in enumerate(p)) - 2 * sum(a != b for a, b in zip(p, p[1:]))
        best = max(value(p) for p in np.ndindex(*(3,) * n))
        assert value(path) == pytest.approx(best)


def test_langid_without_labels_or_rows(docs):
    model = langid.train(docs([row(1, "some text", None)]))
    assert [r.lang_pred for r in langid.identify(docs([row(1, "some text", None)]), model).collect()] == ["und"]
    assert langid.identify(docs([]), model).count() == 0
    assert langid.keep(docs([]), model).count() == 0


def test_langid_keep_drops_jumbles_only(docs, two_languages):
    model = langid.train(two_languages)
    kept = langid.keep(docs([row(1, "the then of and in it to are"), row(2, None), row(3, "??")]), model)
    assert [r.doc_id for r in kept.collect()] == [1] and kept.columns == [c.split()[0] for c in DOC_SCHEMA.split(", ")]


def test_langid_unlearned_scripts_count_for_no_language(docs):
    rnd = random.Random(8)
    rows = [row(i, prose(rnd, 60, FRENCH) if i % 2 else prose(rnd, 60), "fr" if i % 2 else "en") for i in range(80)]
    model = langid.train(docs(rows))
    english = prose(rnd, 40)
    odd = [row(1, "\u4e2d\u6587\u5b57 \u6c49\u8bed"), row(2, "\u03b5\u03bb\u03bb\u03b7\u03bd\u03b9\u03ba\u03ac \u03ba\u03b5\u03af\u03bc\u03b5\u03bd\u03bf"),
           row(3, english), row(4, english + " \u043f\u0440\u0438\u0432\u0435\u0442" * 200)]
    score = {r.doc_id: r.score for r in langid.identify(docs(odd), model).collect()}
    letters = sum(map(len, english.split()))
    assert score[1] == score[2] == 0 and score[3] == 1
    assert score[4] == pytest.approx(letters / (letters + 1200))
    assert [r.doc_id for r in langid.keep(docs(odd), model, 0.35).collect()] == [3]


def test_licenses_match_plain_search(docs, corpus):
    rows = corpus + [row(900, "X MIT-License, mit license the MIT  LICENSE"), row(901, "Apache License general public License"),
                     row(902, "summit license mit licenses"), row(903, "mit license mit\nlicense")]
    got = {r.doc_id: r for r in licenses.scan(docs(rows)).collect()}
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    low = {c: c + 32 for c in range(65, 91)}
    for i, text, *_ in rows:
        w = word.findall((text or "").translate(low))
        at = [(k, lb) for p, lb in licenses.BASE.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        if i is None:
            continue
        places = [k for k, _ in at]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_templates(docs):
    bsd = ("Neither the name of the Big Example Company nor the names of its contributors may be used to endorse or promote "
           "products derived from this software without specific prior written permission.")
    rows = [row(1, "Released under the MIT License."), row(2, "Licensed under the Apache License, Version 2.0."),
            row(3, "This work is licensed under the GNU General Public License, version 3."), row(4, "Licensed under CC BY-NC 4.0."),
            row(5, bsd), row(6, bsd.replace("prior", "")), row(7, "licensed under the apache license version 1.0")]
    got = {r.doc_id: r.labels for r in licenses.scan(docs(rows)).collect()}
    assert got == {1: "mit", 2: "apache,apache-2.0", 3: "gpl,gpl-3.0", 4: "cc-by-nc-4.0", 5: "bsd-3-clause", 6: "", 7: "apache"}
    assert licenses.scan(docs([])).count() == 0


def test_license_automaton_regions():
    a = licenses.Automaton("a <<optional>>b <<optional>>c<<end>><<end>> d <<any 1 2>> e")
    ok = [m for m in ("a d x e", "a b d x e", "a b c d x y e", "a c d x e", "a d e", "a d x y z e")
          if a.finds(m.split(), set(m.split())) == [(0, len(m.split()))]]
    assert ok == ["a d x e", "a b d x e", "a b c d x y e"] and a.needs == {"a", "d", "e"}


def _mix(docs, rows, **how):
    d = docs(rows).withColumn("domain", F.when(F.col("source") == "s3", "b").otherwise("a"))
    w = [mixing.weight_of("domain", {"a": 3, "b": 1}), F.lit(1), F.lit(1)]
    return mixing.select(d, ["domain", "lang", "source"], w, **how).collect()


def test_mixing_redistributes_to_siblings_first(docs):
    # the leaves of domain a have 100, 1000 and 1000 tokens, b has 4000
    rows = [row(i, "w " * 10, "en", "s1") for i in range(10)] + [row(100 + i, "w " * 10, "en", "s2") for i in range(100)]
    rows += [row(300 + i, "w " * 10, "fr", "s1") for i in range(100)] + [row(500 + i, "w " * 10, "en", "s3") for i in range(400)]
    got = _mix(docs, rows, share=0.3, max_epochs=1)           # budget 1830: a 1372, b 457
    size = defaultdict(int)
    for r in got:
        size[r.domain, r.lang, r.source] += r.tokens * r.copies
    assert size == {("a", "en", "s1"): 100, ("a", "en", "s2"): 580, ("a", "fr", "s1"): 680, ("b", "en", "s3"): 450}
    got = _mix(docs, rows, share=0.9, max_epochs=1)           # a has too little: the rest goes to b
    assert sum(r.tokens for r in got if r.domain == "a") == 2100 and sum(r.tokens for r in got if r.domain == "b") == 3390


def test_mixing_epochs_nulls_and_repeats(docs):
    rows = [row(1, "a b c d", None, "s1"), row(2, None, "en", "s1"), row(None, "x y", "en", None), row(4, "q r s", "en", "s3"),
            row(4, "q r s", "en", "s3")]
    got = Counter((r.doc_id, r.copies) for r in _mix(docs, rows, share=2.0, max_epochs=2))
    assert got == {(1, 2): 1, (None, 2): 1, (4, 2): 2}
    assert _mix(docs, [], share=0.5) == []
    extra = docs(rows).withColumns({"epochs": F.lit(9), "cap": F.lit(9), "bound": F.lit("z")})
    out = mixing.mixed(extra, {"lang": F.col("lang")}, [F.lit(1)], share=2.0, max_epochs=2)
    assert out.columns == extra.columns and out.where("doc_id = 1").count() == 2


def test_mixing_prefix_is_the_start_of_the_epoch(docs):
    rows = [row(i, "w " * (1 + i % 7), "en", "s1") for i in range(500)]
    got = _mix(docs, rows, share=0.37, max_epochs=1)
    taken = {r.doc_id for r in got}
    import hashlib
    order = sorted(rows, key=lambda r: hashlib.md5(f"7:0:{r[0]}".encode()).hexdigest())
    total, want, room = 0, set(), int(sum(1 + i % 7 for i in range(500)) * 0.37)
    for r in order:
        total += 1 + r[0] % 7
        if total <= room:
            want.add(r[0])
    assert taken == want


def test_packing_places_and_ids(docs, corpus):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(BPE)
    got = packing.pack(docs(corpus), BPE, with_ids=True).collect()
    want = Counter()
    for i, text, *_ in corpus:
        ids = own.encode(text or "", add_special_tokens=False).ids + [0]
        for k, s in enumerate(range(0, len(ids), 2048)):
            raw = np.array(ids[s:s + 2048], "<u4").tobytes()
            want[i, k, s, len(raw) // 4, zlib.crc32(raw)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-sum(r.length for r in got) // 2048) + 1


def test_packing_sequences_hold_their_pieces(docs, corpus):
    packed = packing.pack(docs(corpus[:40]), BPE, with_ids=True)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)


def test_packing_odd_bytes_equal_the_tokenizer():
    from tokenizers import Tokenizer
    own, rnd = Tokenizer.from_file(BPE), random.Random(5)
    letters = [*"abXZ09.,'-_()<|>\t\n \réßñ中²٣½İ̸́⃣​ \u0085\x1c", "<|endoftext|>", "<|ENDOFTEXT|>", "it's", "='"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    texts += [t.replace("<|", "<") for t in texts]
    data = [t.encode() for t in texts]
    encode = packing.ChunkTokenizer(BPE)
    for part in (slice(0, 3000), slice(3000, 6000)):
        offs = np.concatenate([[0], np.cumsum([len(b) for b in data[part]])])
        ids, cut = encode(np.frombuffer(b"".join(data[part]), np.uint8), offs)
        for i, t in enumerate(texts[part]):
            assert ids[cut[i]:cut[i + 1]].tolist() == own.encode(t, add_special_tokens=False).ids


def test_packing_plan_covers_and_is_near_the_bound():
    rnd = random.Random(7)
    histogram = Counter(min(2048, int(rnd.lognormvariate(6, 1)) + 1) for _ in range(20_000))
    columns, bound = packing.plan(dict(histogram), rounds=60)
    used = Counter()
    for column, n in columns:
        assert sum(length * k for length, k in column.items()) <= 2048
        for length, k in column.items():
            used[length] += k * n
    assert used == histogram
    assert sum(n for _, n in columns) <= bound * 1.002 + 2
    best = packing.price(np.array([3, 5, 7]), np.array([3.1, 5.0, 7.6]), 15)
    assert sorted(best) == [0, 1, 2] or sorted(best) == [2, 2]
    assert packing.plan({}) == ([], 0.0)


def test_packing_empty_table(docs):
    assert packing.pack(docs([]), BPE).count() == 0
