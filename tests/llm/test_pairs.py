"""Jaccard join, suffix dedup: against brute force, on odd rows and empty tables."""

import hashlib
import os
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from salesmart.llm import common, jaccard, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, width=5):
    w = WORD.findall((text or "").translate(LOW))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < width else zip(*(w[i:] for i in range(width))))


def brute_links(rows):
    sets = [(r[0], shingle_set(r[1])) for r in rows]
    root = {i: i for i, _ in sets if i is not None}
    links = [0] * len(sets)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, (i, s) in enumerate(sets):
        for b, (j, t) in enumerate(sets):
            k = len(s & t)
            if a != b and k and i is not None and j is not None and 100 * k >= 75 * len(s | t):
                links[a] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return Counter((i, len(s), n, find(i) if i is not None else None) for (i, s), n in zip(sets, links))


def test_jaccard_matches_brute_force(docs, corpus):
    got = jaccard.link(docs(corpus)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.n_links, r.component_id) for r in got) == brute_links(corpus)


def test_jaccard_blocks_of_a_large_component(docs, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "TASK_SHINGLES", 600)
    got = jaccard.link(docs(corpus)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.n_links, r.component_id) for r in got) == brute_links(corpus)


def test_jaccard_keeps_one_of_each_group(docs, corpus):
    kept = jaccard.keep_first(docs(corpus)).collect()
    roots = {c for (i, n, _, c) in brute_links(corpus) if n and i is not None}
    ids = [r.doc_id for r in kept]
    assert roots <= set(ids) and len([i for i in ids if i in roots]) == len(roots)
    assert set(kept[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars"}


def test_jaccard_empty_table_and_clashing_columns(spark, docs):
    assert jaccard.link(docs([])).count() == 0
    d = spark.createDataFrame([(1, "a b c d e f", 5, 6, 7)], "doc_id int, text string, h int, n int, token int")
    assert [tuple(r) for r in jaccard.link(d).select("doc_id", "n_shingles", "n_links", "component_id").collect()] == [(1, 2, 0, 1)]
    assert jaccard.keep_first(d).collect()[0].token == 7


@pytest.mark.parametrize("neighbours", [1, 3, 16])
def test_jaccard_families_in_many_slices_match_brute_force(docs, monkeypatch, neighbours):
    """Whatever the order of the shingles, and however long the runs that are linked whole."""
    monkeypatch.setattr(jaccard, "NEIGHBOURS", neighbours)
    monkeypatch.setattr(jaccard, "order_table", lambda own, width: np.zeros(1 << jaccard.COUNTERS_LOG2, np.int32))
    rnd = random.Random(neighbours)
    rows = []
    for family in range(24):
        base = [rnd.choice("abcdefgh") * 2 + str(rnd.randrange(40)) for _ in range(rnd.randrange(8, 90))]
        for _ in range(rnd.choice([1, 2, 9, 22])):
            w = [x if rnd.random() > 0.02 else "new" + str(rnd.randrange(30)) for x in base]
            w = w[rnd.randrange(3):] + rows[-1][1].split()[:rnd.randrange(9)] if rows else w
            rows.append((len(rows), " ".join(w), "en", "s", 0))
    got = jaccard.link(docs(rows).repartition(40)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.n_links, r.component_id) for r in got) == brute_links(rows)


def test_jaccard_joins_near_sets_only_and_leaves_no_large_files(spark, docs, monkeypatch):
    """Where the counters order next to nothing, texts that share a fifth of their shingles with the next one
    made one component of all, whose blocks were dealt out as often as there were blocks."""
    monkeypatch.setattr(jaccard, "order_table", lambda own, width: np.zeros(1 << jaccard.COUNTERS_LOG2, np.int32))
    kept, made = {}, jaccard.stash
    monkeypatch.setattr(jaccard, "stash", lambda df, name: kept.setdefault(name, made(df, name)))
    block = [" ".join(f"w{i}x{k}" for k in range(24)) for i in range(200)]
    own = [" ".join(f"o{i}x{k}" for k in range(50)) for i in range(200)]
    rows = [(i, f"{block[i]} {own[i]} {block[(i + 1) % 200]}", "en", "s", 0) for i in range(200)]
    rows += [(1000 + i, rows[i][1] + " end", "en", "s", 0) for i in range(5)]
    got = jaccard.link(docs(rows).repartition(24)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.n_links, r.component_id) for r in got) == brute_links(rows)
    assert kept["set-groups"].count() == 10     # all 205 before
    folder = common.checkpoint_dir(spark).removeprefix("file:")
    assert not any(f.startswith("llm-sets-") and kept["sets"].stash_folder.endswith(f) for f in os.listdir(folder))


def test_bitmaps_never_differ_more_than_the_sets():
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 1 << 63, k, np.uint64)) for k in (0, 1, 31, 32, 33, 64, 65, 500)]
    sets += [np.unique(np.concatenate([x[len(x) // 9:], rnd.integers(0, 1 << 63, len(x) // 3, np.uint64)])) for x in sets]
    n = np.array([len(x) for x in sets])
    words, start, size = jaccard._bitmaps(np.concatenate(sets), np.repeat(np.arange(len(n)), n), n)
    assert (size * 64 >= 2 * n).all()
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(n)), np.arange(len(n))))
    apart = jaccard._apart(words, start, size, a, b)
    assert (apart <= [len(np.setxor1d(sets[x], sets[y])) for x, y in zip(a, b)]).all()
    assert apart[(a == 7) & (b == 6)] > 100 and (apart[a == b] == 0).all()


@pytest.mark.parametrize("percent", [75, 30, 10, 95])
def test_answers_are_derived_exactly(percent):
    rnd = np.random.default_rng(percent)
    sets = []
    for family in range(6):
        base = rnd.integers(0, 1 << 40, 10 + 30 * family)
        sets += [np.unique(np.concatenate([base[rnd.random(len(base)) > 0.08], rnd.integers(0, 1 << 40, k % 5), [1, 2]]))
                 for k in range(25)]
    offs = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    tokens = np.concatenate(sets)
    want = {(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b]))
            >= percent * len(np.union1d(sets[a], sets[b]))}
    got = [(max(x, y), min(x, y)) for x, found in jaccard.answers(tokens, offs, percent) for y in found.tolist()]
    assert len(got) == len(set(got)) and set(got) == want
    weight, ids = rnd.integers(1, 9, len(sets)), rnd.permutation(len(sets))
    side = rnd.integers(0, 2, len(sets))
    for block in (None, side):
        links, label = np.zeros(len(sets), int), ids.copy()
        pairs = [p for p in want if block is None or side[p[0]] != side[p[1]]]
        for a, b in pairs:
            links[a] += weight[b]
            links[b] += weight[a]
        while any(label[a] != label[b] for a, b in pairs):
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        found = jaccard.join_sets(tokens, offs, percent, weight, ids, block)
        assert (found[0] == links).all() and (found[1] == label).all()


def test_memory_of_many_small_families():
    rnd = np.random.default_rng(0)
    base = np.repeat(rnd.integers(0, 1 << 40, (6_000, 12)), 4, axis=0)
    base[np.arange(len(base)), rnd.integers(0, 12, len(base))] = rnd.integers(0, 1 << 40, len(base))   # 24000 sets
    base = base[rnd.permutation(len(base))]
    tracemalloc.start()
    links, _ = jaccard.join_sets(base.reshape(-1), np.arange(0, base.size + 1, 12), 75, np.ones(len(base), int), np.arange(len(base)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20 and links.sum() > 0     # dense counts: 1.2 GB


def brute_removed(rows, size):
    count = Counter()
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    for _, b in texts:
        count.update(b[s:s + size] for s in range(len(b) - size + 1))
    out = Counter()
    for i, b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - size + 1):
            if count[b[s:s + size]] > 1:
                gone[s:s + size] = b"\x01" * size
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("size", [400, 60])
def test_suffixes_match_brute_force(docs, corpus, size):
    got = suffixes.removed(docs(corpus), size, keep="none").collect()
    assert Counter(tuple(r) for r in got) == brute_removed(corpus, size)


def test_suffixes_split_anchors_and_cut_texts(docs, corpus, monkeypatch):
    monkeypatch.setattr(suffixes, "TASK_CLASSES", 2)
    monkeypatch.setattr(suffixes, "STARTS", 1000)
    got = suffixes.removed(docs(corpus), 100, keep="none").collect()
    assert Counter(tuple(r) for r in got) == brute_removed(corpus, 100)


def test_suffixes_keep_first_matches_brute_force(docs, corpus, monkeypatch):
    rows = [r for r in corpus if r[0] is not None and r[0] != 3]
    seen, want = set(), {}
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                gone[s:s + 100] = b"\x01" * 100
            seen.add(b[s:s + 100])
        want[i] = sum(gone)
    for limit in (4_000, 2):
        monkeypatch.setattr(suffixes, "TASK_CLASSES", limit)
        got = {r.doc_id: r.n_removed for r in suffixes.removed(docs(rows), 100, keep="first").collect()}
        assert got == want


def test_suffixes_line_in_many_contexts_crosses_few_windows(docs, monkeypatch):
    rnd = random.Random(8)
    own = lambda n: "".join(rnd.choices("abcdefghij", k=n))
    line, passage = own(80), own(130)
    rows = [(i, own(150) + line + own(150) + (passage if i % 20 == 0 else ""), "en", "s", 0) for i in range(60)]
    made, keep = {}, suffixes.stash

    def stash(df, name):
        made[name] = keep(df, name)
        return made[name]
    monkeypatch.setattr(suffixes, "stash", stash)
    monkeypatch.setattr(suffixes, "TASK_CLASSES", 4)
    got = suffixes.removed(docs(rows), 100, keep="none").collect()
    assert Counter(tuple(r) for r in got) == brute_removed(rows, 100) and sum(r.n_removed for r in got) >= 3 * 130
    assert made["matches"].count() < len(rows)     # each context had some 50 of its own before


def test_suffixes_keep_the_first_copy(docs):
    a, b = "x".join(str(i) for i in range(300)), "y".join(str(i) for i in range(300, 500))
    rows = [(5, "start " + a + " end", "en", "s", 0), (2, a, "en", "s", 0), (9, b + a, "en", "s", 0), (11, None, "en", "s", None)]
    got = {r.doc_id: r for r in suffixes.cut_repeats(docs(rows), 200, keep="first").collect()}
    assert got[2].text == a and got[5].text == "start  end" and got[9].text == b and got[11].text is None
    assert got[9].n_chars == len(b)


def test_suffixes_cut_whole_characters(docs):
    text = "é" * 300
    got = suffixes.cut_repeats(docs([(1, "a" + text + "ß", None, None, 0), (2, text + "b", None, None, 0)]), 101, "none").collect()
    assert {r.doc_id: r.text.replace("é", "") for r in got} == {1: "aß", 2: "b"}


def test_suffixes_empty_table(docs):
    assert suffixes.removed(docs([])).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(5, 160), (7, 7), (300, 301)], "a long, b long")
    got = {r.node: r.root for r in common.components(edges, "a", "b").collect()}
    assert got == {**{i: 5 for i in range(100, 161)}, 5: 5, 300: 300, 301: 300}
