import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from tallyforge.llm.components import components
from tallyforge.llm.minhash import BINS, NearDuplicates, banding, densify, signatures
from tallyforge.llm.texthash import distinct, shared, shingles

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()


def brute(rows, words, percent):
    sets = [(i, shingle_set(t, words)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            ri, rj = sorted((find(i), find(j)))
            parent[rj] = ri
    return {i: (len(s), find(i)) for i, s in sets}


def compare(docs, words, percent, block=1024):
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], words, percent)
    got = NearDuplicates(words, percent, block)(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_provided_documents(spark, words, percent):
    compare(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), words, percent)


def test_group_of_near_copies_with_stragglers(spark):
    draw = random.Random(3)
    base = [f"w{draw.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(draw.randrange(14)):
            words[draw.randrange(120)] = f"v{draw.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    compare(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, block=16)


def test_small_sets(spark):
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice("abcd") for _ in range(draw.randrange(0, 14)))) for i in range(150)]
    compare(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)


def test_hard_rows(spark, hard):
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in NearDuplicates(3, 85)(hard).collect()]
    assert len(got) == hard.count()
    by = defaultdict(list)
    for g in got:
        by[g[0]].append(g)
    assert by[1] == [(1, 0, 1, True)] and by[2] == [(2, 0, 2, True)] and by[3] == [(3, 0, 3, True)]
    assert {g[2] for i in (4, 5, 6) for g in by[i]} == {4} and len(by[5]) == 2
    assert by[None][0][2] is None and by[None][0][3] is True


def test_empty_table(spark, empty):
    assert NearDuplicates()(empty).count() == 0


def test_keep_one(spark, hard):
    kept = NearDuplicates(3, 85).keep_one(hard)
    assert kept.columns == hard.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 4 in ids and 5 not in ids and 6 not in ids and None in ids


def test_components(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(draw.randrange(2000, 2300), draw.randrange(2000, 2300)) for _ in range(150)]
    parent = {v: v for e in edges for v in e}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.vertex: r.component for r in got} == {v: find(v) for v in parent} and len(got) == len(parent)


def test_signatures_estimate_similarity():
    h = np.random.default_rng(0).integers(0, 2**63, 1300).astype(np.uint64)
    (a, b, few, none), byte = signatures([h[:1000], h[300:], h[:3], h[:0]], BINS)
    assert abs((a == b).mean() - 700 / 1300) < 0.1
    assert len(set(few.tolist())) == 3 and (byte[2] > 0).sum() == 3 and not byte[3].any()
    assert (signatures([h[:3]], BINS)[0][0] == few).all(), "a row does not depend on its neighbours"


def test_densified_takes_filled_bins_only():
    filled = np.zeros((2, 64), bool)
    filled[0, [3, 40]] = True
    values = np.arange(128, dtype=np.uint64).reshape(2, 64)
    densify(values, filled)
    assert set(values[0].tolist()) == {3, 40}


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_words_of_a_regular_structure_stay_apart(spark):
    """Polynomial hashes modulo a power of two are equal for a Thue-Morse word and its complement."""
    word = thue_morse(4096)
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"one two three {word} five"), (2, f"one two three {other} five"), (3, f"one two three {word} five")]
    got = {r.doc_id: r.component_id for r in NearDuplicates(3, 85)(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_sets_compare_by_both_lanes():
    h = np.array([[1, 1], [1, 2], [1, 1], [3, 0], [2, 9], [1, 2]], np.uint64)
    a = distinct(h)
    assert sorted(map(tuple, a.tolist())) == [(1, 1), (1, 2), (2, 9), (3, 0)]
    assert shared(a, distinct(h[:1])) == 1 and shared(a, np.array([[1, 3]], np.uint64)) == 0 and shared(a, h[:0]) == 0 and shared(a, a) == 4


def clustered(n_clusters, size, drift, seed):
    """Clusters whose members differ from each other by small steps, so that stars overlap and hubs miss members."""
    draw, rows = random.Random(seed), []
    common = [f"c{k}" for k in range(70)]
    for c in range(n_clusters):
        own = common + [f"o{c}_{k}" for k in range(50)]
        for _ in range(size):
            words = list(own)
            for _ in range(draw.randrange(drift)):
                words[draw.randrange(len(words))] = f"v{draw.randrange(400)}"
            rows.append((len(rows), " ".join(words)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n_clusters", "size", "drift", "block", "rounds"), [(3, 40, 12, 8, 3), (20, 6, 7, 4, 2)])
def test_stars_and_rings_lose_no_link(spark, n_clusters, size, drift, block, rounds):
    rows = clustered(n_clusters, size, drift, n_clusters)
    want = brute(rows, 3, 85)
    got = NearDuplicates(3, 85, block, rounds)(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_banding_finds_pairs_at_the_threshold():
    for s in (0.8, 0.85):
        b = banding(s)
        assert (1 - s**b.rows) ** b.bands <= 1e-7 and b.rows * b.bands <= BINS


def test_shingle_hashes_equal_shingles():
    texts = ["a b c d", "A B C d", "", " x ", "x y", "a  b\tc\nd é", "b c d a b c d"]
    h, counts = shingles([t.encode() for t in texts], 3)
    ends = np.cumsum(counts)
    got = [frozenset(map(tuple, h[e - n : e].tolist())) for e, n in zip(ends, counts, strict=True)]
    want = [shingle_set(t, 3) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    for (ga, wa), (gb, wb) in combinations(zip(got, want, strict=True), 2):
        assert len(ga & gb) == len(wa & wb)
