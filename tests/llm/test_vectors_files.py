import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyforge.llm import balltree, doubledouble, queries, tokenfiles, whitening
from tallyforge.llm.eliasfano import EliasFano
from tallyforge.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, cluster string, component string, n string"


# Elias-Fano ------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 300), max_size=700).map(sorted), st.data())
def test_sequences_come_back_by_selection(values, data):
    seq = EliasFano(EliasFano.encoded(np.array(values, np.uint64)))
    assert seq.between(0, len(values)).tolist() == values
    a = data.draw(st.integers(0, len(values)))
    b = data.draw(st.integers(a, len(values)))
    assert seq.between(a, b).tolist() == values[a:b]
    if values:
        k = data.draw(st.integers(0, len(values) - 1))
        assert seq.select(k) == values[k]
        assert seq.find(values[k]) == values.index(values[k])


def test_space_is_near_the_least():
    rng = np.random.default_rng(1)
    values = np.cumsum(rng.integers(1, 4000, 200_000).astype(np.uint64))
    data = EliasFano.encoded(values)
    least = np.log2(float(values[-1]) / len(values)) + 2
    assert 8 * len(data) / len(values) <= least + 1.2  # 64 for a table of offsets
    with pytest.raises(ValueError):
        EliasFano.encoded(values[::-1])
    with pytest.raises(IndexError):
        EliasFano(data).between(5, len(values) + 1)


# Token files -----------------------------------------------------------------


def _expected(rows, start=0):
    t, out = Tokenizer.from_file(tokenizer_path()), []
    for doc_id, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def _key(doc_id):
    return (doc_id is not None, doc_id or 0)


def test_token_files_of_the_provided_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=lambda r: _key(r[0]))
    assert sorted(map(tuple, queries.op12_token_files(spark, SF).collect())) == _expected(rows)


def test_hard_documents_in_many_small_files(spark, hard, tmp_path):
    rows = hard.select("doc_id", "text").collect()
    where = f"file:{tmp_path}/ids"
    made = tokenfiles.write_ids(hard, where, file_ids=300, file_docs=3)
    files = sorted(made.collect(), key=lambda r: r.file)
    assert sum(f.n_docs for f in files) == len(rows) and max(f.n_docs for f in files) <= 3 and len(files) >= 5
    assert [f.start for f in files] == [sum(g.n_ids for g in files[:k]) for k in range(len(files))]
    got = sorted(tokenfiles.read_ids(spark, where, span_ids=50).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in rows), key=_key)
    text_of = {}
    for r in rows:
        text_of.setdefault(r.doc_id, []).append(r.text)
    at = 0
    for r in got:
        want = [_expected([(r.doc_id, t)], at)[0] for t in text_of[r.doc_id]]
        assert tuple(r)[:4] in want and zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens


def test_documents_are_found_by_selection(spark, tmp_path):
    docs = spark.createDataFrame([(k * 10 - 70, f"text number {k} " * k) for k in range(20)] + [(None, "no id")], "doc_id long, text string")
    where = f"file:{tmp_path}/ids"
    (file,) = tokenfiles.write_ids(docs.coalesce(1), where).where("n_docs > 0").collect()[:1]
    t = Tokenizer.from_file(tokenizer_path())
    for f in tokenfiles.manifest(spark, where).collect():
        with tokenfiles.TokenFile(f"{where}/{f.file}") as part:
            assert part.width == 2 and len(part) == f.n_docs
            for k, doc_id in enumerate(part.doc_ids(0, len(part))):
                ids = part.document(k).tolist()
                text = "no id" if doc_id is None else f"text number {(doc_id + 70) // 10} " * ((doc_id + 70) // 10)
                assert ids == [*t.encode(text, add_special_tokens=False).ids, 0]
                assert doc_id is None or part.find(doc_id) == k
            assert part.find(5) is None and part.find(-(10**9)) is None and part.find(10**9) is None
    path = f"{tmp_path}/ids/{file.file}"
    with open(path, "ab") as out:
        out.write(b"x")
    with pytest.raises(ValueError):
        tokenfiles.TokenFile(path)


def test_no_documents_give_no_files(spark, empty, tmp_path):
    assert tokenfiles.write_ids(empty, f"file:{tmp_path}/ids").count() == 0
    assert tokenfiles.token_table(empty).count() == 0


def test_files_are_the_same_when_spans_and_steps_are_small(spark, monkeypatch, tmp_path):
    docs = spark.createDataFrame([(1, "word " * 3000), (2, None), (3, "a b")], "doc_id long, text string")
    want = _expected([(1, "word " * 3000), (2, None), (3, "a b")])
    assert sorted(map(tuple, tokenfiles.token_table(docs).collect())) == want
    where = f"{tmp_path}/ids"
    name = tokenfiles.write_ids(docs.coalesce(1), where).collect()
    monkeypatch.setattr(tokenfiles, "STEP_IDS", 7)
    for f in name:
        with tokenfiles.TokenFile(f"{where}/{f.file}") as part:
            bounds = part.bounds.between(0, len(part) + 1).astype(int).tolist()
            assert tokenfiles._crcs(part, bounds) == [c for i, _, _, c in want if i in part.doc_ids(0, len(part))]


# Ball trees ------------------------------------------------------------------


def _clusters(rows, size, k, rounds, scale=256.0, seed=2):
    """Plain rounds over whole numbers."""
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, v in kept:
            own[nearest(v)[0]].append(v)
        centroids = [[sum(c) // len(vs) for c in zip(*vs, strict=True)] if vs else old for vs, old in zip(own, centroids, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    within = [sum(d for _, c, d in found if c == k) for k in range(len(centroids))]
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, within[c], sum(within), hashes[c]) for i, c, d in found), key=str)


def _hard_vectors(size=4):
    rng = np.random.default_rng(3)
    centres = rng.integers(-40, 40, (6, size)) / 8
    rows = [(k, (centres[k % 6] + rng.integers(-6, 7, size) / 256).tolist()) for k in range(300)]
    rows += [(1000 + k, rows[0][1]) for k in range(200)]  # copies
    rows += [(2000, rows[1][1])] * 3  # repeated rows
    rows += [(3000, None), (3001, []), (3002, [1.0] * (size + 1)), (3003, [None] * size), (3004, [float("nan")] + [0.0] * (size - 1)), (3005, [float("inf")] * size)]
    rows += [(None, [0.25] * size), (3006, [0.0] * size), (3007, [-1e-9] * size)]
    return [(*r, "x", "x", "x") for r in rows]


@pytest.mark.parametrize("leaf,block", [(1, 50), (4, 4096), (32, 7)])
def test_trees_give_what_plain_rounds_give(spark, leaf, block):
    rows = _hard_vectors()
    df = spark.createDataFrame(rows, VECTORS)
    got = balltree.cluster(df, size=4, k=12, rounds=4, leaf=leaf, block=block).collect()
    assert sorted(map(tuple, got), key=str) == _clusters([r[:2] for r in rows], 4, 12, 4)


def test_large_values_stay_exact(spark):
    rows = [(k, [float(2**28 + 3 * k), float(-(2**27) * (k % 3))], "x", "x", "x") for k in range(40)]
    got = balltree.cluster(spark.createDataFrame(rows, VECTORS.replace("float", "double")), size=2, k=5, rounds=3, leaf=2).collect()
    assert len(got) == 40
    exact = [(i, [int(256 * x) for x in v]) for i, v, *_ in rows]
    order = sorted(exact, key=lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest())
    centroids = [v for _, v in order[:5]]
    for _ in range(3):
        own = [[] for _ in centroids]
        for _, v in exact:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            own[d.index(min(d))].append(v)
        centroids = [[sum(c) // len(vs) for c in zip(*vs, strict=True)] if vs else old for vs, old in zip(own, centroids, strict=True)]
    for r in got:
        v = dict(exact)[r.vec_id]
        d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
        assert (r.cluster, r.distance) == (d.index(min(d)), min(d) if min(d) < 2**63 else None)


def test_whole_balls_are_assigned(spark):
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.integers(-9, 10, (500, 8)) + 4000 * k for k in range(8)])
    tree = balltree.Tree.built(np.arange(len(points)), np.ones(len(points), bool), points)
    filtered = balltree.Filter((np.arange(8)[:, None] * 4000 + np.zeros((8, 8), int)).tolist())
    parts = list(filtered.parts(tree))
    assert all(isinstance(c, int) for *_, c in parts) and len(parts) <= 16
    assert sorted((a, b) for a, b, _ in parts)[0][0] == 0 and sum(b - a for a, b, _ in parts) == len(points)


def test_no_vectors_no_clusters(spark):
    df = spark.createDataFrame([], VECTORS)
    assert balltree.cluster(df).collect() == []
    only_bad = spark.createDataFrame([(1, None, "", "", ""), (2, [1.0], "", "", "")], VECTORS)
    assert balltree.cluster(only_bad).collect() == []


# Whitening -------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(-(2**62), 2**62), st.integers(-(2**62), 2**62)), min_size=1, max_size=20))
def test_sums_of_products_are_exact_to_a_hundred_bits(pairs):
    a, b = (doubledouble.of_integers(np.array(c, np.int64)) for c in zip(*pairs, strict=True))
    high, low = doubledouble.sum_rows(doubledouble.mul(a, b))
    want = sum(Fraction(x) * y for x, y in pairs)
    size = sum(abs(Fraction(x) * y) for x, y in pairs)
    assert abs(Fraction(float(high)) + Fraction(float(low)) - want) <= size / 2**95


def _covariance(xs):
    n, size = len(xs), len(xs[0])
    sums = [sum(c) for c in zip(*xs, strict=True)]
    d = [[n * a - s for a, s in zip(x, sums, strict=True)] for x in xs]
    return n, sums, [[Fraction(sum(r[i] * r[j] for r in d), n**3) for j in range(size)] for i in range(size)]


def _whole(v):
    return tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v)


def test_whitening_against_exact_arithmetic(spark):
    rows = _hard_vectors()
    usable = [(i, v) for i, v, *_ in rows if v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v)]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    n, sums, v = _covariance(sorted({_whole(x) for _, x in usable}))
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in r] for r in v]))
    assert len(got) == 4 * len(usable)
    assert {r.n for r in got} == {n} and {r.component for r in got} == {1, 2, 3, 4}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-12
    sign = {}
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    trace = float(sum(v[i][i] for i in range(4)))
    for i, c in usable:
        x = _whole(c)
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)])
        for k in range(1, 5):
            want = centred @ vectors[:, -k] / np.sqrt(values[-k])
            for r in by[i][k]:
                assert r.deviation == deviation and r.explained == pytest.approx(values[-k] / trace, rel=1e-12)
                if abs(want) > 1e-6:
                    sign.setdefault(k, np.sign(want) == np.sign(r.whitened))
                    assert (np.sign(want) == np.sign(r.whitened)) == sign[k]
                assert abs(r.whitened) == pytest.approx(abs(want), abs=1e-9)


def test_covariance_keeps_what_doubles_lose(spark):
    rng = np.random.default_rng(9)
    xs = sorted({tuple(r) for r in (rng.integers(-3, 4, (200, 3)) + np.array([2**52, 2**45, -(2**50)])).tolist()})
    fit_list = spark.createDataFrame([(list(x),) for x in xs], "x array<long>").repartition(7)
    n, sums, v = _covariance(xs)
    bare = whitening.Whitening(n, sums, np.empty(0), np.empty((3, 0)), 0.0)
    high, low = whitening.covariance(fit_list, bare, 3)
    for i in range(3):
        for j in range(3):
            assert abs(Fraction(float(high[i, j])) + Fraction(float(low[i, j])) - v[i][j]) <= abs(v[i][i]) / 2**95


def test_eigenvectors_are_right_where_doubles_do_not_tell_them():
    # two eigenvalues that differ by 1e-17 of the largest: the matrix rounded to doubles has lost them
    q, _ = np.linalg.qr(np.random.default_rng(2).normal(size=(5, 5)))
    pair = q, np.zeros_like(q)
    for _ in range(3):  # orthonormal to double-double
        r = doubledouble.matmul((pair[0].T, pair[1].T), pair)
        r = doubledouble.add((np.eye(5), np.zeros((5, 5))), (-r[0], -r[1]))
        pair = doubledouble.add(pair, doubledouble.matmul(pair, (r[0] / 2, r[1] / 2)))
    low = np.array([0, 0, 0, 0, 1e-12])
    scaled = doubledouble.mul(pair, (np.tile([1e5, 9.0, 4.0, 1.0, 1.0], (5, 1)), np.tile(low, (5, 1))))
    v = doubledouble.matmul(scaled, (pair[0].T, pair[1].T))
    values, vectors = whitening.eigen(v, rounds=4)
    order = np.argsort(-np.array([1e5, 9.0, 4.0, 1.0, 1.0 + 1e-12]), kind="stable")
    for k, j in enumerate(order):
        assert abs(abs(vectors[:, k] @ q[:, j]) - 1) < 1e-12


def test_vectors_alike_have_no_components(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "", "", ""), (2, [1.0, 2.0], "", "", ""), (3, None, "", "", "")], VECTORS)
    assert whitening.whiten(df).collect() == []
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    line = spark.createDataFrame([(k, [float(k), 1.0], "", "", "") for k in range(5)], VECTORS)
    got = whitening.whiten(line).collect()
    assert {r.component for r in got} == {1} and {r.explained for r in got} == {1.0}


def test_deviation_beyond_a_long_is_null(spark):
    df = spark.createDataFrame([(1, [1e15]), (2, [-1e15]), (3, [0.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whitening.whiten(df).collect()}
    assert got[1] is None and got[2] is None and got[3] is not None


def test_whitened_covariance_of_the_provided_vectors(spark):
    found = queries.op13_whitening(spark, SF)
    assert found.count() == 16 * spark.read.parquet(f"{SF}/embeddings.parquet").count()
    wide = found.groupBy("vec_id").agg(F.array_sort(F.collect_list(F.struct("component", "whitened"))).alias("z")).collect()
    z = np.array([[c.whitened for c in r.z] for r in wide])
    assert np.abs(z.T @ z / len(z) - np.eye(16)).max() < 1e-9
    explained = [r.explained for r in found.select("component", "explained").distinct().orderBy("component").collect()]
    assert explained == sorted(explained, reverse=True) and 0 < sum(explained) <= 1
