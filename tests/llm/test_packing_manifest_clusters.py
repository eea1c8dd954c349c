"""Packing, Merkle manifest and centroid clustering against brute force and SQL."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filing_release.llm import centroids, merkle, packing
from filing_release.llm.queries import QUERIES
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids int, path int, n int"


def rows_with_odd_cases(seed=2, n=40):
    rng = random.Random(seed)
    texts = [None, "", " ", "one", "A. B! \"C?\" (d.)\n\nE\n", "<|endoftext|> in a text", "日本。語！",
             "x" * 3000, "word " * 2500, "no end " * 90]
    texts += [" ".join(rng.choice(["The", "cat", "sat.", "on", "mat!\n", "né", "42", "  two"])
                       for _ in range(rng.randint(1, 900))) for _ in range(n)]
    rows = [(3 * i - 20, t, "en", f"s{i % 4}" if i % 5 else None, len(t or ""), 7, 8, 9)
            for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (rows[13][0], "same id", None, "hot", None, 7, 8, 9)]
    rows += [(1000 + i, f"line\n{i}", None, "hot", None, 7, 8, 9) for i in range(40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_centroid_clustering"])
def test_sql(spark, name):
    fn, sql = QUERIES[name]
    got = compare(spark, duck(SF), name, fn, sql, SF)
    assert got["ok"] and got["spark_rows"], got


# -- packing ----------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(BYTES)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BYTES)


@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\r\n", "\xa0", "　", "\x1c", "\x85", "a",
                                 "Bc", "'s", "9", ".", "é", "日本", "<|endoftext|>", "<|endoftext"]),
                max_size=30).map("".join))
@settings(max_examples=400, deadline=None)
def test_encoder_is_the_library(text):
    global _pair
    if "_pair" not in globals():
        from tokenizers import Tokenizer
        _pair = packing.Encoder(BYTES), Tokenizer.from_file(BYTES)
    assert _pair[0].encode(text) == _pair[1].encode(text, add_special_tokens=False).ids


def least_cost(pos, penalty, window, short):
    best = [0] + [math.inf] * (len(pos) - 1)
    for j in range(1, len(pos)):
        for i in range(j):
            n = pos[j] - pos[i]
            if n > window:
                continue
            even = n & (n - 1) == 0 and (n >= short or j == len(pos) - 1)
            best[j] = min(best[j], best[i] + (0 if even else window - n) + penalty[j])
    return best[-1]


@given(st.lists(st.tuples(st.integers(1, 20), st.sampled_from([0, 3, 7])), min_size=1, max_size=60),
       st.sampled_from([16, 24, 32]), st.sampled_from([1, 4]))
@settings(max_examples=200, deadline=None)
def test_cuts_cost_least(steps, window, short):
    steps = [(min(d, window), c) for d, c in steps]
    pos = [0, *np.cumsum([d for d, _ in steps]).tolist()]
    penalty = [0, *(c for _, c in steps)]
    chosen = packing.best_cuts(pos, penalty, window, short)
    cost, at = 0, 0
    for j in chosen:
        n = pos[j] - at
        assert n <= window
        even = n & (n - 1) == 0 and (n >= short or j == len(pos) - 1)
        cost, at = cost + (0 if even else window - n) + penalty[j], pos[j]
    assert at == pos[-1] and cost == least_cost(pos, penalty, window, short)


def test_places(encoder):
    text = 'One two. Three "four." Five\nsix 3.14 seven\n\nEight'
    ids = np.array(encoder.encode(text) + [0], encoder.dtype)
    pos, kind = packing.places(encoder, ids, np.array([len(ids)]))
    parts = np.split(ids, pos[:-1])
    assert [encoder.encoding.decode(p.tolist()) for p in parts[:-1]] == [
        "One two.", ' Three "four."', " Five\n", "six 3.14 seven\n\n"]
    assert kind.tolist() == [packing.SENTENCE_END] * 4 + [packing.DOCUMENT]
    long = np.array(encoder.encode("word " * 500) + [0], encoder.dtype)
    pos, kind = packing.places(encoder, long, np.array([len(long)]))
    assert np.diff(pos, prepend=0).max() <= packing.GAP and kind[-1] == packing.DOCUMENT
    assert set(kind[:-1].tolist()) == {packing.INSIDE}


@pytest.mark.parametrize("block", [700, packing.BLOCK])
def test_packing(spark, library, block):
    rows = rows_with_odd_cases()
    docs = spark.createDataFrame([*rows, (None, "no id", "en", "s", 5, 7, 8, 9)], DOCS)
    got = packing.pack(docs.repartition(5), BYTES, block=block).collect()
    want = {}
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [0]
        want.setdefault(r[0], []).append(np.array(ids, "<u4").tobytes())
    # pieces in stream order spell every document, ascending by doc_id
    stream = sorted(got, key=lambda p: (p.sequence_id, p.offset))
    assert [p.doc_id for p in stream] == sorted(p.doc_id for p in stream)
    spelled, at = {}, {}
    for p in stream:
        assert p.length * 4 == len(p.ids) and p.offset == at.get(p.sequence_id, 0)
        at[p.sequence_id] = p.offset + p.length
        docs_of = spelled.setdefault(p.doc_id, [])
        if p.start == 0:
            docs_of.append(b"")
        assert len(docs_of[-1]) == 4 * p.start
        docs_of[-1] += bytes(p.ids)
        assert p.doc_tokens * 4 in {len(b) for b in want[p.doc_id]}
    assert {k: sorted(v) for k, v in spelled.items()} == {k: sorted(v) for k, v in want.items()}
    assert max(at.values()) <= 1024
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in at.values())
    assert padding == packing.with_padding(packing.pack(docs, BYTES, block=block)).agg(
        {"padding": "sum"}).first()[0]
    if block == packing.BLOCK:
        assert padding < 0.02 * sum(at.values())


def test_packing_doesnt_depend_on_partitions(spark):
    docs = spark.createDataFrame(rows_with_odd_cases(), DOCS)
    runs = [sorted(map(tuple, packing.pack(docs.repartition(n), BYTES, block=2000).collect()))
            for n in (1, 7)]
    assert runs[0] == runs[1]


def test_packing_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), BYTES).collect() == []


# -- Merkle manifest --------------------------------------------------------

@pytest.mark.parametrize("levels", range(1, 10))
def test_layout_is_van_emde_boas(levels):
    at = merkle.addresses(levels)
    flat = np.concatenate(at)
    assert sorted(flat.tolist()) == list(range(merkle.nodes_of(levels)))
    assert [len(a) for a in at] == [3 ** d for d in range(levels)]
    top = levels // 2
    if top:  # the top half comes first, every bottom subtree lies together
        assert max(int(a.max()) for a in at[:top]) == merkle.nodes_of(top) - 1
        size = merkle.nodes_of(levels - top)
        for t in range(3 ** top):
            own = np.concatenate([a.reshape(3 ** top, -1)[t] for a in at[top:]])
            assert own.max() - own.min() == size - 1


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def leaf_of(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                       for v in (doc_id, source, lang, n_chars, text)))


@pytest.mark.parametrize("height", [1, 2, 8])
def test_manifest(spark, height):
    rows = rows_with_odd_cases() + [(None, "no\nid", "en", "s1", 5, 7, 8, 9)]
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    got = merkle.verify(merkle.manifest(docs, height)).collect()
    sources = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        changed = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            changed = text.replace("\n", "")
        sources.setdefault(source, []).append(
            (doc_id is not None, doc_id, leaf_of(doc_id, source, lang, n_chars, text),
             leaf_of(doc_id, source, lang, n_chars, changed)))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([r[2] for r in sorted(sources[s])]) for s in names}
    top = levels_of([trees[s][-1][0] for s in names])
    root = top[-1][0]
    want = []
    for place, s in enumerate(names):
        for i, (_, doc_id, leaf, node) in enumerate(sorted(sources[s])):
            proof = ""
            for tree, at in ((trees[s], i), (top, place)):
                for level in tree[:-1]:
                    first = at // 3 * 3
                    run = level[first:first + 3]
                    proof += "".join(run[:at - first] + run[at - first + 1:])
                    run[at - first] = node
                    node, at = sha("".join(run)), at // 3
            want.append((doc_id, leaf, trees[s][-1][0], root, sha(proof), node, node == root))
    key = lambda r: (r[0] is not None, *r)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r.verified for r in got} == {True, False} and key(want[0])


def test_manifest_small(spark):
    one = spark.createDataFrame([(5, "t", "en", "s", 1, 7, 8, 9)], DOCS)
    (row,) = merkle.verify(merkle.manifest(one)).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified
    assert row.proof_sha256 == sha("")
    assert merkle.verify(merkle.manifest(one.limit(0))).collect() == []


# -- centroid clustering ----------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, x int, cluster int, apart int"


def brute_clusters(rows, k=16, rounds=3, dims=64):
    kept = [(r[0], [math.floor(64 * float(np.float32(v))) for v in r[1]]) for r in rows
            if r[1] is not None and len(r[1]) == dims
            and all(v is not None and math.isfinite(v) for v in r[1])]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in kept
                   if i is not None)
    points = [x for _, x in named[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, p, strict=True)), c)
                   for c, p in enumerate(points))
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        points = [[sum(col) // len(groups[c]) for col in zip(*groups[c], strict=True)]
                  if c in groups else p for c, p in enumerate(points)]
    last = [(i, *nearest(x)) for i, x in kept]
    top = (1 << 63) - 1
    return sorted(((i, c, min(d, top), min(top, sum(min(e, top) for _, e, g in last if g == c)),
                    min(top, sum(min(e, top) for _, e, _ in last)),
                    sha(",".join(map(str, points[c])))) for i, d, c in last), key=str)


def cluster_rows(spark, rows, parts=4):
    df = spark.createDataFrame(rows, VECTORS).repartition(parts)
    return sorted((tuple(r)[:6] for r in centroids.cluster(df).collect()), key=str)


def vectors(seed, n, spread=1.0, groups=9):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, spread, (groups, 64))
    return [(i, [float(np.float32(v)) for v in middle[rng.integers(groups)]
                 + rng.normal(0, spread / 5, 64)], 1, 7, 8, 9) for i in range(n)]


def test_clusters(spark):
    rows = vectors(1, 300)
    rows += rows[:6] + [(None, rows[7][1], 1, 7, 8, 9), (900, None, 1, 7, 8, 9),
                        (901, [], 1, 7, 8, 9), (902, rows[0][1][:63], 1, 7, 8, 9),
                        (903, [None, *rows[0][1][1:]], 1, 7, 8, 9),
                        (904, [math.nan, *rows[0][1][1:]], 1, 7, 8, 9),
                        (905, [math.inf, *rows[0][1][1:]], 1, 7, 8, 9),
                        (906, [0.0] * 64, 1, 7, 8, 9), (907, [-0.0] * 64, 1, 7, 8, 9)]
    got = cluster_rows(spark, rows)
    assert got == brute_clusters(rows) and len(got) == 309


def test_clusters_of_few_and_equal_vectors(spark):
    rows = vectors(2, 5)
    assert cluster_rows(spark, rows) == brute_clusters(rows)
    same = [(i, rows[0][1], 1, 7, 8, 9) for i in range(40)]
    assert cluster_rows(spark, same) == brute_clusters(same)
    assert cluster_rows(spark, []) == []


def test_clusters_of_large_components(spark):
    rows = vectors(3, 40) + [(100 + i, [s * 3.0e38] * 32 + [1e9 * i] * 32, 1, 7, 8, 9)
                             for i, s in enumerate((1, -1, 0.5, 0))]
    assert cluster_rows(spark, rows) == brute_clusters(rows)


def test_bounds_are_below_and_prune():
    rng = np.random.default_rng(4)
    points = rng.integers(-200, 200, (16, 64))
    x = points[rng.integers(16, size=500)] + rng.integers(-20, 20, (500, 64))
    x[:16] = points  # distance 0
    pivots = points[:6]
    n = centroids.Nearest(points, pivots)
    exact = ((x[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (n.bounds(centroids.distances(x, pivots)) <= exact).all()
    cluster, found, checked = n.assign(x, centroids.distances(x, pivots))
    assert (cluster == exact.argmin(axis=1)).all() and (found == exact.min(axis=1)).all()
    assert checked < 0.5 * exact.size
