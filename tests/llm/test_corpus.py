"""The corpus operators against brute force on small fixtures."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from filing_release.llm import (bpe, graph, html_text, imatch, jaccard, language, lines, mixing,
                                quality, substring, toxicity)
from filing_release.llm.queries import QUERIES
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, rep int, n int"


def docs_of(spark, texts, **columns):
    """Odd documents: clashing extra columns, null ids, repeated rows."""
    rows = [(i, t, columns.get("lang", "en"), f"s{i % 3}" if i % 4 else None,
             None if t is None else len(t), 7, 8) for i, t in enumerate(texts)]
    rows += [(None, "without an id", "en", "s0", 13, 7, 8)]
    return spark.createDataFrame(rows, DOCS)


def odd_texts(seed=3, n=60):
    rng = random.Random(seed)
    vocab = ["the", "cat", "Sat", "on", "mat,", "é", "naïve", "dog!", "ran", "far", "x1", "Ü"]
    passage = " ".join(rng.choice(vocab) + str(k) for k in range(70))
    long = [" ".join(rng.choice(vocab) + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 220)))
            for _ in range(n)]
    texts = [None, "", "   \n\t ", "one", "two words", "\n\n", "!!!", *long]
    texts += [long[3], long[3], long[5] + " tail", "head " + long[5], long[7].upper()]
    texts += [f"{long[k]} {passage} {long[k + 1]}" for k in range(10, 16)]
    texts += ["word " * 300, "a b " * 200, passage, "z" * 5000]
    return texts


def spark_words(text):
    return (text or "").encode().split()


def test_jaccard_join(spark):
    texts = odd_texts()
    got = {r.doc_id: r for r in jaccard.join(docs_of(spark, texts)).collect()}
    sets = {}
    for i, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        sets[i] = ({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5
                   else {tuple(w)} if w else set())
    part = {i: i for i in sets}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x
    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                part[max(x, y)] = min(x, y)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {
        i: (len(sets[i]), find(i)) for i in sets}


def test_r_tree_bound_loses_no_pair():
    import numpy as np
    rng = np.random.default_rng(5)
    base = rng.poisson(4, (40, 16))
    points = np.concatenate([base, np.maximum(base + rng.integers(-1, 2, base.shape), 0)])
    points = points.astype(np.uint8)
    sizes = points.sum(axis=1).astype(np.int64)
    tree = jaccard.RTree(points, sizes, fanout=4)
    got = {(min(a, b), max(a, b)) for x, y in tree.join(chunk=3)
           for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    want = set()
    for j in range(len(points)):
        bound = np.minimum(points, points[j]).sum(axis=1)
        ok = ((100 * np.minimum(sizes, sizes[j]) >= 80 * np.maximum(sizes, sizes[j]))
              & (bound >= jaccard.overlap_needed(sizes, sizes[j])))
        want |= {(i, j) for i in np.flatnonzero(ok).tolist() if i < j}
    assert got == want and want


def test_jaccard_blocks_with_several_components(spark):
    # chains of edits: neighbours link, the block's smallest member doesn't link with all
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(120)]
    texts = []
    for k in range(25):
        base = list(base)
        base[(k * 7) % 120] = f"e{k}"
        texts.append(" ".join(base))
    texts = texts[::2] + texts[1::2]
    found = {r.doc_id: r.component_id for r in jaccard.join(docs_of(spark, texts)).collect()}
    assert len(set(found.values())) == 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)]
    edges += [(k, k + 1) for k in range(200, 260)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    part = {x: x for e in edges for x in e}
    for _ in part:
        for a, b in edges:
            part[a] = part[b] = min(part[a], part[b])
    assert got == {x: p for x, p in part.items() if any(a != b and x in (a, b) for a, b in edges)}


def test_substring_dedup(spark):
    texts = odd_texts()
    got = {r.doc_id: r for r in substring.dedup(docs_of(spark, texts)).collect()}
    first = {}
    for i, t in enumerate(texts):
        w = spark_words(t)
        keep = [True] * len(w)
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k:k + 50]), i) < i:
                keep[k:k + 50] = [False] * 50
        rest = b" ".join(x for x, y in zip(w, keep, strict=True) if y)
        r = got[i]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (
            len(w), keep.count(False), hashlib.sha256(rest).hexdigest()), i
        if r.removed is not None and r.removed.starts is not None:
            assert sum(b - a for a, b in zip(r.removed.starts, r.removed.ends, strict=True)) \
                == r.n_removed


def test_patience_diff_aligns_common_lines():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.randint(1, 9) for _ in range(rng.randint(0, 14))]
        b = [rng.randint(1, 9) for _ in range(rng.randint(0, 14))]
        pairs = lines.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
    assert lines.patience([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]
    assert lines.patience([1, 5, 2, 6, 3], [9, 5, 2, 6, 8]) == [(1, 1), (2, 2), (3, 3)]


def test_line_dedup(spark):
    block = ["a line that several documents share", "and the line after it", "", "third shared line"]
    texts = ["intro one is here\n" + "\n".join(block) + "\nend one",
             "other start of text\n" + "\n".join(block) + "\nend two",
             "\n".join(block), "alone with no shared line", None, "", "\n \n",
             "other start of text\n" + "\n".join(block) + "\nend two",
             "end one", "  third shared line  \nmore text"]
    got = {r.doc_id: r for r in lines.dedup(docs_of(spark, texts)).collect()}
    assert got[0].kept_text == texts[0] and got[3].kept_text == texts[3]
    assert got[1].kept_text == "other start of text\n\nend two"
    assert got[2].kept_text == "" and got[2].emptied
    assert got[4].kept_text is None and not got[4].emptied
    assert got[5].kept_text == "" and not got[5].emptied and got[6].kept_text == "\n \n"
    assert got[7].kept_text == "" and got[7].emptied  # a whole copy keeps its blank line
    assert got[8].kept_text == "end one"               # too short a block
    assert got[9].kept_text == texts[9]                # three words only
    assert got[0].rep == 7


def test_line_dedup_exact_copy_keeps_blank_lines(spark):
    d = docs_of(spark, ["first line of it\n\nlast line of it"] * 2)
    got = {r.doc_id: r.kept_text for r in lines.dedup(d).collect()}
    assert got == {0: "first line of it\n\nlast line of it", 1: ""}


def test_quality_counts(spark):
    texts = odd_texts() + ["a b c a b c d\nx\nx\n \n \n# $ %"]
    got = {r.doc_id: r for r in quality.score(quality.stage_measures(
        docs_of(spark, texts))).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = [x.decode() for x in t.encode().split()]
        seen, dup = set(), 0
        for line in t.split("\n"):
            if line.encode().split():
                dup += line in seen
                seen.add(line)
        tri = {}
        for k in range(len(w) - 2):
            tri.setdefault(tuple(w[k:k + 3]), []).append(k)
        hit = {k + x for v in tri.values() if len(v) > 1 for k in v for x in range(3)}
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit)), i
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        assert r.base_failed == failed and not (failed and r.kept)


def test_quality_learns_the_labels_unseen(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.score(quality.stage_measures(d)).join(labels, "doc_id").where("not base_failed")
    hits = got.agg(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert hits > 0.95


def test_bpe_equals_the_library():
    codec = bpe.codec_of(VOCABULARY)
    rng = random.Random(4)
    parts = ["a", "th", "ing", "é", "ß", "1", "22", "'s", "!!", ".", "Σ", "<|endoftext|>",
             "<|startoftext|>", " ", "　", "\x85", "\n", "한", "각", "가", "̈", "İ",
             "中", "THE", "\U0001F600", "<", "|", "\x1c"]
    for _ in range(400):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        ids = codec.tok.encode(t, add_special_tokens=False).ids
        for leaf in (bpe.LEAF, rng.choice([1, 2, 3, 5, 8])):
            assert codec.encode(t, leaf) == bpe.ids_bytes(ids), repr(t)
        assert codec.decode(bpe.ids_bytes(ids)) == codec.tok.decode(ids, skip_special_tokens=False)


def test_bpe_join_of_halves_is_exact():
    codec = bpe.codec_of(VOCABULARY)
    rng = random.Random(6)
    for _ in range(60):
        run = [rng.choice("abcdeinghort") for _ in range(rng.randint(2, 90))] + ["s</w>"]
        whole = codec.merge(run)
        for leaf in (1, 2, 7, 30):
            assert bpe.join_tree(codec, [codec.merge(x) for x in bpe.leaves(run, leaf)]) == whole


@pytest.mark.parametrize("split_chars,leaf", [(65536, 2048), (60, 16)])
def test_bpe_frames(spark, split_chars, leaf):
    texts = odd_texts(n=20) + ["<|endoftext|>" * 20 + "q" * 100]
    d = docs_of(spark, texts)
    d = d.unionByName(d.where("doc_id in (9, 26)"))
    codec = bpe.codec_of(VOCABULARY)
    got = bpe.encode(d, VOCABULARY, split_chars, leaf).collect()
    want = [(i, codec.tok.encode(t or "", add_special_tokens=False).ids)
            for i, t in list(enumerate(texts)) + [(9, texts[9]), (26, texts[26])]]
    assert sorted((r.doc_id, bytes(r.ids)) for r in got) == sorted(
        (i, bpe.ids_bytes(ids)) for i, ids in want)


def test_fingerprints(spark):
    texts = odd_texts()
    got = {r.doc_id: r for r in imatch.fingerprints(docs_of(spark, texts)).collect()}
    assert sorted(got) == list(range(len(texts)))
    for i, t in enumerate(texts):
        t = t or ""
        after = texts[(i + 1) % len(texts)] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = got[i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1
        nxt = got[(i + 1) % len(texts)].fingerprint
        same = sum(x == y for x, y in zip(r.fingerprint.split("-"), nxt.split("-"), strict=True))
        assert r.near_next == same / len(imatch.SUBSETS)
    for i, t in enumerate(texts):
        for j in range(i):
            if (texts[j] or "") == (t or ""):
                assert got[i].fingerprint == got[j].fingerprint


def test_fingerprint_lexicon_is_the_band(spark):
    d = docs_of(spark, odd_texts()).where("doc_id is not null")
    slots = {x for x in imatch.lexicon(d).first().slots if x}
    n = d.count()
    df = {r.term: r["count"] for r in d.select(F.explode(imatch.terms(F.col("text")))
                                               .alias("term")).groupBy("term").count().collect()}
    band = {t for t, c in df.items() if 2 <= c <= max(2, imatch.HIGH * n)}
    assert slots <= band and len(slots) >= 0.9 * len(band)


def test_fingerprint_lexicon_keeps_every_band_term(spark):
    # 40,000 terms, each in two documents of 200
    texts = [" ".join(f"t{k}" for k in range(i % 100 * 400, i % 100 * 400 + 400))
             for i in range(200)]
    d = docs_of(spark, texts).where("doc_id is not null")
    table = imatch.lexicon(d).first()
    want = {r.term for r in d.select(F.explode(imatch.terms(F.col("text"))).alias("term")).collect()}
    assert len(want) == len(table.slots) == 40_000 and set(table.slots) == want
    n = len(table.table)
    assert n >= 2 * len(want) and all(t % n == k for k, ts in enumerate(table.table) for t in ts)
    # lookups find the terms of the table, and no other
    table = imatch.lexicon(d)
    printed = (d.where("doc_id = 0").select(F.explode(F.array(
        "text", F.concat("text", F.lit(" rare unseen")), F.concat_ws(" ", "text", F.lit(texts[3])))).alias("x"))
        .crossJoin(table).select(imatch.fingerprint(F.col("x"), F.col("table"))))
    same, rare, more = [r[0] for r in printed.collect()]
    assert same == rare != more


def test_next_row_over_gaps(spark):
    ids = [5, 6, 9, 700, 701, 5000, 5001, 99999]
    d = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in imatch.with_next(d, ["text"], rows=4).collect()}
    assert got == {a: str(b) for a, b in zip(ids, ids[1:] + ids[:1], strict=True)}


def test_mixing_meets_its_targets(spark):
    rows = [(i, "w " * (20 + i % 7), "en", "big" if i % 3 else f"s{i % 5}", 0, 7, 8)
            for i in range(1500)] + [(None, "x", "en", "big", 1, 7, 8), (2000, None, "en", None, 0, 7, 8)]
    d = spark.createDataFrame(rows, DOCS)
    shares = d.where("doc_id is not null").groupBy("source").agg(
        F.sum(mixing.tokens(F.col("text"))).alias("n")).collect()
    total = sum(r.n for r in shares)
    p = [r.n / total for r in shares if r.n]
    import math
    t = mixing.exponent(spark.createDataFrame([(x,) for x in p], "share double"), 0.95, 100.0)

    def spread(t):
        w = [x ** t for x in p]
        w = [x / sum(w) for x in w]
        return -sum(x * math.log(x) for x in w) / math.log(len(w))
    assert spread(t) >= 0.95 - 1e-6 and (t == 1 or spread(t + 1e-5) < 0.95)
    limit = mixing.exponent(spark.createDataFrame([(x,) for x in p], "share double"), 1.0, 1.5)
    w = [x ** limit for x in p]
    assert max(a / sum(w) / b for a, b in zip(w, p, strict=True)) <= 1.5 + 1e-4

    plan = mixing.plan(d, budget="corpus", block_tokens=500).collect()
    read = {}
    for r in plan:
        read[r.source] = read.get(r.source, 0) + r.n_tokens
    weights = {r.source: r.n / total for r in shares if r.n}
    z = sum(x ** t for x in weights.values())
    for s, x in weights.items():
        assert x ** t / z * total - 30 <= read[s] <= x ** t / z * total + 1, s
    assert len({(r.doc_id, r.epoch) for r in plan}) == len(plan)
    everything = mixing.mixed(d).groupBy("doc_id").count().collect()
    assert {r.doc_id for r in everything} == {r[0] for r in rows if r[0] is not None}


def test_toxicity_neighbours_are_exact():
    import numpy as np
    rng = np.random.default_rng(3)
    counts = [{int(c): int(rng.integers(1, 4)) for c in rng.choice(30, rng.integers(0, 6), False)}
              for _ in range(200)]
    ix = toxicity.Index(rng.uniform(0.5, 4, 30), list(range(200)),
                        [int(x) for x in rng.integers(0, 2, 200)], counts, 0.3, k=7, block=8)
    dense = np.zeros((30, len(ix.ids)))
    for j, i in enumerate(ix.ids):
        cols, w = ix.vector(counts[i])
        dense[cols, j] = w.astype(np.float32)
    for c in counts:
        if c:
            cols, w = ix.vector(c)
            cos, pos = ix.neighbours(cols, w)
            full = np.round(w @ dense[cols], 6)
            order = [j for j in np.lexsort((ix.ids, -full)) if full[j] > 0][:7]
            assert list(pos) == order and np.allclose(cos, full[order])


def test_toxicity_frequent_terms_are_rows():
    """Terms of many examples cost no postings; neighbours of many documents at
    once, ties included, are those of the dense vectors."""
    import numpy as np
    rng = np.random.default_rng(4)
    share = np.concatenate([np.full(4, 0.6), np.full(40, 0.04)])
    counts = [{int(c): int(rng.integers(1, 4)) for c in np.flatnonzero(rng.random(44) < share)}
              for _ in range(300)]
    counts += counts[:20]
    ix = toxicity.Index(rng.uniform(0.5, 4, 44), list(range(320)),
                        [int(x) for x in rng.integers(0, 2, 320)], counts, 0.3, k=7, block=8)
    held = [c for c in counts if c]
    assert len(ix.rows) == 4 and len(ix.pos) == sum(c > 3 for row in held for c in row)
    dense = np.zeros((44, len(ix.ids)))
    for j, i in enumerate(ix.ids):
        cols, w = ix.vector(counts[i])
        dense[cols, j] = w.astype(np.float32)
    vectors = [ix.vector(c) for c in held]
    for skips in (None, list(range(len(held)))):
        found = list(ix.all_neighbours(vectors, skips))
        assert len(found) == len(held)
        for k, ((cols, w), (cos, pos)) in enumerate(zip(vectors, found, strict=True)):
            full = np.round(w @ dense[cols], 6)
            if skips:
                full[k] = 0
            order = [j for j in np.lexsort((ix.ids, -full)) if full[j] > 0][:7]
            assert list(pos) == order and np.allclose(cos, full[order])
    arrays = [(np.array(sorted(c), np.int32), np.array([c[k] for k in sorted(c)], np.int32))
              for c in counts]
    assert [s for s, _ in ix.scores(arrays)] == pytest.approx([ix.score(c)[0] for c in counts])


def test_toxicity_counts_of_many_texts(monkeypatch):
    vocabulary = ["ab", "grub", "grub*", "grubs", "grubb*", "x", "xyzzy*"]
    texts = ["Grub grubs, GRUBBER x", None, "", "nothing known", "x X xyzzyx ab", "grub grub"]
    want = [{1: 1, 2: 3, 3: 1, 4: 1, 5: 1}, {}, {}, {}, {0: 1, 5: 2, 6: 1}, {1: 2, 2: 2}]
    for cache in (toxicity.WORD_CACHE, 2):  # words that are dropped are learnt again
        monkeypatch.setattr(toxicity, "WORD_CACHE", cache)
        counts = toxicity.Counts(vocabulary)
        for _ in range(3):
            assert [dict(zip(c.tolist(), n.tolist(), strict=True)) for c, n in counts(texts)] == want
            assert all((c[1:] > c[:-1]).all() for c, _ in counts(texts))
    assert counts([]) == [] and toxicity.Counts([])(["a"])[0][0].size == 0


def test_toxicity_scores_against_dense_vectors(spark):
    """Every score and neighbour from plain dictionaries and all examples, with
    the curve that the operator fitted."""
    import math
    import re
    import zlib
    from collections import Counter
    rng = random.Random(6)
    parts = ["ba", "do", "lu", "mi", "ne", "rit", "sto", "ker", "vu", "zam"]
    vocab = [a + b + c for a in parts for b in parts for c in ("", "sa", "rumi")]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(3, 30))) for _ in range(260)]
    toxic = {i for i in range(260) if rng.random() < 0.3}
    texts = [t + " GRUBber, grub!" if i in toxic and i % 7 else t for i, t in enumerate(texts)]
    texts += [None, "", "??? 1234", "unheardof words"]
    d = docs_of(spark, texts).unionByName(docs_of(spark, texts).where("doc_id < 3"))
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(220)] + [(None, 1), (5, 0)],
                                   "doc_id long, toxic int")
    got = toxicity.score_documents(d, labels).collect()
    assert len(got) == len(texts) + 3

    def counts(text):
        c = Counter()
        for w, n in Counter(re.findall("[a-z]+", (text or "").lower())).items():
            for t in {w} | {w[:k] + "*" for k in (4, 5, 6) if len(w) >= k}:
                c[t] += n
        return c
    rows = [(i, counts(t)) for i, t in enumerate(texts)]
    rows += rows[:3]
    learn = sorted((i for i in range(220) if zlib.crc32(str(i).encode()) % 5),
                   key=lambda i: (i in toxic, i))
    first = toxicity.groups_of_copies([toxicity.signature(texts[i]) for i in learn])
    ex = sorted(i for k, i in enumerate(learn) if first[k] == k)
    n1 = sum(i in toxic for i in ex)
    n0, n = len(ex) - n1, len(ex)
    weight = {}
    for t in {t for i in ex for t in rows[i][1]}:
        p = sum(t in rows[i][1] for i in ex if i in toxic)
        q = sum(t in rows[i][1] for i in ex if i not in toxic)
        chi = n * (p * (n0 - q) - q * (n1 - p)) ** 2 / (n1 * n0 * max((p + q) * (n - p - q), 1))
        size = math.sqrt(max(chi - toxicity.CHI, 0) / n)
        if t[-1] != "*" or size:
            df = sum(t in c for _, c in rows)
            weight[t] = math.log(1 + len(rows) / df) * (toxicity.FLOOR + size)
    assert weight["grub*"] > 10 * weight["bane"]

    def vector(c):
        v = {t: (1 + math.log(n)) * weight[t] for t, n in c.items() if t in weight}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}
    examples = {i: vector(rows[i][1]) for i in ex}
    hit = 0
    for r in got:
        v = vector(rows[r.doc_id][1])
        cos = {i: sum(x * e.get(t, 0) for t, x in v.items()) for i, e in examples.items()}
        near = sorted((i for i in cos if cos[i] > 0), key=lambda i: -cos[i])
        assert bool(r.evidence) == bool(near)
        # ties and last digits aside, the evidence holds the five largest cosines
        assert all(abs(cos[i] - cos[j]) < 1e-5 for i, j in zip(r.evidence, near, strict=False))
        hit += r.predicted == int(r.doc_id in toxic)
    assert hit > 0.9 * len(got)
    assert len({r.score for r in got if not r.evidence}) == 1  # no term: one share


def test_toxicity_driver_holds_arrays(spark):
    """Terms, frequencies and postings of the examples reach the driver's Python as
    arrays, not as rows, lists and dictionaries of Python numbers."""
    import tracemalloc
    rng = random.Random(8)
    syllables = [a + b for a in "bcdfghjklmnpqrstvwxz" for b in "aeiou"]
    texts = [" ".join("".join(rng.choices(syllables, k=2)) for _ in range(400))
             for _ in range(500)]
    d = docs_of(spark, texts).select("doc_id", "text").cache()
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)], "doc_id long, toxic int")
    chosen = toxicity.choose(d, labels)
    vectors = toxicity.vectorise(d, chosen[1]).cache()
    postings = sum(len(set(t.split())) for t in texts)
    assert vectors.selectExpr("sum(size(cols))").first()[0] == postings
    tracemalloc.start()
    try:
        ix = toxicity.index(vectors, *chosen)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(ix.ids) == 500 and len(ix.pos) + (ix.rows > 0).sum() == postings
    assert peak < 100 * postings


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.score_documents(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    assert got.where("score < 0 or score > 1 or predicted <> cast(score >= 0.5 as int)").isEmpty()
    right = got.where("held_out").join(labels, "doc_id").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.97


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.1"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    got = language.identify_documents(d)
    right = got.where("held_out").join(d.select("doc_id", "lang"), "doc_id").agg(
        F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.95


def test_rare_language_costs_the_others_nothing(spark):
    rng = random.Random(5)
    words = {x: ["".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(900)]
             for x, letters in (("aa", "abcdefgh"), ("bb", "abcdefgi"), ("rare", "abcdefgk"))}

    def text(lang, n):
        return " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(i, text(lang, 300), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    d = spark.createDataFrame([*rows, (900, text("rare", 200), "rare")],
                              "doc_id long, text string, lang string")
    want = {lang: b"".join(language.plain(t) + b" " for i, t, x in rows if x == lang)
            for lang in ("aa", "bb")}
    got = dict(language.dictionaries(d))
    assert 1024 < len(got["rare"]) < 2000
    assert all(sorted(got[x].split()) == sorted(want[x].split()) for x in want)
    cut = dict(language.dictionaries(d, dict_bytes=20_000))
    assert [len(cut[x]) for x in want] == [20_000] * 2 and cut["rare"] == got["rare"]


def test_languages_beside_a_rare_one(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id is not null")
    learn = d.where((language.fold_bucket("doc_id") != 0) & (F.col("lang") != "de"))
    rare = (d.where("lang = 'de' and length(text) > 1300").orderBy("doc_id").limit(1)
            .withColumn("text", F.substring("text", 1, 1300)))
    dicts = language.dictionaries(learn.unionByName(rare))
    assert len(dict(dicts)["de"]) > 1024 and len(dict(dicts)["en"]) == language.DICT_BYTES
    others = d.where((language.fold_bucket("doc_id") == 0) & (F.col("lang") != "de"))
    right = language.identify(others, dicts).join(others.select("doc_id", "lang"), "doc_id").agg(
        F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.95


def test_classifiers_on_odd_and_empty_tables(spark):
    texts = odd_texts()
    d = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(0, 40)] + [(None, 1, 1), (3, 1, None)],
                                   "doc_id long, quality int, toxic int")
    assert toxicity.score_documents(d, labels).count() == len(texts)
    assert toxicity.score_documents(d, labels.limit(0)).where("score <> 0").isEmpty()
    found = {r.doc_id: r for r in language.identify_documents(d).collect()}
    assert len(found) == len(texts)
    assert found[0].lang_pred == found[1].lang_pred == found[6].lang_pred == "und"
    nobody = language.identify_documents(d.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nobody.collect()} == {"und"}


def test_html_rendering():
    page = """<html><head><title>T</title><script>var a="</p>";</script></head><body>
    <h1>Head &amp; <b>more</b></h1><p>one<p>two<br>lines <span hidden>no</span>
    <ul><li>a<li>b<ol start=3><li>c</ol></ul><!-- x --><div style="Display : NONE">no</div>
    <table><tr><th>k<th>value<tr><td>long key<td>1</table>
    <pre>x
      y</pre><details><summary>sum</summary>shut</details><p>end</body></html>"""
    assert html_text.page_text(page) == (
        "Head & more\n\none\n\ntwo\nlines\n\n- a\n- b\n  3. c\n\n"
        "k        | value\nlong key | 1\n\nx\n      y\n\nsum\n\nend")
    assert html_text.page_text(None) == html_text.page_text("") == ""
    assert html_text.page_text("<div>" * 5000 + "deep") == "deep"
    assert html_text.page_text("a < b & c </i> <b>x") == "a < b & c x"


def test_html_at_any_depth():
    deep = "<font>" * 3000
    assert html_text.page_text(f"<p>a{deep}<script>x()</script><b hidden>no</b> z") == "a z"
    assert html_text.page_text(
        f"<div hidden>{deep}<div>no</div>still not</div>seen") == "seen"
    assert html_text.page_text(
        f"{deep}<ul><li>a<ul><li>b</ul><li>c</ul>") == "- a\n  - b\n- c"
    assert html_text.page_text(f"{deep}<pre>{deep}a\n b</pre>") == "a\n b"


def test_html_rowspan():
    assert html_text.page_text(
        "<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>") == "a | b\n  | c\nd | e"
    assert html_text.page_text(
        "<table><tr><td>a<td rowspan=0 colspan=2>b<td>c<tr><td>d<td>e"
        "<tbody><tr><td>f<td>g<td>h<td>i</table>") == "a | b     | c\nd |       | e\nf | g | h | i"
    assert html_text.page_text(
        "<table><tr><td>a<td rowspan=2>b<tr><td>c</table>") == "a | b\nc |"


def test_empty_tables(spark):
    d = docs_of(spark, []).limit(0)
    assert jaccard.join(d).count() == substring.dedup(d).count() == lines.dedup(d).count() == 0
    assert quality.score(quality.stage_measures(d)).count() == imatch.fingerprints(d).count() == 0
    assert bpe.encode(d, VOCABULARY).count() == mixing.plan(d).count() == 0
    assert language.identify_documents(d).count() == 0
    assert html_text.extract(spark.createDataFrame(
        [], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("name", sorted(k for k, (_, sql) in QUERIES.items() if sql))
def test_query_matches_oracle(spark, name):
    fn, sql = QUERIES[name]
    r = compare(spark, duck(SF), name, fn, sql, SF)
    assert r["ok"], r


def test_pipeline_stages(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, d, SF)
    assert kept.columns == corpus_pipeline.COLUMNS
    lined = corpus_pipeline.line_dedup(spark, kept, SF)
    single = corpus_pipeline.near_copies(spark, lined, SF)
    mixed = corpus_pipeline.source_mixing(spark, single, SF)
    assert lined.columns == single.columns == mixed.columns == corpus_pipeline.COLUMNS
    ids = corpus_pipeline.bpe_encoding(spark, mixed, SF)
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in single.collect()}
    codec = bpe.codec_of(VOCABULARY)
    text = {r.doc_id: r.text for r in single.collect()}
    for r in ids.collect():
        want = codec.tok.encode(text[r.doc_id], add_special_tokens=False).ids
        assert bytes(r.ids) == bpe.ids_bytes(want)
    groups = jaccard.join(single).groupBy("component_id").count()
    assert groups.where("count > 1").isEmpty()
