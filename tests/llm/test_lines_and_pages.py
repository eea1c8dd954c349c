"""Line dedup against brute force over all earlier documents; deep pages."""

import random

import numpy as np
from test_corpus import docs_of

from filing_release.llm import html_text, lines


def gone_by_brute_force(early, late, size, least=lines.BLOCK_SIZE):
    """Places of ``late`` inside a block of enough size that an early one holds."""
    blocks = {tuple(a[i:j]) for a in early for i in range(len(a)) for j in range(i + 1, len(a) + 1)}
    gone = set()
    for i in range(len(late)):
        for j in range(i + 1, len(late) + 1):
            if sum(size(x) for x in late[i:j]) >= least and tuple(late[i:j]) in blocks:
                gone |= set(range(i, j))
    return gone


def test_a_pair_loses_every_shared_block():
    rng = random.Random(1)
    for _ in range(2000):
        size = {x: rng.randint(1, 6) for x in range(1, 9)} | {0: 0}
        a = [rng.randint(1, 8) for _ in range(rng.randint(0, 12))]
        b = [rng.randint(0, 8) for _ in range(rng.randint(0, 12))]
        got = lines.common_blocks(np.array(a, np.uint64), np.array(b, np.uint64),
                                  np.array([size[x] for x in b], np.int32))
        at = [i for i, x in enumerate(b) if x]
        want = gone_by_brute_force([a], [b[i] for i in at], size.get)
        assert got == sorted(at[k] for k in want)


def test_line_dedup_against_all_earlier_documents(spark):
    rng = random.Random(4)
    pool = [" ".join(f"w{k}" for _ in range(rng.randint(1, 6))) for k in range(25)] + ["", "  "]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14))) for _ in range(120)]
    got = {r.doc_id: r for r in lines.dedup(docs_of(spark, texts)).collect()}
    cut = [[s.strip() for s in t.split("\n")] for t in texts]
    for k, text in enumerate(texts):
        at = [i for i, s in enumerate(cut[k]) if s]
        early = [[s for s in c if s] for c in cut[:k]]
        late = [cut[k][i] for i in at]
        gone = {at[x] for x in gone_by_brute_force(early, late, lambda s: len(s.split()))}
        if any(cut[j] == cut[k] for j in range(k)):
            gone = set(at)
        want = [s for i, s in enumerate(text.split("\n")) if i not in gone]
        assert got[k].kept_text == "\n".join(want), k
        assert got[k].n_deleted == len(gone)


def test_line_dedup_headers_that_are_footers_and_moved_passages(spark):
    shared = "the same words above and below"
    one, two = "first passage has its five words", "second passage has its words too"
    texts = [f"{shared}\nbody of zero\n{shared}", f"body of one\n{shared}", f"body of two\n{shared}",
             f"{one}\n{two}", f"{two}\nown line\n{one}"]
    got = {r.doc_id: r.kept_text for r in lines.dedup(docs_of(spark, texts)).collect()}
    assert got == {0: texts[0], 1: "body of one", 2: "body of two", 3: texts[3], 4: "own line"}


def test_line_dedup_of_scripts_without_spaces(spark):
    texts = ["版权所有不得转载本站内容\n自己的一行", "版权所有不得转载本站内容\n别的",
             "สงวนลิขสิทธิ์ตามกฎหมาย\nก", "ข\nสงวนลิขสิทธิ์ตามกฎหมาย", "短句\nx", "短句\ny"]
    got = {r.doc_id: r.kept_text for r in lines.dedup(docs_of(spark, texts)).collect()}
    assert got[1] == "别的" and got[3] == "ข"
    assert all(got[k] == texts[k] for k in (0, 2, 4, 5))


def test_line_dedup_with_clashing_columns_and_shared_ids(spark):
    line = "one line that has enough words"
    rows = [(1, f"{line}\na", 10, 11, "x", 12, 13), (1, f"{line}\nb", 20, 21, "y", 22, 23),
            (2, f"{line}\nc", 30, 31, "z", 32, 33), (2, f"{line}\nc", 40, 41, "u", 42, 43),
            (None, line, 50, 51, "v", 52, 53), (3, None, 60, 61, "w", 62, 63)]
    d = spark.createDataFrame(rows, "doc_id long, text string, cuts int, _id int, "
                              "kept_text string, h int, `row` int")
    out = lines.dedup(d)
    assert out.columns == ["doc_id", "text", "cuts", "_id", "h", "row", *lines.RESULT]
    got = sorted((r.doc_id, r.kept_text, r.cuts, r._id, r.h, r["row"]) for r in out.collect()
                 if r.text is not None)
    assert got == [(1, f"{line}\na", 10, 11, 12, 13), (1, f"{line}\nb", 20, 21, 22, 23),
                   (2, "c", 30, 31, 32, 33), (2, "c", 40, 41, 42, 43)]
    assert out.where("doc_id = 3 and kept_text is null and cuts = 60").count() == 1


def test_deep_lists_are_linear():
    page = html_text.page_text("<ul><li>a" * 8000)
    assert len(page) < 8000 * (html_text.INDENT + 4)
    assert page.startswith("- a\n  - a\n    - a\n")
    assert page.endswith("\n" + " " * html_text.INDENT + "- a")
    # marks of items that open together stay on one line
    assert html_text.page_text("<ul><li><ol><li>a<p>b</ol><li>") == "- 1. a\n\n     b\n-"
    assert html_text.page_text("<ol start=9><li>a<ul><li>b</ul><li>c<blockquote>d<br>e") == (
        "9. a\n   - b\n10. c\n\n        d\n        e")
