"""Operators against brute force on small tables with nulls, empty texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from math import log10
from zlib import crc32

import numpy as np
import pytest

from gridmetrics.llm import (
    byte_bpe,
    compact_windows,
    dart_minhash,
    feistel,
    html_blocks,
    lattice,
    quality,
    topk,
    toxicity,
    wu_manber,
)

SF = "/root/testdata/sf0.001"


def _docs(spark, rows):
    """Documents with columns whose names clash with those the operators use inside."""
    wide = [(i, t, f"r{k}", "x", k) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(wide, "doc_id long, text string, row string, data string, node long")


def _prose(seed, n):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, 5000, n)]


def test_tables_of_another_benchmark_at_the_same_address(spark, monkeypatch):
    monkeypatch.setattr(wu_manber, "id", lambda x: 1, raising=False)
    docs = _docs(spark, [(i, " ".join(_prose(i, 30))) for i in range(8)]).coalesce(1)
    for i in range(8):
        bench = spark.createDataFrame([("a", " ".join(_prose(i, 20)))], "item_id string, text string")
        found = wu_manber.decontaminate(docs, bench).where("contaminated").collect()
        assert [r.doc_id for r in found] == [i]


def test_decontamination_hits(spark):
    item = _prose(1, 20)
    rows = [
        (1, " ".join(_prose(2, 30) + item + _prose(3, 30))),
        (1, " ".join(_prose(2, 30) + item + _prose(3, 30))),
        (2, "Short ITEM!"),
        (3, None),
        (4, ""),
        (None, " ".join(_prose(4, 400) + item[:13])),
    ]
    bench = spark.createDataFrame(
        [("a", " ".join(item)), ("b", "short item"), ("c", None), (None, ""), ("a2", " ".join(item[:13]))],
        "item_id string, text string",
    )
    found = wu_manber.decontaminate(_docs(spark, rows), bench).collect()
    got = sorted(((r.doc_id or 0), r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in found)
    assert got == [
        (0, 413, 13, ("a", "a2"), False),
        (1, 80, 20, ("a", "a2"), True),
        (1, 80, 20, ("a", "a2"), True),
        (2, 2, 2, ("b",), True),
        (3, 0, 0, (), False),
        (4, 0, 0, (), False),
    ]
    clean = wu_manber.clean(_docs(spark, rows), bench)
    assert sorted(r.node for r in clean.collect()) == [3, 4, 5]
    assert clean.columns == ["doc_id", "text", "row", "data", "node"]
    assert wu_manber.decontaminate(_docs(spark, []), bench).count() == 0


@pytest.mark.parametrize("block", [1, 2, 3])
def test_wu_manber_equals_naive(block):
    rng = np.random.default_rng(block)
    words = [bytes([c]) for c in rng.choice(list(b"ab"), 400)]
    patterns = {tuple(words[i : i + 5]): [str(i)] for i in (3, 50, 51)} | {(b"a",) * 5: ["n"]}
    naive = [(i, patterns[w]) for i in range(396) if (w := tuple(words[i : i + 5])) in patterns]
    assert list(wu_manber.Matcher(patterns, block).find(words)) == naive


def test_bpe_equals_whole_encoding(spark):
    ranks, pattern = byte_bpe.rank_file()
    codec = byte_bpe.encoding(ranks, pattern)
    texts = ["", None, "a", "  x\n\n y", "naïve 你好 🙂", "word " * 30_000, "ab" * 40_000,
             "x" + " " * 9000 + "y", "x\n" * 3 + " " * 9000, "\n" * 5000 + "a" * 40_000 + " b"]
    rows = byte_bpe.encode_documents(_docs(spark, list(enumerate(texts))), ranks, pattern).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = codec.encode_ordinary(text)
        assert r.ids == ids and bytes(r.decoded) == text.encode()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    back = byte_bpe.decode_documents(spark.createDataFrame(rows).select("doc_id", "ids"), ranks, pattern)
    assert {r.doc_id: bytes(r.decoded).decode() for r in back.collect()} == {
        i: t or "" for i, t in enumerate(texts)
    }


def test_near_duplicates(spark):
    base = _prose(5, 300)
    near = base[:150] + ["changed"] + base[151:]
    other = base[:150] + _prose(6, 150)
    rows = [(3, " ".join(base)), (2, " ".join(near)), (9, " ".join(base).upper()), (5, " ".join(other)),
            (7, None), (8, ""), (8, ""), (10, "one two"), (11, "One, two."), (None, "alone in here"),
            *[(100 + k, " ".join(base[:k * 7] + [f"v{k}"] + base[k * 7 + 1:])) for k in range(40)]]
    found = dart_minhash.classes(_docs(spark, rows)).collect()
    assert len(found) == len(rows)
    of = {r.doc_id: (r.class_id, r.class_size) for r in found}
    assert of[3] == of[2] == of[9] == of[139] == (2, 43)
    assert of[5] == (5, 1) and of[7] == of[8] == (7, 3) and of[11] == of[10] == (10, 2)
    assert of[None] == (None, 1)
    kept = dart_minhash.first_of_each_class(_docs(spark, rows))
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 5, 7, 10]
    assert dart_minhash.classes(_docs(spark, [])).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for n in (30, 300, 3000):
        ids = rng.integers(1, 1 << 62, 2 * n, dtype=np.uint64)
        a, b = ids[: n + n // 2], ids[n // 2 :]
        marks = dart_minhash.signatures([a, b], 1200)
        errors.append((marks[0] == marks[1]).mean() - dart_minhash.similarity(a, b))
    assert max(map(abs, errors)) < 0.06
    heavy = dart_minhash.strips(b"a b c d e " * 50)
    assert len(heavy) == 246


def test_passages_found(spark):
    shared, near = _prose(7, 60), _prose(8, 200)
    edited = near[:90] + ["edit"] + near[91:]
    rows = [(1, " ".join(_prose(11, 80) + shared + _prose(12, 10))), (2, " ".join(shared)),
            (3, " ".join(_prose(13, 5) + shared + _prose(14, 90))), (4, None), (5, ""),
            (6, " ".join(_prose(15, 300))), (7, " ".join(near)), (8, " ".join(edited)),
            (9, " ".join(_prose(16, 60) * 2))]
    found = compact_windows.repeated_passages(_docs(spark, rows)).collect()
    spans = {(r.doc_id, r.start_word, r.end_word) for r in found}
    assert {(1, 80, 140), (2, 0, 60), (3, 5, 65), (7, 0, 200), (8, 0, 200)} <= spans
    assert {r.doc_id for r in found} == {1, 2, 3, 7, 8}
    assert compact_windows.repeated_passages(_docs(spark, [])).count() == 0


def test_passage_twice_in_the_first_document(spark):
    shared = _prose(21, 60)
    twice = _prose(22, 60) + shared + _prose(23, 60)
    rows = [(1, " ".join(twice + _prose(24, 200) + twice)),
            (2, " ".join(_prose(25, 30) + shared)), (3, " ".join(shared + _prose(26, 30))),
            (4, " ".join(_prose(27, 60) + _prose(28, 90) + _prose(27, 60)))]
    found = compact_windows.repeated_passages(_docs(spark, rows)).collect()
    spans = {(r.doc_id, r.start_word, r.end_word) for r in found}
    assert spans == {(1, 60, 120), (1, 440, 500), (2, 30, 90), (3, 0, 60)}


def test_exact_repeats_survive_earlier_rows_that_hold_parts(spark):
    early, late, want = [], [], set()
    for i in range(12):
        shared = _prose(100 + i, 60)
        for j, part in enumerate((shared[:45], shared[15:], shared[:30], shared[30:], shared[18:43])):
            early.append((i, " ".join(_prose(200 + 10 * i + j, 40) + part + _prose(400 + 10 * i + j, 40))))
        for doc, before in ((1000 + i, 30), (2000 + i, 70)):
            late.append((doc, " ".join(_prose(doc, before) + shared + _prose(doc + 500, 40))))
            want.add((doc, before, before + 60))
    found = compact_windows.repeated_passages(_docs(spark, early + late)).collect()
    assert {(r.doc_id, r.start_word, r.end_word) for r in found} == want


def test_windows_cover_all_subsequences():
    from gridmetrics.llm.common import mix

    tokens = np.random.default_rng(3).integers(1, 1 << 62, 200, dtype=np.uint64)
    _, left, place, right = compact_windows.windows(tokens, 0, 10)
    hashes = mix(tokens + np.uint64(0x9E3779B97F4A7C15))
    starts: dict[int, list[int]] = {}
    for i in range(191):
        starts.setdefault(i + int(hashes[i : i + 10].argmin()), []).append(i)
    want = {(min(x), p, max(x) + 9) for p, x in starts.items()}
    assert set(zip(left.tolist(), place.tolist(), right.tolist())) == want


def test_windows_are_the_wide_nodes_of_the_cartesian_tree():
    from gridmetrics.llm.common import mix

    width = 10
    tokens = np.random.default_rng(4).integers(1, 1 << 62, 300, dtype=np.uint64)
    hashes = mix(tokens + np.uint64(0x9E3779B97F4A7C15)).tolist()
    nodes, todo = set(), [(0, len(hashes) - 1)]
    while todo:
        i, j = todo.pop()
        if j - i + 1 < width:
            continue
        c = min(range(i, j + 1), key=hashes.__getitem__)
        nodes.add((max(i, c - width + 1), c, min(j, c + width - 1)))
        todo += [(i, c - 1), (c + 1, j)]
    _, left, place, right = compact_windows.windows(tokens, 0, width)
    assert set(zip(left.tolist(), place.tolist(), right.tolist())) == nodes


def test_agreeing_windows():
    rng = np.random.default_rng(5)
    left = rng.integers(0, 300, 80)
    right = left + rng.integers(9, 18, 80)
    starts = [set(range(a, b - 8)) for a, b in zip(left, right)]
    count = Counter(x for s in starts for x in s)
    want = [any(count[x] >= 2 for x in s) for s in starts]
    assert compact_windows.agreeing(left, right, 10, 2).tolist() == want


def _anchors(a, b):
    """Every pair of places that hold the same five words."""
    at = {tuple(b[j : j + 5]): j for j in range(len(b) - 4)}
    return [(i, at[k]) for i in range(len(a) - 4) if (k := tuple(a[i : i + 5])) in at]


def test_passages_inside_a_chain_that_fails():
    words = lambda seed, n: np.random.default_rng(seed).integers(1, 1 << 62, n, dtype=np.uint64)
    near, exact = words(1, 61), words(2, 60)
    edited = near.copy()
    edited[30] = 1
    a, b = np.concatenate([near, words(3, 90), exact]), np.concatenate([edited, words(4, 90), exact])
    got = [x[:4] for x in compact_windows.passages(a, b, _anchors(a, b))]
    assert got == [(0, 61, 0, 61), (151, 211, 151, 211)]
    near, other = words(5, 200), words(6, 30)
    edited = near.copy()
    edited[[40, 80, 120, 160]] = 1
    a, b = np.concatenate([near, words(7, 90), other]), np.concatenate([edited, words(8, 90), other])
    assert [x[:4] for x in compact_windows.passages(a, b, _anchors(a, b))] == [(0, 200, 0, 200)]


def test_span_of_a_far_shift_does_not_split_a_passage():
    words = np.random.default_rng(9).integers(1, 1 << 62, 100, dtype=np.uint64)
    edited = words[:61].copy()
    edited[30] = 1
    b = np.concatenate([edited, words[61:], words[26:36], words[90:]])
    pairs = [(0, 0), (27, 101), (31, 31)]
    assert (0, 61) in [(x[0], x[1]) for x in compact_windows.passages(words[:61], b, pairs)]


def test_hashes_of_runs():
    from gridmetrics.llm.common import hash_runs

    words = np.random.default_rng(1).integers(0, 2, 300, dtype=np.uint64)
    hashes = hash_runs(words, 7).tolist()
    runs = [tuple(words[i : i + 7].tolist()) for i in range(294)]
    assert len(hashes) == 294 and len(set(zip(hashes, runs))) == len(set(hashes)) == len(set(runs))
    assert len(hash_runs(words[:6], 7)) == 0


def _luhn(text):
    digits = [int(c) for c in reversed(text) if c.isdigit()]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def test_pseudonyms_keep_format(spark):
    values = ["4111 1111 1111 1111", "4111111111111111", "4111111111111112", "GB82WEST12345698765432",
              "123-45-6789", "666-45-6789", "10.0.0.255", "300.1.1.1", "2024-02-29", "2023-02-29",
              "31/12/1999", "+1 (017) 555-7713", "ab.34@mail7.example.com", None, "", "none here"]
    docs = _docs(spark, list(enumerate(values)))
    out = feistel.pseudonymise(docs, "k")
    assert out.columns == docs.columns
    new = {r.doc_id: r.text for r in out.collect()}
    assert new[2] == values[2] and new[5] == values[5] and new[7] == values[7] and new[9] == values[9]
    assert new[13] is None and new[14] == "" and new[15] == values[15]
    assert _luhn(new[0]) and new[0].replace(" ", "") == new[1] != values[1]
    for i in (0, 1, 3, 4, 8, 10, 11, 12):
        shape = lambda s: re.sub("[0-9]", "9", re.sub("[a-z]", "a", s))
        assert new[i] != values[i] and shape(new[i]) == shape(values[i])
    land, check, body = new[3][:2], new[3][2:4], new[3][4:]
    assert int("".join(str(int(c, 36)) for c in body + land + check)) % 97 == 1
    again = feistel.pseudonymise(_docs(spark, [(1, f"pay 4111111111111111 now, {values[8]}.")]), "k").first()
    assert again.text == f"pay {new[1]} now, {new[8]}."


def test_ranked_is_a_permutation(spark):
    from pyspark.sql import functions as F

    out = spark.range(73100).select(feistel.ranked(F.col("id"), (340, 215), "k", "d").alias("r"))
    assert tuple(out.agg(F.countDistinct("r"), F.min("r"), F.max("r")).first()) == (73100, 0, 73099)


def test_top_k_ties_and_gaps(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(1, 60)]
    rows += [(100, [0.5] * 8), (101, [0.5] * 8), (102, None), (103, [float("nan")] * 8), (104, [None] * 8),
             (105, [float("inf")] * 8), (106, []), (None, [9.0] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(vectors, vectors.where("vec_id % 20 = 0 OR vec_id = 100"), k=3).collect()
    good = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows
            if i is not None and i not in (102, 103, 104, 105)}
    want = []
    for q in [i for i in good if i % 20 == 0 or i == 100]:
        score = lambda i: int(good[q][: len(good[i])] @ good[i]) if len(good[i]) else 0  # noqa: E731,B023
        best = sorted((i for i in good if i != q), key=lambda i: (-score(i), i))[:3]  # noqa: B023
        want += [(q, n, i, score(i)) for n, i in enumerate(best, 1)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)


def test_lattice_counts_and_marginals(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r for r in lattice.query(spark, SF).collect()}
    words = {
        r.doc_id: re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode().lower()) + [None]
        for r in docs.collect()
    }
    learn = {i for i in words if crc32(str(i).encode()) % 10}
    c = Counter(w for i in learn for w in words[i])
    n, v = sum(c.values()), len(c)
    assert found.keys() == words.keys()
    for i, r in found.items():
        assert (r.n_tokens, r.train_tokens, r.held_out) == (len(words[i]), n, i not in learn)
        assert r.n_known == sum(w in c for w in words[i])
        base = sum(log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words[i])
        assert r.base_score == pytest.approx(base) and r.score < 0
    pieces = [b" ", b"a", b"b", b" a", b"ab", b" ab"]
    scores = np.log(np.array([0.1, 0.2, 0.1, 0.3, 0.2, 0.1]))
    got = lattice.Lattice(pieces, scores).log_probabilities([b"ab", b"a", b"abab"])
    ab = 0.1 + 0.3 * 0.1 + 0.1 * (0.2 + 0.2 * 0.1)
    assert np.exp(got) == pytest.approx([ab, 0.3 + 0.1 * 0.2, ab * (0.2 + 0.2 * 0.1)])


PAGE = (
    '<html><body><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">Buy</div><article>'
    "<h1>Title</h1><p>First &amp; <b>bold<br>line<p>Second\n line</p><div class='comments'><p>Nice post"
    "</p></div></article><script>var x='</p>';</script><footer>&copy; me</footer>"
)


def test_html_blocks(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = html_blocks.learned(pages)
    rows = [(1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "w", "<<p"), (1, "u", PAGE)]
    mine = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text) for r in html_blocks.extract(mine, model).collect())
    text = "Title\n\nFirst & bold line\n\nSecond line"
    assert got[0] == got[1] == (1, text) and got[2] == (2, "") and got[3] == (3, "")
    for r in html_blocks.extract(pages, model).join(pages, "page_id").collect():
        blocks = html_blocks.blocks_of(r.html)
        weak = html_blocks.weak_labels(blocks)
        assert weak is None or r.text == "\n\n".join(b.text for b, y in zip(blocks, weak) if y)


@pytest.mark.parametrize("operator,label,modulus,held", [(quality, "quality", 5, 0), (toxicity, "toxic", 4, 2)])
def test_classifiers_on_held_out_rows(spark, operator, label, modulus, held):
    sf = "/root/testdata/sf0.01"
    rows = operator.query(spark, sf).collect()
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % modulus == held) for r in rows)
    mine = np.array([(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels])
    # Some 40 toxic rows to learn from, 5 of the 14 held out without a word that any of them shares.
    least, most = (0.95, 0.1) if operator is quality else (0.5, 0.05)
    assert mine[mine[:, 1] == 1, 0].mean() >= least, "positives caught"
    assert mine[mine[:, 1] == 0, 0].mean() <= most, "false alarms"
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    docs = _docs(spark, [(1, None), (2, ""), (2, "")])
    model = operator.learned(docs, none, none.doc_id.isNotNull())
    assert model is None and operator.score(docs, model).count() == 3


def test_order_of_lattice_places():
    rng = np.random.default_rng(29)
    for width in (9, 70_000):
        places = rng.integers(0, width + 1, 5_000)
        assert lattice._order(places, width).tolist() == np.argsort(places, kind="stable").tolist()


def test_lattice_finds_every_piece_in_words(spark):
    pieces = [bytes([c]) for c in range(256)] + [b" a", b"ab", b"aba", b"bab", b"abab", b" ba"]
    found = lattice.Lattice(pieces, np.zeros(len(pieces)))
    rows, starts, ends, piece = found.arcs(np.frombuffer(b" abab babaabba", np.uint8).reshape(2, -1))
    got = sorted(zip(rows.tolist(), starts.tolist(), ends.tolist(), (pieces[p] for p in piece)))
    texts = [b" abab b", b"abaabba"]
    assert got == sorted(
        (i, s, e, t[s:e]) for i, t in enumerate(texts) for s in range(7) for e in range(s + 1, 8) if t[s:e] in pieces
    )
