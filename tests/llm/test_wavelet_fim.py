"""Wavelet matrices against plain counting, and rewriting against splitting."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from gridmetrics.llm import wavelet_fim as fim

_WAYS = {"line": r"[^\n]*\n|[^\n]+", "word": r"[^ \t\n\v\f\r]+[ \t\n\v\f\r]*|[ \t\n\v\f\r]+", "char": r"(?s)."}


def _units(text, unit):
    return re.findall(_WAYS[unit], text)


def _texts():
    rng = np.random.default_rng(5)
    letters = list("ab. \n\n\té漢🙂") + ["word", "line\n", "\r\n", "<", "P>"]
    texts = ["".join(rng.choice(letters, int(n))) for n in rng.integers(0, 200, 60)]
    return [*texts, "", "\n", "\n\n\n", "x", "no end", "end\n", " ", "é", "a <P> b", "<S>", "ends <M", "<", "<\n<S\n<M"]


def test_rank_and_select_equal_counting():
    rng = np.random.default_rng(2)
    for n in (1, 7, 64, 511, 512, 513, 5000):
        sequence = rng.integers(0, 6, n).astype(np.uint8)
        matrix = fim.WaveletMatrix(sequence)
        for end in {0, 1, n // 3, n - 1, n}:
            for kind in range(6):
                assert matrix.rank(kind, end) == int((sequence[:end] == kind).sum())
        places = np.flatnonzero(np.isin(sequence, (3, 5)))
        for k in range(1, len(places) + 1, max(1, len(places) // 20)):
            assert matrix.select((3, 5), k) == places[k - 1]


@pytest.mark.parametrize("unit", ["line", "word", "char"])
def test_cuts_equal_splitting(unit):
    for text in _texts():
        parts = _units(text, unit)
        units = fim.Units(text.encode(), unit)
        assert units.count == len(parts), (unit, text)
        for k in range(len(parts) + 1):
            assert text.encode()[: units.cut(k)].decode() == "".join(parts[:k])


def _brute(doc_id, text, unit, rate, spm):
    text = text or ""
    parts = _units(text, unit)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(parts), "plain", None, None, text
    low, high = sorted((h1 % (len(parts) + 1), h2 % (len(parts) + 1)))
    p, m, s = "".join(parts[:low]), "".join(parts[low:high]), "".join(parts[high:])
    if h4 % 100 < spm:
        return len(parts), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(parts), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit,rate,spm", [("line", 100, 50), ("word", 60, 0), ("char", 100, 100)])
def test_rewriting_equals_brute_force_and_is_undone(spark, unit, rate, spm):
    rows = [*enumerate(_texts()), (None, "of\nnobody"), (3, None), (4, "same\nrow\n"), (4, "same\nrow\n")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, data string, n long")
    done = fim.fill_in_middle(docs, unit=unit, rate=rate, spm=spm)
    got = done.withColumn("back", fim.restored()).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    found = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key)
    assert found == sorted(((i, *_brute(i, t, unit, rate, spm)) for i, t in rows), key=key)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)


def test_empty_table_long_text_unknown_unit(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.fill_in_middle(docs).count() == 0
    text = "é line\n" * 400_000 + "rest"
    row = fim.fill_in_middle(spark.createDataFrame([(11, text)], "doc_id long, text string")).first()
    assert tuple(row)[1:] == _brute(11, text, "line", 100, 50)
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, unit="page")
