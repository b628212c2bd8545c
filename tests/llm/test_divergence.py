"""The source audit against plain counting, with collisions forced by narrow digests."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridmetrics.llm import divergence

_TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def _brute(rows, least, top):
    """Rows of the result, from (text, lang, source)."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = [w.translate(_LOWER) for w in _TERM.findall(text or "")]
        docs[lang].update(set(words))
        counts[lang, source].update(words)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        of = {s: counts[lang, s] for g, s in groups if g == lang}
        whole = sum(of.values(), Counter())

        def share(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, p = share(whole), {s: share(c) for s, c in of.items()}
        for s in of:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in of if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if of[s][t] and p[s][t] > q[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -f, k + 1) for k, (f, _, item) in enumerate(ranked)]
    return sorted(out)


def _rows():
    rng = np.random.default_rng(3)
    words = ["The", "the", "café", "naïve", "漢字", "x", "E", "straße", "Ünder"] + [f"w{a}q" for a in "abcdefghijklmnop"]
    rows = []
    for k in range(400):
        lang, source = ["en", "de", None][int(rng.integers(3))], f"s{int(rng.integers(5))}"
        text = " ".join(rng.choice(words[: int(rng.integers(3, 25))], int(rng.integers(0, 40))))
        rows.append((text.replace(" ", ["-", " ", "1"][k % 3]), lang, source))
    rows += [("only rare words here", "xx", "a"), (None, "xx", None), ("", "xx", "b")] + [("copy the copy", "en", "s0")] * 9
    return rows + [("123 456", "en", "silent"), (None, None, None)]


def _frame(spark, rows):
    wide = [(*r, "x", 1, 2) for r in rows]
    return spark.createDataFrame(wide, "text string, lang string, source string, term string, digest long, part int")


@pytest.mark.parametrize("bits,top", [(64, 50), (3, 4)])
def test_equals_brute_force(spark, bits, top):
    got = divergence.divergence(_frame(spark, _rows()), least_documents=8, top=top, bits=bits).collect()
    assert sorted(map(tuple, got)) == _brute(_rows(), 8, top)


def test_many_sources_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 4)
    monkeypatch.setattr(divergence, "CHUNK", 5)
    rows = [(t, lang, f"{s}{k % 4}") for k, (t, lang, s) in enumerate(_rows())]
    got = divergence.divergence(_frame(spark, rows), least_documents=5).collect()
    assert sorted(map(tuple, got)) == _brute(rows, 5, 50)


def test_empty_table_and_very_long_text(spark, monkeypatch):
    assert divergence.divergence(_frame(spark, [])).count() == 0
    monkeypatch.setattr(divergence, "LONG", 1 << 16)
    monkeypatch.setattr(divergence, "HELD", 100)
    rng = np.random.default_rng(1)
    letters = np.array(list("abcdefghij"))
    long = " ".join("".join(rng.choice(letters, 3)) for _ in range(60_000))
    rows = [(long, "en", "a"), (long.upper(), "en", "b"), ("abc abc", "en", "b"), ("abc", "en", "c")]
    got = divergence.divergence(_frame(spark, rows), least_documents=2).collect()
    assert sorted(map(tuple, got)) == _brute(rows, 2, 50)
