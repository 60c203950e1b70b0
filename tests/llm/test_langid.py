from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from causeway.llm import langid
from causeway.llm.queries import QUERIES
from tests.llm.data import documents, odd_rows, table


class Few:
    """A tiny vocabulary with the interface of ``Pieces``."""

    def __init__(self, pieces):
        self.size = len(pieces)
        self.table = {p: i for i, p in enumerate(pieces)}
        for p in pieces:
            for end in range(1, len(p)):
                self.table.setdefault(p[:end], -1)

    edges = langid.Pieces.edges


def every_segmentation(word, pieces, p):
    if not word:
        return 1.0
    return sum(p[pieces.table[word[:k]]] * every_segmentation(word[k:], pieces, p)
               for k in range(1, len(word) + 1) if pieces.table.get(word[:k], -1) >= 0)


PIECES = [b"a", b"b", b"c", b" ", b" a", b"ab", b"bc", b"abc", b"cab", b" ca"]


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(0)
    pieces, p = Few(PIECES), rng.dirichlet(np.ones(len(PIECES)), 3)
    words = [b" abc", b" cabab", b" a", b" abcabcabc", b" cab" + b"ab" * 3]
    found = langid.log_likelihoods(words, pieces, p, np.log(p).tolist())
    for word, row in zip(words, found, strict=True):
        assert row == pytest.approx([math.log(every_segmentation(word, pieces, own)) for own in p])


def test_steps_find_the_pieces_of_many_words():
    """All words at once give what the prefix table gives word by word, whole bytes and words of every size included."""
    rng = np.random.default_rng(2)
    whole = langid.Pieces(langid.vocabulary_path())
    for pieces, letters in ((Few(PIECES), b"abc "), (Few([b"a", b"aa", b"aab", b"\xff", b"\0", b"a\0a"]), b"ab\0\xff"), (whole, bytes(range(256)))):
        words = [b"", *(bytes(rng.choice(list(letters), size)) for size in rng.integers(0, 40, 300)), b" the language", " größer".encode()]
        edge = langid.Steps(pieces.table).edges(words, np.array([len(w) for w in words]))
        found: dict = {}
        for x in np.sort(edge).tolist():
            found.setdefault(x >> 26 & 4095, set()).add((x >> 20 & 63, x >> 38, x & ((1 << 20) - 1)))
        for k, word in enumerate(words):
            assert found.get(k, set()) == (set(pieces.edges(word)) if len(word) <= langid.LINEAR else set())
    assert len(edge) == sum(len(whole.edges(w)) for w in words if len(w) <= langid.LINEAR)
    assert len(langid.Steps(whole.table).edges([], np.empty(0, np.int64))) == 0


def test_long_words_agree_with_short_ones(monkeypatch):
    rng = np.random.default_rng(1)
    pieces, p = Few(PIECES), rng.dirichlet(np.ones(len(PIECES)), 2)
    words = [b" abc" * 5, b" cabab", b" " + b"abc" * 9]
    linear = langid.log_likelihoods(words, pieces, p, np.log(p).tolist())
    counts = []
    for limit in (32, 0):
        monkeypatch.setattr(langid, "LINEAR", limit)
        if not limit:
            assert langid.log_likelihoods(words, pieces, p, np.log(p).tolist()) == pytest.approx(linear)
        into: dict = {}
        for w in words:
            langid.expected_counts(pieces.edges(w), len(w), p[0].tolist(), np.log(p[0]).tolist(), 2.0, into)
        counts.append([into.get(i, 0.0) for i in range(pieces.size)])
    assert counts[0] == pytest.approx(counts[1])
    # expected uses weigh with the pieces' sizes to the words' bytes
    assert sum(n * len(x) for n, x in zip(counts[0], PIECES, strict=True)) == pytest.approx(2 * sum(map(len, words)))


def test_held_out_accuracy(spark, sf):
    found = QUERIES["op10_language"](spark, sf).collect()
    lang = dict(table(sf, "documents", "doc_id, lang"))
    assert len(found) == len(lang)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in found if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def whole_text(text, pieces, own):
    """Log of the sum over all segmentations of a text's words, one forward sum after the other."""
    total = 0.0
    for word in text.encode().lower().split():
        word = b" " + word
        sums = [1.0] + [0.0] * len(word)
        scale = 0.0
        for j in range(1, len(word) + 1):
            sums[j] = sum(sums[i] * own[pieces.table[word[i:j]]] for i in range(max(0, j - 60), j) if pieces.table.get(word[i:j], -1) >= 0)
            if j % 50 == 0:  # keep long words in range
                top = max(sums[j - 49:j + 1])
                sums = [x / top for x in sums]
                scale += math.log(top)
        total += math.log(sums[-1]) + scale
    return total


def test_predictions_equal_brute_force(spark, sf, monkeypatch):
    """Whole texts with digits and signs, word by word without a cache or numpy; small caches and groups in the operator."""
    monkeypatch.setattr(langid, "CACHE_LIMIT", 40)
    monkeypatch.setattr(langid, "TEXT_BYTES", 200)
    rows = table(sf, "documents", "doc_id, text, lang")[:60]
    model = langid.LanguageModel.fit(documents(spark, rows))
    rows = [(d, t[:400], lang) for d, t, lang in rows] + [(900, "Call 555-0199 on 12/24 at 7pm!", "en"), (901, "x" * 300 + " und 3.14", "de")]
    pieces = langid.Pieces(model.model_path)
    for r in model.predict(documents(spark, rows)).collect():
        sums = [whole_text(r.text, pieces, own.tolist()) for own in model.probabilities]
        best = max(sums)
        assert r.lang_pred == model.languages[sums.index(best)]
        assert r.lang_score == pytest.approx(1 / sum(math.exp(x - best) for x in sums), rel=1e-6)


def test_digits_and_signs_count(spark):
    """Texts of two languages that share their letters and differ in numbers and signs only."""
    train = [(i, f"abc {'12:30' if i % 2 else '#77'} def", "ab"[i % 2]) for i in range(60)]
    model = langid.LanguageModel.fit(documents(spark, train))
    found = model.predict(documents(spark, [(1, "def 12:30 abc"), (2, "abc #77")])).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {1: "b", 2: "a"}
    assert langid.words_of("call 555-0199 on 12/24 at 7PM") == [b"call", b"555-0199", b"on", b"12/24", b"at", b"7pm"]


def test_odd_rows(spark, sf):
    train = [(i, t, lang) for i, (t, lang) in enumerate(table(sf, "documents", "text, lang")[:200])] + [(900, None, "en"), (901, "text", None)]
    model = langid.LanguageModel.fit(documents(spark, train))
    assert model.languages == sorted({r[2] for r in train if r[1] is not None and r[2] is not None})
    rows = odd_rows() + [(50, "123 — 456"), (51, "!?"), (52, "\x00 a")]
    frame = documents(spark, rows)
    found = model.predict(frame)
    assert found.columns == [*frame.columns, "lang_pred", "lang_score"]
    rows_found = found.collect()
    assert len(rows_found) == len(rows)
    for r in rows_found:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred != "und") == letters and (r.lang_score > 0) == letters
    assert model.predict(frame.limit(0)).collect() == []
    kept = langid.keep_identified(documents(spark, train))
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} >= set(range(150))


def test_nothing_learned(spark):
    found = langid.identify(documents(spark, [(1, "abc", None), (2, None, "en")])).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 2
    assert langid.identify(documents(spark, [])).collect() == []
