"""Fingerprints, resampling, source divergence."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from loadcast.llm import divergence, fingerprints, interning, resampling, textnp
from tests.llm import brute
from tests.llm.conftest import SF, key


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=key)


# ---------------------------------------------------------------- interning

def spans_of(words):
    buf = np.frombuffer(b" ".join(words), np.uint8)
    s, e, _ = textnp.words(buf, np.array([0, len(buf)]))
    return interning.compact(buf, s, e, lower=False)


@pytest.mark.parametrize("collide", [False, True])
def test_intern_keeps_different_bytes_apart(collide):
    r = np.random.RandomState(1)
    words = [bytes(r.randint(33, 127, r.randint(1, 70)).astype(np.uint8)) for _ in range(400)] + [b"a", b"b", b"a" * 33]
    words += words[::3]
    text, s, e = spans_of(words)
    h = interning.xxh64(text, s, e - s)
    assert [int(x) for x in h] == [xxhash.xxh64_intdigest(w) for w in words]
    owner, slot = interning.intern(text, s, e - s, np.zeros(len(s), np.uint64) if collide else None)
    assert len(set(zip(words, slot.tolist()))) == len(set(words)) == len(set(slot.tolist()))
    assert (owner >= 0).sum() == len(set(words)) and all(words[owner[i]] == w for i, w in zip(slot, words))


def test_intern_of_nothing():
    text, s, e = spans_of([])
    owner, slot = interning.intern(text, s, e - s)
    assert len(slot) == 0 and (owner < 0).all()


# ------------------------------------------------------------- fingerprints

def agree(a, i, b, j):
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    return n


def test_longest_common_extensions(spark):
    r = random.Random(3)
    rows = []
    for k in range(300):
        a = "".join(r.choice("abé語") for _ in range(r.randint(0, 40)))
        b = a[r.randint(0, 5):] + "x" if k % 2 else "".join(r.choice("ab") for _ in range(30))
        rows.append((a, r.randint(0, 10), b, r.randint(0, 10), "kept"))
    rows += [(None, 0, "a", 0, "x"), ("aa", None, "aa", None, "y"), ("a", -1, "a", 0, "z"), ("a", 5, "a", 0, "z"), ("a" * 5000, 0, "a" * 4999, 0, "w")]
    df = spark.createDataFrame(rows, "left_text string, left_at long, right_text string, right_at long, extension string")
    got = rows_of(fingerprints.common_extensions(df), "left_text", "left_at", "right_text", "right_at", "extension")
    want = [(a, i, b, j, 0 if (i or 0) < 0 else agree(a or "", i or 0, b or "", j or 0)) for a, i, b, j, _ in rows]
    assert got == sorted(want, key=key)


def test_likeness():
    r = random.Random(1)
    voc = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(voc) for _ in range(n))
    for n in (5, 20, 100, 1000, 20_000):
        t, u = say(n), say(n)
        cut = len(t) // 4
        moved = t.split()
        moved[n // 2] = "other"
        made = [t, u, t[:len(t) - cut] + u[:cut], " ".join(moved), "in front of " + t, t]
        p = fingerprints.prints(*fingerprints.code_points(made))
        parsed = [fingerprints.Print.parse(x.text()) for x in p]
        like = [[fingerprints.likeness(x, y) for y in p] for x in parsed]
        assert p[0].text() == p[5].text() and like[0][5] == like[0][0] == 1.0
        assert all(0 <= v <= 1 and v == like[j][i] for i, row in enumerate(like) for j, v in enumerate(row))
        assert 0.6 < like[0][2] < 0.9 and like[0][1] < 0.1
        if n >= 100:
            assert like[0][3] > 0.8 and like[0][4] > 0.8
        assert max(len(x.text()) for x in p) < 1500
    p = fingerprints.prints(*fingerprints.code_points(["", "", "a", "ab", "a" * 9000, "a" * 8999, "日本語" * 500]))
    assert [fingerprints.likeness(p[0], x) for x in p[:4]] == [1.0, 1.0, 0.0, 0.0]
    assert fingerprints.likeness(p[4], p[5]) > 0.9 and fingerprints.likeness(p[4], p[6]) == 0.0


def edited(rows):
    """(doc_id, n_chars, sha256 of the edited text) of rows in order of id and text."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for i, (d, t) in enumerate(rows):
        cut = len(t) // 4
        text = t[:len(t) - cut] + rows[(i + 1) % len(rows)][1][:cut]
        out.append((d, len(t), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=key)


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_edited_texts(odd, odd_pairs, ranges):
    got = fingerprints.edited_fingerprints(odd, ranges).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=key) == edited(odd_pairs)
    texts = {r["fingerprint"] for r in got}
    assert len(texts) == len({t or "" for _, t in odd_pairs})


def test_edited_texts_of_few_rows(spark, none):
    assert fingerprints.edited_fingerprints(none).count() == 0
    one = spark.createDataFrame([(5, "one two three four")], "doc_id long, text string")
    got = fingerprints.edited_fingerprints(one).collect()
    assert [(r["doc_id"], r["edited_sha256"], r["near_next"]) for r in got] == [(5, hashlib.sha256(b"one two three one ").hexdigest(), 1.0)]


def test_op11(spark, docs):
    got = fingerprints.op11(spark, SF).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=key) == edited((r["doc_id"], r["text"]) for r in docs.collect())
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    order = sorted(text)
    made = {r["doc_id"]: r for r in got}
    for d, nxt in zip(order, order[1:]):
        assert (made[d]["near_next"] == 1.0) == (text[d] == text[nxt])
        if len(text[d]) > 40:
            assert made[d]["near_edited"] > 0.6
        p = fingerprints.prints(*fingerprints.code_points([text[d]]))[0]
        assert p.text() == made[d]["fingerprint"]


def test_with_fingerprints_keeps_columns(odd, none):
    got = fingerprints.with_fingerprints(odd)
    assert set(got.columns) == set(odd.columns) | {"fingerprint"} and got.count() == odd.count()
    assert fingerprints.with_fingerprints(none).count() == 0
    like = got.select(fingerprints.likeness_column("fingerprint", "fingerprint").alias("x")).distinct().collect()
    assert [r["x"] for r in like] == [1.0]


# --------------------------------------------------------------- resampling

@pytest.mark.parametrize("min_n, max_n", [(1, 1), (1, 2), (2, 3)])
def test_weights(spark, odd, odd_pairs, none, min_n, max_n):
    target = [odd_pairs[0][1], None, "", "Ünïcode größe 12,34"]
    t = spark.createDataFrame([(x,) for x in target], "text string")
    got = rows_of(resampling.importance_weights(odd, t, min_n, max_n), "doc_id", "n_features", "weight")
    assert got == sorted(((r[0], r[1], r[2]) for r in brute.resampling(odd_pairs, target, min_n, max_n)), key=key)
    assert resampling.importance_weights(none, t).count() == 0
    empty = resampling.importance_weights(odd, t.limit(0), min_n, max_n)
    assert rows_of(empty, "weight") == sorted(((r[2],) for r in brute.resampling(odd_pairs, [], min_n, max_n)), key=key)


def test_op12(spark, docs):
    want = brute.resampling([(r["doc_id"], r["text"]) for r in docs.collect()],
                            [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert rows_of(resampling.op12(spark, SF), "doc_id", "n_features", "weight", "score", "rank") == sorted(want, key=key)


def test_resample_odd_table(odd, none, odd_pairs):
    got = resampling.resample(odd, odd, percent=50)
    assert set(got.columns) == set(odd.columns) | set(resampling.OWN)
    want = [r for r in brute.resampling(odd_pairs, [t for _, t in odd_pairs], percent=50) if r[4]]
    assert rows_of(got, "score", "rank") == sorted((r[3:] for r in want), key=key)
    assert resampling.resample(none, none).count() == 0


# --------------------------------------------------------------- divergence

def test_gallop():
    r = np.random.RandomState(2)
    for _ in range(200):
        a, b = (np.unique(r.randint(0, 60, r.randint(0, 40))) for _ in range(2))
        assert divergence.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()


def test_share_is_exact():
    counts = np.array([0, 1, 7, 10**12, 8 * 10**15])
    for total, v in ((8 * 10**15, 10**9), (9 * 10**15 - 3, 1)):
        assert divergence.share(counts, total, v).tolist() == [1 + 10**9 * (int(c) + 2) // (total + 2 * v) for c in counts]


@pytest.mark.parametrize("block", [3, 8192])
def test_divergence(docs, odd, none, block):
    cols = ("lang", "source", "part", "item", "value", "rank")
    for df, least in ((docs, 10), (odd, 2), (odd, 50)):
        got = rows_of(divergence.audit(df, min_docs=least, block_terms=block if df is odd else 8192), *cols)
        want = brute.divergence([(r["lang"], r["source"], r["text"]) for r in df.collect()], least)
        assert got == sorted(want, key=key)
    assert divergence.audit(none).count() == 0
