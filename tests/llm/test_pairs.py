"""Near duplicates, repeated strings, decontamination: against brute force."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadcast.llm import common, decontaminate, near_dups, repeats
from tests.llm import brute
from tests.llm.conftest import key


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=key)


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, odd, odd_pairs, none, k, percent):
    for df in (docs, odd):
        got = rows_of(near_dups.near_duplicates(df, k, percent), "doc_id", "n_shingles", "component_id")
        assert got == sorted(brute.near_duplicates(pairs_of(df), k, percent), key=key)
    assert near_dups.near_duplicates(none, k, percent).count() == 0


def test_near_duplicate_blocks_lose_no_link(spark):
    base = [f"w{i}" for i in range(120)]
    texts = [(i, " ".join(base[:i % 100] + [f"e{i}"] + base[i % 100 + 1:])) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    one = rows_of(near_dups.near_duplicates(df, 3, 85), "doc_id", "component_id", "kept")
    many = rows_of(near_dups.near_duplicates(df, 3, 85, block_rows=7), "doc_id", "component_id", "kept")
    assert one == many and sum(r[2] for r in one) < 60
    assert [r[:2] for r in one] == sorted((d, c) for d, _, c in brute.near_duplicates(texts, 3, 85))


def test_drop_near_duplicates_keeps_columns(odd, none):
    left = near_dups.drop_near_duplicates(odd, k=5, percent=80)
    assert left.columns == odd.columns
    kept = {r[0] for r in brute.near_duplicates(pairs_of(odd), 5, 80) if r[0] is None or r[0] == r[2]}
    assert {r["doc_id"] for r in left.collect()} == kept
    assert near_dups.drop_near_duplicates(none).count() == 0


def test_drop_near_duplicates_decides_by_row(spark):
    say = lambda c: " ".join(f"{c}{i}" for i in range(40))
    a, b, c, d = map(say, "abcd")
    rows = [(3, a), (5, a), (5, b), (7, c), (7, c), (7, c.upper()), (9, None), (9, None), (None, c), (3, d), (6, d), (5, d + " more")]
    left = near_dups.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((r["doc_id"], r["text"] and r["text"].lower()) for r in left.collect()), key=key)
    assert got == sorted([(3, a), (5, b), (7, c), (9, None), (9, None), (None, c), (3, d)], key=lambda r: key((r[0], r[1])))


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (102, 101), (7, 7), (200, 100)] + [(500, x) for x in range(501, 540)]
    got = dict(rows_of(common.components(spark.createDataFrame(edges, "a long, b long")), "id", "component_id"))
    assert all(got[i] == 0 for i in range(31)) and got[200] == got[102] == 100 and got[539] == 500


@pytest.mark.parametrize("split", [200_000, 1])
def test_repeats(docs, odd, none, split):
    for df, n in ((docs, 50), (odd, 50), (odd, 200)):
        got = rows_of(repeats.repeat_report(df, n, split_rows=split), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert got == sorted(brute.repeats(pairs_of(df), n), key=key)
    assert repeats.repeat_report(none, 50).count() == 0


def test_repeats_random(spark):
    r = np.random.RandomState(1)
    texts = [(int(i), "".join("ab"[x] for x in r.randint(0, 2, 400)) + "abbaab" * int(r.randint(0, 9))) for i in range(25)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for n in (21, 25):
        got = rows_of(repeats.repeat_report(df, n), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert got == sorted(brute.repeats(texts, n), key=key)


def test_remove_repeats(odd, none):
    left = repeats.remove_repeats(odd, min_len=200)
    assert left.columns == odd.columns
    old = {t for _, t in pairs_of(odd)}
    new = [(t, n) for _, t, n in rows_of(left, "doc_id", "text", "n_chars") if t not in old]
    assert len(new) >= 3 and all(n == len(t) for t, n in new)
    gone = {r["doc_id"] for r in odd.collect()} - {r["doc_id"] for r in left.collect()}
    assert gone == {5, 18, 20}  # whole copies; nothing of them is left
    assert repeats.remove_repeats(none).count() == 0


def test_common_prefix_intervals():
    text = "mississippi$banana"
    sa = sorted(range(len(text)), key=lambda i: text[i:])
    common_len = lambda a, b: next((k for k in range(20) if text[a:][k:k + 1] != text[b:][k:k + 1] or not text[a:][k:k + 1]), 0)
    lcp = np.array([-1] + [common_len(a, b) for a, b in zip(sa, sa[1:])])
    nodes = set(repeats.intervals(lcp))
    for lo in range(len(sa)):
        for hi in range(lo + 1, len(sa)):
            depth = lcp[lo + 1:hi + 1].min()
            whole = (lo == 0 or lcp[lo] < depth) and (hi == len(sa) - 1 or lcp[hi + 1] < depth)
            assert ((lo, hi, depth) in nodes) == whole


def test_left_agreement():
    r = np.random.RandomState(3)
    for _ in range(50):
        n = r.randint(2, 12)
        doc, lcp = r.randint(0, 5, n).tolist(), [0, *r.randint(0, 6, n - 1).tolist(), 0]
        want = [max([min(lcp[min(i, j) + 1:max(i, j) + 1]) for j in range(n) if doc[j] < doc[i]], default=-1) for i in range(n)]
        assert repeats.left_agreement(doc, lcp) == want


def test_contamination(spark, odd, none, odd_pairs):
    passage = odd_pairs[19 + 4][1]
    w = passage.split()
    items = [(1, passage), (2, " ".join(w[:20]).upper()), (3, None), (4, ""), (None, passage), (5, "ab"), (6, passage), (7, "never seen words here at all"),
             (8, " ".join(w[3:40] + ["tail"]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination(odd_pairs, items)
    for size in (20_000, 2):
        got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["first_word"], r["n_words"])
               for r in decontaminate.contamination(odd, bench, block_items=size).collect()}
        assert got == {k: (round(s, 9), a, n) for k, (s, a, n) in want.items()} and len(got) > 10
    left = decontaminate.drop_contaminated(odd, bench)
    assert left.columns == odd.columns
    assert not {r["doc_id"] for r in left.collect()} & {k[0] for k in want}
    assert left.count() == sum(not brute.contamination([p], items) for p in odd_pairs)
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(odd, bench.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(odd, bench.limit(0)).count() == len(odd_pairs)


def test_contamination_of_texts_shorter_than_the_item(spark):
    words = [f"w{i}" for i in range(59)]
    rows = [(1, " ".join(words[:-1])), (2, " ".join(words[:48])), (3, " ".join(words[:40])), (4, " ".join(words[:4])), (5, " ".join(words[9:]))]
    items = [(1, " ".join(words)), (2, " ".join(words[:5]))]
    docs, bench = (spark.createDataFrame(x, f"{c} long, text string") for x, c in ((rows, "doc_id"), (items, "item_id")))
    want = brute.contamination(rows, items)
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["first_word"], r["n_words"]) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {k: (round(s, 9), a, n) for k, (s, a, n) in want.items()} and (1, 1) in got and (3, 1) not in got
    assert {r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench).collect()} == {4, 5} - {k[0] for k in want}


def test_contamination_query(spark, docs):
    from tests.llm.conftest import SF
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r["first_word"] for r in decontaminate.op5(spark, SF).collect()}
    want = brute.contamination(pairs_of(docs.filter(F.length("text") < 6000)), [(r["item_id"], r["text"]) for r in bench.collect()])
    short = {r["doc_id"] for r in docs.filter(F.length("text") < 6000).collect()}
    assert {k: v for k, v in got.items() if k[0] in short} == {k: v[1] for k, v in want.items()}


def test_anchors_are_packed_without_zeros_between_random_bytes():
    r = np.random.RandomState(2)
    n = 2000
    gram, pos = r.randint(0, 2**63 - 1, n, dtype=np.uint64), np.sort(r.randint(0, 60_000, n))
    reach = r.randint(-2**31, 2**31 - 1, n).astype(np.int32)
    a, b = repeats.pack(gram, reach, pos)
    raw = np.stack([a, b], axis=1).view(np.uint8).reshape(n, 16)
    assert (raw[:, [0, 12, 13, 14, 15]] == 0).all() and all(raw[:, i].any() for i in range(1, 12))
    a, b = a.view(np.uint64), b.view(np.uint64)
    assert (a >> np.uint64(24) == gram >> np.uint64(24)).all() and (b >> np.uint64(16) == pos.astype(np.uint64)).all()
    assert (((a >> np.uint64(8) & np.uint64(0xFFFF)) << np.uint64(16)) | b & np.uint64(0xFFFF) == reach.view(np.uint32)).all()


def test_map_side_combine_decides_only_larger_documents():
    r = np.random.RandomState(5)
    n = 500
    gram, reach = r.randint(0, 20, n).astype(np.uint64) << np.uint64(40), r.randint(0, 5, n).astype(np.uint32).view(np.int32)
    pos, doc = np.arange(n, dtype=np.int64), r.randint(-3, 30, n)
    # bytes of the reach: as its hash, but in one of eight rows, which then is covered by nothing
    size = 4 + reach.astype(np.int64) % 3
    other = r.randint(0, 8, n) == 0
    data = np.concatenate([np.full(k, 65 + c + 8 * o + (i % 100 + 16 if o else 0), np.uint8) for i, (k, c, o) in enumerate(zip(size, reach, other))])
    hi = np.cumsum(size)
    lo = hi - size
    a, b = repeats.pack(gram, reach, pos)
    x, y = repeats.combine(a, b, doc, data, lo, hi)
    done = (y.view(np.uint64) & repeats.DECIDED) > 0
    low = {}
    for i, k in enumerate(zip(gram.tolist(), reach.tolist())):
        low[k] = min(low.get(k, (doc[i], i)), (doc[i], i))
    heads = [low[k][1] for k in zip(gram.tolist(), reach.tolist())]
    assert done.tolist() == [doc[i] > doc[j] and data[lo[i]:hi[i]].tolist() == data[lo[j]:hi[j]].tolist() for i, j in enumerate(heads)]
    assert (x[~done] == a[~done]).all() and (y[~done] == b[~done]).all() and done.sum() > 200
    assert ((x ^ a)[done] & 0xFFFF == 0).all() and len(np.unique(x[done] >> 16)) > 0.9 * done.sum()
    assert len(repeats.combine(a[:0], b[:0], doc[:0], data[:0], lo[:0], hi[:0])[0]) == 0


def colliding_texts():
    """Two texts that share a gram of 20 bytes and the 32-bit hash of its reach, and nothing else."""
    r = np.random.RandomState(9)
    letters = lambda n, k: r.randint(97, 123, (n, k)).astype(np.uint8)
    grams = letters(100_000, 20)
    best = grams[np.argmin([repeats.byte_grams(g, 20)[0] for g in grams])]  # the smallest hash: a minimizer wherever it is
    n = 300_000
    texts = np.concatenate([letters(n, 30), np.tile(best, (n, 1)), letters(n, 30)], axis=1)
    off = np.arange(n + 1) * 80
    h = repeats.reach_hash(texts.reshape(-1), off, off[:-1] + 30, np.arange(n), 50)
    order = np.argsort(h, kind="stable")
    i = np.flatnonzero(h[order][1:] == h[order][:-1])[0]
    return [texts[j].tobytes().decode() for j in (order[i], order[i + 1])]


@pytest.mark.parametrize("apart", [False, True])
def test_equal_hashes_of_reaches_remove_nothing(spark, apart):
    """In one slice, and in different ones."""
    one, two = colliding_texts()
    rows = [(1, one), (2, two), (3, "x" + two[10:] + "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.repartition(3, "doc_id") if apart else df.coalesce(1)
    got = [tuple(r) for r in repeats.repeat_report(df, 50).collect()]
    want = brute.repeats(rows, 50)
    assert sorted(got) == sorted(want) and [r[2] for r in sorted(want)] == [0, 0, 70]


def test_one_gram_in_very_many_contexts(spark):
    """A phrase in hundreds of texts, its neighbourhood shared by some of them."""
    r = random.Random(3)
    say = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    phrase, ends = say(24), [say(40) for _ in range(12)]
    rows = [(i, say(30) + r.choice(ends) + phrase + r.choice(ends) + say(25)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    for split in (200_000, 64):
        got = [tuple(x) for x in repeats.repeat_report(df, 50, split_rows=split).collect()]
        assert sorted(got) == sorted(brute.repeats(rows, 50))


def test_an_anchor_has_one_span_of_all_its_intervals(monkeypatch):
    """Occurrences of one gram that agree with others over many lengths."""
    monkeypatch.setattr(repeats, "MATRIX_ROWS", 7, raising=False)
    r = np.random.RandomState(4)
    letters = lambda n: r.randint(97, 123, n).astype(np.uint8)
    side, left, right, gram = 30, letters(30), letters(30), letters(repeats.SEED)
    texts = []
    for _ in range(40):
        a, b = left.copy(), right.copy()
        a[:r.randint(0, 31)] = letters(1)
        b[r.randint(0, 31):] = letters(1)
        texts.append(np.concatenate([a, gram, b]))
    n = len(texts)
    doc, pos, off = np.arange(n), np.full(n, side), np.arange(n + 1) * len(texts[0])
    rows, lo, hi, _ = repeats.cover(np.zeros(n, np.int64), doc, pos, pos, np.concatenate(texts), off, side + repeats.SEED)
    want = {}
    for i in range(n):
        for j in range(i):
            same = texts[i] == texts[j]
            x = side - int(np.argmin(np.concatenate([same[:side][::-1], [False]])))
            y = side + repeats.SEED + int(np.argmin(np.concatenate([same[side + repeats.SEED:], [False]])))
            if y - x >= side + repeats.SEED:
                want[i] = (min(x, want.get(i, (x, y))[0]), max(y, want.get(i, (x, y))[1]))
    assert len(want) > 5 and len(rows) == len(want)
    assert {k: (x, y) for k, x, y in zip(rows.tolist(), lo.tolist(), hi.tolist())} == want


def nested_anchors(n, side, seed, docs=None):
    """Occurrences of one gram that agree with others over many lengths: (doc, pos, left, bytes, off)."""
    r = np.random.RandomState(seed)
    letters = lambda k: r.randint(97, 100, k).astype(np.uint8)
    lefts, rights, gram = [letters(side) for _ in range(3)], [letters(side) for _ in range(3)], letters(repeats.SEED)
    texts, left_n = [], []
    for _ in range(n):
        a, b = lefts[r.randint(3)].copy(), rights[r.randint(3)].copy()
        a[:r.randint(0, side + 1)], b[r.randint(0, side + 1):] = letters(1), letters(1)
        a, b = a[r.choice([0, 0, r.randint(0, side + 1)]):], b[:r.choice([side, side, r.randint(0, side + 1)])]
        texts.append(np.concatenate([a, gram, b]))
        left_n.append(len(a))
    left_n = np.array(left_n)
    return (np.arange(n) if docs is None else r.randint(0, docs, n)), left_n + r.randint(0, 9, n), left_n, np.concatenate(texts), np.cumsum([0, *map(len, texts)])


@pytest.mark.parametrize("chunk", [1, 7, 60])
def test_a_large_key_is_split_until_it_is_small(monkeypatch, chunk):
    """The same spans as of all rows at once, also when no group is small enough and texts repeat an id."""
    monkeypatch.setattr(repeats, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(repeats, "MATRIX_ROWS", 5)
    found = 0
    for seed in range(6):
        for n, docs in ((150, None), (90, 12), (40, 1)):
            doc, pos, left_n, data, off = nested_anchors(n, 30, seed, docs)
            want = [x.tolist() for x in repeats.cover(np.zeros(n, np.int64), doc, pos, left_n, data, off, 30 + repeats.SEED)[:3]]
            large = repeats.Large(30 + repeats.SEED)
            for i in range(0, n, 13):
                j = min(i + 13, n)
                large.add(doc[i:j], pos[i:j], left_n[i:j], data[off[i]:off[j]], off[i:j + 1] - off[i])
            assert [x.tolist() for x in large.cover()] == want
            found += len(want[0])
    assert found > 200
    # grams that only share a number
    large = repeats.Large(30 + repeats.SEED)
    for i in range(2 * chunk + 2):
        large.add(np.array([i]), np.array([0]), np.array([0]), np.frombuffer(bytes([97 + i % 2]) * 60, np.uint8), np.array([0, 60]))
    rows, lo, hi = (x.tolist() for x in large.cover())
    assert rows == list(range(2, 2 * chunk + 2)) and set(lo) == {0} and set(hi) == {50}


def test_nested_intervals_are_not_held():
    """Many rows that agree over many lengths: what is held grows with the rows, not with rows times lengths."""
    n, side = 2000, 180
    r = np.random.RandomState(1)
    texts = np.tile(r.randint(97, 123, 2 * side + repeats.SEED).astype(np.uint8), (n, 1))
    for i in range(n):  # the more alike, the fewer
        texts[i, side + repeats.SEED + i * side // n:] = r.randint(97, 123, side - i * side // n)
    rows = np.zeros(n, np.int64), np.arange(n), np.full(n, side), np.full(n, side), texts.reshape(-1), np.arange(n + 1) * texts.shape[1]
    tracemalloc.start()
    try:
        found = len(repeats.cover(*rows, side + repeats.SEED)[0])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == n - 1 and peak < 5000 * n


def test_more_rows_of_a_gram_than_a_task_holds(spark):
    """A passage between different neighbours in more texts than a chunk has rows."""
    r = random.Random(8)
    say = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage, n = say(60), repeats.CHUNK_ROWS + 2000
    rows = [(i, say(40) + passage + say(40)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {x["doc_id"]: x for x in repeats.repeat_report(df, 50).collect()}
    assert len(got) == n and got[0]["n_removed"] == 0
    # the letters beside the passage may be those of another text too
    assert all(x["n_spans"] == 1 and 60 <= x["n_removed"] < 80 for d, x in got.items() if d)
    some = [rows[0], *r.sample(rows[1:], 20)]
    for d, t in some[1:]:
        left = max(k for k in range(40) if any(t[40 - k:100] in u for _, u in rows[:d]))
        right = max(k for k in range(40) if any(t[40:100 + k] in u for _, u in rows[:d]))
        assert got[d]["n_removed"] == 60 + left + right


def test_linked_stars_against_plain_sets():
    r = np.random.RandomState(0)
    for _ in range(60):
        m, base = r.randint(2, 40), r.randint(0, 10**9, 60)
        sets = [np.unique(np.where(r.rand(60) < r.choice([.02, .1, .3]), r.randint(0, 10**9, 60), base)) for _ in range(m)]
        start = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        a, b = near_dups.linked_stars(np.arange(m) * 7, start, np.concatenate(sets), 80)
        label = list(range(m))
        for i in range(m):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    x, y = max(label[i], label[j]), min(label[i], label[j])
                    label = [y if k == x else k for k in label]
        assert set(zip(a.tolist(), b.tolist())) == {(7 * i, 7 * k) for i, k in enumerate(label) if i != k}
