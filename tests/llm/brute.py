"""Plain-Python versions of the text operators' contracts, for small tables."""

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile("[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    return WORD.findall((text or "").translate(LOW) if lower else text or "")


def fold(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text, lower=False)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    runs = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = collections.Counter(runs)
    cover = {i + j for i, r in enumerate(runs) if n[r] > 1 for j in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cover)


def shingle_set(text, k):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def near_duplicates(rows, k, percent):
    """(doc_id, n_shingles, component_id) per row of (doc_id, text)."""
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return [(d, len(s), None if d is None else low[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def repeats(rows, min_len):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row."""
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - min_len + 1):
            if d is not None:
                w = b[s:s + min_len]
                first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - min_len + 1):
            if d is not None and first[b[s:s + min_len]] < d:
                gone[s:s + min_len] = b"\1" * min_len
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def contamination(docs, items, percent=80):
    """{(doc_id, item_id): (similarity, first word, words)} of best windows."""
    best = {}
    for d, t in docs:
        w = words(t)
        for item, it in items:
            iw = words(it)
            n = len(iw)
            k = min(5, n)
            if item is None or not n:
                continue
            c = collections.Counter(tuple(iw[j:j + k]) for j in range(n - k + 1))
            size = min(n, len(w))  # a shorter text is one window
            for a in range(len(w) - size + 1):
                x = collections.Counter(tuple(w[a + j:a + j + k]) for j in range(size - k + 1))
                sim = sum((x & c).values()) / sum((x | c).values())
                if 100 * sim >= percent - 1e-9 and (-sim, a) < (-best.get((d, item), (0,))[0], best.get((d, item), (0, 1e9))[1]):
                    best[d, item] = (sim, a, size)
    return best


def base_scores(rows, n_folds=7, out_fold=2):
    """(n_tokens, n_known, train_tokens, base_score) per row."""
    tokens = [words(t) + [None] for _, t in rows]
    count = collections.Counter()
    for (d, _), t in zip(rows, tokens):
        if fold(d, n_folds) != out_fold:
            count.update(t)
    n, v = sum(count.values()), len(count)
    return [(len(t), sum(count[w] > 0 for w in t), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t)) for t in tokens]


ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LETTERS = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def resampling(docs, target, min_n=1, max_n=1, buckets=10_000, seed=2024, percent=10, min_words=20):
    """(doc_id, n_features, weight, score, rank) per row."""
    def features(text):
        w = ALNUM.findall((text or "").translate(LOW))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(min_n, max_n + 1) for i in range(len(w) - n + 1)]

    own = [features(t) for _, t in docs]
    s = collections.Counter(b for _, f in own for b in f)
    t = collections.Counter(b for text in target for b in features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log(float(t[b] + 1) * float(all_s + buckets) / (float(s[b] + 1) * float(all_t + buckets)))) for b in s}
    rows = []
    for (d, _), (n, f) in zip(docs, own):
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(fit[:percent * len(fit) // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in rows]


def divergence(docs, min_docs=10, top=10):
    """(lang, source, part, item, value, rank) over (lang, source, text) rows."""
    n, df, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        w = LETTERS.findall((text or "").translate(LOW))
        groups.add((lang, source))
        n[lang, source].update(w)
        df[lang].update(set(w))
    out = []
    for lang in {g[0] for g in groups}:
        terms = [t for t, c in df[lang].items() if c >= min_docs]
        mine = sorted(g[1] for g in groups if g[0] == lang)

        def shares(counts):
            total = sum(counts[t] for t in terms)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(terms)) for t in terms}

        q = shares(sum((n[lang, s] for s in mine), collections.Counter()))
        p = {s: shares(n[lang, s]) for s in mine}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in mine:
            pair = [(sum(f(p[s][t], p[o][t]) for t in terms), o) for o in mine if o != s]
            term = [(f(p[s][t], q[t]), t) for t in terms if n[lang, s][t] and p[s][t] > q[t]]
            for part, rows, limit in (("pair", pair, None), ("term", term, top)):
                rows = sorted(rows, key=lambda r: (-r[0], r[1].encode()))[:limit]
                out += [(lang, s, part, o, v, i + 1) for i, (v, o) in enumerate(rows)]
    return out
