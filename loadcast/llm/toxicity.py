"""Toxicity: class-conditional Kneser-Ney models.

An expression is a word, spelled byte by byte between two spaces. Each class,
toxic and ordinary, has its own counts of a byte after its longest context (up to
``ORDER`` bytes, mostly the whole beginning of the word). Both back off to the
same shared counts: first those of that context pooled over the classes, then
Kneser-Ney continuation counts (in how many distinct longer contexts a byte
follows) of contexts of ``SHORT`` to 0 bytes. An expression that a class has
hardly seen is thus smoothed to what both classes have in common, and only what
the classes really differ in moves the comparison. A document is judged by its toxic minus its ordinary log-likelihood,
normalised by length: per word over the whole text, and per word in its most
toxic window of ``WINDOW`` words and its most toxic word, so that one insult in a
long text is not averaged away. A logistic curve over these three turns them into
a score.

Counts cover all labelled rows that are not held out, and every gram of them
stays in the model, however rare. The work is done by distinct word: a lexicon has
every word of the texts once, with its counts, packed in parts of words that begin
alike. A part knows the longer contexts of its words in full, and asks for the ratios
of its counted grams and of those after shorter contexts; the grams that end their contexts in
the same two bytes meet in one group, which has all that a ratio depends on but the
shared counts of contexts of one byte and none (at most 65,536 sums, broadcast). The
ratio of a word is then the sum of its grams'. Up to ``broadcast_words`` words are
broadcast to the texts (a parameter); above that texts are dealt to slices of about
``SLICE_TEXT`` bytes by hash, and a slice's distinct words are joined to their ratios.
The curve is fitted across two halves of
the labelled rows, each judged by the counts of the other, on a hash sample of
about ``curve_rows`` rows (a parameter). Labels are broadcast up to
``broadcast_labels`` rows (16 bytes each); above that the join is a shuffle.

Nulls and odd input: null or empty texts have differences of 0 and get the score
that the curve gives to 0; labels with null id or value, and documents labelled
both ways, are not learned from; without both classes every score is the share of
toxic labels (0 without labels); each input row gives one row, also when an id
repeats; a null doc_id counts as '' for the fold. Only the text enters a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from loadcast.llm.common import cut, free_name, prepare, slot, stored, table
from loadcast.llm.textnp import distinct_words, grams, mix, slices, span_hashes, spelled, text_buffer, words

ORDER = 14
SHORT = 6
DISCOUNT = 0.75
SHARED_WEIGHT = 20.0
CLEAR = 2.5  # difference in nats from which a word counts as a likely insult
WINDOW = 12
CURVE_ROWS = 20_000
BROADCAST_LABELS = 2_000_000
SLICE_BYTES = 1 << 20
SLICE_TEXT = 32 << 20
BROADCAST_WORDS = 4_000_000  # 16 bytes each
PART_TEXT = 16 << 20
RUN_WORDS = 50_000
FLUSH_WORDS = 400_000
FLUSH_BYTES = 16 << 20
BEGIN = 4  # bytes of a word that decide on its part of the lexicon
TAILS = 16  # groups of tails, times the root of the parts: their product has a row each
DIFFERENCES = ["mean_diff", "window_diff", "word_diff", "clear_diff"]


def clear_labels(labels: DataFrame) -> DataFrame:
    """(label_id, y) of the documents with an unambiguous label."""
    return (labels.filter("doc_id is not null and toxic is not null")
            .groupBy(F.col("doc_id").cast("long").alias("label_id"))
            .agg(F.min("toxic").alias("y"), F.max("toxic").alias("y2")).filter("y = y2").select("label_id", "y"))


def contexts(data: np.ndarray, word: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every byte after the first of a word: its index, (hash of its longest
    context, byte) in 56 + 8 bits, and the gram of its last ``SHORT`` bytes."""
    i, short = grams(data, word, SHORT)
    start = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1]) if len(word) else np.zeros(0, np.int64)
    begin = np.maximum(start[word[i]], i - order)
    ctx = span_hashes(data, begin, i, lower=False)
    return i, (ctx & ~np.uint64(255)) | data[i], short


GROUPS = ["ordinary0", "toxic0", "ordinary1", "toxic1"]
MODELS = 3  # counts of half 1, of half 0, of both
COUNTS = len(GROUPS) + 1  # and those in rows that the curve is fitted on


def shut(*arrays: np.ndarray) -> bytes:
    """The arrays, one after the other, compressed."""
    return pa.compress(b"".join(a.tobytes() for a in arrays), codec="zstd", asbytes=True)


def opened(value: pa.Scalar, size: int) -> np.ndarray:
    """The bytes of :func:`shut`."""
    return np.frombuffer(pa.decompress(value.as_buffer(), size, codec="zstd"), np.uint8)


def opened_words(rows: pa.Table | pa.RecordBatch):
    """(buffer of spaced words, counts by word) of each row of a lexicon."""
    for n, size, value in zip(rows.column("n").to_pylist(), rows.column("size").to_pylist(), rows.column("words")):
        raw = opened(value, n * COUNTS * 8 + size)
        yield raw[n * COUNTS * 8:], raw[:n * COUNTS * 8].view(np.int64).reshape(COUNTS, n).T


def opened_grams(rows: pa.Table | pa.RecordBatch):
    """(gram, short, counts) of each row of :func:`asked_grams`."""
    for n, value in zip(rows.column("n").to_pylist(), rows.column("grams")):
        raw = opened(value, n * (len(GROUPS) + 2) * 8).view(np.int64).reshape(-1, n)
        yield raw[0].view(np.uint64), raw[1], list(raw[2:])


def parts_of(docs: DataFrame, bytes_each: int = SLICE_TEXT) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return max(1, -(-size // bytes_each))


def lexicon(rows: DataFrame, parts: int) -> DataFrame:
    """(part, n, size, words): all distinct words of (text, half, y, curve), lower-cased,
    with their counts by class and half, 0 where ``y`` is null, and those in rows for
    which ``curve`` holds. A part has one row, packed as :func:`opened_words` reads it."""
    names = ["part", "n", "size", "words"]

    def merged(buf, counts):
        """(buffer, start, end, part, counts) of the distinct words, sorted by part."""
        s, e, _ = words(buf, np.array([0, len(buf)]))
        h = [span_hashes(buf[s[x]:e[y - 1]], s[x:y] - s[x], e[x:y] - s[x], lower=False) for x, y in runs(len(s))]
        _, first, inv = np.unique(np.concatenate(h), return_index=True, return_inverse=True)
        sums = np.column_stack([np.bincount(inv, counts[:, c], minlength=len(first)) for c in range(COUNTS)]).astype(np.int64)
        s, e = s[first], e[first]
        key = np.zeros(len(s), np.uint64)  # words that begin alike stand together, which packs them
        for j in range(8):
            key = (key << np.uint64(8)) | np.where(s + j < e, buf[np.minimum(s + j, len(buf) - 1)], 0).astype(np.uint64)
        part = (mix(key >> np.uint64(64 - 8 * BEGIN)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((key, part))
        return buf, s[order], e[order], part[order], sums[order]

    def runs(n):
        return [(x, min(x + RUN_WORDS, n)) for x in range(0, n, RUN_WORDS)]

    def packed(buf, s, e, part, counts):
        out = []
        for p, x, y in zip(*np.unique(part, return_index=True), [*np.flatnonzero(np.diff(part)) + 1, len(part)]):
            data = spelled(buf, s[x:y], e[x:y])[0]
            out.append((int(p), int(y - x), len(data), shut(counts[x:y].T, data)))
        return [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]

    def run(batches):
        held, n, size = [], 0, 0

        def flush():
            return pa.RecordBatch.from_arrays(packed(*merged(*map(np.concatenate, zip(*held)))), names)

        for batch, buf, off in slices(batches, "text", SLICE_BYTES):
            half, y = (np.asarray(batch.column(c).cast(pa.int64()).fill_null(0)) for c in ("half", "y"))
            group = np.where(np.asarray(batch.column("y").is_valid()), half * 2 + (y > 0), -1)
            curve = np.asarray(batch.column("curve").fill_null(False))
            s, e, prow, pword, pn = distinct_words(buf, off, lower=True)
            if not len(s):
                continue
            by = [np.bincount(pword, pn * mine[prow], minlength=len(s)) for mine in (*[group == c for c in range(len(GROUPS))], curve)]
            data = spelled(buf, s, e, lower=True)[0]
            held.append((data, np.column_stack(by)))
            n, size = n + len(s), size + len(data)
            if n > FLUSH_WORDS or size > FLUSH_BYTES:  # words of several slices are held once, from here on
                buf, s, e, _, counts = merged(*map(np.concatenate, zip(*held)))
                held = [(np.concatenate([spelled(buf, s[x:y], e[x:y])[0] for x, y in runs(len(s))]), counts)]
                n, size = len(s), len(held[0][0])
            if n > FLUSH_WORDS // 2 and len(held) == 1 or size > FLUSH_BYTES:
                yield flush()
                held, n, size = [], 0, 0
        if held:
            yield flush()

    def merge(group):
        return pa.Table.from_arrays(packed(*merged(*map(np.concatenate, zip(*opened_words(group))))), names)

    schema = "part long, n long, size long, words binary"
    return rows.select("text", "half", "y", "curve").mapInArrow(run, schema).groupBy("part").applyInArrow(merge, schema)


def lexicon_grams(buf: np.ndarray, counts: np.ndarray, groups: int, order: int = ORDER):
    """Of one part of a lexicon: (start, end) of its words, the word and number of the
    gram of each of their bytes, the distinct grams (gram, short, counts), and the numbers
    of those that the part has to ask for: all but those without counts whose context
    has the ``BEGIN`` bytes that keep all its words in one part. These come by their
    tail, below ``groups``, which is given too."""
    s, e, _ = words(buf, np.array([0, len(buf)]))
    data, word = spelled(buf, s, e)
    i, key, short = contexts(data, word, order)
    u, first, inv = np.unique(key, return_index=True, return_inverse=True)
    sums = [np.bincount(inv, counts[word[i], c], minlength=len(u)).astype(np.int64) for c in range(len(GROUPS))]
    start = np.concatenate([[0], np.cumsum(e - s + 2)])
    depth, short = (i - start[word[i]])[first], short[first]
    tail = (mix(tails(short).astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
    ask = np.flatnonzero((depth <= BEGIN) | (depth > order) | (sum(sums) > 0))
    ask = ask[np.lexsort((short[ask], tail[ask]))]
    return (s, e), word[i], inv, (u, short, sums), ask, tail[ask]


def tails(short: np.ndarray) -> np.ndarray:
    """The last two bytes of each gram's context; one number for all contexts of one."""
    return np.where(short >> 56 > 1, (short >> 8) & 0xFFFF, 1 << 16)


def asked_grams(lex: DataFrame, groups: int, order: int = ORDER) -> DataFrame:
    """(part, tail, n, grams): the distinct grams that every part of a lexicon has to ask
    for; those whose contexts end alike have the same ``tail``, below ``groups``. A part
    has one row for a tail, packed as :func:`opened_grams` reads it."""
    def run(batches):
        for batch in batches:
            for part, (buf, counts) in zip(batch.column("part").to_pylist(), opened_words(batch)):
                *_, (u, short, sums), ask, tail = lexicon_grams(buf, counts, groups, order)
                edge = [*np.unique(tail, return_index=True)[1], len(tail)]
                at = [ask[x:y] for x, y in zip(edge, edge[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(at), pa.int64()), pa.array(tail[edge[:-1]]), pa.array([len(k) for k in at], pa.int64()),
                     pa.array([shut(u[k], short[k], *[c[k] for c in sums]) for k in at], pa.binary())], ["part", "tail", "n", "grams"])

    return lex.mapInArrow(run, "part long, tail long, n long, grams binary")


def gram_rows(asked: DataFrame) -> DataFrame:
    """(gram, short, counts by class and half) of all grams asked for."""
    def run(batches):
        for batch in batches:
            for u, short, sums in opened_grams(batch):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(short), *map(pa.array, sums)], ["gram", "short", *GROUPS])

    return asked.mapInArrow(run, "gram long, short long, " + ", ".join(f"{c} long" for c in GROUPS))


def count_grams(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, short, counts by class and half): how often a byte follows its
    longest context, over the words of all rows of (text, half, y)."""
    parts = parts_of(rows, PART_TEXT)
    lex = lexicon(rows.select("text", "half", "y", F.lit(False).alias("curve")), parts)
    return gram_rows(asked_grams(lex, 1, order)).groupBy("gram", "short").agg(*[F.sum(c).alias(c) for c in GROUPS])


class Level:
    """Counts of bytes after contexts, as sorted tables."""

    def __init__(self, gram: np.ndarray, count: np.ndarray):
        k = np.argsort(gram)
        self.gram, self.count = gram[k], count[k].astype(np.float64)
        self.ctx, first, size = np.unique(self.gram >> 8, return_index=True, return_counts=True)
        self.types = size.astype(np.float64)
        self.total = np.add.reduceat(self.count, first) if len(first) else np.zeros(0)

    @staticmethod
    def at(table, values, key):
        if not len(table):
            return np.zeros(len(key))
        at = np.minimum(np.searchsorted(table, key), len(table) - 1)
        return np.where(table[at] == key, values[at], 0.0)

    def smooth(self, gram: np.ndarray, backoff: np.ndarray, weight: float = 0.0) -> np.ndarray:
        """Kneser-Ney probability of each gram's byte after its context."""
        ctx = gram >> 8
        n, total, types = self.at(self.gram, self.count, gram), self.at(self.ctx, self.total, ctx), self.at(self.ctx, self.types, ctx)
        size = total + weight
        p = (np.maximum(n - DISCOUNT, 0) + (DISCOUNT * types + weight) * backoff) / np.maximum(size, 1e-9)
        return np.where(size > 0, p, backoff)


def unseen(classes: list[Level], ctx: np.ndarray) -> np.ndarray:
    """Ratio of a byte that was not counted in the context, of (toxic, ordinary)."""
    rest = [np.log((DISCOUNT * c.at(c.ctx, c.types, ctx) + SHARED_WEIGHT) / (c.at(c.ctx, c.total, ctx) + SHARED_WEIGHT)) for c in classes]
    return (rest[0] - rest[1]).astype(np.float32)


class Ratio:
    """Log-likelihood ratio of a byte after its context, toxic to ordinary.

    Both classes back off to the same probability, so for a byte that neither has
    in a context it cancels out: what is left depends on the context only, and is
    0 where that is unknown. The model is therefore two tables: a ratio per counted
    gram, and one per context. This is the form for counts that fit one process,
    or for all grams of some ``tails``, with what is ``low`` under them."""

    def __init__(self, gram: np.ndarray, short: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, low: np.ndarray | None = None):
        k = np.argsort(gram)
        gram, short, counts = gram[k], short[k], [toxic[k].astype(np.float64), ordinary[k].astype(np.float64)]
        shared = Level(gram, counts[0] + counts[1]).smooth(gram, continuation(short, low))
        classes = [Level(gram[c > 0], c[c > 0]) for c in counts]
        at_gram = [np.log(c.smooth(gram, shared, SHARED_WEIGHT)) for c in classes]
        ctx = np.unique(gram >> 8)
        self.gram, self.value = gram, (at_gram[0] - at_gram[1]).astype(np.float32)
        self.ctx, self.other = ctx, unseen(classes, ctx)

    def __call__(self, gram: np.ndarray) -> np.ndarray:
        if not len(self.gram):
            return np.zeros(len(gram))
        at = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        return np.where(self.gram[at] == gram, self.value[at], Level.at(self.ctx, self.other, gram >> 8))


def continuation(short: np.ndarray, low: np.ndarray | None = None) -> np.ndarray:
    """Shared Kneser-Ney probability of each gram's byte after ``SHORT`` bytes. That
    after one byte may be given, by (byte, byte)."""
    key, depth = short & ((1 << 56) - 1), short >> 56
    mask = lambda o: (1 << 8 * (o + 1)) - 1
    levels, k, d = [], key, depth
    least = 0 if low is None else 2
    for o in range(SHORT, least - 1, -1):
        # distinct longer contexts are counted; words' beginnings have none
        take = d >= o
        u, n = np.unique(k[take] & mask(o), return_counts=True)
        levels.append(Level(u, n))
        k, d = np.concatenate([u, k[~take]]), np.concatenate([np.full(len(u), o), d[~take]])
    p = np.full(len(short), 1 / 256) if low is None else low[key & mask(1)]
    for o, level in enumerate(reversed(levels), least):
        deep = np.flatnonzero(depth >= o)
        p[deep] = level.smooth(key[deep] & mask(o), p[deep])
    return p


def by_model(ordinary0, toxic0, ordinary1, toxic1):
    """(toxic, ordinary) counts of each model."""
    return [(toxic1, ordinary1), (toxic0, ordinary0), (toxic0 + toxic1, ordinary0 + ordinary1)]


NODES = "node long, " + ", ".join(f"h{m} boolean" for m in range(MODELS))


def nodes(short: np.ndarray, counts: list[np.ndarray]) -> pa.RecordBatch:
    """(node, whether each model counts it): the distinct contexts of two bytes, with
    the byte after them; words' beginnings, which have none, stand for themselves."""
    u, inv = np.unique(np.where(short >> 56 > 1, short & 0xFFFFFF, (short & 0xFFFF) | (1 << 24)), return_inverse=True)
    has = [np.bincount(inv, t + o, minlength=len(u)) > 0 for t, o in by_model(*counts)]
    return pa.RecordBatch.from_arrays([pa.array(u), *map(pa.array, has)], ["node", *[f"h{m}" for m in range(MODELS)]])


def low_levels(parts: DataFrame) -> np.ndarray:
    """By model and (byte, byte): what :func:`continuation` has after one byte, of all
    rows of :func:`nodes`."""
    nodes = parts.groupBy("node").agg(*[F.max(f"h{m}").cast("long").alias(f"h{m}") for m in range(MODELS)])
    one = (nodes.groupBy(F.col("node").bitwiseAND(F.lit(0xFFFF)).alias("key"))
           .agg(*[F.sum(f"h{m}").alias(f"h{m}") for m in range(MODELS)]).toPandas())
    key, out = one["key"].to_numpy().astype(np.int64), np.full((MODELS, 1 << 16), 1 / 256)
    every = np.arange(1 << 16)
    for m in range(MODELS):
        n = one[f"h{m}"].to_numpy().astype(np.int64)
        have = key[n > 0]
        zero = Level(*np.unique(have & 255, return_counts=True)).smooth(every & 255, out[m])
        out[m] = Level(have, n[n > 0]).smooth(every, zero)
    return out


def differences(buf: np.ndarray, off: np.ndarray, ratio: Looked) -> np.ndarray:
    """Per row: (per word over the text, best window, best word, sum of what
    likely insults have above ``CLEAR``)."""
    n = len(off) - 1
    out = np.zeros((n, 4))
    s, e, row = words(buf, off)
    if not len(s):
        return out
    u, inv = np.unique(span_hashes(buf, s, e), return_inverse=True)
    each = ratio(u)[inv]
    count = np.bincount(row, minlength=n)
    has = np.flatnonzero(count)
    out[:, 0] = np.bincount(row, each, minlength=n) / np.maximum(count, 1)
    begin = np.searchsorted(row, has)
    out[has, 2] = np.maximum.reduceat(each, begin)
    out[:, 3] = np.bincount(row, np.maximum(each - CLEAR, 0), minlength=n)
    total = np.concatenate([[0.0], np.cumsum(each)])
    to = np.minimum(np.arange(len(s)) + WINDOW, (begin + count[has])[np.searchsorted(has, row)])
    window = (total[to] - total[:-1]) / WINDOW
    out[has, 1] = np.maximum.reduceat(window, begin)
    return out


class Looked:
    """Ratios of words by their sorted hashes, looked up before."""

    def __init__(self, word: np.ndarray, value: np.ndarray):
        self.word, self.value = word, value

    def __call__(self, word: np.ndarray) -> np.ndarray:
        return Level.at(self.word, self.value, word)


def ratios_of(gram: np.ndarray, short: np.ndarray, counts: list[np.ndarray], low: np.ndarray) -> tuple[np.ndarray, list[Ratio], np.ndarray]:
    """(distinct grams, ratio under each model, number of each row's gram) of all rows
    of some tails."""
    u, first, inv = np.unique(gram, return_index=True, return_inverse=True)
    n = [np.bincount(inv, c, minlength=len(u)) for c in counts]
    out = []
    for m, (t, o) in enumerate(by_model(*n)):
        seen = t + o > 0
        out.append(Ratio(u[seen], short[first[seen]], t[seen], o[seen], low[m]))
    return u, out, inv


def ratio_table(counts: DataFrame) -> DataFrame:
    """(ctx, other, grams): per context the ratio of a byte that was not counted in
    it, and (gram, value) of those that were, each an array over the models. What
    :class:`Ratio` gives, over all counts of (gram, short, GROUPS)."""
    def of_counts(batches):
        for batch in batches:
            yield nodes(batch.column("short").to_numpy(), [batch.column(c).to_numpy() for c in GROUPS])

    low = counts.sparkSession.sparkContext.broadcast(low_levels(counts.select("short", *GROUPS).mapInArrow(of_counts, NODES)))

    def run(group):
        column = lambda c: group.column(c).to_numpy()
        u, ratios, _ = ratios_of(column("gram").view(np.uint64), column("short"), [column(c) for c in GROUPS], low.value)
        ctx = u >> np.uint64(8)
        # byte 0 is never counted
        cols = [*[r(u) for r in ratios], *[r(ctx << np.uint64(8)) for r in ratios]]
        return pa.Table.from_arrays([pa.array(ctx.view(np.int64)), pa.array(u.view(np.int64)), *[pa.array(np.asarray(c, np.float32)) for c in cols]],
                                    ["ctx", "gram", *[f"{k}{m}" for k in "vo" for m in range(MODELS)]])

    tail = F.when(F.shiftright("short", 56) > 1, F.shiftright("short", 8).bitwiseAND(F.lit(0xFFFF))).otherwise(1 << 16)
    rows = counts.groupBy(tail.alias("tail")).applyInArrow(
        run, "ctx long, gram long, " + ", ".join(f"{k}{m} float" for k in "vo" for m in range(MODELS)))
    arrays = [F.array(*[f"{k}{m}" for m in range(MODELS)]) for k in "vo"]
    return rows.groupBy("ctx").agg(F.first(arrays[1]).alias("other"), F.collect_list(F.struct("gram", arrays[0].alias("value"))).alias("grams"))


def word_ratios(lex: DataFrame, parts: int) -> DataFrame:
    """(word, v0 to v2): ratio of every word of a lexicon under each model; under the
    counts of one half, of words in rows that the curve is fitted on."""
    groups = int(np.ceil(TAILS * parts ** 0.5))
    asked = asked_grams(lex, groups)

    # one worker for a task here: each more in a row would be there at the same time
    def of_lexicon(batches):
        for batch in batches:
            for buf, counts in opened_words(batch):
                _, short, sums = lexicon_grams(buf, counts, groups)[3]
                yield nodes(short, sums)

    low = lex.sparkSession.sparkContext.broadcast(low_levels(lex.mapInArrow(of_lexicon, NODES)))

    def answer(group):
        every = list(opened_grams(group))
        u, ratios, inv = ratios_of(np.concatenate([g[0] for g in every]), np.concatenate([g[1] for g in every]),
                                   [np.concatenate(c) for c in zip(*[g[2] for g in every])], low.value)
        value = [np.asarray(r(u), np.float32)[inv] for r in ratios]
        edge = np.cumsum([0, *[len(g[0]) for g in every]])
        values = pa.array([shut(*[v[x:y] for v in value]) for x, y in zip(edge, edge[1:])], pa.binary())
        return pa.Table.from_arrays([group.column("part"), group.column("tail"), group.column("n"), values], ["part", "tail", "n", "ratios"])

    def add(left, right):
        out = []
        right = right.sort_by("tail")
        got = [opened(x, n * MODELS * 4).view(np.float32).reshape(MODELS, n) for n, x in zip(right.column("n").to_pylist(), right.column("ratios"))]
        got = np.concatenate(got, axis=1)
        for buf, counts in opened_words(left):
            (s, e), word, inv, (u, _, sums), ask, _ = lexicon_grams(buf, counts, groups)
            each = []
            for m, (t, o) in enumerate(by_model(*sums)):
                value = unseen([Level(u[c > 0], c[c > 0]) for c in (t, o)], u >> np.uint64(8))
                value[ask] = got[m]
                each.append(pa.array(np.bincount(word, value[inv], minlength=len(s)), mask=None if m == MODELS - 1 else counts[:, -1] == 0))
            out.append(pa.RecordBatch.from_arrays([pa.array(span_hashes(buf, s, e).view(np.int64)), *each],
                                                  ["word", *[f"v{m}" for m in range(MODELS)]]))
        return pa.Table.from_batches(out) if out else empty

    schema = "word long, " + ", ".join(f"v{m} double" for m in range(MODELS))
    empty = to_arrow_schema(StructType.fromDDL(schema)).empty_table()
    found = asked.groupBy("tail").applyInArrow(answer, "part long, tail long, n long, ratios binary")
    return lex.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(add, schema)


class Ratios:
    """Ratios of words under some models; below a counted size also as broadcast arrays."""

    def __init__(self, table: DataFrame, models: list[int], broadcast_words: int):
        self.table, self.near = table.select("word", *[f"v{m}" for m in models]), None
        if table.count() <= broadcast_words:
            rows = self.table.toPandas()
            word = rows["word"].to_numpy().view(np.uint64)
            order = np.argsort(word)
            self.near = table.sparkSession.sparkContext.broadcast((word[order], {m: rows[f"v{m}"].to_numpy()[order] for m in models}))


def judged(docs: DataFrame, ratios: Ratios, model: Column, keep: list[str], finish, schema, slice_text: int = SLICE_TEXT) -> DataFrame:
    """``finish(rows, differences)`` of every row of ``docs`` under the ``model``
    (a column: 0 to 2) of its row. Texts stay where they are if the ratios are
    broadcast, else they are shuffled once, to their slices."""
    text, by_col, part_of = (free_name(x, keep) for x in ("judged_text", "judged_by", "judged_slice"))
    if "text" in keep and dict(docs.dtypes)["text"] == "string":
        text = "text"  # no second copy of it
    named = [F.col("text").cast("string").alias(text)] if text not in keep else []
    rows = docs.select(*keep, *named, model.cast("int").alias(by_col))

    def each_slice(batches, ratio_of):
        for batch, buf, off in slices(batches, text, SLICE_BYTES):
            by = np.asarray(batch.column(by_col))
            d = np.zeros((len(by), 4))
            for m in np.unique(by):
                d[by == m] = differences(buf, off, ratio_of(m))[by == m]
            yield finish(batch, d)

    if ratios.near is not None:
        near = ratios.near

        def broadcast_to(batches):
            word, value = near.value
            yield from each_slice(batches, lambda m: Looked(word, value[m]))

        return rows.mapInArrow(broadcast_to, schema)

    n = parts_of(docs, slice_text)
    rows = (docs.select(*keep, *named, model.cast("int").alias(by_col), F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).alias(part_of)).repartition(n, part_of))

    def used(batches):
        held, size = {}, 0

        def flush():
            for part, keys in held.items():
                u = np.unique(np.concatenate(keys)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), part)), pa.array(u)], ["judged_slice", "need"])

        for batch, buf, off in slices(batches, text, SLICE_BYTES):
            part = np.asarray(batch.column(part_of))
            s, e, row = words(buf, off)
            h = span_hashes(buf, s, e)
            for p in np.unique(part):
                held.setdefault(p, []).append(u := np.unique(h[(part == p)[row]]))
                size += len(u)
            if size > 10 * FLUSH_WORDS:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    need = rows.mapInArrow(used, "judged_slice long, need long").distinct()
    found = need.join(ratios.table.withColumnRenamed("word", "need"), "need")

    def judge(left, right):
        word = right.column("need").to_numpy().view(np.uint64)
        order, models = np.argsort(word), {}

        def ratio_of(m):
            if m not in models:
                models[m] = Looked(word[order], right.column(f"v{m}").to_numpy()[order])
            return models[m]

        out = list(each_slice(left.to_batches(), ratio_of))
        return pa.Table.from_batches(out) if out else empty

    empty = to_arrow_schema(schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).empty_table()
    return rows.groupBy(part_of).cogroup(found.groupBy("judged_slice")).applyInArrow(judge, schema)


class Curve:
    """Logistic curve over the squashed differences."""

    def __init__(self, weight: np.ndarray, base: float):
        self.weight, self.base = weight, base

    @staticmethod
    def inputs(d: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(d)), np.clip(d[:, 0] * 10, -5, 5), np.clip(d[:, 1], -3, 6), np.clip(d[:, 2] / 3, -3, 6),
                                np.minimum(np.log1p(d[:, 3]), 4)])

    def __call__(self, d: np.ndarray) -> np.ndarray:
        if self.weight is None:
            return np.full(len(d), self.base)
        return 1 / (1 + np.exp(-np.clip(self.inputs(d) @ self.weight, -40, 40)))

    @classmethod
    def fit(cls, d: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> "Curve":
        if len(y) == 0 or y.min() == y.max():
            return cls(None, float(y.mean()) if len(y) else 0.0)
        x, w = cls.inputs(d), np.zeros(5)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
            g = x.T @ (y - p) - ridge * w
            h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(5)
            step = np.linalg.solve(h, g)
            w = w + step
            if np.abs(step).max() < 1e-8:
                break
        return cls(w, 0.0)


def train(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, curve_rows: int = CURVE_ROWS,
          broadcast_labels: int = BROADCAST_LABELS, broadcast_words: int = BROADCAST_WORDS) -> tuple[Ratios, Curve]:
    """Ratios of all words of ``docs`` and the curve, from its labelled rows for which
    ``held_out`` does not hold."""
    prepare(docs.sparkSession, SLICE_BYTES)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       (F.lit(True) if held_out is None else ~held_out).alias("learn"))
    lab = cut(clear_labels(labels))
    n_labels = lab.count()
    near = F.broadcast(lab) if n_labels <= broadcast_labels else lab
    rows = (base.join(near, F.col("doc_id") == F.col("label_id"), "left")
            .withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2))).withColumn("y", F.when(F.col("learn"), F.col("y"))))
    curve = F.col("y").isNotNull()
    if n_labels > curve_rows:
        curve &= F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < int((1 << 20) * curve_rows / n_labels)
    parts = parts_of(base, PART_TEXT)
    by_word = stored(word_ratios(stored(lexicon(rows.withColumn("curve", curve), parts)), parts))
    some = base.filter("learn").join(near, F.col("doc_id") == F.col("label_id")).withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)))
    halves = Ratios(by_word.filter("v0 is not null"), [0, 1], broadcast_words)

    def finish(batch, d):
        return pa.RecordBatch.from_arrays([batch.column("y").cast(pa.int64()), *[pa.array(x) for x in d.T]], ["y", *DIFFERENCES])

    # each half is judged by the counts of the other
    fit = judged(some.filter(curve), halves, F.col("half"), ["y"], finish, "y long, " + ", ".join(f"{c} double" for c in DIFFERENCES)).toPandas()
    if halves.near is not None:
        halves.near.destroy()
    ratios = Ratios(by_word, [MODELS - 1], broadcast_words)
    return ratios, Curve.fit(fit[DIFFERENCES].to_numpy(), (fit["y"].to_numpy() > 0).astype(float))


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, **how) -> DataFrame:
    """(doc_id, differences, score, predicted) of every row; rows for which
    ``held_out`` holds are never learned from."""
    base = docs.select("doc_id", "text")
    ratios, curve = train(base, labels, held_out, **how)
    rows = base.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def finish(batch, d):
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x) for x in d.T], pa.array(curve(d))],
                                          ["doc_id", *DIFFERENCES, "score"])

    schema = ", ".join(["doc_id long", *[f"{c} double" for c in DIFFERENCES], "score double"])
    return (judged(rows, ratios, F.lit(MODELS - 1), ["doc_id"], finish, schema)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    ratios, curve = train(docs.select("doc_id", "text"), labels, **how)
    columns = docs.columns

    def finish(batch, d):
        return batch.select(columns).filter(pa.array(curve(d) < 0.5))

    return judged(docs, ratios, F.lit(MODELS - 1), columns, finish, docs.schema)


def op1(spark, sf_dir):
    held = slot("doc_id", 5) == 0
    return (toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held)
            .withColumn("held_out", held))


QUERIES = {"op1_toxicity_kneser_ney": op1}
ORACLES: dict[str, str] = {}
