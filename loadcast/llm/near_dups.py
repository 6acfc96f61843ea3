"""MinHash near-duplicates by min-max hashing.

Per text, the set of its distinct word shingles is hashed under K permutations,
and both the minimum and the maximum of each are kept: 2K signature values for K
hash evaluations. Signatures are cut into bands; with the defaults (30 bands of
5 values, from 75 permutations) a pair at similarity 0.85 shares no band with
probability 2e-8, and for lower thresholds bands have 4 values (1e-7 at 0.8).

1. Equal sets are one node (128-bit fingerprint and size); the smallest doc_id
   stands for it, so a group of exact copies, however large, is one node.
2. Nodes that share a band are linked to the band's smallest node -- an aggregate
   and a join, never pairs within a band -- and the connected components of these
   links are the candidate clusters. Every pair that shares a band lies in one
   cluster, and a node is in one cluster only, so its text is read and shuffled
   once however many bands it shares.
3. Within a cluster all pairs are compared exactly on full sets: intersections
   are a blocked matrix product over the shingles that many members share, plus
   the few pairs of rare shingles. A cluster above ``block_rows`` nodes or
   ``block_shingles`` shingles is dealt to blocks by hash, and every pair of
   blocks is a task of its own, so memory per task is bounded and no pair is
   left out. A task emits a spanning star per linked group, not pairs.
4. The components of the verified links give each document its class.

Nulls and odd input: null or empty texts have an empty set and are linked with
nothing; a text of fewer words than a shingle has its whole sequence as its only
shingle; a row with null doc_id is never linked, has a null component and is
kept; rows that repeat an id are rows of their own and appear as often as in the
input; an empty table gives no rows. Only doc_id and text are read.
``drop_near_duplicates`` decides by row, not by id: exactly one row of every class
stays, that of the smallest doc_id (then the smallest text hash); of rows that
repeat its id and text, any one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import components, cut, prepare, stored, table
from loadcast.llm.textnp import mix, shingle_sets, slices

BANDS = 30
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 1_000_000
DENSE_FROM = 24
DENSE_COLUMNS = 1024

_rng = np.random.RandomState(97)
_MULT = _rng.randint(1, 2**62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def band_rows(percent: int) -> int:
    return 5 if percent >= 85 else 4


def set_keys(row: np.ndarray, h: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two fingerprints of every row's set."""
    n = np.bincount(row, minlength=n_rows)
    k1, k2 = np.zeros(n_rows, np.uint64), np.zeros(n_rows, np.uint64)
    has = np.flatnonzero(n)
    if len(has):
        begin = np.searchsorted(row, has)
        k1[has] = np.add.reduceat(mix(h), begin)
        k2[has] = np.add.reduceat(mix(h * np.uint64(0x9FB21C651E98DF25) + np.uint64(1)), begin)
    return n, k1, k2


def signatures(row: np.ndarray, h: np.ndarray, rows: np.ndarray, bands: int, width: int) -> np.ndarray:
    """Band hashes, one line per given (non-empty) row: minimum and maximum under
    each permutation, hashed ``width`` at a time."""
    begin = np.searchsorted(row, rows)
    values = []
    for a in _MULT[:(bands * width + 1) // 2]:
        p = h * a
        values.append(np.minimum.reduceat(p, begin))
        values.append(np.maximum.reduceat(p, begin))
    out = np.zeros((len(rows), bands), np.uint64)
    for b in range(bands):
        x = np.full(len(rows), b, np.uint64)
        for v in values[b * width:(b + 1) * width]:
            x = mix(x * np.uint64(0xA24BAED4963EE407) + v)
        out[:, b] = x
    return out


def fingerprint(docs: DataFrame, k: int, bands: int, width: int) -> DataFrame:
    """(doc_id, text_hash, n, k1, k2, bands): a row per input row, over whole texts."""
    def run(batches):
        for batch, buf, off in slices(batches, "text"):
            row, h = shingle_sets(buf, off, k)
            n, k1, k2 = set_keys(row, h, batch.num_rows)
            has = np.flatnonzero(n)
            sig = signatures(row, h, has, bands, width) if len(has) else np.zeros((0, bands), np.uint64)
            offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n.astype(np.int64)), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig.reshape(-1).view(np.int64)))],
                ["doc_id", "text_hash", "n", "k1", "k2", "bands"])

    text = F.col("text").cast("string")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
            .mapInArrow(run, "doc_id long, text_hash long, n long, k1 long, k2 long, bands array<long>"))


def linked_stars(sids: np.ndarray, start: np.ndarray, h: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within one group of nodes, given by their ids and the runs of their
    shingles in ``h``, as (node, smallest node of its linked part)."""
    m = len(sids)
    size = np.diff(start)
    doc = np.repeat(np.arange(m), size)
    order = np.argsort(h, kind="stable")
    hs, ds = h[order], doc[order]
    first = np.concatenate([[0], np.flatnonzero(hs[1:] != hs[:-1]) + 1])
    df = np.diff(np.concatenate([first, [len(hs)]]))
    common = np.zeros((m, m), np.float32)
    # shingles of many members: a product of 0/1 matrices, some columns at a time
    often = np.flatnonzero(df >= DENSE_FROM)
    for at in range(0, len(often), DENSE_COLUMNS):
        part = often[at:at + DENSE_COLUMNS]
        x = np.zeros((m, len(part)), np.float32)
        for c, g in enumerate(part):
            x[ds[first[g]:first[g] + df[g]], c] = 1
        common += x @ x.T
    # shingles of 2 to DENSE_FROM - 1 members: their pairs, all of one size at once
    for d in range(2, DENSE_FROM):
        groups = np.flatnonzero(df == d)
        if len(groups):
            members = ds[first[groups][:, None] + np.arange(d)]
            for i in range(d):
                for j in range(i + 1, d):
                    np.add.at(common, (members[:, i], members[:, j]), 1)
                    np.add.at(common, (members[:, j], members[:, i]), 1)
    # 100 * common >= percent * (a + b - common), some rows at a time
    linked = np.zeros((m, m), bool)
    for at in range(0, m, 256):
        both = percent * (size[at:at + 256, None] + size[None, :])
        linked[at:at + 256] = (100 + percent) * common[at:at + 256].astype(np.float64) >= both
    np.fill_diagonal(linked, True)
    label = np.arange(m)
    while True:  # spread the smallest label along the links
        new = np.array([label[linked[i]].min() for i in range(m)])
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(m))
    return sids[far], sids[label[far]]


def verify(groups: DataFrame, percent: int) -> DataFrame:
    """(a, b) links from rows (task, sid, shingles), sorted by task within each
    partition."""
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        current = None

        def flush():
            sid = np.concatenate([x[0] for x in held])
            lens = np.concatenate([x[1] for x in held])
            h = np.concatenate([x[2] for x in held])
            u, first = np.unique(sid, return_index=True)  # a repeated row is one node
            if len(u) < 2:
                return None
            begin = np.concatenate([[0], np.cumsum(lens)])
            take = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in first])
            start = np.concatenate([[0], np.cumsum(lens[first])])
            a, b = linked_stars(u, start, h[take], percent)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"]) if len(a) else None

        for batch in batches:
            if batch.num_rows == 0:
                continue
            task, sid = np.asarray(batch.column("task")), np.asarray(batch.column("sid"))
            col = batch.column("shingles")
            off = np.asarray(col.offsets).astype(np.int64)
            h = np.asarray(col.values)
            edge = np.concatenate([[0], np.flatnonzero(task[1:] != task[:-1]) + 1, [len(task)]])
            for x, y in zip(edge[:-1], edge[1:]):
                if current is not None and task[x] != current:
                    if (out := flush()) is not None:
                        yield out
                    held = []
                current = task[x]
                held.append((sid[x:y], np.diff(off[x:y + 1]), h[off[x]:off[y]]))
        if held and (out := flush()) is not None:
            yield out

    return groups.select("task", "sid", "shingles").mapInArrow(run, "a long, b long")


def member_sets(docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """Members with their shingle sets, from the texts of their smallest id."""
    extra = [c for c in members.columns if c not in ("rep", "sid")]

    def run(batches):
        for batch, buf, off in slices(batches, "text"):
            row, h = shingle_sets(buf, off, k)
            n, k1, k2 = set_keys(row, h, batch.num_rows)
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))
            same = (k1.view(np.int64) == np.asarray(batch.column("k1"))) & (n == np.asarray(batch.column("n")))
            out = pa.RecordBatch.from_arrays([batch.column(c) for c in ("sid", *extra)] + [sets], ["sid", *extra, "shingles"])
            yield out.filter(pa.array(same))  # a repeated id may carry another text

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    types = dict(members.dtypes)
    schema = "sid long, " + ", ".join(f"{c} {types[c]}" for c in extra) + ", shingles array<long>"
    return texts.join(members, "rep").select("sid", *extra, "text").mapInArrow(run, schema)


def row_classes(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS,
                block_rows: int = BLOCK_ROWS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, text_hash, n, component_id, stays): the class of every row, and
    whether its id and text are those of the one row that stands for it."""
    prepare(docs.sparkSession)
    sig = stored(fingerprint(docs, k, bands, band_rows(percent)).withColumn("sid", F.xxhash64("k1", "k2", "n")))
    sets = (sig.filter("doc_id is not null and n > 0").groupBy("sid")
            .agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.min("n").alias("n"), F.min("k1").alias("k1"), F.min("bands").alias("bands")))
    sets = stored(sets.select("sid", F.col("first.doc_id").alias("rep"), F.col("first.text_hash").alias("rep_hash"), "n", "k1", "bands"))
    in_band = sets.select("sid", F.explode("bands").alias("band"))
    shared = in_band.groupBy("band").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).filter("low < high")
    stars = in_band.join(shared.select("band", "low"), "band").filter("sid <> low").select(F.col("sid").alias("a"), F.col("low").alias("b"))
    clusters = cut(components(stars))
    members = sets.drop("bands", "rep_hash").join(clusters.withColumnRenamed("id", "sid").withColumnRenamed("component_id", "cluster"), "sid")
    sizes = (members.groupBy("cluster").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
             .select("cluster", F.greatest(F.ceil(F.col("rows") / block_rows), F.ceil(F.col("shingles") / block_shingles))
                     .cast("int").alias("blocks")))
    members = cut(members.join(sizes, "cluster"))
    full = member_sets(docs, members, k)
    # every pair of blocks of a cluster is a task; a cluster of one block is one task
    block = F.pmod(F.xxhash64("sid", F.lit(5)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = (full.withColumn("block", block).withColumn("other", other)
             .withColumn("task", F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other")))
             .select("task", "sid", "shingles"))
    links = verify(tasks.repartition("task").sortWithinPartitions("task"), percent)
    classes = components(links).withColumnRenamed("id", "sid").withColumnRenamed("component_id", "class")
    named = sets.select("sid", "rep", "rep_hash").join(classes, "sid", "left").withColumn("class", F.coalesce("class", "sid"))
    names = (named.groupBy("class").agg(F.min(F.struct("rep", "rep_hash")).alias("first"))
             .select("class", F.col("first.rep").alias("component"), F.col("first.rep_hash").alias("stay_hash")))
    linked = cut(named.join(names, "class").filter("component <> rep or stay_hash <> rep_hash or class <> sid")
                 .select(F.col("sid").alias("set_id"), "component", "stay_hash"))
    reps = sets.select(F.col("sid").alias("rep_id"), "rep", "rep_hash")
    out = sig.join(reps, sig.sid == reps.rep_id, "left").join(linked, sig.sid == linked.set_id, "left")
    own = F.when(F.col("n") > 0, F.coalesce("component", "rep", "doc_id")).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), own))
    first = (F.col("doc_id") == F.col("component_id")) & (F.col("text_hash") == F.coalesce("stay_hash", "rep_hash"))
    return out.select("doc_id", "text_hash", "n", "component_id", (F.col("doc_id").isNull() | (F.col("n") == 0) | first).alias("stays"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, **how) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): the class of every row, links
    being 100 * intersection >= percent * union of the k-word shingle sets."""
    return row_classes(docs, k, percent, **how).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                           F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """One row of every class, with all columns of ``docs``."""
    rows = stored(row_classes(docs, **how).filter("doc_id is not null and n > 0")
                  .groupBy(F.col("doc_id").alias("row_id"), F.col("text_hash").alias("row_hash"))
                  .agg(F.first("stays").alias("stays"), F.count("*").alias("times")).filter("not stays or times > 1"))
    gone, many = (rows.filter(c).select("row_id", "row_hash") for c in ("not stays", "stays"))
    text_hash = F.xxhash64(F.col("text").cast("string"))

    def same(df):
        return (docs["doc_id"] == df["row_id"]) & (text_hash == df["row_hash"])

    if many.isEmpty():
        return docs.join(gone, same(gone), "left_anti")
    one = docs.join(many, same(many), "left_semi").dropDuplicates(["doc_id", "text"])
    return docs.join(rows, same(rows), "left_anti").unionByName(one)


def op9(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


QUERIES = {"op9_near_duplicates": op9}
ORACLES: dict[str, str] = {}
