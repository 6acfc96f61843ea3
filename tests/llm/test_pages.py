"""HTML extraction, WARC transactions, source mixing, pipeline, registry."""

import base64
import gzip
import hashlib
import io
import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loadcast.llm import html_text, mixing, registry, warc
from tests.llm import brute
from tests.llm.conftest import SF, key
from tools.oracle_check import compare, duck


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=key)


# ---------------------------------------------------------------------- HTML

CASES = [
    ("<html><body><nav>Menu</nav><article><h1>T &amp; t</h1><p>One\n two&#233;<p>Three <b>bold</b> x</article><footer>F", "T & t\nOne twoé\nThree bold x"),
    ("<body class='home search'><main><header><h2>Head</h2></header><div class='ad-box'>Buy</div><p>Text</p><div id=comments><p>First!</p></div></main>", "Head\nText"),
    ("<article><script>var a='</article><p>no</p>';</script><style>p{}</style><p>yes<br>sir</p><!-- <p>no</p> --></article><aside>no</aside>", "yes sir"),
    ("<article><p>a</p><article class=comment><p>reader</p></article><form><label>Mail</label><input value=x></form><p>b", "a\nb"),
    ("<article><ul><li>x<li>y</ul><table><tr><td>1<td>2</table><p>&lt;tag&gt; &nbsp; end &copy", "x\ny\n1\n2\n<tag> end ©"),
    ("", ""), (None, ""), ("<nav>only</nav>", ""), ("plain text", "plain text"), ("<p>open <b>never closed", "open never closed"), ("<", "<"),
    ("<article><p>cut <a href='x", "cut"), ("<div role=navigation>n</div><div>kept words here</div>", "kept words here"),
    ("<article><p class=notice>n<p>a<span class=share>s</span>b</article>", "ab"),
    ("<article><p>a <span class=ad>x<p>y</span> b</p>z</article>", "a\ny b\nz"),
    # a wrapper or an article that is only marked by its class or id
    ("<div class='has-sidebar'><article><p>Body</p></article></div>", "Body"), ("<article class='no-ads post'><p>Body</p></article>", "Body"),
    ("<div id='search-page'><main><p>Body</p></main></div><div class='sidebar'>no</div>", "Body"),
    ("<div class='sidebar'>no</div><article class='promo'><p>Body</p></article>", "Body"),
    ("<article><p>a</p></article><div class='related-posts'><article><p>other</p></article></div>", "a"),
    ("<article><p>a</p><div class='comments-area'><article><p>reader</p></article></div></article>", "a"),
    ("<div class='cookie-notice'>c</div><div class='page sidebar'>s</div><p>free</p>", "free"),
    ("<article>" + "<div><b>x" * 4000 + "</i></p>" * 4000, "\n".join(["x"] * 4000)),
]


@pytest.mark.parametrize("page,want", CASES)
def test_main_text(page, want):
    assert html_text.main_text(html_text.blocks(page or ""), None) == want


def test_host_suffix_array_removes_what_pages_share(spark, none):
    shared = "subscribe now to all of our daily weekly and monthly letters"
    page = lambda body: f"<body><div>{shared}</div><div>{body}</div><div>read on {shared} today</div></body>"
    one, two = "first page has words of its own in a line", "second page speaks of other things in its text"
    rows = [(1, "http://a.org/1", page(one)), (2, "http://a.org/2", page(two)), (3, "http://b.org/1", page(one)), (4, None, None),
            (5, "http://[bad", page(two)), (1, "http://a.org/1", page(one)), (6, "http://a.org/3", f"<article><p>{shared}</p></article>")]
    df = spark.createDataFrame([r + ("k", 1) for r in rows], "page_id long, url string, html string, covered string, page_key int")
    got = [(r["page_id"], r["text"]) for r in html_text.extract(df).collect()]
    whole = lambda body: f"{shared}\n{body}\nread on {shared} today"
    assert sorted(got) == sorted([(1, one), (2, two), (3, whole(one)), (4, ""), (5, whole(two)), (1, one), (6, shared)])
    assert all(r["n_chars"] == len(r["text"]) for r in html_text.extract(df, broadcast_pages=0).collect())
    assert html_text.extract(df.limit(0)).count() == 0


def test_short_unique_runs_are_kept(spark):
    shared = "read all our letters every day of the week"
    rows = [(i, "http://a.org/", f"<div>{w} {shared} {w}</div>") for i, w in enumerate(("one", "two two"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((r["page_id"], r["text"]) for r in html_text.extract(df).collect()) == [(0, "one\none"), (1, "two two\ntwo two")]


def test_windows_equal_a_full_suffix_array(spark):
    """Covered words by host, from a sorted list of all suffixes."""
    pages = [(i, "http://h.org/", " ".join(f"w{(i * j) % 7}" for j in range(3, 60))) for i in range(1, 9)]
    suffixes = sorted((t.split()[s:s + html_text.RUN], p, s) for p, _, t in pages for s in range(len(t.split())))
    want = {}
    for a in suffixes:
        if len(a[0]) == html_text.RUN and any(b[0] == a[0] and b[1] != a[1] for b in suffixes):
            want.setdefault(a[1], set()).add(a[2])
    df = spark.createDataFrame([(p, u, f"<div>{t}</div>") for p, u, t in pages], "page_id long, url string, html string")
    keyed = html_text.keyed(df)
    got = {r["page_id"]: set(r["covered"]) for r in html_text.boilerplate(keyed).join(keyed, F.col("covered_key") == F.col("page_key")).collect()}
    assert got == want and want


def test_html_query(spark):
    got = html_text.op2(spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(got) == len(pages)
    assert all(r["text"] and len(r["text"]) == r["n_chars"] <= len(pages[r["page_id"]]) for r in got)


# ---------------------------------------------------------------------- WARC

def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_warc_round_trip(spark, tmp_path):
    tricky = "WARC/1.1\r\nContent-Length: 3\r\n\r\n\r\n\r\nWARC-Type: response é"
    rows = [(1, "http://a/1", "x"), (2, "http://a/2", "x"), (3, None, None), (4, "bad\r\nX: y url", ""), (5, "u", tricky), (6, "u", "ü" * 70_000),
            (7, "u", "x"), (None, "n", "x"), (8, "u", "only"), (8, "v", "other"), (8, "u", "only")]
    df = spark.createDataFrame([r + (1, "z") for r in rows], "page_id long, url string, html string, digest int, first_id string")
    c = {(r["page_id"], r["response"]["payload_digest"]): r for r in warc.round_trip(df, str(tmp_path / "w")).collect()}
    assert len(c) == len({(p, digest(h)) for p, _, h in rows})
    for p, u, h in rows:
        r = c[p, digest(h)]
        x = r["response"]
        assert x["payload_bytes"] == len((h or "").encode()) and r["request"] and r["metadata"]
        top = max((q for q, _, g in rows if q is not None and (g or "") == (h or "")), default=None)
        if p == top:
            assert x["type"] == "response" and x["refers_to"] is None and bytes(x["payload"]).decode() == (h or "")
        else:
            assert x["type"] == "revisit" and x["refers_to"] == f"<urn:capture:{top}:{digest(h)}:response>" and x["payload"] == b""
    assert {r["url"] for r in c.values()} >= {"http://a/1", None, "bad\r\nX: y url"}
    # a stricter floor keeps small payloads as responses
    big = warc.round_trip(df, min_revisit_bytes=2)
    assert {r["response"]["type"] for r in big.collect()} == {"response"}
    assert warc.round_trip(df.limit(0)).count() == 0


def test_archives_are_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a/", "<p>hi</p>")], "page_id long, url string, html string")
    warc.write_archives(df, str(tmp_path / "w"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "w").glob("part-*"))
    assert data.count(b"WARC/1.1\r\n") == 3 and data.endswith(b"\r\n\r\n")
    got = list(warc.parse_archive(io.BytesIO(data)))
    assert [h["warc-type"] for h, _ in got] == ["request", "response", "metadata"] or len(got) == 3
    assert all(int(h["content-length"]) == len(b) for h, b in got)
    for broken in (data[:-6], data.replace(b"Content-Length: ", b"Content-Length: 9", 1), b"junk"):
        with pytest.raises(ValueError):
            list(warc.parse_archive(io.BytesIO(broken)))


# -------------------------------------------------------------------- mixing

def count_of(rate, doc_id, seed=17):
    u = int(hashlib.md5(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) / 2**52
    k, p = 0, math.exp(-rate)
    c = p
    while c <= u and k < 400:
        k += 1
        p *= rate / k
        c += p
    return k


def test_mixing(odd, odd_pairs, none):
    weights = odd.sparkSession.createDataFrame([("s0", 3.0), ("s1", 1.0), ("s2", 0.0), (None, 2.0), ("absent", 5.0)], "source string, weight double")
    rows = [(r["doc_id"], r["source"]) for r in odd.collect()]
    n = {s: sum(x[1] == s for x in rows) for s in {x[1] for x in rows}}
    rate = {s: 60 * w / 6 / n[s] for s, w in (("s0", 3.0), ("s1", 1.0), (None, 2.0))}
    want = sorted(((d, s, k) for d, s in rows if s in rate for k in range(count_of(rate[s], d))), key=key)
    for limit in (20_000, 0):  # broadcast, salted
        got = mixing.mix_sources(odd, weights, total=60, broadcast_sources=limit)
        assert rows_of(got, "doc_id", "source", "copy") == want
        assert "text" in got.columns and got.columns.count("copy") == 1
    assert mixing.mix_sources(none).count() == 0
    assert mixing.mix_sources(odd, weights.limit(0)).count() == 0


def test_rates_meet_the_target(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "small").otherwise("large").alias("source"))
    weights = spark.createDataFrame([("small", 1.0), ("large", 1.0)], "source string, weight double")
    got = {r["source"]: r["count"] for r in mixing.mix_sources(df, weights).groupBy("source").count().collect()}
    assert abs(got["small"] - 10_000) < 500 and abs(got["large"] - 10_000) < 500
    tables = {r["source"]: r["cdf"] for r in mixing.with_cdf(spark.createDataFrame([(None, 2000.0), ("b", 60_000.0), ("c", 0.5)], "source string, rate double")).collect()}
    big = tables[None]
    assert abs(tables["c"][0] - math.exp(-0.5)) < 1e-15 and abs(tables["b"][60_000] - 0.5) < 0.005 and abs(tables["b"][-1] - 1) < 1e-8
    assert math.isclose(big[-1], 1, rel_tol=1e-9) and abs(sum(x < 0.5 for x in big) - 2000) < 3


# ------------------------------------------------------- registry and pipeline

@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_oracle(spark, name):
    r = compare(registry.QUERIES[name](spark, SF), duck(SF), registry.ORACLE[name])
    assert r["cols_match"] and r["spark_rows"] == r["oracle_rows"] and r["values_match"], r


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_dedup", "suffix_array_dedup", "decontamination", "source_mix"]


def test_pipeline_stages_against_brute_force(spark, docs):
    """Stages 2 to 4 on the rows that their predecessors kept."""
    (_, toxic), (_, near), (_, cut_), (_, clean), (_, mix) = corpus_pipeline.STAGES
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    start = docs.filter(F.length("text") < 5000).cache()
    pairs = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    kept = toxic(spark, start, SF).cache()
    assert kept.columns == docs.columns and kept.count() > 0.8 * start.count()
    one = near(spark, kept, SF).cache()
    assert {d for d, _ in pairs(one)} == {d for d, _, c in brute.near_duplicates(pairs(kept), 5, 80) if d == c}
    rest = cut_(spark, one, SF).cache()
    left = {d: n - gone for d, n, gone, _, _ in brute.repeats(pairs(one), corpus_pipeline.MIN_PASSAGE)}
    for d, t in pairs(rest):
        assert abs(len(t.encode()) - left[d]) <= 12  # whole characters at the borders
    pure = clean(spark, rest, SF).cache()
    assert {d for d, _ in pairs(pure)} == {d for d, t in pairs(rest) if not brute.contamination([(d, t)], bench)}
    assert rest.columns == pure.columns == docs.columns
    assert set(docs.columns) < set(mix(spark, pure, SF).columns)
    for df in (start, kept, one, rest, pure):
        df.unpersist()


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_pipeline_odd_tables(spark, odd, none):
    for df in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF)
        df.count()
