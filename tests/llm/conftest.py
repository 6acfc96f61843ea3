import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, copy int, rate int, cdf int, score string, "
          "kept int, label_id long, sid long, repeat_spans int, copy_id long, doc long, marks int, judged_slice int, judged_by string, "
          "judged_text int, n_words string, weight int, rank string, place int, ghost int, at string, to_doc int, digest string")


def odd_rows():
    """Documents with nulls, empty, blank, very long, equal and near-equal texts,
    an id that repeats, a row that repeats, and columns with clashing names."""
    r = random.Random(4)
    voc = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(400)]
    say = lambda n: " ".join(r.choice(voc) for _ in range(n))
    base, other, passage = say(300), say(200), say(60)
    near = base.split()
    near[40] = "changed"
    far = base.split()
    for i in range(0, 300, 12):
        far[i] = "x"
    long = say(30_000)
    rows = [(1, base), (2, None), (3, ""), (4, " \t\n\r\x0b\x0c "), (5, base), (6, " ".join(near)), (7, " ".join(far)), (8, other),
            (9, other.upper()), (10, long), (11, passage + "\n" + say(100)), (12, say(90) + "\n" + passage + " end"), (13, "ab"), (14, "ab"),
            (15, "Ünïcode größe ñandú 日本語 " * 12), (16, "x " + "Ünïcode größe ñandú 日本語 " * 12), (None, base), (None, None),
            (8, say(50)), (1, base), (17, "a" * 300), (18, "a" * 200), (19, "a" * 49), (20, passage), (-3, say(30) + " " + passage)]
    extra = ("r", 1, 2, 3, "s", 4, 5, 6, 7, 8, 9, 10, 11, "b", 12, "w", 13, "k", 14, 15, "a", 16, "d")
    return [(d, t, None if i % 7 == 0 else ("en", "de")[i % 2], None if i % 5 == 0 else f"s{i % 3}", len(t) if t else None) + extra
            for i, (d, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_pairs():
    return [(r[0], r[1]) for r in odd_rows()]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def key(row):
    return tuple((x is not None, x) for x in row)
