import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, cell long, term string, row int, score double, ends string, key int, place int"
LONG = " ".join(f"w{i % 977}x{i // 7}" for i in range(30000))


def as_rows(pairs):
    """Documents with columns whose names the operators use inside."""
    return [(i, t, "en", None if i is None or i % 3 else "src0", None if t is None else len(t), 1, 2, "x", 3, 0.5, "e", 4, 5) for i, t in pairs]


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda pairs: spark.createDataFrame(as_rows(pairs), SCHEMA)


#: Nulls, empty and very long texts, repeated rows, ties, odd white space and characters.
ODD = [(5, None), (7, ""), (7, ""), (None, "alpha beta gamma"), (9, LONG), (11, " \t\n "), (13, "é́ ﬁ İstanbul J̌ 日本語 😀 end"), (15, "alpha beta gamma"),
       (15, "alpha beta gamma"), (17, "ALPHA beta  gamma"), (19, "the " * 200), (21, "a\nb\n\nc\r\n"), (-3, "x<|endoftext|>y it's 1234")]


@pytest.fixture(scope="session")
def sf_small():
    import os

    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("driver test data not present")
    return path
