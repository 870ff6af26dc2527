import pytest

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text, lang, source) rows, with columns whose names the operators use inside."""
    clashes = ("row", "shard", "slot", "size", "words", "key", "place", "part", "component", "target", "ids", "kept", "_cut")

    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.selectExpr("*", *[f"'x' as `{c}`" for c in clashes]).repartition(3)

    return make


def sentence(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n \x0b\x0c\r "),
    (4, "one"),
    (5, "one two three four five six seven"),
    (5, "one two three four five six seven"),
    (6, "one two three four five six seven"),
    (None, "no id here, only words and words and words"),
    (None, None),
    (7, sentence(20_000)),
    (8, "\x1c\x1d\x85\xa0 　 odd  spaces here \n\n\n and\r\nthere \x00 zero"),
    (9, "ÀÉ İK ſ ß \U0001f600 \U0001f468‍\U0001f469 é 中文字 9½ ٣"),
    (10, "\n".join([sentence(60)] * 5)),
    (11, "Mail a.b+c@x-y.example.com or +1 (555) 010-0199, ip 10.0.0.256 10.0.0.25, card 4111 1111 1111 1111."),
    (12, "Under the MIT license. Apache License, Version 2.0; CC BY-NC 4.0 cc by nc"),
    (13, "a a a a a"),
    (14, "x" * 100_000),
]


@pytest.fixture(scope="session")
def edges(docs_of):
    return docs_of([(i, t, "en" if n % 3 else None, "s" if n % 2 else None) for n, (i, t) in enumerate(EDGES)])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def given(spark):
    def read(name, folder=SMALL):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    return read


def rows_of(df, *columns):
    """Rows of a frame in a fixed order, nulls first."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: [(x is not None, x) if not isinstance(x, list) else (True, str(x)) for x in r])


@pytest.fixture(scope="session")
def sorted_rows():
    return rows_of
