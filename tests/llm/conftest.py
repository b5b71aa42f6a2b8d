import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

REAL = "/root/testdata/sf0.001"

WORDS = "the of and rain river stone light under green walks over small house water tree night".split()
PLAIN = " ".join(WORDS * 2 + WORDS[::-1])
ODD_TEXTS = [
    None, "", " \n\t ", "...", "A.", "The tree.", "a b c", "a  b\tc", "A B C", "12 34 56",
    PLAIN, PLAIN, PLAIN + " end", PLAIN.upper(), " ".join(f"w{k}" for k in range(100)), " ".join(f"w{k}" for k in range(99)),
    "same line here\nsame line here\n\nsame line here\n\n", "word " * 40, "x" * 3000, "é" * 700 + " 日本語 ñandú",
    "it's 'RE don't ''s !!'re <|endoftext|>  x <|startoftext|> y<|endoftext|>", "a\u00a0b\u2003 c\u3000\u0085d \x1c e", "I\u0307 İstanbul ΣΑΣ e\u0301 n\u0303",
    "😀 😀😀 \r\n\r\n  \n tab\there", "spam### buy*** now$$$ cheap%%% " * 10, "HELLO!! WORLD!! " * 30,
    " ".join(f"long{k % 977} text{k % 31}" for k in range(30000)), "z" * 100 + " " + "ab" * 400,
]


def table(path, columns):
    pq.write_table(pa.table(columns), path)


def documents(path, texts, lang=None):
    """Documents with columns whose names the operators also use, a null id, and a repeated row."""
    ids = [*range(100, 100 + len(texts))]
    if texts:
        texts, ids = [*texts, "a row without an id, of some twelve words or so, and that is all", texts[10], texts[10]], [*ids, None, 110, 7]
    size = len(texts)
    clash = {name: pa.array([name] * size) for name in
             ("n_tokens", "kept", "score", "row", "host", "component_id", "sequence_id", "key", "low", "content", "band", "label", "lang_pred")}
    table(path, {
        "doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()),
        "lang": pa.array([[None, "en", "de"][k % 3] for k in range(size)], pa.string()),
        "source": pa.array([[None, "s1", "s1", "s2"][k % 4] for k in range(size)], pa.string()),
        "n_chars": pa.array([None] * size, pa.int64()), "day": pa.array([datetime.date(2024, 1, 1)] * size), **clash})


def vectors(path, values):
    ids = [*range(len(values))]
    if values:
        values, ids = [*values, values[0], values[0], values[0]], [*ids, None, 3, 900]
    table(path, {"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(values, pa.list_(pa.float32())),
                 "label": pa.array([1] * len(values), pa.int32()), "low": pa.array(["x"] * len(values)), "digest": pa.array([1] * len(values))})


ODD_VECTORS = [
    [1.0, 0.0, 0.0], [2.0, 0.0, 0.0], [0.9, 0.43588989, 0.0], [0.9, 0.0, 0.4359], [0.0, 0.0, 0.0], None, [], [1.0, None, 0.0],
    [float("nan"), 1.0, 0.0], [float("inf"), 1.0, 0.0], [1.0, 0.0], [1.0, 0.001], [-1.0, 0.0, 0.0], [1e-30, 0.0, 0.0], [1e30, 1e30, 0.0], [1.0, 1.0, 0.0],
    [0.6, 0.8, 0.0], [0.62, 0.78, 0.05],
]
ODD_URLS = [
    None, "", "example.org/es/x", "http://example.org/es/x", "https://WWW.Example.ORG/en/123?x=1#t", "http://a.org", "http://a.org/", "http://org/", "http://xorg/",
    "http://b.com/fr/1", "http://b.com/de/1", "http://b.com/de", "http://notexample.org/es/1", "http://b.net?x=1&y=2", "http://b.net#/fr/", "ftp://u:p@H.com:80/fr/a?b://c", "://", "x://y://z/de/",
    "http://É.com/de/É", "http://b.com/fr/1", "http://b.com/fr/1", "http://c.com/" + "a1/" * 3000, "http://b.com\n/fr/1",
]


@pytest.fixture(scope="session")
def odd(tmp_path_factory):
    """A folder whose tables hold nulls, empty and long texts, ties, repeated rows and clashing names."""
    folder = tmp_path_factory.mktemp("odd")
    documents(folder / "documents.parquet", ODD_TEXTS)
    table(folder / "labels.parquet", {
        "doc_id": pa.array([None, *range(100, 126), 110, 5555], pa.int64()),
        "quality": pa.array([1, *[k % 3 and 1 for k in range(26)], 1, None], pa.int32()), "toxic": pa.array([0] * 29, pa.int32())})
    vectors(folder / "embeddings.parquet", ODD_VECTORS)
    table(folder / "pages.parquet", {
        "page_id": pa.array([None, *range(1, len(ODD_URLS))], pa.int64()), "url": pa.array(ODD_URLS, pa.string()),
        "html": pa.array([None] * len(ODD_URLS), pa.string()), "host": pa.array(["h"] * len(ODD_URLS)), "suffix": pa.array([1] * len(ODD_URLS))})
    return str(folder)


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    """A folder whose tables have no rows."""
    folder = tmp_path_factory.mktemp("empty")
    documents(folder / "documents.parquet", [])
    table(folder / "labels.parquet", {"doc_id": pa.array([], pa.int64()), "quality": pa.array([], pa.int32()), "toxic": pa.array([], pa.int32())})
    vectors(folder / "embeddings.parquet", [])
    table(folder / "pages.parquet", {"page_id": pa.array([], pa.int64()), "url": pa.array([], pa.string()), "html": pa.array([], pa.string())})
    return str(folder)


@pytest.fixture(params=["real", "odd", "empty"])
def folder(request):
    return REAL if request.param == "real" else request.getfixturevalue(request.param)


@pytest.fixture
def read():
    """All rows of a table as tuples of the named columns."""
    def rows(folder, name, *columns):
        found = pq.read_table(f"{folder}/{name}.parquet", columns=list(columns)).to_pydict()
        return list(zip(*(found[column] for column in columns)))
    return rows


@pytest.fixture
def run(spark):
    """The rows of a query as tuples, in any order."""
    from hirelake.llm.queries import QUERIES

    def rows(name, folder, *columns):
        frame = QUERIES[name](spark, folder)
        return [tuple(row) for row in frame.select(*columns).collect()]
    return rows
