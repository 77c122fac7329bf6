import pyarrow as pa
import pyarrow.parquet as pq
import pytest

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
BENCH = pa.schema([("item_id", pa.int64()), ("text", pa.string())])
LABELS = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])
EMBEDDINGS = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())])
PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())])

PROSE = " ".join(f"word{i % 97}x{i % 13} of tale{i}" for i in range(120))
ITEM = "one two three four five six seven eight nine ten eleven twelve"
LONG = " ".join(f"long{i}" for i in range(200_000))
DOC_ROWS = [
    (1, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1), (3, None, "en", "b", None), (4, "", None, "b", 0),
    (None, PROSE + " tail", "en", None, 5), (5, " \n\t ", "en", None, 3), (6, LONG, "fr", "c", 9), (7, "Says: " + ITEM.upper() + "! " + PROSE[::-1], "en", "c", 7),
    (8, "spam spam " * 200, "en", "c", 8), (9, "short text", "en", "d", 2), (10, "loser <|endoftext|> 中文 İx é", "zh", "d", 2),
    (None, None, None, None, None), (11, "All rights reserved.\nReleased under the MIT License.", "en", "a", 3), (11, "other text of the same id " * 4, "en", "a", 3),
]
BENCH_ROWS = [(1, ITEM), (2, None), (3, ""), (None, "nobody has this id"), (4, "spam spam spam"), (4, "spam spam spam"), (5, "...")]
LABEL_ROWS = [(1, 1, 0), (1, 0, 1), (2, 1, None), (3, 0, 0), (8, 0, 1), (None, 1, 1), (99, 1, 1), (10, 1, 1)]
# (id, vector, label); the last four go
VEC_ROWS = [(i // 2, [((i * 37 + c * 11) % 23 - 11) / 7 for c in range(32)], None if i % 5 == 0 else i % 3) for i in range(150)] + [
    (7, [0.5] * 32, 1), (7, [0.5] * 32, 1), (200, [1.0] * 20, 2), (201, [], 2), (None, [0.25] * 32, None), (-3, [3e38] + [-1e9] * 31, 4), (202, [2.5e20] * 32, 4), (203, [9e20] * 32, 4),
    (300, None, 1), (301, [None] * 32, 1), (302, [float("nan")] + [0.0] * 31, 1), (303, [0.0] * 31 + [float("-inf")], None),
]
PAGE_ROWS = [
    (1, "http://EXAMPLE.net/en/x?q#f", "<article><p>Hi &amp; bye</p></article>"), (2, "https://a.b.net/", "<nav><a href=/>x</a></nav><article><h1>T</h1><p>One\n two</p></article>"),
    (3, None, None), (4, "no scheme", ""), (5, "x://net", "<p>open <a href=\"cut"), (6, "http://www.spam-farm.org/a/", "<script>var a='<p>';</script><main>m</main>"),
    (6, "http://www.spam-farm.org/a/", "<article>" + "<p>w" * 20_000), (None, "ftp://host.org/fr/../", "<!-- c --><p>t"), (7, "http:///en/", "&lt;&#65;"),
]


def write(path, documents=DOC_ROWS, benchmark=BENCH_ROWS, labels=LABEL_ROWS, pages=PAGE_ROWS, embeddings=VEC_ROWS, extra=()):
    for name, rows, schema in (("documents", documents, DOCS), ("benchmark", benchmark, BENCH), ("labels", labels, LABELS), ("pages", pages, PAGES), ("embeddings", embeddings, EMBEDDINGS)):
        cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
        t = pa.table([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
        for x in extra:
            if x not in t.column_names:
                t = t.append_column(x, pa.array([f"{x}{i}" for i in range(len(t))], pa.string()))
        pq.write_table(t, f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="session")
def odd_dir(tmp_path_factory):
    return write(tmp_path_factory.mktemp("odd"))


@pytest.fixture(scope="session")
def empty_dir(tmp_path_factory):
    return write(tmp_path_factory.mktemp("empty"), [], [], [], [], [])


CLASHES = ("id", "row", "n", "key", "node", "label", "size", "source_size", "repeats", "kept", "measures", "quality", "host", "rate", "score", "x",
           "fold", "y", "lid", "h", "win", "u", "rule", "verdict", "_raw", "_n", "tokens", "main_text", "licences", "text_hash", "_id", "_hash", "html", "url", "vec", "code", "error", "label_error", "start", "core", "hull", "win", "pos", "periodic", "runs", "_key", "text_bytes", "spans")


@pytest.fixture(scope="session")
def clash_dir(tmp_path_factory):
    return write(tmp_path_factory.mktemp("clash"), extra=CLASHES)
