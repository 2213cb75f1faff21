import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

CLASH = ["id", "rest", "h", "g", "pos", "key", "size", "rows", "label", "node", "version", "taken", "words", "count", "rank", "host", "shard", "edits", "level"]


def prose(rng: random.Random, n: int) -> str:
    letters = "abcdefghijklmnop"
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(n))


def hostile_documents() -> list[tuple]:
    rng = random.Random(5)
    rows: list[tuple] = [(0, None, None, None), (1, "", "en", "a"), (2, " \t\n\x0b\n ", "en", "a"), (None, "null id text here", None, "b")]
    line = "  A shared LINE of more than twenty characters\t"
    for i in range(3, 9):
        rows.append((i, f"{prose(rng, 60)}\n{line}\nshort\n{line.strip().lower()}\n", "en", "ab"[i % 2]))
    base = prose(rng, 120).split()
    for i in range(9, 30):  # near copies of one another
        words = list(base)
        for _ in range(i % 5):
            words[rng.randrange(len(words))] = "edited%d" % rng.randrange(99)
        rows.append((i, " ".join(words), "de", None))
    rows += [(i, "one two three", "fr", "c") for i in range(30, 34)] + [(34, "one TWO three", "fr", "c"), (35, "one", None, "d")]
    rows += [rows[5], rows[5], (5, prose(rng, 40), "en", "b"), (6, " ".join(base), "en", "b")]  # repeated rows, and ids with other texts
    rows += [(40, prose(rng, 30_000) + "\n" + "la la la " * 5_000, "es", "z"), (41, "x" * 50_000, "es", "z"), (42, "é漢🙂▁ $%&# " * 30, "de", "\x7fé")]
    rows += [(None, None, None, None), (None, " ".join(base), "en", "a")]
    passage = prose(rng, 60)
    rows += [(100 + i, f"{prose(rng, 20)} {passage} {prose(rng, 25)}", "en", "hot") for i in range(60)]
    return rows


def write(path, columns: dict[str, pa.Array]) -> None:
    n = len(next(iter(columns.values())))
    extra = {c: pa.array([f"{c}{i}" for i in range(n)], pa.string()) for c in CLASH if c not in columns}
    pq.write_table(pa.table({**columns, **extra}), path)


def write_tables(folder, documents, pages, embeddings, talk) -> str:
    col = lambda rows, i, kind: pa.array([r[i] for r in rows], kind)
    s, n = pa.string(), pa.int64()
    write(folder / "documents.parquet", {"doc_id": col(documents, 0, n), "text": col(documents, 1, s), "lang": col(documents, 2, s), "source": col(documents, 3, s),
                                         "n_chars": pa.array([len(r[1] or "") for r in documents], n)})
    write(folder / "pages.parquet", {"page_id": col(pages, 0, n), "url": col(pages, 1, s), "html": col(pages, 1, s)})
    write(folder / "embeddings.parquet", {"vec_id": col(embeddings, 0, n), "embedding": col(embeddings, 1, pa.list_(pa.float32())), "label": pa.array([0] * len(embeddings), pa.int32())})
    write(folder / "conversations.parquet", {"conv_id": col(talk, 0, n), "turn": col(talk, 1, n), "role": col(talk, 2, s), "text": col(talk, 3, s)})
    wanted = documents[:: max(1, len(documents) // 9)]
    write(folder / "benchmark.parquet", {"item_id": pa.array(range(len(wanted)), n), "text": col(wanted, 1, s)})
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "labels"):
        write(folder / f"{name}.parquet", {"nothing": pa.array([], s)})
    return str(folder)


@pytest.fixture(scope="session")
def hostile(tmp_path_factory):
    """Tables with nulls, empty and very long texts, ties, repeated rows and extra columns with clashing names."""
    rng = random.Random(6)
    pages = [(0, None), (1, ""), (2, "no scheme"), (3, "HTTP://Sub.Example.ORG"), (4, "http://example.org/es/x?q#f"), (5, "https://a.b.com/fr/://x"),
             (6, "ftp://com/de/\nline"), (7, "http://x.net/free-click-casino"), (8, "http://x.net/free-free"), (None, "http://x.net/FREE/ads"), (8, "http://x.net/free-free"),
             (9, "http://example.org/en/1?x"), (10, "http://notexample.org/es/"), (11, "://h"), (12, "http://org?/"), (13, "a://xxx" + "y" * 5000), (14, "http://t.net/sexxx-essex.adult")]
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(200)]
    vectors += [(i, [0.5] * 8) for i in range(200, 260)]
    vectors += [(300, None), (350, [None] * 8), (400, [float("nan")] * 8), (450, [float("inf")] * 8), (None, [0.1] * 8), (500, [0.25, 0.5]), (501, [0.25, 0.75]), vectors[50], vectors[7]]
    talk = [(1, t, "user" if t % 2 == 0 else "assistant", prose(rng, 5 + 9 * t)) for t in range(14)]
    talk += [(2, 0, "user", None), (2, 1, "assistant", None), (2, 3, "assistant", ""), (2, 4, "user", 'quote " back \\ tab\t'), (None, 1, "assistant", "x"), (3, None, "assistant", "x"),
             (3, 1, None, "x"), (4, 3, "assistant", "say"), (4, 3, "assistant", "say"), (4, 4, "user", "b"), (4, 4, "user", "a"), (5, 2, "user", "orphan")]
    return write_tables(tmp_path_factory.mktemp("hostile"), hostile_documents(), pages, vectors, talk)


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return write_tables(tmp_path_factory.mktemp("empty"), [], [], [], [])
