import os
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
PASSAGE = " ".join(f"shared{i} passage" for i in range(40))
ITEM = "the quick brown fox jumps over the lazy dog while seven wizards brew tea in silence tonight"


def documents():
    """Ids and texts with nulls, empties, ties, repeated rows, copies, near copies and a very long text."""
    base = [" ".join(f"w{(i * 7 + j * 13) % 501}" for j in range(60 + i % 9)) for i in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100, None), (101, ""), (102, " \n\t"), (None, base[3]), (None, "no id here"), (103, base[5] + "  \n"), (104, base[5])]
    rows += [(7, base[7]), (7, base[7]), (7, "another text under the same id"), (105, LONG), (106, "A" + LONG)]
    rows += [(110 + i, base[9] + f" tail{i}") for i in range(6)]
    rows += [(120, "x " + PASSAGE + " first"), (121, PASSAGE + " second " + PASSAGE), (122, "é" * 150 + PASSAGE), (123, "é" * 260)]
    rows += [(130, ITEM), (131, ITEM.upper() + "!"), (132, base[1] + " " + ITEM), (133, "tiny item"), (134, "TINY, item and more"),
             (135, " ".join(base) + " " + ITEM), (136, "<|endoftext|> a <|endoftext|>"), (137, "don't we're  spaces \u3000 ok \x1c x"),
             (138, "aaaa" * 300), (139, "\U0001F600" * 70)]
    return rows


def write(folder, docs, **more):
    folder.mkdir(parents=True, exist_ok=True)
    n = len(docs)
    t = pa.table({
        "doc_id": pa.array([d[0] for d in docs], pa.int64()), "text": pa.array([d[1] for d in docs], pa.string()),
        "lang": pa.array([None if k % 11 == 0 else ("en", "de")[k % 2] for k in range(n)], pa.string()),
        "source": pa.array(["s"] * n, pa.string()), "n_chars": pa.array([None] * n, pa.int64()),
        # names that an operator might use itself
        "score": pa.array([0.5] * n), "fp": pa.array(list(range(n)), pa.int64()), "row": pa.array([None] * n, pa.int64()),
        "digest": pa.array(["d"] * n), "salt": pa.array([1] * n, pa.int32()), "keep_id": pa.array([0] * n, pa.int64()),
        "w": pa.array(["w"] * n), "y": pa.array([1] * n), "id": pa.array([3] * n), "v": pa.array([3] * n)})
    pq.write_table(t, folder / "documents.parquet", row_group_size=16)
    labels = more.get("labels", [(k, k % 3 == 0, k % 5 == 0) for k in range(40)] + [(None, 1, 1), (3, None, None)])
    pq.write_table(pa.table({
        "doc_id": pa.array([x[0] for x in labels], pa.int64()), "quality": pa.array([x[1] if x[1] is None else int(x[1]) for x in labels], pa.int32()),
        "toxic": pa.array([x[2] if x[2] is None else int(x[2]) for x in labels], pa.int32())}), folder / "labels.parquet")
    items = more.get("items", [(1, ITEM), (2, "tiny item"), (3, None), (4, ""), (5, " ".join(ITEM.split()[1:14])), (5, "more"), (None, "seven wizards brew")])
    pq.write_table(pa.table({"item_id": pa.array([x[0] for x in items], pa.int64()), "text": pa.array([x[1] for x in items], pa.string())}),
                   folder / "benchmark.parquet")
    urls = more.get("urls", [])
    pq.write_table(pa.table({"page_id": pa.array(range(len(urls)), pa.int64()), "url": pa.array(urls, pa.string()),
                             "html": pa.array([""] * len(urls), pa.string())}), folder / "pages.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def odd_dir(tmp_path_factory):
    return write(tmp_path_factory.mktemp("odd") / "t", documents(),
                 urls=[None, "", "no scheme", "http://", "https://EXAMPLE.com/en/x", "http://www.example.com/en/a?q#f", "http://a.b.example.com/en",
                       "http://com/", "http://xcom/", "ftp://a.net/es/", "http://a.net/ES/", "http://net/fr/x", "http://x.org/a", "http://.com/",
                       "http://a..com/en/", "//x.com/", "http://b.com?x://y/", "http://www.example.com/en/" + "p" * 50_000, "http://a.com", "x://y://z.com/"])


@pytest.fixture(scope="session")
def empty_dir(tmp_path_factory):
    return write(tmp_path_factory.mktemp("none") / "t", [], labels=[], items=[])
