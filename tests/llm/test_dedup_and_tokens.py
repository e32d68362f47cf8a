"""Operators with exact contracts against plain restatements, on odd rows and on the small tables."""

import brute
import duckdb
import pyarrow.parquet as pq
import pytest
from conftest_path import SMALL

from marquee.llm.catalog import QUERIES

KEY = {"op1_simhash_dedup": brute.op1, "op7_bpe": brute.op7, "op9_exact_dedup": brute.op9, "op5_suffix_dedup": brute.op5}


def rows_of(folder):
    return duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet'").fetchall() if folder else []


def in_order(folder):
    t = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))


def same(got, expected):
    order = lambda rows: sorted(map(repr, rows))
    assert order(got) == order(expected)


@pytest.mark.parametrize("name", [n for n in KEY if n in QUERIES])
@pytest.mark.parametrize("where", ["odd", "small", "empty"])
def test_against_brute_force(spark, odd_dir, empty_dir, name, where):
    folder = {"odd": odd_dir, "small": SMALL, "empty": empty_dir}[where]
    got = [tuple(r)[:len(r)] for r in QUERIES[name](spark, folder).collect()]
    same(got, [tuple(x) for x in KEY[name](in_order(folder))])


@pytest.mark.parametrize("where", ["odd", "small", "empty"])
def test_contamination(spark, odd_dir, empty_dir, where):
    folder = {"odd": odd_dir, "small": SMALL, "empty": empty_dir}[where]
    items = pq.read_table(f"{folder}/benchmark.parquet")
    expected = brute.op3(in_order(folder), list(zip(items["item_id"].to_pylist(), items["text"].to_pylist())))
    same([tuple(r) for r in QUERIES["op3_decontamination"](spark, folder).collect()], expected)
