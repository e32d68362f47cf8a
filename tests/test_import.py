"""The entry imports in a fresh process without jars, and without the optional folders."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = ("import zipfile; zipfile.ZipFile = None; import __spark_entry__ as e; q = e.queries();"
        "print(len(q), len(e.oracle_sql()), sum(n == 'pipeline' or n.startswith('op') and n[2].isdigit() for n in q))")
#: Queries of the rest, and their SQL statements, at least.
CORE, SQL = 105, 78


def run(cwd):
    return subprocess.run([sys.executable, "-B", "-W", "ignore", "-c", CODE], cwd=cwd, capture_output=True, text=True)


def counts(cwd):
    out = run(cwd)
    assert out.returncode == 0, out.stderr
    return [int(x) for x in out.stdout.split()[-3:]]


def copied(to, *left_out):
    shutil.copytree(os.path.join(ROOT, "marquee"), to / "marquee", ignore=shutil.ignore_patterns("__pycache__", *left_out))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), to)


def test_fresh_import_needs_no_jar():
    n, sql, optional = counts(ROOT)
    there = os.path.isdir(os.path.join(ROOT, "marquee", "llm"))
    assert optional == (14 if there else 0)
    assert n - optional >= CORE and sql >= SQL


def test_import_without_the_optional_part(tmp_path):
    copied(tmp_path, "llm")
    n, sql, optional = counts(tmp_path)
    assert optional == 0 and n >= CORE and sql >= SQL


def test_a_broken_optional_part_is_not_hidden(tmp_path):
    if not os.path.isdir(os.path.join(ROOT, "marquee", "llm")):
        return
    copied(tmp_path)
    shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), tmp_path)
    with open(tmp_path / "marquee" / "llm" / "common.py", "a") as f:
        f.write("\nfrom marquee.session import no_such_name\n")
    assert "no_such_name" in run(tmp_path).stderr
