import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from lexispark.plans.oracle import ORACLE
from lexispark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(rows):
    return sorted(tuple(repr(round(v, 9) + 0.0) if isinstance(v, float) else repr(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", ["extract", "page_stats", "zone_split", "dup_headword_flags", "homonym_exact", "merge_multi_sense", "merge_same_gloss", "merge_conflicts", "gloss_conflicts", "corpus_conflict_flags", "reconcile_flags", "recurring_subs", "morph_findings"])
def test_query_against_sql(spark, name):
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    names = ", ".join(f'"{x}"' for x in cols)
    sql = c.sql(f"SELECT {names} FROM ({ORACLE[name]})").fetchall()
    assert plain(df.select(*cols).collect()) == plain(sql)


def test_names():
    assert set(ORACLE) <= set(QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())


def test_works_without_the_llm_folders(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name.startswith('lexispark.llm') or name == 'corpus_pipeline': raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'extract' in e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
