"""The driver's entry points with and without the optional part."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

HIDE = """
import sys, warnings
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.partition(".")[0] == {hidden!r} or name == {hidden!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
warnings.simplefilter("always")
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), sum(n.startswith("op") for n in entry.queries()))
"""


def counts(hidden):
    done = subprocess.run([sys.executable, "-c", HIDE.format(hidden=hidden)], capture_output=True, text=True, cwd=ROOT)
    assert done.returncode == 0, done.stderr
    return *map(int, done.stdout.split()), done.stderr


def test_queries_stay_when_the_optional_part_cannot_be_imported():
    from tidemark.plans.oracle import ORACLE
    from tidemark.plans.registry import QUERIES

    for hidden in ("tokenizers", "public_tokenizers"):
        queries, sql, optional, said = counts(hidden)
        assert (queries, sql, optional) == (len(QUERIES), len(ORACLE), 0)
        assert f"no module named '{hidden}'" in said or not os.path.isdir(f"{ROOT}/tidemark/llm")
    queries, sql, optional, said = counts("tidemark.llm")
    assert (queries, sql, optional) == (len(QUERIES), len(ORACLE), 0) and "left out" not in said
