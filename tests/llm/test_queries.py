"""The package's queries against their SQL."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

ORACLES = {k: v for k, v in entry.oracle_sql().items() if k.startswith("op")}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert differences(entry.queries()[name](spark, sf), connect(sf), ORACLES[name]) is None


def test_the_entry_works_without_the_package(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(entry.__file__).resolve().parent
    shutil.copytree(top / "tabwright", tmp_path / "tabwright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), set(e.oracle_sql()) <= set(e.queries()))"],
                          cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert said.stdout.split()[1:] == ["False", "True"], said.stderr
