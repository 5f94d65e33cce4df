import subprocess
import sys
from pathlib import Path

import pytest

from tidemark.session import SETTINGS, cluster_settings

ROOT = Path(__file__).resolve().parents[1]


def test_imports_need_no_session():
    subprocess.run([sys.executable, "-c", "import __spark_entry__, bench"], cwd=ROOT, check=True)


def test_the_rest_works_without_the_training_data_operators():
    """As where that subpackage and its pipeline have been left out."""
    code = ("import sys; sys.modules['tidemark.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; from checks.queries import QUERIES\n"
            "assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


@pytest.mark.parametrize("package", ["xxhash", "tokenizers", "ahocorasick"])
def test_the_rest_works_without_a_package_they_need(package):
    code = (f"import sys; sys.modules[{package!r}] = None\n"
            "import __spark_entry__ as e; from checks.queries import QUERIES\n"
            "assert set(QUERIES) <= set(e.queries())")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_a_local_session_without_a_shared_folder_gets_one():
    code = ("from pyspark.sql import SparkSession\n"
            "from tidemark.sources.shared_folder import scratch, shared_folder, stored\n"
            "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
            ".getOrCreate()\n"
            "assert shared_folder(spark) == shared_folder(spark)\n"
            "with scratch(spark) as folder:\n"
            "    assert stored(spark.range(3), 'x').inputFiles()[0].startswith('file://' + folder)\n"
            "import os; assert not os.path.exists(folder)\n"
            "assert stored(spark.range(3), 'x').count() == 3\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_else_imports_them():
    for path in [*ROOT.glob("tidemark/**/*.py"), *ROOT.glob("checks/*.py")]:
        if path.parent.name != "llm":
            assert "llm" not in path.read_text()


def test_session_has_the_settings(spark):
    assert all(spark.conf.get(key) == value for key, value in SETTINGS.items())


def test_partitions_follow_cores_and_bytes():
    assert cluster_settings(4000, 100)["spark__sql__shuffle__partitions"] == 12000
    assert cluster_settings(100, 10_000)["spark__sql__shuffle__partitions"] == 80_000
