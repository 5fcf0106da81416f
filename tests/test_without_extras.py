"""The package, its queries and its tests work when the optional subpackage and its tests are not there."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture
def bare(tmp_path):
    """A copy of the repository without the optional folders; the pipeline's module is left, as it may be."""
    skip = shutil.ignore_patterns("llm", "__pycache__", ".pytest_cache")
    for folder in ("cohortspark", "tests"):
        shutil.copytree(ROOT / folder, tmp_path / folder, ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    return tmp_path


def run(folder, *arguments):
    import os

    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK", "PYSPARK"))} | {"PYTHONPATH": str(folder)}
    return subprocess.run([sys.executable, *arguments], cwd=folder, check=True, env=env, capture_output=True, text=True, timeout=600).stdout


@pytest.mark.parametrize("empty", [False, True])
def test_queries_without_optional_parts(bare, empty):
    if empty:  # a folder that is there and holds nothing
        (bare / "cohortspark" / "llm").mkdir()
    code = "import __spark_entry__ as e; q = e.queries(); assert 'meta_fixed_effect' in q and not any(k.startswith('op') for k in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q); print(len(q))"
    assert int(run(bare, "-c", code)) > 100


def test_tests_without_optional_parts(bare):
    shutil.rmtree(bare / "tests" / "llm", ignore_errors=True)
    (bare / "tests" / "test_without_extras.py").unlink()
    listed = run(bare, "-m", "pytest", "-p", "no:cacheprovider", "--collect-only", "-q", "tests")
    assert "test_numeric.py" in listed
    assert "passed" in run(bare, "-m", "pytest", "-p", "no:cacheprovider", "-q", "tests/test_functions.py")
