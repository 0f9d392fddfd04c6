"""The registered queries without the corpus part."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_works_without_the_corpus_part(tmp_path):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py", "spark-warehouse")
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    told = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), len(o), any(k.startswith('op') and k[2].isdigit() for k in q))"
    out = subprocess.run([sys.executable, "-c", told], cwd=copy, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 80 and int(out[1]) > 70 and out[2] == "False"


def test_a_missing_dependency_of_the_corpus_part_leaves_the_rest(tmp_path):
    skip = shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse", "tests")
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    if not (copy / "teamlines" / "llm" / "queries.py").exists():
        return
    told = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') and k[2].isdigit() for k in q))"
    (copy / "teamlines" / "llm" / "queries.py").write_text("import a_package_that_is_not_there\n")
    out = subprocess.run([sys.executable, "-c", told], cwd=copy, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 80 and out[1] == "False"
