import pytest
from comparing import assert_same

import __spark_entry__
from inkmill.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, name):
    assert_same(spark, QUERIES[name], ORACLE_SQL[name], SF)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_works_without_the_training_data_operators(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/inkmill", tmp_path / "inkmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLE_SQL))], done.stderr


def test_faults_of_the_training_data_operators_are_seen(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/inkmill", tmp_path / "inkmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "inkmill/llm").mkdir()
    (tmp_path / "inkmill/llm/__init__.py").write_text("")
    (tmp_path / "inkmill/llm/queries.py").write_text("import a_module_that_is_not_there")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True)
    assert done.returncode and "a_module_that_is_not_there" in done.stderr
