import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_entry_and_names(spark):
    assert entry.entry(spark).columns == ["input_seq", "corporate_debtor", "reserve_price", "combined"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_all_but_the_training_data_works_without_its_folders(tmp_path):
    """The whole repository but the two folders, corpus_pipeline.py included: entry(), all names, and every test module."""
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", "__pycache__", ".git", ".pytest_cache"))
    code = """
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
names = sorted(e.queries())
print([n for n in names if n[:2] == "op" and n[2:3].isdigit() or n == "pipeline"], len(names) > 40, set(e.oracle_sql()) <= set(names), e.entry(spark).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = lambda *args: subprocess.run([sys.executable, "-B", *args], cwd=tmp_path / "repo", env=env, capture_output=True, text=True)
    out = run("-c", code)
    assert out.stdout.strip() == "[] True True 15", out.stderr
    listed = run("-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider")
    assert listed.returncode == 0 and "error" not in listed.stdout.lower(), listed.stdout


def spark_mode(df):
    return df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")


def explained(df):
    return df._jdf.queryExecution().explainString(spark_mode(df))


def test_plans(spark, sf_dir):
    queries = entry.queries()
    top = explained(queries["top_scored"](spark, sf_dir))
    assert "TakeOrderedAndProject" in top and "Python" not in top and "Cartesian" not in top
    assert "WindowGroupLimit" in explained(queries["top_scored_by_batch"](spark, sf_dir))
    recent = explained(queries["identity_key"](spark, sf_dir))
    assert "ReadSchema" in recent and "value" not in recent.split("ReadSchema")[1]
    for name in ("change_status", "form_fields", "plot_size", "registry_lookup", "report_sections"):
        text = explained(queries[name](spark, sf_dir)).replace("(Python)", "")  # the scan of the registry's data source
        assert "Python" not in text and "Cartesian" not in text, name
