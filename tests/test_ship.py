"""The package reaches executors that don't have it on their path."""

import os
import subprocess
import sys
import textwrap


def test_workers_import_the_shipped_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = textwrap.dedent("""
        import sys
        sys.path.insert(0, sys.argv[1])  # the driver only
        from sparkwright.operators import moments
        from sparkwright.session import get_spark, ship_package
        spark = get_spark("local[1]", shuffle_partitions=1)
        ship_package(spark)
        df = spark.range(10).selectExpr("cast(id as double) a", "cast(id * 2 as double) b")
        print("GOT", moments.correlations(df, ["a", "b"]).first()["corr"])""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code, root], capture_output=True, text=True, timeout=180, cwd=tmp_path, env=env)
    assert "GOT 1.0" in run.stdout, run.stderr[-2000:]


def test_entry_without_the_training_data_folders(tmp_path):
    """Copies of the repository without the optional folders still import, and
    an empty folder of that name counts as none."""
    import shutil
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/sparkwright", tmp_path / "sparkwright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    os.makedirs(tmp_path / "sparkwright" / "llm" / "__pycache__")
    code = "import __spark_entry__ as e; print('N', len(e.queries()), len(e.oracle_sql()), [q for q in e.queries() if q[:2] == 'op'])"
    env = os.environ | {"PYTHONPATH": str(tmp_path)}
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=tmp_path, env=env)
    assert run.stdout.startswith("N ") and run.stdout.rstrip().endswith("[]"), run.stderr[-2000:]
