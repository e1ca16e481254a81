"""Model files that executors fetch: folders beyond one process, several of one name."""

import os
import subprocess
import sys
import textwrap

from pyspark.sql import functions as F

from velograph.operators import forecast


def _load(folder):
    import pathlib
    add = sum(float(f.read_text()) for f in pathlib.Path(folder).rglob("*.txt"))
    return lambda x: x[:, -1:] + add


def _scored(spark, folder):
    w = spark.range(4).select(F.timestamp_seconds("id").alias("label_start"), F.lit("s").alias("edge_id"),
                              F.array(F.lit(10.0)).alias("x"), F.array(F.lit(1.0)).alias("y"))
    return {r.pred[0] for r in forecast.score_with_artifact(w, str(folder), _load, 1).collect()}


def test_folders_of_one_name_stay_apart(spark, tmp_path):
    for name, parts in {"a": {"m.txt": "1", "in/m.txt": "2", "_hidden.txt": "70"}, "b": {"m.txt": "5"}}.items():
        for inner, text in parts.items():
            file = tmp_path / name / "model" / inner
            file.parent.mkdir(parents=True, exist_ok=True)
            file.write_text(text)
    assert _scored(spark, tmp_path / "a" / "model") == {13.0}
    assert _scored(spark, tmp_path / "b" / "model") == {15.0}
    (tmp_path / "b" / "model" / "m.txt").write_text("7.5")
    assert _scored(spark, tmp_path / "b" / "model") == {17.5}


def test_folder_reaches_executors_of_other_processes(tmp_path):
    (tmp_path / "model").mkdir()
    (tmp_path / "model" / "m.txt").write_text("3")
    code = f"""
        from pyspark.sql import SparkSession
        from tests.test_model_files import _scored
        spark = (SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.ui.enabled", "false").config("spark.executor.memory", "1g")
                 .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate())
        print("SCORED", _scored(spark, "{tmp_path}/model"))
        spark.stop()
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=300)
    assert "SCORED {13.0}" in out.stdout, out.stderr[-2000:]
