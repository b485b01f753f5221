"""The kernel builds wherever a session runs, and its absence only stops what needs it."""

import subprocess
import sys

import pytest

from coverlay import kernel
from tests.conftest import DATA


def test_class_path_from_the_running_session(spark, monkeypatch, tmp_path):
    """PySpark's own folder hidden: the JVM still says where its classes are."""
    monkeypatch.setattr(kernel.pyspark, "__file__", str(tmp_path / "nowhere" / "__init__.py"))
    monkeypatch.delenv("SPARK_HOME", raising=False)
    assert kernel.build_jar(tmp_path / "jar", spark).endswith(".jar")
    with pytest.raises(kernel.KernelUnavailable, match="not found; searched"):
        kernel.class_path()


def test_build_in_a_plain_locale(tmp_path):
    code = f"from coverlay.kernel import build_jar; print(build_jar({str(tmp_path)!r}))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env={"PATH": "/usr/bin:/bin:/usr/local/bin", "LC_ALL": "C", **_java()}, cwd=sys.path[0] or ".", timeout=200)
    assert done.returncode == 0 and list(tmp_path.glob("*.jar")), done.stderr


def _java():
    import os

    return {k: os.environ[k] for k in ("JAVA_HOME", "PYTHONPATH", "PATH") if k in os.environ}


def test_plain_queries_need_no_kernel():
    """In a session of its own that can't build the kernel."""
    code = f"""
import coverlay.kernel as K
def broken(*a, **b): raise K.KernelUnavailable("no kernel here")
K.build_jar = broken
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as e
for name in ("fil1", "agg4", "set1", "scl3"):
    print(name, e.queries()[name](spark, "{DATA}/sf0.001").count())
try:
    e.queries()["fil5"](spark, "{DATA}/sf0.001")
except K.KernelUnavailable:
    print("kernel asked for")
"""
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, timeout=200)
    assert done.returncode == 0 and "kernel asked for" in done.stdout, done.stderr[-2000:]
