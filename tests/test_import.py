"""The driver loads PySpark from pyspark.zip: importing the queries must not
read files next to the pyspark package, nor need a session."""

import glob
import os
import subprocess
import sys

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_with_pyspark_zip_first():
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = glob.glob(os.path.join(lib, "*.zip"))
    assert zips
    code = ("import pyspark, __spark_entry__ as e; assert '.zip' in pyspark.__file__; "
            "assert len(e.queries()) > 150; assert len(e.oracle_sql()) > 130; print('ok')")
    env = os.environ | {"PYTHONPATH": ":".join([*zips, ROOT])}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and "ok" in out.stdout, out.stderr


def test_stop_words_are_sparks(spark):
    from quarry.operators.profile import english_stop_words
    from pyspark.ml.feature import StopWordsRemover
    assert sorted(english_stop_words()) == sorted(StopWordsRemover.loadDefaultStopWords("english"))
