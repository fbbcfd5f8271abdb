import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from panelforge.session import DEFAULTS
    b = (SparkSession.builder.master("local[*]").appName("panelforge-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pf-test-ckpt-"))
    from panelforge.session import checkpoint_dir
    checkpoint_dir(s)
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="pf-test-")
