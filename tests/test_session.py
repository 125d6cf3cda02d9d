import subprocess
import sys
import textwrap
from pathlib import Path

import pytest

from ludoshelf import Staging
from ludoshelf.session import CHECKPOINT_CONF, shared_dir

REPO = Path(__file__).resolve().parents[1]


class Cluster:
    """A session of which only the settings are asked."""

    class conf:
        named = None

        @classmethod
        def get(cls, name, default=None):
            return cls.named or default

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match=CHECKPOINT_CONF):
        shared_dir(Cluster)
    Cluster.conf.named = "hdfs://store/shared/"
    assert shared_dir(Cluster) == "hdfs://store/shared"


def test_staging_removes_its_own_run_only(spark):
    one, other = Staging(spark), Staging(spark)
    one(spark.range(3).toDF("id"), "t")
    kept = other(spark.range(3).toDF("id"), "t")
    one.close()
    assert not Path(one.root).exists() and kept.count() == 3


def test_workers_find_the_package_from_a_foreign_folder(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {str(REPO)!r})
        from ludoshelf import build_session
        from ludoshelf.functions.text import slug
        spark = build_session("foreign", "local[2]", **{{"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1"}})
        print("SLUG", spark.createDataFrame([("Crème Brûlée",)], "t string").select(slug("t").alias("s")).first().s)
    """)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=200, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path), **{k: v for k, v in __import__("os").environ.items() if k in ("JAVA_HOME", "PATH")}})
    assert "SLUG creme-brulee" in done.stdout, done.stderr[-2000:]
