import os

import pytest

from dealerlake.session import drop_written, shared_folder, written


def test_written_tables_lie_in_the_shared_folder(spark):
    df = written(spark.range(3).selectExpr("id", "'x' AS v"))
    folder = shared_folder(spark).removeprefix("file:")
    assert folder == spark.conf.get("spark.checkpoint.dir")
    own = f"{folder}/dealerlake/{spark.sparkContext.applicationId}"
    assert df.count() == 3 and os.listdir(own)
    os.makedirs(f"{folder}/dealerlake/another")
    drop_written(spark)
    assert not os.path.exists(own) and os.path.exists(f"{folder}/dealerlake/another")


def test_a_cluster_must_name_the_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())
