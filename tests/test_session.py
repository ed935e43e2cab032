"""Where written intermediates go."""

import pytest

from snaplake.session import CHECKPOINT_DIR, shared_dir


class Conf(dict):
    @property
    def conf(self):
        return self


WAREHOUSE = "spark.sql.warehouse.dir"


def test_the_cluster_names_the_folder():
    spark = Conf({CHECKPOINT_DIR: "hdfs://n/c/", WAREHOUSE: "file:/w", "spark.master": "yarn"})
    assert shared_dir(spark, "x").startswith("hdfs://n/c/snaplake/x-")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_a_folder_of_one_machine_is_refused_on_a_cluster():
    folder = "file:/w"  # Spark names the store in this setting
    with pytest.raises(ValueError, match=CHECKPOINT_DIR):
        shared_dir(Conf({WAREHOUSE: folder, "spark.master": "yarn"}), "x")
    assert shared_dir(Conf({WAREHOUSE: folder, "spark.master": "local[4]"}), "x").startswith(folder)
    assert shared_dir(Conf({WAREHOUSE: "s3a://b/w", "spark.master": "yarn"}), "x").startswith("s3a://b/w")
