import pytest

from strandweave import scratch
from strandweave.operators.ordering import numbered


class Session:
    """What shared_folder asks of a session."""

    def __init__(self, **conf):
        self.values, self.conf = conf, self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_shared_folder_is_the_cluster_s():
    assert scratch.shared_folder(Session(**{"spark.checkpoint.dir": "hdfs://x/y/", "spark.master": "yarn"})) == "hdfs://x/y"
    with pytest.raises(ValueError):
        scratch.shared_folder(Session(**{"spark.master": "spark://host:7077"}))
    with pytest.raises(ValueError):
        scratch.shared_folder(Session())
    assert scratch.shared_folder(Session(**{"spark.master": "local[2]"})) == scratch.shared_folder(Session(**{"spark.master": "local[4]"}))


def test_numbers_follow_the_order(spark):
    df = spark.createDataFrame([(k * 37 % 101, k) for k in range(101)], "v int, k int").repartition(7)
    assert [(r["_number"], r["v"]) for r in numbered(df, ["v"]).orderBy("_number").collect()] == [(k, k) for k in range(101)]
    assert numbered(df.limit(0), ["v"]).count() == 0
