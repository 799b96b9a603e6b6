import pytest

from strandweave.llm.components import connected_components


def test_components_never_end_early(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)], "a int, b int")
    assert {r["component"] for r in connected_components(edges).collect()} == {0}
    with pytest.raises(RuntimeError):
        connected_components(edges, most=1)
