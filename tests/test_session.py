import os

from matchlake.session import Workspace


def test_workspace_drops_its_tables_and_nothing_else(spark):
    with Workspace(spark, "kept") as kept:
        other = kept.written(spark.range(3))
        with Workspace(spark, "gone") as gone:
            table = gone.written(spark.range(5))
            assert table.count() == 5 and os.path.isdir(gone.root.removeprefix("file:"))
        assert not os.path.exists(gone.root.removeprefix("file:"))
        assert other.count() == 3
