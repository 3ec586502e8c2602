import pytest

from keyedflow.sources import files
from keyedflow.sources.jdbc import jdbc_options
from keyedflow.sources.lines import text_lines, topic_options


def test_topic_options():
    assert topic_options("h:9092", "t", "earliest", 5000) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5000",
    }
    assert "maxOffsetsPerTrigger" not in topic_options("h:9092", "t")


def test_jdbc_options_split_the_read():
    options = jdbc_options("jdbc:x:y", "t", "id", 0, 1000, 8, fetchsize="500")
    assert options == {
        "url": "jdbc:x:y", "dbtable": "t", "fetchsize": "500", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "1000", "numPartitions": "8",
    }
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x:y", "t", "id")


def test_text_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n,,\n")
    assert [r.line for r in text_lines(spark, str(tmp_path)).collect()] == ["x,y", ",,"]


def test_shared_dir_is_below_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    one, other = files.shared_dir(spark, "x"), files.shared_dir(spark, "x")
    assert one != other and (root is None or one.startswith(root))


def test_no_local_folder_on_a_cluster(spark):
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        files.shared_dir(Session(), "x")
    Session.sparkContext.master = "local[4]"
    assert files.shared_dir(Session(), "x") != files.shared_dir(Session(), "x")
