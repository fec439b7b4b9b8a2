"""Rules that hold for the whole package."""

import datetime
import re
from pathlib import Path

import pytest

from postline import session
from postline.plans import catalog, daily
from tests.plans import initial_plan

PACKAGE = Path(session.__file__).parent


@pytest.mark.parametrize(
    "word", ["toPandas", r"\.collect\(", "toLocalIterator", r"\.rdd\b", "localCheckpoint", "crossJoin", "inferSchema", r"coalesce\(1\)", r"\budf\b"]
)
def test_not_used(word):
    for file in PACKAGE.rglob("*.py"):
        # The training-data operators have rules and tests of their own.
        assert file.parent.name == "llm" or not re.search(word, file.read_text()), file


def test_every_query_has_its_sql():
    assert catalog.QUERIES.keys() == catalog.SQL.keys()


def test_partitions_grow_with_the_input():
    assert session.partitions_for(100 << 40, 8000) == 409_600
    assert session.partitions_for(1, 4) == 8


def test_nothing_imports_the_training_data_operators():
    for file in [*PACKAGE.rglob("*.py"), PACKAGE.parent / "bench.py"]:
        assert file.parent.name == "llm" or not re.search(r"postline\.llm|corpus_pipeline", file.read_text()), file


def test_a_run_sizes_its_shuffles(spark, monkeypatch, tmp_path):
    """The window of a run over 100 TB of payloads has partitions of 256 MB."""
    monkeypatch.setattr(daily.folders, "size_of", lambda *_: 100 << 40)
    plans = []

    def land(spark, *_):
        rows = spark.range(10).repartition(3).selectExpr("id AS user", "id AS post_id", "id AS date_creation")
        plans.append(initial_plan(daily.timeline_top_n(rows)))
        raise InterruptedError

    monkeypatch.setattr(daily, "land", land)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(InterruptedError):
        daily.run_day(spark, "p", str(tmp_path / "r"), "sized", datetime.date(2024, 1, 1))
    assert re.search(rf"hashpartitioning\(user#\d+L?, {2 * (100 << 40 >> 28)}\)", plans[0])
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


class Cluster:
    """What shared_dir asks of a session."""

    def __init__(self, master, named=None):
        self.settings, self.sparkContext = {}, self
        self.master, self.conf, self.named = master, self, named

    def get(self, key, default=None):
        return self.named or self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value

    def getCheckpointDir(self):
        return None


def test_shared_dir():
    assert session.shared_dir(Cluster("spark://c", "hdfs://shared")) == "hdfs://shared"
    with pytest.raises(ValueError, match="all executors share"):
        session.shared_dir(Cluster("spark://c"))
    local = Cluster("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local) != ""


def test_stage_gives_the_planner_the_size(spark):
    staged = session.stage(spark.range(1000).repartition(3), "t")
    assert staged.count() == 1000
    assert session.shared_dir(spark) in staged.inputFiles()[0]
