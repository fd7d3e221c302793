import pytest

from quadrangle import session
from workload.trial import ensure_scratch


def test_shuffle_partitions_grow_with_the_input():
    assert session.shuffle_partitions(0) == 200
    assert session.shuffle_partitions(10**13) == 18_627
    assert session.shuffle_partitions(10**14) == 100_000


def test_scratch_paths_are_new_and_shared(spark):
    first, second = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_cut_keeps_rows_and_schema_and_drops_the_plan(spark):
    df = spark.range(10).selectExpr("id", "CAST(id % 3 AS STRING) AS k", "array(id) AS a")
    stored = session.cut(df)
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, stored.select("id", "k").collect())) == sorted(map(tuple, df.select("id", "k").collect()))
    assert "Range" not in stored._jdf.queryExecution().executedPlan().toString()


class _Conf:
    def get(self, name, default=None):
        return default


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master):
        self.conf, self.sparkContext = _Conf(), _Context(master)


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]", "local[2]", "local"])
def test_every_master_needs_a_named_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session(master))


@pytest.mark.parametrize("master, named", [("local[2]", True), ("local", True), ("local-cluster[2,1,1024]", False), ("yarn", False)])
def test_trials_on_one_machine_get_a_folder(master, named):
    trial = _Session(master)
    ensure_scratch(trial)
    assert (trial.sparkContext.getCheckpointDir() is not None) == named


def test_code_is_sent_once(spark):
    session.ship_code(spark)
    session.ship_code(spark)
    assert sum(name.endswith("quadrangle.zip") for name in spark.sparkContext._python_includes) == 1
