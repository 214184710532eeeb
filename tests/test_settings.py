import pytest
from pyspark.sql import SparkSession

from eventlens.settings import Join, Settings, session, window_ms


def test_nothing_set_gives_defaults_without_a_folder():
    settings = Settings.read({"HOME": "/root", "SPARK_MASTER": "yarn"})
    assert settings == Settings()
    with pytest.raises(ValueError, match="EVENTLENS_SINKS"):
        _ = settings.sinks.raw


def test_folders_follow_the_root_unless_named():
    settings = Settings.read({"EVENTLENS_SINKS": "abfs://lake/ev/"})
    assert settings.sinks.raw == "abfs://lake/ev/events_raw"
    assert settings.sinks.pairs == settings.table_place("correlated") == "abfs://lake/ev/correlated"
    assert settings.sinks.checkpoint_root == "abfs://lake/ev/checkpoints"
    other = Settings.read({"EVENTLENS_SINKS": "abfs://lake/ev", "EVENTLENS_TABLES": "/mnt/lake/ev",
                           "EVENTLENS_CHECKPOINTS": "abfs://fast/cp"})
    assert other.table_place("events_raw") == "/mnt/lake/ev/events_raw"
    assert other.sinks.checkpoint_root == "abfs://fast/cp"


@pytest.mark.parametrize("master", ["spark://h:1", "yarn", "k8s://x", "local-cluster[2,1,512]"])
@pytest.mark.parametrize("root", ["", "file:///data", "file:/data"])
def test_a_cluster_refuses_folders_of_one_machine(master, root):
    with pytest.raises(ValueError):
        Settings.at(root).on(master)


def test_folders_that_pass():
    assert Settings.at("/shared/x").on("yarn").sinks.raw == "/shared/x/events_raw"
    assert Settings.at("file:///x").on("local[4]").sinks.raw == "file:///x/events_raw"


@pytest.mark.parametrize(("name", "text"), [
    ("REPAIR_SECONDS", "soon"), ("REPAIR_SECONDS", "-1"), ("HOT_GRID", "0"), ("HIVE", "yes"),
    ("WINDOW", "2 months"), ("SINK", "/x"), ("BATCH_ROWS", ""),
])
def test_an_unfit_setting_is_named(name, text):
    with pytest.raises(ValueError, match=f"EVENTLENS_{name}"):
        Settings.read({f"EVENTLENS_{name}": text})


def test_values_are_read():
    settings = Settings.read({
        "EVENTLENS_HIVE": "true", "EVENTLENS_HOT_ENTITIES": " GME, ,AMC ", "EVENTLENS_WINDOW": "90 seconds",
        "EVENTLENS_BATCH_ROWS": "77", "EVENTLENS_TRIGGER": " 4 seconds "})
    assert settings.tables.hive and settings.bus.batch_rows == 77
    assert settings.join == Join("90 seconds", 8, ("GME", "AMC"))
    assert settings.sinks.trigger == "4 seconds"


def test_the_session_keeps_its_master(spark):
    class Spy(SparkSession.Builder):
        def getOrCreate(self):
            return dict(self._options)

    options = session(Spy(), Settings.read({"EVENTLENS_METASTORE": "thrift://meta:1"}))
    assert options["hive.metastore.uris"] == "thrift://meta:1"
    assert options["spark.sql.session.timeZone"] == "UTC"
    assert "spark.master" not in options


@pytest.mark.parametrize(("text", "ms"), [
    ("3 minutes", 180_000), ("2 hours 5 seconds", 7_205_000), ("40 MILLISECONDS", 40), ("1week", 604_800_000)])
def test_intervals(text, ms):
    assert window_ms(text) == ms


@pytest.mark.parametrize("text", ["", "7", "1 year", "3 minutes' OR '1'='1", "minutes"])
def test_what_is_no_interval(text):
    with pytest.raises(ValueError):
        window_ms(text)
