"""Small helpers: option builders, sizing, registry, folder versions, batch twins."""

from pyspark.sql import functions as F

from cascata import operators as O
from cascata.sinks import paths, records_per_file, write_rolling_text
from cascata.sinks.files import delimited_records
from cascata.sources.messages import kafka_options, message_id_columns
from cascata.sources.text import read_directory_lines


def test_kafka_options():
    opts = kafka_options("broker:9092", "logs", max_offsets_per_trigger=1000, groupIdPrefix="cascata")
    assert opts["subscribe"] == "logs"
    assert opts["startingOffsets"] == "earliest"
    assert opts["kafka.bootstrap.servers"] == "broker:9092"
    assert opts["maxOffsetsPerTrigger"] == "1000"
    assert opts["groupIdPrefix"] == "cascata"
    assert message_id_columns() == ["topic", "partition", "offset"]


def test_records_per_file():
    assert records_per_file(100) == 52428
    assert records_per_file(10 * 1024 * 1024) == 1
    assert records_per_file(0) == 5 * 1024 * 1024


def test_read_directory_lines_batch(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("1wjoie,wjoeig\r\n111\n")
    (tmp_path / "sub" / "b.txt").write_text("x")
    (tmp_path / "skip.TXT").write_text("no")
    lines = read_directory_lines(spark, str(tmp_path))
    assert sorted(r.line for r in lines.collect()) == ["111", "1wjoie,wjoeig", "x"]


def test_custom_registry_function(spark):
    reg = O.default_registry().register("shout", lambda a: F.upper(a))
    req = spark.createDataFrame([("1", "shout", "hi"), ("2", "addUser", "bo")], "id string, func string, args string")
    responses, dead = O.respond(req, reg)
    assert {r.id: r.result for r in responses.collect()} == {"1": "HI", "2": "add user:bo"}
    assert dead.count() == 0
    assert reg.names() == ["addUser", "shout"]


def test_versions_and_pruning(spark, tmp_path):
    for v in (0, 1, 2, 3):
        (tmp_path / f"v={v}").mkdir()
    (tmp_path / "other").mkdir()
    assert paths.versions(spark, str(tmp_path)) == [0, 1, 2, 3]
    paths.prune_versions(spark, str(tmp_path), keep=2)
    assert paths.versions(spark, str(tmp_path)) == [2, 3]
    assert "other" in paths.children(spark, str(tmp_path))
    assert paths.children(spark, str(tmp_path / "missing")) == []


def test_rolling_text_batch_twin(spark, tmp_path):
    df = spark.range(0, 10_000).select(F.col("id"), (F.col("id") % 7).alias("m")).coalesce(1)
    out = str(tmp_path / "files")
    write_rolling_text(delimited_records(df), out, max_records_per_file=4000)
    parts = [p for p in (tmp_path / "files").iterdir() if p.name.startswith("part-")]
    assert len(parts) == 3
    assert spark.read.text(out).count() == 10_000


def test_mean_record_bytes_sizes_files(spark):
    from cascata.sinks import mean_record_bytes
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    recs = delimited_records(orders)
    m = mean_record_bytes(recs, fraction=1.0)
    exact = recs.selectExpr("avg(octet_length(value) + 1)").first()[0]
    assert abs(m - exact) < 1e-9
    assert records_per_file(m) == int(5 * 1024 * 1024 // m)


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, conf, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d

    def getConf(self):
        return _Conf(self._conf)


class _Session:
    def __init__(self, master, conf):
        self.sparkContext = _Context(master, conf)
        self.conf = _Conf(conf)


def test_checkpoint_root_never_invents_a_local_folder_on_a_cluster():
    import pytest

    from cascata.session import checkpoint_root

    with pytest.raises(RuntimeError):
        checkpoint_root(_Session("yarn", {}))
    shared = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_root(shared) == "hdfs:///shared/ckpt"
    local = checkpoint_root(_Session("local[2]", {}))
    assert local.startswith("/") and "cascata-ckpt-" in local
