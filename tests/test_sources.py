import pathlib
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from candlestream.schemas import SALES_SCHEMA, STUDENT_SCHEMA, candle_schema
from candlestream.sources import log
from candlestream.sources import store as store_module
from candlestream.sources.outside import CommittedSink
from candlestream.sources.log import CommitLog, stored
from candlestream.session import CHECKPOINT_CONF, new_folder, shared_folder
from candlestream.sources import documents, kafka
from candlestream.sources.files import infer_csv, read_csv, read_lines, write_tab_lines
from candlestream.sources.store import CandleStore
from tests.data import candles, walk


def test_kafka_reader_options():
    assert kafka.kafka_options("h:1") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "crypto-prices",
        "startingOffsets": "latest", "failOnDataLoss": "false",
    }
    replay = kafka.replay_options("h:1", "t")
    assert (replay["startingOffsets"], replay["endingOffsets"]) == ("earliest", "latest")
    assert replay["failOnDataLoss"] == "true"
    assert kafka.kafka_options("h:1", per_trigger=500)["maxOffsetsPerTrigger"] == "500"
    assert kafka.sink_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.acks": "1", "kafka.retries": "5",
    }


def test_kafka_tls_takes_texts_not_paths(tmp_path):
    for name in ("ca", "crt", "key"):
        (tmp_path / name).write_text(f"PEM {name}")
    tls = kafka.Tls.from_files(*(str(tmp_path / n) for n in ("ca", "crt", "key")))
    options = kafka.kafka_options("h:1", tls=tls)
    assert options["kafka.security.protocol"] == "SSL"
    assert options["kafka.ssl.truststore.certificates"] == "PEM ca"
    assert options["kafka.ssl.keystore.certificate.chain"] == "PEM crt"
    assert options["kafka.ssl.keystore.key"] == "PEM key"
    assert not any("location" in key for key in options)


def test_document_options(spark, monkeypatch):
    monkeypatch.delenv(documents.URI_ENV, raising=False)
    with pytest.raises(ValueError):
        documents.document_options(None, "d", "c")
    monkeypatch.setenv(documents.URI_ENV, "mongodb://env")
    assert documents.document_options(spark, "d", "c") == {
        documents.URI_CONF: "mongodb://env", "database": "d", "collection": "c",
    }
    assert documents.document_options(spark, "d", "c", "mongodb://x")[documents.URI_CONF] == "mongodb://x"


@pytest.mark.parametrize("sep", [",", ";"])
def test_csv_by_name_with_fixed_types(spark, tmp_path, sep):
    path = tmp_path / "s.csv"
    rows = ["Country,Extra,UnitPrice,Quantity", "France,?,1.5,2", "Spain,?,x,3", ",?,2,"]
    path.write_text("\n".join(rows).replace(",", sep))
    df = read_csv(spark, str(path), SALES_SCHEMA, sep)
    assert df.schema == SALES_SCHEMA
    assert [tuple(r) for r in df.collect()] == [
        (2, 1.5, "France"), (3, None, "Spain"), (None, 2.0, None)]


def test_files_with_another_header_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Quantity,UnitPrice,Country\n1,2,France\n")
    (tmp_path / "b.csv").write_text("Country,Quantity,UnitPrice\nSpain,3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path), SALES_SCHEMA).collect()


def test_csv_students(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(",".join(STUDENT_SCHEMA.names) + "\nyes,health,no,U,9,4,1,1,11,5\n")
    assert read_csv(spark, str(path), STUDENT_SCHEMA).first().G3 == 9


def test_lines_in_and_tab_lines_out(spark, tmp_path):
    (tmp_path / "in.txt").write_text("b a\na\n")
    assert read_lines(spark, str(tmp_path / "in.txt")).count() == 2
    df = spark.createDataFrame([("a", 2), ("b", 1)], "word string, n long").coalesce(1)
    write_tab_lines(df, str(tmp_path / "out"), "word", "n")
    assert [r.value for r in read_lines(spark, str(tmp_path / "out")).collect()] == ["a\t2", "b\t1"]


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get(CHECKPOINT_CONF).rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")


class Conf(dict):
    """A session of which only the settings are looked at."""

    @property
    def conf(self):
        return self


def test_a_machines_own_folder_is_for_local_sessions_only():
    assert shared_folder(Conf({CHECKPOINT_CONF: "hdfs:///x/"})) == "hdfs:///x"
    local = shared_folder(Conf({"spark.master": "local[2]"}))
    assert shared_folder(Conf({"spark.master": "local[2]"})) == local
    with pytest.raises(ValueError):
        shared_folder(Conf({"spark.master": "yarn"}))


@pytest.fixture
def store(spark, tmp_path):
    return CandleStore(spark, str(tmp_path / "store"))


def test_replayed_batch_leaves_the_same_rows(spark, store):
    first, second = candles(spark, walk(1, {"A": 9})), candles(spark, walk(2, {"B": 4}))
    assert store.append(first, 0)[1] == 9
    store.append(second, 1)
    store.append(second, 1)
    got = store.candles()
    assert got.count() == 13 and got.filter("commit LIKE '1-%'").count() == 4
    again, n = store.append(second, 1)
    assert n == 4 and rows_of(again) == rows_of(second)
    # So does a process that knows nothing of the first one's commits.
    other = CandleStore(spark, store.path)
    assert other.append(second, 1)[1] == 4 and other.candles().count() == 13
    assert other.append(second.limit(0), 2)[1] == 0 and other.candles().count() == 13


def rows_of(df):
    return sorted(map(str, df.select("symbol", "event_time", "close").collect()))


def days(spark, n, seed=1, per_day=5):
    """Candles of n dates."""
    rows = [("A", 1440 * day + 10 * seed + m, float(day + m + seed), 1.0) for day in range(n) for m in range(per_day)]
    return candles(spark, rows)


def data_files(store, table="candles"):
    return {str(f) for f in pathlib.Path(f"{store.path}/{table}/data").rglob("*.parquet")}


def test_a_read_opens_the_files_of_its_dates_only(spark, store):
    for batch in range(3):
        store.append(days(spark, 4, batch), batch, "a writer")
    assert len(store.candles(name="a writer").inputFiles()) == len(data_files(store)) >= 12
    one = store.candles(since="2024-01-02", until="2024-01-02", name="a writer")
    assert one.count() == 15
    assert {f.split("dt=")[1][:10] for f in one.inputFiles()} == {"2024-01-02"}
    assert {unquote(f).split("data/")[1] for f in one.inputFiles()} == {
        f.split("data/")[1] for f in data_files(store) if "dt=2024-01-02" in f}
    assert store.candles(name="nobody").count() == 0 and store.candles(since="2030-01-01").count() == 0


def test_what_was_written_and_not_committed_does_not_count(spark, store, monkeypatch):
    store.append(days(spark, 2), 0)

    def lost(*args):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as broken:
        broken.setattr(CommitLog, "_commit", lost)
        with pytest.raises(RuntimeError):
            store.append(days(spark, 2, 2), 1)
    left = len(data_files(store))
    assert store.candles().count() == 10 and len(store.candles().inputFiles()) < left
    store.append(days(spark, 2, 2), 1)
    assert store.candles().count() == 20
    # Two runs of one batch that both commit: the first counts.
    first, second = CandleStore(spark, store.path), CandleStore(spark, store.path)
    for twin in (first, second):
        twin.log("candles")._known("batch")
    first.append(days(spark, 1, 3), 7)
    second.append(days(spark, 1, 3), 7)
    assert store.candles().count() == 25


def test_epochs_and_compaction_change_no_rows(spark, store, monkeypatch):
    monkeypatch.setattr(log, "EPOCH", 3)
    monkeypatch.setattr(store_module, "_FILES_PER_DATE", 2)
    for batch in range(8):
        store.append(days(spark, 3, batch), batch, "live")
    assert store.log("candles")._heads()["live"] == 2
    want, tail = rows_of(store.candles(name="live")), rows_of(store.tail("live", 4))
    reader = store.candles(name="live")
    opened = len(reader.inputFiles())
    gone = store.compact("candles", candle_schema(), "live", "2024-01-03")
    assert gone == sum("2024-01-03" not in f for f in reader.inputFiles())
    got = store.candles(name="live")
    assert rows_of(got) == want == rows_of(reader) and rows_of(store.tail("live", 4)) == tail
    assert len(got.inputFiles()) <= opened - gone + 4
    assert store.compact("candles", candle_schema(), "live", "2024-01-03") == 0
    # Commits, replays and epochs go on.
    other = CandleStore(spark, store.path)
    for batch in range(6, 12):
        other.append(days(spark, 1, batch), batch, "live")
    assert store.log("candles")._heads()["live"] > 2
    assert store.candles(name="live").count() == 8 * 15 + 4 * 5


def test_a_broken_table_is_an_error_not_an_empty_one(spark, tmp_path):
    assert stored(spark, "a int", str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no table")
    with pytest.raises(Exception):
        stored(spark, "a int", str(tmp_path / "bad")).collect()


def test_writers_may_lack_columns(spark, store):
    c = candles(spark, walk(3, {"A": 3}))
    store.append(c, 0, "v0")
    store.append(c.drop("window_start", "window_end", "vwap").withColumn("RSI", F.lit(1.0)), 0, "vT")
    got = store.candles()
    assert got.columns[:11] == candle_schema().names
    assert got.filter("writer = 'vT' AND window_start IS NULL AND vwap IS NULL").count() == 3
    assert got.filter("window_start IS NOT NULL").count() == 3


def test_date_folders_are_pruned(spark, store):
    store.append(candles(spark, [("A", 0, 1.0), ("A", 60 * 24 * 3, 2.0)]), 0)
    late = store.candles(since="2024-01-03")
    assert [r.close for r in late.collect()] == [2.0]
    assert all("dt=2024-01-04" in f for f in late.inputFiles())


def test_tail(spark, store):
    c = candles(spark, walk(4, {"A": 50, "B": 7}))
    store.append(c, 0, "one")
    store.append(c, 0, "two")
    got = store.tail("one", 33)
    assert dict(map(tuple, got.groupBy("symbol").count().collect())) == {"A": 33, "B": 7}
    assert got.select("event_time", "symbol").distinct().count() == 40


def test_publish_replaces_at_once(spark, store):
    with pytest.raises(ValueError):
        store.published()
    for version, n in ((9, 5), (10, 3)):
        store.publish(candles(spark, walk(version, {"A": n})), version)
    reader = store.published()
    assert reader.count() == 3
    # A folder that no version row names is not there yet.
    reader.limit(1).write.parquet(f"{store.path}/published/indicators/data/000000000011-x")
    assert store.published().count() == 3
    # A version published again leaves what is being read alone.
    store.publish(candles(spark, walk(11, {"A": 4})), 10)
    assert reader.count() == 3 and store.published().count() == 4


def test_csv_types_are_found_in_all_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,x,day,at,flag,none,text,big\n1,1,2024-01-02,2024-01-02 03:04:05,true,,a,1\n"
                                    "-2,2.5,2024-1-3,2024-01-02,FALSE, ,1,9999999999\n")
    (tmp_path / "b.csv").write_text("text,flag,n,x,late\n2024-01-01,false,+3,1e3,7\n,,,,\n")
    (tmp_path / "c.csv").write_text("")
    got = infer_csv(spark, str(tmp_path))
    assert dict(got.dtypes) == {
        "n": "int", "x": "double", "day": "date", "at": "timestamp", "flag": "boolean", "none": "string",
        "text": "string", "big": "bigint", "late": "int"}
    assert got.count() == 4
    assert sorted((r.n, r.x, r.text) for r in got.filter("n IS NOT NULL").collect()) == [
        (-2, 2.5, "1"), (1, 1.0, "a"), (3, 1000.0, "2024-01-01")]
    assert got.filter("n IS NULL AND text IS NULL AND flag IS NULL").count() == 1
    (tmp_path / "d.csv").write_text("n\nx\n")
    assert dict(infer_csv(spark, str(tmp_path)).dtypes)["n"] == "string"


def test_csv_with_another_separator_or_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b c\n")
    got = infer_csv(spark, str(tmp_path / "a.csv"), ";")
    assert got.dtypes == [("a", "string"), ("b c", "string")] and got.count() == 0
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError, match="header"):
        infer_csv(spark, str(tmp_path / "a.csv"))


def test_a_sink_is_read_once_per_batch(spark, tmp_path, monkeypatch):
    sink = CommittedSink("parquet", {"path": str(tmp_path / "rows")}, {"path": str(tmp_path / "commits")})
    c = candles(spark, walk(5, {"A": 6, "B": 2}))
    sink.write(c, 0, "one")
    own, calls = CommittedSink._append, []

    def fails(self, df, options):
        calls.append(options)
        if len(calls) == 2:
            raise RuntimeError("lost before the commit")
        own(self, df, options)

    with monkeypatch.context() as broken:
        broken.setattr(CommittedSink, "_append", fails)
        with pytest.raises(RuntimeError):
            sink.write(c, 1, "one")
    assert sink.read(spark, c.schema).count() == 8
    for _ in range(2):
        sink.write(c, 1, "one")
    sink.write(c, 0, "two")
    got = sink.read(spark, c.schema)
    assert dict(map(tuple, got.groupBy("writer").count().collect())) == {"one": 16, "two": 8}
    assert rows_of(got.filter("writer = 'two'")) == rows_of(c)
