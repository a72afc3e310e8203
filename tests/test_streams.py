from datetime import datetime, timedelta

import pytest
from helpers import elevator_messages, message, reading
from pyspark.sql import functions as F

from quayside.catalogue import ELEVATOR
from quayside.plans.cleaning import clean_batch
from quayside.sinks.tables import read_clean, read_rejected
from quayside.sources.topics import stream_source
from quayside.streaming import clean as stream
from quayside.streaming.state import stuck_stream
from quayside.streaming.windows import stream_hourly

ONCE = {"availableNow": True}


class Feed:
    """A cleaning stream over an inbox folder, run batch by batch."""

    def __init__(self, spark, home, **options):
        self.spark, self.home, self.options = spark, home, options
        self.sent, self.counts = 0, []

    def path(self, name):
        return f"{self.home}/{name}"

    def start(self):
        return stream.start_clean_stream(
            stream_source(self.spark, fmt="parquet", path=self.path("inbox")),
            clean_path=self.path("clean"),
            rejected_path=self.path("rejected"),
            checkpoint=self.path("checkpoint"),
            trigger=ONCE,
            on_counts=lambda batch_id, counts: self.counts.append(counts),
            **self.options,
        )

    def drop(self, payloads):
        """Put one file of messages into the inbox."""
        rows = elevator_messages(self.spark, payloads, start=self.sent)
        rows.coalesce(1).write.mode("append").parquet(self.path("inbox"))
        self.sent += len(payloads)

    def send(self, payloads):
        self.drop(payloads)
        query = self.start()
        query.awaitTermination()
        return query

    def clean(self):
        return read_clean(self.spark, self.path("clean"), ELEVATOR)

    def rejected(self):
        return read_rejected(self.spark, self.path("rejected"))

    def seconds(self, df):
        return sorted(r[0] for r in df.select(F.unix_timestamp("event_timestamp") % 3600).collect())

    def stuck(self):
        return self.seconds(self.rejected().filter("reject_reason = 'capteur_bloque'"))


@pytest.fixture
def feed(spark, tmp_path):
    return lambda **options: Feed(spark, str(tmp_path), **options)


def run_of(values, start=0):
    return [reading(start + i, v) for i, v in enumerate(values)]


def test_runs_cross_micro_batches(feed):
    f = feed()
    f.send(run_of([2, 2, 2]))
    f.send(run_of([2, 2, 2], start=3))
    assert f.stuck() == [4, 5]
    assert f.seconds(f.clean()) == [0, 1, 2, 3]
    assert f.counts[-1] == {"valid_count": 1, "rejected_count": 2, "stuck_count": 2}


def test_flagged_rows_update_the_state(feed):
    f = feed()
    f.send(run_of([2, 2, 2, 2, 2]))
    f.send(run_of([2], start=5))
    assert f.stuck() == [4, 5]


def test_rejected_rows_do_not_interrupt_a_run(feed):
    f = feed()
    f.send([*run_of([2, 2, 2]), reading(3, 2, energy=None), *run_of([2, 2], start=4)])
    assert f.stuck() == [5]
    assert f.rejected().count() == 2


def test_late_row_is_kept_and_resets_the_run(feed):
    f = feed()
    f.send(run_of([2, 2, 2, 2], start=10))
    f.send(run_of([3], start=5))
    f.send(run_of([2], start=14))
    assert f.stuck() == [] and f.seconds(f.clean()) == [5, 10, 11, 12, 13, 14]


def test_copies_in_two_batches(spark, feed, tmp_path):
    f = feed()
    f.send(run_of([2, 2, 1]) * 2)
    f.send(run_of([2]))
    assert f.seconds(f.clean()) == [0, 0, 1, 2]
    w = Feed(spark, str(tmp_path / "w"), dedupe="watermark", delay="10 minutes")
    w.send(run_of([2, 2, 1]) * 2)
    w.send([*run_of([2]), reading(3, 2, energy=None)])
    assert w.seconds(w.clean()) == [0, 1, 2]
    assert w.rejected().count() == 1


def test_watermark_reports_what_it_drops(feed):
    f = feed(dedupe="watermark", delay="1 second")
    f.send(run_of([1, 2, 3], start=600))
    f.send(run_of([1], start=1200))
    query = f.send(run_of([1], start=5))
    assert stream.dropped_by_watermark(query) == 1
    assert f.seconds(f.clean()) == [600, 601, 602, 1200]


def test_unknown_mode_is_refused(feed):
    f = feed(dedupe="always")
    f.drop(run_of([1]))
    with pytest.raises(ValueError):
        f.start()


def test_failed_batch_is_repeated_without_copies(feed, monkeypatch):
    f = feed()
    f.send(run_of([2, 2, 2]))
    healthy = stream.StuckState.write

    def lost(*_):
        raise RuntimeError("lost")

    # Both tables are written, the state is not: the batch counts as not done.
    f.drop([*run_of([2, 2, 2], start=3), message(speed=99)])
    monkeypatch.setattr(stream.StuckState, "write", lost)
    with pytest.raises(Exception, match="lost"):
        f.start().awaitTermination()
    monkeypatch.setattr(stream.StuckState, "write", healthy)
    f.start().awaitTermination()
    assert f.stuck() == [4, 5]
    assert f.seconds(f.clean()) == [0, 1, 2, 3]
    assert f.rejected().count() == 3


@pytest.mark.parametrize("batches", [1, 3])
def test_stream_equals_batch(spark, feed, batches):
    payloads = []
    for i in range(90):
        speed = [1, 1, 1, 2][(i // 7) % 4]
        payloads.append(reading(i * 2, speed, equipment_id=f"E{i % 3 and 1}"))
        if i % 10 == 0:
            payloads.append(reading(i * 2, speed, equipment_id=f"E{i % 3 and 1}"))
        if i % 13 == 0:
            payloads.append(message(speed=None))
    f = feed()
    size = len(payloads) // batches
    for n in range(batches):
        f.send(payloads[n * size : (n + 1) * size if n < batches - 1 else None])
    whole = clean_batch(elevator_messages(spark, payloads))
    columns = ["equipment_id", "event_timestamp", "reject_reason"]
    expected = sorted(map(repr, whole.select(*columns).collect()))
    clean = f.clean().withColumn("reject_reason", F.lit(None).cast("string")).select(*columns)
    got = clean.unionByName(f.rejected().select(*columns))
    assert sorted(map(repr, got.collect())) == expected
    assert len(f.stuck()) > 5


def test_stuck_stream_drops_copies_inside_a_batch(spark, tmp_path):
    start = datetime(2026, 1, 1)
    rows = [("E", start + timedelta(seconds=s), n, 2.0) for n, s in enumerate([0, 1, 1, 2, 3, 3, 4])]
    schema = "id string, ts timestamp, seq bigint, v double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = (
        stuck_stream(source, ["id"], ["ts", "seq"], "v", dedupe_on=["ts"])
        .writeStream.format("memory")
        .queryName("stuck_copies")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(**ONCE)
        .start()
    )
    query.awaitTermination()
    got = spark.table("stuck_copies").orderBy("seq").collect()
    assert [(r.seq, r.run_length, r.is_stuck) for r in got] == [
        (0, 1, False), (1, 2, False), (3, 3, False), (4, 4, False), (6, 5, True),
    ]


def test_hourly_window_emits_complete_hours(spark, tmp_path):
    start = datetime(2026, 1, 1, 8)
    rows = [("E", start + timedelta(minutes=20 * i), float(i), "NONE") for i in range(10)]
    clean = spark.createDataFrame(rows, "equipment_id string, event_timestamp timestamp, speed double, alarm string")
    for column in ("load_value", "temperature", "energy", "engine_hours"):
        clean = clean.withColumn(column, F.lit(1.0))
    clean.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(clean.schema).parquet(str(tmp_path / "in"))
    query = (
        stream_hourly(source, ELEVATOR, "10 minutes")
        .writeStream.format("memory")
        .queryName("hours")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(**ONCE)
        .start()
    )
    query.awaitTermination()
    got = spark.table("hours").orderBy("hour_key").collect()
    assert [(r.hour_key, r.measurement_count, r.avg_speed) for r in got] == [(8, 3, 1.0), (9, 3, 4.0)]


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        stream_source(spark, ["rmg"], **{"kafka.bootstrap.servers": "nowhere:9092"})


@pytest.mark.parametrize("limit", [{"maxFilesPerTrigger": "2"}, {"maxBytesPerTrigger": "1"}])
def test_rate_limits_cut_a_backlog_into_batches(spark, tmp_path, limit):
    inbox = str(tmp_path / "inbox")
    for part in range(4):
        elevator_messages(spark, run_of([1], start=part), start=part).coalesce(1).write.mode("append").parquet(inbox)
    sizes = []
    query = (
        stream_source(spark, [ELEVATOR], fmt="parquet", path=inbox, **limit)
        .writeStream.foreachBatch(lambda batch, number: sizes.append(batch.count()))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(**ONCE)
        .start()
    )
    query.awaitTermination()
    assert sizes == ([2, 2] if "maxFilesPerTrigger" in limit else [1, 1, 1, 1])
