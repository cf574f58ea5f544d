import json

import pytest

from sluice.sources.jdbc import JdbcSettings, jdbc_options
from sluice.sources.kafka import KafkaSettings, client_options, kafka_options, position_text, trigger_options


def test_named_topics():
    options = kafka_options(KafkaSettings(brokers="b:1", topic=" a, b ", group_id="g", max_poll_records=5))
    assert options == {
        "subscribe": "a,b",
        "kafka.bootstrap.servers": "b:1",
        "kafka.security.protocol": "PLAINTEXT",
        "kafka.isolation.level": "read_committed",
        "kafka.default.api.timeout.ms": "60000",
        "kafka.group.id": "g",
        "includeHeaders": "true",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
    }


def test_pattern_transactions_and_reset():
    options = kafka_options(
        KafkaSettings(topic="a.*", topic_type="pattern", honor_transactions=False, offset_reset="earliest"), False
    )
    assert options["subscribePattern"] == "a.*" and options["kafka.isolation.level"] == "read_uncommitted"
    assert (options["startingOffsets"], options["endingOffsets"]) == ("earliest", "latest")
    assert kafka_options(KafkaSettings(topic="a", fail_on_data_loss=False))["failOnDataLoss"] == "false"


def test_stored_positions(spark):
    rows = [("a", 0, 7), ("a", 1, 0), ("b", 0, 12)]
    text = position_text(spark.createDataFrame(rows, "topic string, partition int, next_offset bigint"))
    assert json.loads(text) == {"a": {"0": 7, "1": 0}, "b": {"0": 12}}
    for streaming in (True, False):
        options = kafka_options(KafkaSettings(topic="a, b"), streaming, text)
        assert options["startingOffsets"] == text and ("endingOffsets" in options) != streaming
    with pytest.raises(ValueError, match="given positions"):
        kafka_options(KafkaSettings(topic="a"), False)


def test_stream_limits():
    settings = KafkaSettings(topic="a", max_offsets_per_trigger=7, max_uncommitted_time="2 secs", min_partitions=50)
    options = kafka_options(settings)
    assert (options["maxOffsetsPerTrigger"], options["minPartitions"]) == ("7", "50")
    assert trigger_options(settings) == {"processingTime": "2000 milliseconds"}


def test_client_options():
    got = client_options({"fetch.max.wait.ms": "5 secs", "retry.backoff.ms": "100", "enable.auto.commit": "False"})
    assert got == {"kafka.fetch.max.wait.ms": "5000", "kafka.retry.backoff.ms": "100"}


@pytest.mark.parametrize(
    "settings",
    [
        KafkaSettings(topic=" , "),
        KafkaSettings(topic="a", topic_type="list"),
        KafkaSettings(topic="a", offset_reset="middle"),
        KafkaSettings(topic="a", max_poll_records=0),
        KafkaSettings(topic="a", client={"no.such.option": "1"}),
        KafkaSettings(topic="a", client={"auto.offset.reset": "latest"}),
        KafkaSettings(topic="a", client={"enable.auto.commit": "true"}),
        KafkaSettings(topic="a", client={"group.id": "g"}, group_id="h"),
        KafkaSettings(topic="a", client={"session.timeout.ms": "soon"}),
    ],
)
def test_bad_settings(settings):
    with pytest.raises(ValueError):
        kafka_options(settings)


JDBC = JdbcSettings("jdbc:x", "u", "p", "D", "1500 ms", {"ssl": "on"})


def test_jdbc():
    common = {"ssl": "on", "url": "jdbc:x", "user": "u", "password": "p", "driver": "D", "queryTimeout": "1"}
    assert jdbc_options(JDBC, table="t") == common | {"dbtable": "t"}
    assert jdbc_options(JDBC, query="q") == common | {"query": "q"}
    split = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    assert jdbc_options(JDBC, query="q", partition_column="id", bounds=("0", "9"), partitions=3) == (
        common | split | {"dbtable": "(q) q"}
    )
    assert jdbc_options(JdbcSettings("j", "u", "p", statement_limit="250 ms"), table="t")["queryTimeout"] == "0"


@pytest.mark.parametrize("what", [{}, {"table": "t", "query": "q"}, {"table": "t", "partitions": 2}])
def test_bad_jdbc(what):
    with pytest.raises(ValueError):
        jdbc_options(JDBC, **what)


def test_jdbc_property_clash():
    with pytest.raises(ValueError):
        jdbc_options(JdbcSettings("j", "u", "p", properties={"user": "x"}), table="t")
