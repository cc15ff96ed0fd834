from helpers import rows
from pyspark.sql import functions as F

from tripflow.plans import jobs
from tripflow.schemas import MESSAGE_SCHEMA
from tripflow.streaming import messages


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_encode_and_decode_are_inverse(spark):
    df = spark.createDataFrame([(1,), (None,)], "number long")
    encoded = messages.encode_messages(df)
    assert encoded.columns == ["value"]
    decoded = messages.decode_messages(encoded, MESSAGE_SCHEMA)
    assert set(rows(messages.well_formed(decoded))) == {(1,), (None,)}
    keyed = messages.encode_messages(df.filter("number = 1"), key="number")
    assert rows(keyed) == [("1", '{"number":1}')]


def test_binary_topic_values_are_decoded(spark):
    df = spark.createDataFrame([(bytearray(b'{"number":5}'), 3)], "value binary, offset int")
    decoded = messages.decode_messages(df, MESSAGE_SCHEMA)
    assert rows(decoded) == [(3, 5, None)]


def test_malformed_messages_go_to_quarantine(spark):
    df = spark.createDataFrame([('{"number":5}',), ("{oops",), ('{"number":"x"}',)], "value string")
    decoded = messages.decode_messages(df, MESSAGE_SCHEMA)
    assert rows(messages.well_formed(decoded)) == [(5,)]
    assert set(rows(messages.quarantined(decoded))) == {("{oops",), ('{"number":"x"}',)}


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    inbox, out, checkpoint = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/cp"

    def drain():
        stream = messages.read_text_files(spark, str(inbox))
        jobs.consume(stream, out, checkpoint).awaitTermination()
        return messages.read_stored(spark, out)

    put(inbox, "a.json", '{"number":1}', "{oops")
    assert set(rows(drain())) == {(1, None), (None, "{oops")}
    put(inbox, "b.json", '{"number":2}')
    assert messages.well_formed(drain()).count() == 2
    assert messages.well_formed(drain()).count() == 2


def test_action_runs_once_per_batch_and_replays_are_idempotent(spark, tmp_path):
    inbox, out = tmp_path / "in", f"{tmp_path}/out"
    put(inbox, "a.json", '{"number":1}', '{"number":2}')

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    stream = messages.read_text_files(spark, str(inbox))
    jobs.consume(stream, out, f"{tmp_path}/cp", action=store).awaitTermination()
    store(messages.decode_messages(spark.read.text(str(inbox)), MESSAGE_SCHEMA), 0)
    assert rows(spark.read.parquet(out).select("number")) == [(1,), (2,)]


def test_console_sink_drains(spark, tmp_path):
    put(tmp_path / "in", "a.json", '{"number":1}')
    decoded = messages.decode_messages(
        messages.read_text_files(spark, str(tmp_path / "in")), MESSAGE_SCHEMA
    )
    query = messages.print_messages(decoded, f"{tmp_path}/cp", once=True)
    query.awaitTermination()
    assert query.exception() is None


def test_topic_options():
    assert messages.topic_options("h:1", "trips") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "trips",
        "startingOffsets": "earliest",
    }
    assert messages.topic_options("h:1", "t", earliest=False)["startingOffsets"] == "latest"


def test_decoded_stream_can_be_scored_or_filtered(spark, tmp_path):
    put(tmp_path / "in", "a.json", '{"number":1}', '{"number":20}')
    decoded = messages.decode_messages(
        messages.read_text_files(spark, str(tmp_path / "in")), MESSAGE_SCHEMA
    ).filter(F.col("number") > 10)
    messages.store_messages(decoded, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert messages.read_stored(spark, f"{tmp_path}/out").select("number").collect()[0][0] == 20
