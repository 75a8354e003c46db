"""Dead letters and the committed table."""

import pytest
from pyspark.sql import functions as F

from lendwise.fixtures import loans
from lendwise.plans.pipeline import LoanPrep
from lendwise.sources import files
from lendwise.streaming import stream
from lendwise.streaming.sink import CommittedTable


@pytest.fixture(scope="module")
def model(spark, sf):
    return LoanPrep().fit(loans(spark, sf))


def send(spark, folder, *batches):
    """One file of messages per batch, in order of the names."""
    for k, lines in enumerate(batches):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{folder}/{k}")


def message(i):
    return f'{{"loan_id": {i}, "loan_amount": {i}.5, "term": " 36 months"}}'


def run(spark, model, folder, sink, checkpoint):
    messages = stream.read_messages(spark, f"{folder}/*", max_files_per_trigger=1)
    q, flag = stream.clean_stream(spark, model, messages, stream.message_schema(), sink, checkpoint, trigger={"availableNow": True})
    stream.run_until_eof(q, flag)
    return flag.event.is_set()


def test_a_bad_message_in_the_middle_loses_nothing(spark, model):
    folder, sink, checkpoint = (files.scratch_path(spark, f"dead-{k}") for k in ("in", "sink", "ckpt"))
    send(spark, folder, [message(1), message(2)], [message(3), "{broken", '{"loan_id": "seven"}', message(4), "[]"], [message(5)], ['"EOF"'])
    assert run(spark, model, folder, sink, checkpoint)
    ids = lambda: sorted(r["loan_id"] for r in stream.read_sink(spark, sink).collect())
    dead = lambda: sorted((r["value"], r["error"], "dead-in" in r["origin"]) for r in stream.dead_letters(spark, sink).collect())
    first = ids(), dead()
    assert first[0] == [1, 2, 3, 4, 5]
    assert first[1] == sorted([("[]", "no JSON object", True), ("{broken", "malformed JSON, or a value of another type", True),
                        ('{"loan_id": "seven"}', "malformed JSON, or a value of another type", True)])
    # A batch whose offsets were not yet recorded is replayed: the stream forgets its last commit, the table does not.
    done = files.listed(spark, f"{checkpoint}/commits")
    files.remove(spark, f"{checkpoint}/commits/{done[-1]}")
    files.remove(spark, f"{checkpoint}/commits/.{done[-1]}.crc")
    run(spark, model, folder, sink, checkpoint)
    assert (ids(), dead()) == first
    # Another query (a new checkpoint) is not taken for a replay of the first.
    run(spark, model, folder, sink, files.scratch_path(spark, "dead-ckpt2"))
    assert ids() == sorted(first[0] * 2)


def rows(spark, *ids, kind="clean"):
    return spark.createDataFrame([(i, kind) for i in ids], "id long, kind string")


def table(spark):
    t = CommittedTable(spark, files.scratch_path(spark, "committed"))
    for kind in ("clean", "dead"):
        t.declare(kind, rows(spark, 1).drop("kind").schema)
    return t


def ids(t, kind="clean"):
    return sorted(r["id"] for r in t.read(kind).collect())


def test_a_half_written_batch_is_invisible(spark):
    t = table(spark)
    assert ids(t) == []
    t.commit("s-1", rows(spark, 1, 2).union(rows(spark, 9, kind="dead")))
    rows(spark, 3).drop("kind").write.parquet(f"{t.path}/data/s-2-attempt/kind=clean")  # never published
    assert ids(t) == [1, 2] and ids(t, "dead") == [9]

    def fails(i):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        t.commit("s-2", rows(spark, 3, 4).withColumn("id", F.udf(fails, "long")("id")))
    assert ids(t) == [1, 2] and not t.committed("s-2")
    t.commit("s-2", rows(spark, 3, 4))
    assert ids(t) == [1, 2, 3, 4]
    assert t.vacuum() >= 1 and ids(t) == [1, 2, 3, 4] and ids(t, "dead") == [9]


def test_compaction_keeps_the_rows_and_the_names(spark):
    t = table(spark)
    for k in range(6):
        t.commit(f"s-{k}", rows(spark, 2 * k, 2 * k + 1).union(rows(spark, 100 + k, kind="dead")))
    before = t.read()  # a reader that listed the batches earlier
    assert t.compact(rows_per_file=5) is not None
    assert ids(t) == list(range(12)) and ids(t, "dead") == list(range(100, 106)) and before.count() == 12
    assert len(t.commits()) == 1 and t.committed("s-3")
    t.commit("s-6", rows(spark, 12))
    assert t.compact() is not None and ids(t) == list(range(13))
    assert t.compact() is None
    assert t.vacuum() == 9 and ids(t) == list(range(13)) and ids(t, "dead") == list(range(100, 106))
