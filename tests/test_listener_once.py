"""Listener logs are read by their patterns once."""

from flowloom.plans import jobs
from flowloom.session import work_path
from flowloom.sources import logs


def test_listener_lines_are_read_by_their_patterns_once(spark, monkeypatch):
    calls, plain = [], logs._with_parts
    monkeypatch.setattr(logs, "_with_parts", lambda *a: calls.append(1) or plain(*a))
    line = "01-02-2016 10:00:00 * (CONNECT_DATA=(SID=Db)(CID=(PROGRAM=P)(HOST=H)(USER=U))) * (ADDRESS=(PROTOCOL=tcp)(HOST=10.0.0.1)(PORT=5)) * establish * Inst * 0"
    broken, ctx = "01-02-2016 11:00:00 * (CONNECT_DATA=(CID=)) * establish broken", jobs.scratch(spark, "listener")
    path = work_path(spark, "logs/listener_HostA_1")
    spark.createDataFrame([(v,) for v in (line, broken, line, "other", None)], "value string").coalesce(1).write.text(path)
    for _ in range(2):
        jobs.ingest_listener(spark, ctx, [path], "2016-05-04", in_pieces=True)
    assert len(calls) == 2
    assert spark.read.parquet(ctx.path("listener")).count() == 2
    assert [r.value for r in spark.read.parquet(ctx.path("listener_trash")).collect()] == [broken]
