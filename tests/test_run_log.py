"""The run-log data source: ranges of bytes, damaged lines, files that grow, streams."""

import pytest

from tunewright.sources import datasets as ds
from tunewright.sources import run_log
from tunewright.streaming.episodes import drain

STEP = "[STEP] step={} action=inspect_query reward=0.05 done=false error=null"


@pytest.fixture(scope="module")
def registered(spark):
    spark.dataSource.register(run_log.RunLogSource)
    return spark


def lines(run, n):
    return [f"{run}\t[START] task={run}"] + [f"{run}\t{STEP.format(k)}" for k in range(1, n + 1)] + [f"{run}\t[END] success=true", "no tab", f"x\t{STEP.format(1)}", f"{run}\t[STEP] step=x"]


def test_same_as_the_parser(registered, tmp_path, as_rows):
    (tmp_path / "a.txt").write_text("\n".join(lines(1, 40) + lines(-2, 3)) + "\n")
    (tmp_path / "b.txt").write_text("\n".join(lines(3, 5)))  # no line end
    (tmp_path / "c.txt").write_text("")
    (tmp_path / "_skipped").write_text("\n".join(lines(9, 5)))
    got = registered.read.format("run_log").load(str(tmp_path))
    assert as_rows(got) == as_rows(ds.read_run_log(registered, str(tmp_path))) and got.count() == 48


def test_every_line_in_one_range(tmp_path):
    text = "\n".join(lines(1, 30) + [f"2\t{STEP.format(1)} ü"] + lines(2, 9)) + "\n"
    (tmp_path / "a.txt").write_text(text)
    whole = list(run_log._lines(str(tmp_path), run_log.ByteRange(f"{tmp_path}/a.txt", 0, len(text.encode()))))
    assert whole == text.splitlines()
    for size in (1, 7, 64, 1000):
        parts = run_log._ranges(f"{tmp_path}/a.txt", 0, len(text.encode()), size)
        assert [x for p in parts for x in run_log._lines(str(tmp_path), p)] == whole


def test_no_files(registered, tmp_path):
    assert registered.read.format("run_log").load(f"{tmp_path}/none").count() == 0


def test_stream_follows_files_that_appear_and_grow(registered, tmp_path):
    log, out, state = tmp_path / "log", f"{tmp_path}/out", f"{tmp_path}/state"
    log.mkdir()
    (log / "a.txt").write_text(f"1\t{STEP.format(1)}\n1\t{STEP.format(2)}\n1\t[STEP] ste")
    seen = []
    for more in (None, ("a.txt", "p=3 action=inspect_query reward=0.05 done=false error=null\n"), ("b.txt", f"2\t{STEP.format(1)}\n"), None):
        if more:
            with open(log / more[0], "a") as file:
                file.write(more[1])
        drain(registered.readStream.format("run_log").load(str(log)), out, state)
        seen.append(sorted((r.episode_id, r.step_no) for r in registered.read.schema(run_log.SCHEMA).parquet(out).collect()))
    assert seen == [[(1, 1), (1, 2)], [(1, 1), (1, 2), (1, 3)], [(1, 1), (1, 2), (1, 3), (2, 1)], [(1, 1), (1, 2), (1, 3), (2, 1)]]


def test_round_trip_and_append_only(registered, tmp_path):
    rows = registered.createDataFrame([(7, k, STEP.format(k)) for k in range(1, 6)], "episode_id long, line_no long, line string")
    path = f"{tmp_path}/log"
    rows.write.format("run_log").mode("append").save(path)
    rows.where("line_no > 3").write.format("run_log").mode("append").save(path)
    assert registered.read.format("run_log").load(path).count() == 7
    with pytest.raises(Exception):
        rows.write.format("run_log").mode("overwrite").save(path)
