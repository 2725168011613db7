"""The stream job against the batch count."""

import os

from conftest import rows
from driftwell.session import scratch_path
from driftwell.streaming import word_count as wc


def put(directory, name, *texts):
    with open(f"{directory}/{name}", "w") as out:
        out.write("\n".join(texts) + "\n")


def run(spark, source, base):
    lines = wc.file_lines(spark, source, "value string", "value", format="text", files_per_batch=1)
    running = wc.start_word_count(lines, f"{base}/counts", f"{base}/checkpoint", available_now=True)
    assert running.awaitTermination(120)


def test_batches_are_counted_on_their_own(spark):
    base = scratch_path(spark, "stream-test")
    source = f"{base}/in"
    os.makedirs(source)
    put(source, "a.txt", "to be or", "not to")
    run(spark, source, base)
    put(source, "b.txt", "to  do", "")
    run(spark, source, base)
    got = rows(wc.read_batches(spark, f"{base}/counts"), "batch", "word", "n")
    # the empty word stands for the second blank and the empty line
    assert got == [(0, "be", 1), (0, "not", 1), (0, "or", 1), (0, "to", 2), (1, "", 2), (1, "do", 1), (1, "to", 1)]


def test_a_repeated_batch_replaces_itself(spark):
    base = scratch_path(spark, "stream-again")
    os.makedirs(f"{base}/in")
    put(f"{base}/in", "a.txt", "x y x")
    run(spark, f"{base}/in", base)
    # the same input without the first run's progress: batch 0 again
    lines = wc.file_lines(spark, f"{base}/in", "value string", "value", format="text")
    wc.start_word_count(lines, f"{base}/counts", f"{base}/checkpoint2", available_now=True).awaitTermination(120)
    assert rows(wc.read_batches(spark, f"{base}/counts"), "word", "n") == [("x", 2), ("y", 1)]


def test_words_with_odd_characters(spark):
    base = scratch_path(spark, "stream-odd")
    os.makedirs(f"{base}/in")
    put(f"{base}/in", "a.txt", 'tab\there "quoted" é\\')
    run(spark, f"{base}/in", base)
    assert rows(wc.read_batches(spark, f"{base}/counts"), "word") == [('"quoted"',), ("tab\there",), ("é\\",)]


def put_later(directory, name, *texts, seconds):
    """A file whose time is that of its turn, so that the source reads files in this order."""
    put(directory, name, *texts)
    os.utime(f"{directory}/{name}", (seconds, seconds))


def start_timed(spark, source, base):
    found = wc.file_lines_with_origin(spark, source, "value string", "value", format="text", files_per_batch=1)
    return wc.start_timed_word_count(found, f"{base}/counts", f"{base}/manifest", f"{base}/checkpoint", available_now=True)


def timed(spark, base):
    """Words by batch and the manifest, with files by name."""
    manifest = wc.read_manifest(spark, f"{base}/manifest").collect()
    batches = {r["batch"]: (r["time_ms"], r["attempts"], [f.rpartition("/")[2] for f in r["files"]]) for r in manifest}
    return rows(wc.read_timed_batches(spark, f"{base}/counts", f"{base}/manifest"), "batch", "word", "n"), batches


def test_batches_carry_their_time_and_files(spark):
    base = scratch_path(spark, "stream-timed")
    os.makedirs(f"{base}/in")
    put_later(f"{base}/in", "b.txt", "to be", "to", seconds=1_000_000)
    put_later(f"{base}/in", "a.txt", "to", seconds=2_000_000)
    assert start_timed(spark, f"{base}/in", base).awaitTermination(120)
    words, batches = timed(spark, base)
    assert words == [(0, "be", 1), (0, "to", 2), (1, "to", 1)]
    assert [(a, f) for _, a, f in (batches[0], batches[1])] == [(1, ["b.txt"]), (1, ["a.txt"])]
    times = [batches[b][0] for b in (0, 1)]
    assert times[0] < times[1]
    assert {f"time_ms={t}" for t in times} == {d for d in os.listdir(f"{base}/counts") if d.startswith("time_ms=")}


def test_a_killed_batch_runs_again_under_its_time_and_is_seen(spark, monkeypatch):
    """The job dies after a batch's counts are written and before its progress is."""
    base = scratch_path(spark, "stream-killed")
    os.makedirs(f"{base}/in")
    put_later(f"{base}/in", "a.txt", "x", seconds=1_000_000)
    put_later(f"{base}/in", "b.txt", "x y", seconds=2_000_000)
    put_later(f"{base}/in", "c.txt", "z", seconds=3_000_000)
    real, calls = wc.count_words, []

    class Writer:
        def __init__(self, frame, die):
            self.frame, self.die = frame, die
            self.write = self

        def mode(self, name):
            return self

        def json(self, path):
            self.frame.write.mode("overwrite").json(path)
            calls.append(path)
            if self.die:
                raise RuntimeError("killed")

    monkeypatch.setattr(wc, "count_words", lambda batch: Writer(real(batch), len(calls) == 1))
    running = start_timed(spark, f"{base}/in", base)
    with __import__("pytest").raises(Exception, match="killed"):
        running.awaitTermination(120)
    # its counts are there, but no attempt has finished, so they are not read
    words, batches = timed(spark, base)
    assert words == [(0, "x", 1)] and sorted(batches) == [0]
    assert start_timed(spark, f"{base}/in", base).awaitTermination(120)
    words, batches = timed(spark, base)
    assert words == [(0, "x", 1), (1, "x", 1), (1, "y", 1), (2, "z", 1)]
    assert [batches[b][1] for b in (0, 1, 2)] == [1, 2, 1]
    assert calls[1] == calls[2] and len(set(calls)) == 3
