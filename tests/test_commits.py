"""One version for all tables, bucketed folds, rebuilds over old truncates, and the job's command line."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_durability import event, log_of
from tests.test_streams import rows
from tideline import job
from tideline.operators.envelope import changes, judged_changes
from tideline.operators.state import latest_per_key
from tideline.session import new_folder
from tideline.streaming import ChangeSink, StateTables, rebuild
from tideline.streaming.tables import BatchTable, Segments, folder_counts


def order(op, key, offset, status="PENDING", **source):
    image = {"id": key, "customer_id": key % 3, "status": status}
    return event(op, "orders", image if op == "d" else None, None if op == "d" else image, offset, **source)


def truncate(offset, **source):
    return event("t", "orders", None, None, offset, **source)


@pytest.fixture
def tables(spark):
    return StateTables.at(spark, new_folder(spark, "state"), buckets=8)


def apply(spark, tables, batch, events, **options):
    ChangeSink(tables, **options)(judged_changes(log_of(spark, events)), batch)


def ids(frame):
    return sorted(r["id"] for r in frame.select("id").collect())


@pytest.mark.parametrize("folded", [False, True])
def test_old_truncates_do_not_cut_a_new_log(spark, tables, folded):
    rebuild(log_of(spark, [order("c", 9, 1), truncate(5000)]), tables)
    assert ids(tables.current()) == [] and tables.rejects.read().count() == 1
    if folded:
        tables.fold()
    rebuild(log_of(spark, [order("c", i, i) for i in (1, 2, 3)]), tables)
    assert ids(tables.current()) == [1, 2, 3]
    assert tables.rejects.read().count() == 0 and tables.cuts.read().count() == 0
    tables.fold()
    assert ids(tables.current()) == [1, 2, 3] and tables.rejects.read().count() == 0


def test_an_empty_log_replaces_what_was_there(spark, tables):
    rebuild(log_of(spark, [order("c", 1, 1), truncate(2)]), tables)
    tables.fold()
    rebuild(log_of(spark, []), tables)
    for frame in (tables.current(), tables.counters(), tables.scores(), tables.rejects.read(), tables.batch_rows()):
        assert frame.count() == 0
    tables.fold()
    assert tables.current().count() == 0 and tables.counters().count() == 0


@pytest.mark.parametrize("table", ["latest", "deltas", "rejects", "cuts"])
def test_a_failed_batch_shows_in_no_table(spark, tables, table):
    apply(spark, tables, 0, [order("c", 1, 1)])
    events = [order("u", 1, 2, "SHIPPED"), truncate(3), order("c", 2, 4), event("c", "parts", None, {"id": 1}, 5)]

    def stop(written, batch):
        if written == table:
            raise RuntimeError("stopped")

    before = [rows(t.read()) for t in tables.all]
    with pytest.raises(RuntimeError, match="stopped"):
        apply(spark, tables, 1, events, after_write=stop)
    assert [rows(t.read()) for t in tables.all] == before
    apply(spark, tables, 1, events)
    assert ids(tables.current()) == [2] and tables.rejects.read().count() == 2
    after = [rows(t.read()) for t in tables.all]
    # Committed, so it is left alone, folded or not.
    for _ in range(2):
        apply(spark, tables, 1, [order("c", 77, 9)])
        assert [rows(t.read()) for t in tables.all] == after
        tables.fold()


def test_a_pinned_view_stays_at_its_batch(spark, tables):
    apply(spark, tables, 0, [order("c", 1, 1)])
    view = tables.pinned()
    apply(spark, tables, 1, [order("c", 2, 2)])
    tables.fold()
    assert ids(view.latest.read()) == [1] and view.batch_rows().count() == 1
    assert ids(tables.latest.read()) == [1, 2]


def test_folds_keep_every_table_small_and_every_count(spark, tables):
    for batch in range(6):
        key = 10 * batch
        apply(spark, tables, batch, [order("c", key, key), truncate(key + 1), order("c", key + 1, key + 2)], fold_every=2)
    found = folder_counts(tables)
    for name in ("latest", "deltas", "cuts", "rejects"):
        assert found[f"{name} batches"] <= 2 and found[f"{name} versions"] <= 2, found
    assert found["commits"] <= 4
    assert sorted((r["batch"], r["n"]) for r in tables.batch_rows().collect()) == [(b, 2) for b in range(6)]
    assert tables.rejects.read().count() == 6 and ids(tables.current()) == [51]


def test_a_fold_leaves_untouched_buckets_alone(spark, tables):
    apply(spark, tables, 0, [order("c", i, i) for i in range(100)])
    tables.fold()
    before = tables.latest.base().parts
    assert len(before) == 8
    apply(spark, tables, 1, [order("u", 5, 200, "SHIPPED"), order("d", 6, 201)])
    tables.fold()
    after = tables.latest.base().parts
    touched = {r["b"] for r in spark.createDataFrame([(5,), (6,)], "id long").select(tables.latest.base_kind.bucket().alias("b")).collect()}
    assert {int(b) for b in before if before[b] != after[b]} == touched
    state = {r["id"]: (r["op"], r["status"]) for r in tables.latest.read().collect()}
    assert len(state) == 100 and state[5] == ("u", "SHIPPED") and state[6][0] == "d" and state[7] == ("c", "PENDING")


def test_folds_and_reads_shuffle_no_base(spark, tables, capsys):
    apply(spark, tables, 0, [order("c", i, i) for i in range(100)])
    tables.fold()
    apply(spark, tables, 1, [order("u", 5, 200, "SHIPPED")])
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        tables.latest.read().explain()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    plan = capsys.readouterr().out
    # The only shuffle is that of the new batch; the base meets it by broadcasts.
    base = [line for line in plan.splitlines() if "FileScan" in line and "/base/data" in line]
    assert len(base) >= 2 and plan.count("Exchange hashpartitioning") <= 3
    for block in plan.split("Exchange hashpartitioning")[1:]:
        scan = next(line for line in block.splitlines() if "FileScan" in line)
        assert "/batches" in scan


def test_late_older_changes_never_win(spark, tables):
    apply(spark, tables, 0, [order("c", 1, 10, "NEW"), order("c", 2, 11, "NEW")])
    tables.fold()
    apply(spark, tables, 1, [order("u", 1, 5, "LATE"), order("u", 2, 20, "NEWER")])
    for _ in range(2):
        assert {r["id"]: r["status"] for r in tables.latest.read().collect()} == {1: "NEW", 2: "NEWER"}
        tables.fold()


def test_many_changes_and_many_folds(spark, tables):
    """Past the broadcast bound, and once buckets were written on often enough to be dealt anew."""
    table = tables.latest
    small = BatchTable(**{**vars(table), "base_kind": type(table.base_kind)(4, rounds=2, max_rows=3)})
    want = {}
    for batch in range(7):
        keys = range(20) if batch % 3 == 0 else [batch, batch + 1]
        events = [order("u", k, 100 * batch + k, f"S{batch}") for k in keys]
        want |= {k: f"S{batch}" for k in keys}
        small.write_batch(latest_per_key(changes(log_of(spark, events))), batch)
        tables.commit(batch, len(events), ("latest",))
        assert {r["id"]: r["status"] for r in small.read().collect()} == want
        small.fold()
        assert {r["id"]: r["status"] for r in small.read().collect()} == want
    assert max(age for _, age in small.base().parts.values()) < 2


def test_a_fold_of_many_changes_writes_the_base_only(spark, tables, monkeypatch):
    """No copy of the changes beside the base, and late changes still lose to what is stored."""
    from tideline.streaming import tables as module

    def written(frame):
        raise AssertionError("rows were written beside the base")

    monkeypatch.setattr(module, "cut_lineage", written)
    table = tables.latest
    large = BatchTable(**{**vars(table), "base_kind": type(table.base_kind)(4, max_rows=3)})
    for batch, (first, offset, status) in enumerate([(0, 100, "A"), (10, 50, "LATE"), (5, 200, "B")]):
        events = [order("u", k, offset + k, status) for k in range(first, first + 20)]
        large.write_batch(latest_per_key(changes(log_of(spark, events))), batch)
        tables.commit(batch, len(events), ("latest",))
        assert large.fold() == batch
    want = {k: "B" if 5 <= k < 25 else "A" if k < 20 else "LATE" for k in range(30)}
    got = large.read().collect()
    assert {r["id"]: r["status"] for r in got} == want and len(got) == len(want)


def test_a_batch_is_stored_as_it_comes(spark, tables):
    """Without a shuffle of its own: the last change of a key is settled when batches are read or folded."""
    apply(spark, tables, 0, [order("c", 1, 1), order("u", 1, 2, "SHIPPED"), order("c", 2, 3)])
    stored = tables.latest.batches(tables.latest.places())
    assert sorted((r["id"], r["op"]) for r in stored.collect()) == [(1, "c"), (1, "u"), (2, "c")]
    for _ in range(2):
        assert {r["id"]: r["status"] for r in tables.latest.read().collect()} == {1: "SHIPPED", 2: "PENDING"}
        assert tables.latest.read().count() == 2
        tables.fold()


def test_a_fold_combines_the_changes_of_a_hot_key_before_it_deals_them(spark, tables):
    combined = []

    def combine(rows):
        combined.append(rows)
        return latest_per_key(rows)

    table = tables.latest
    large = BatchTable(**{**vars(table), "combine": combine, "base_kind": type(table.base_kind)(8, max_rows=3)})
    want = {}
    for batch, keys in enumerate([range(400), [7] * 300 + list(range(300, 500))]):
        events = [order("u", k, 1000 * batch + at, f"S{batch}-{at}") for at, k in enumerate(keys)]
        want |= {k: f"S{batch}-{at}" for at, k in enumerate(keys)}
        apply(spark, tables, batch, events)
        large.fold()
        assert len(combined) == batch
        got = large.read().collect()
        assert {r["id"]: r["status"] for r in got} == want and len(got) == len(want)


def test_segments_are_written_again_a_few_times_only(spark):
    table = BatchTable(spark, new_folder(spark, "segments") + "/t", "n bigint", lambda d: d, lambda a, b: a.unionByName(b), base_kind=Segments(3))
    for batch in range(12):
        table.write_batch(spark.range(1).select(F.lit(batch).cast("bigint").alias("n")), batch)
        table.fold()
        assert sorted(r["n"] for r in table.read().collect()) == list(range(batch + 1))
    tiers = sorted(tier for _, tier in table.base().parts.values())
    assert len(tiers) <= 4 and max(tiers) == 2


def test_job_passes_its_options(spark, monkeypatch):
    seen = {}

    class Query:
        def awaitTermination(self):
            pass

    def start(log, sink, checkpoint, interval, wrapped):
        seen.update(sink=sink, checkpoint=checkpoint, interval=interval)
        return Query()

    monkeypatch.setattr(job, "build_session", lambda *a, **conf: spark)
    monkeypatch.setattr(job, "stream_kafka", lambda *a, **options: seen.update(options))
    monkeypatch.setattr(job, "start", start)
    root = new_folder(spark, "job")
    job.main(["--servers", "h:9", "--root", root, "--fold-every", "200", "--rules", "scala", "--buckets", "32"])
    assert seen["sink"].fold_every == 200 and seen["sink"].hold is True and seen["sink"].rules.amount_as_double
    assert seen["sink"].tables.latest.base_kind.count == 32 and seen["starting"] == "earliest"
    job.main(["--servers", "h:9", "--root", root, "--fold-every", "0"])
    assert seen["sink"].fold_every is None and seen["sink"].hold is True
