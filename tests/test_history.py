"""Merges against a plain restatement of the rules, replay, and the stored history."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from regchron.operators import history as H
from regchron.operators.replay import list_runs, scd2_replay
from regchron.operators.staging import build_staging, latest_per_key
from regchron.plans import gold, profile
from regchron.schema import OPEN_END, SCD2_SCHEMA
from regchron.session import scratch_path
from regchron.sources.store import HistoryStore, buckets_for

OPEN = datetime.fromisoformat(OPEN_END)
START = datetime(2024, 1, 1)
SCHEMA = T.StructType(
    [T.StructField("egid", T.LongType(), False), T.StructField("gstat", T.IntegerType()),
     T.StructField("gdekt", T.StringType()), *SCD2_SCHEMA.fields]
)
HASHED = ["gstat", "gdekt"]


def merge_by_hand(history, staged, now, scope):
    """Close, insert, mark - one row at a time."""
    out = [dict(r) for r in history]
    current = {r["egid"]: r for r in out if r["is_current"]}
    for key, (gstat, gdekt) in staged.items():
        mine = current.get(key)
        if mine and (mine["gstat"], mine["gdekt"]) == (gstat, gdekt):
            continue
        if mine:
            mine.update(valid_to=now, is_current=False)
        out.append(dict(egid=key, gstat=gstat, gdekt=gdekt, valid_from=now, valid_to=OPEN,
                        is_current=True, dqa_deleted=False))
    for key, mine in current.items():
        if key not in staged and scope(mine) and staged:
            mine.update(valid_to=now, is_current=False, dqa_deleted=True)
    return out


def random_runs(seed, runs=6, keys=12):
    rng = random.Random(seed)
    return [
        {k: (rng.choice([1001, 1003, 1004, None]), rng.choice(["AG", "ZH"]))
         for k in range(1, keys) if rng.random() < 0.6}
        for _ in range(runs)
    ]


def bronze(spark, runs):
    rows = [
        (k, s, c, (START + timedelta(days=i)).isoformat(), f"run{i}")
        for i, run in enumerate(runs) for k, (s, c) in run.items()
    ]
    return spark.createDataFrame(
        rows, "egid bigint, gstat int, gdekt string, _ingested_at string, _run_id string"
    )


def staged(log, run_id=None, **options):
    return build_staging(log, run_id=run_id, hash_columns=HASHED, **options)


def plain(rows):
    names = ["egid", "gstat", "gdekt", "valid_from", "valid_to", "is_current", "dqa_deleted"]
    return sorted(str([r[n] for n in names]) for r in rows)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


SCOPES = {
    "all": lambda r: True,
    "none": lambda r: False,
    "gdekt = 'AG'": lambda r: r["gdekt"] == "AG",
}


@pytest.mark.parametrize("scope", SCOPES)
@pytest.mark.parametrize("seed", [1, 2])
def test_sequence_of_merges(spark, scope, seed):
    runs = random_runs(seed, runs=4)
    log = bronze(spark, runs)
    store = HistoryStore(spark, scratch_path(spark, "test"), SCHEMA)
    expected = []
    for i, run in enumerate(runs):
        now = START + timedelta(days=i)
        before = plain(expected)
        expected = merge_by_hand(expected, run, now, SCOPES[scope])
        counts = store.merge(staged(log, f"run{i}"), now, scope, run_id=f"run{i}")
        assert plain(store.read().collect()) == plain(expected)
        assert counts["records_inserted"] == sum(r["valid_from"] == now for r in expected)
        assert counts["records_deleted"] == sum(
            r["valid_to"] == now and r["dqa_deleted"] for r in expected
        )
        assert counts["records_closed"] == sum(
            r["valid_to"] == now and not r["dqa_deleted"] for r in expected
        )
        assert len(plain(expected)) >= len(before)
    history = store.read()
    assert H.history_violations(history).count() == 0
    again = H.scd2_apply(history, staged(log, "run3"), START + timedelta(days=9), delete_scope=scope)
    assert plain(again.collect()) == plain(expected)


@pytest.mark.parametrize("seed", [3, 4, 5])
@pytest.mark.parametrize("delete", [True, False])
def test_replay_equals_the_merges(spark, seed, delete):
    runs = [r or {1: (1001, "AG")} for r in random_runs(seed)]
    log = bronze(spark, runs)
    expected = []
    for i, run in enumerate(runs):
        expected = merge_by_hand(expected, run, START + timedelta(days=i), lambda r: delete)
    replayed = scd2_replay(
        staged(log, per_run=True), list_runs(log), columns=["egid", "gstat", "gdekt"], delete_missing=delete
    )
    assert plain(replayed.collect()) == plain(expected)
    assert H.history_violations(replayed).count() == 0


@pytest.mark.parametrize("seed", [6, 7])
def test_small_merge_equals_the_merge(spark, seed):
    first, second = random_runs(seed, runs=2)
    log = bronze(spark, [first, second])
    now = START + timedelta(days=1)
    base = H.scd2_merge(empty(spark), staged(log, "run0"), START)
    merged = H.scd2_merge(base, staged(log, "run1"), now)
    small = H.scd2_merge_small(base, staged(log, "run1"), now)
    assert sorted(map(str, merged.collect())) == sorted(map(str, small.select(merged.columns).collect()))


def test_classification(spark):
    log = bronze(spark, [{1: (1, "AG"), 2: (1, "AG"), 3: (1, "ZH")}, {1: (1, "AG"), 2: (2, "AG"), 4: (1, "AG")}])
    base = H.scd2_merge(empty(spark), staged(log, "run0"), START)

    def actions(scope):
        rows = H.scd2_classify(base, staged(log, "run1"), delete_scope=scope).collect()
        return {r["egid"]: r["action"] for r in rows}

    assert actions("all") == {1: "unchanged", 2: "changed", 3: "deleted", 4: "new"}
    assert actions("gdekt = 'AG'")[3] == "kept"


def test_an_empty_staging_deletes_nothing(spark):
    log = bronze(spark, [{1: (1, "AG")}])
    base = H.scd2_merge(empty(spark), staged(log, "run0"), START)
    after = H.scd2_apply(base, staged(log, "no such run"), START + timedelta(days=1), delete_scope="all")
    assert plain(after.collect()) == plain(base.collect())


def test_a_source_with_fewer_columns_opens_no_versions(spark):
    log = bronze(spark, [{1: (1, "AG"), 2: (1, "ZH")}])
    base = H.scd2_merge(empty(spark), staged(log, "run0"), START)
    narrow = build_staging(log.drop("gdekt"), hash_columns=["gstat"])
    compared = H.scd2_merge(base, narrow, START + timedelta(days=1), compare=["gstat"])
    assert plain(compared.collect()) == plain(base.collect())
    by_hash = H.scd2_merge(base, narrow, START + timedelta(days=1))
    assert by_hash.count() == 4


def test_latest_row_with_ties_is_the_same_every_time(spark):
    rows = [(1, "a", 1, "run0"), (1, "a", 2, "run0"), (1, "b", 3, "run0"), (None, "z", 4, "run0")]
    log = spark.createDataFrame(rows, "egid bigint, _ingested_at string, gstat int, _run_id string")
    shuffled = [build_staging(log.repartition(n), hash_columns=["gstat"]).collect() for n in (1, 2, 4)]
    assert all(len(s) == 1 and s[0]["gstat"] == 3 for s in shuffled)
    tied = log.filter("gstat < 3")
    picked = {build_staging(tied.repartition(n), hash_columns=["gstat"]).first()["gstat"] for n in (1, 2, 4)}
    assert len(picked) == 1
    chosen = build_staging(tied, hash_columns=["gstat"], tie_break=[F.col("gstat").desc()]).first()
    assert chosen["gstat"] == 2


def test_the_rank_filter_works_before_the_shuffle(spark):
    rows = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    df = latest_per_key(rows, ["k"], [F.desc("id")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_a_failed_merge_leaves_the_table_as_it_was(spark):
    log = bronze(spark, [{1: (1, "AG")}, {1: (2, "AG"), 2: (1, "AG")}])
    store = HistoryStore(spark, scratch_path(spark, "crash"), SCHEMA)
    store.merge(staged(log, "run0"), START, "all", run_id="run0")
    before = plain(store.read().collect())

    def stop(entry):
        raise RuntimeError("stopped before the commit")

    store._commit, commit = stop, store._commit
    with pytest.raises(RuntimeError):
        store.merge(staged(log, "run1"), START + timedelta(days=1), "all")
    store._commit = commit
    assert plain(store.read().collect()) == before
    store.merge(staged(log, "run1"), START + timedelta(days=2), "all", run_id="run1")
    assert len(store.read().collect()) == 3
    assert {r["run_id"] for r in store.merged_runs().collect()} == {"run0", "run1"}
    assert sorted(r["version"] for r in store.commits().collect()) == [0, 1]


def test_old_current_rows_can_be_dropped(spark):
    runs = [{1: (i, "AG"), 2: (1, "AG")} for i in range(4)]
    log = bronze(spark, runs)
    store = HistoryStore(spark, scratch_path(spark, "old"), SCHEMA)
    for i in range(4):
        store.merge(staged(log, f"run{i}"), START + timedelta(days=i), staging_rows=2)
    before = plain(store.read().collect())
    assert {f.split("is_current=true/")[1].split("/")[0] for f in store.drop_old_currents(keep=1)} == {"v=0", "v=1", "v=2"}
    assert plain(store.read().collect()) == before
    assert store.drop_old_currents(keep=1) == []
    assert store.closed().count() == 3 and store.current().count() == 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written_files(store):
    """Files of the current rows by merge and bucket."""
    pattern = store._path(f"{store.base}/data/is_current=true/v=*/bucket=*/*.parquet")
    paths = [f.getPath().toString() for f in store._fs.globStatus(pattern)]
    return sorted(tuple(p.split("is_current=true/")[1].split("/")[:2]) for p in paths)


def test_an_increment_leaves_other_buckets_alone(spark):
    first = bronze(spark, [{i: (1, "AG") for i in range(1, 60)}, {5: (2, "AG")}, {5: (3, "AG"), 6: (2, "AG")}])
    store = HistoryStore(spark, scratch_path(spark, "buckets"), SCHEMA, buckets=8)
    store.merge(staged(first, "run0"), START)
    assert store.head()["current_at"] == {str(b): 0 for b in range(8)}
    counts = store.merge(staged(first, "run1"), START + timedelta(days=1))
    assert (counts["records_closed"], counts["records_inserted"], counts["records_deleted"]) == (1, 1, 0)
    after = store.head()["current_at"]
    assert sorted(after.values()) == [0] * 7 + [1] and store.current().count() == 59
    assert [v for v, _ in written_files(store)] == ["v=0"] * 8 + ["v=1"]
    store.merge(staged(first, "run2"), START + timedelta(days=2))
    assert {r["gstat"] for r in store.current().filter("egid = 5").collect()} == {3}
    before = plain(store.read().collect())
    store.drop_old_currents(keep=1)
    assert plain(store.read().collect()) == before and len(before) == 62
    # A full load touches all of them and may empty some.
    store.merge(staged(first, "run1"), START + timedelta(days=3), "all")
    assert set(store.head()["current_at"].values()) == {3} and store.current().count() == 1


def test_one_file_per_bucket_and_no_shuffle_of_the_current_rows(spark):
    runs = [{i: (1, "AG") for i in range(1, 400)}, {i: (2, "AG") for i in range(1, 400, 3)}]
    log = bronze(spark, runs).repartition(7)
    store = HistoryStore(spark, scratch_path(spark, "layout"), SCHEMA, buckets=4)
    for i in range(2):
        store.merge(staged(log, f"run{i}"), START + timedelta(days=i), "all")
    assert written_files(store) == [(f"v={v}", f"bucket={b}") for v in range(2) for b in range(4)]
    merged = H.scd2_merge(store.current(), store.dealt(staged(log, "run1")), START + timedelta(days=2), delete_scope="all")
    lines = plan_of(merged).split("\n")
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "_current" in line)
    assert not any("Exchange" in line for line in lines[:scan]) and join < scan
    assert "Bucketed: true" in lines[scan]
    # The folders of two buckets, and no others, are left after pruning.
    some = plan_of(store.current({1, 3}))
    assert "bucket" in some.split("PartitionFilters: [")[1].split("]")[0] and "IN (1,3)" in some
    bucket = F.pmod(F.hash("egid"), F.lit(4))
    assert {r[0] for r in store.current({1, 3}).select(bucket).distinct().collect()} == {1, 3}


def test_what_a_dead_merge_left_is_cleared(spark):
    log = bronze(spark, [{1: (1, "AG")}, {1: (2, "AG")}, {2: (1, "AG")}])
    store = HistoryStore(spark, scratch_path(spark, "dead"), SCHEMA, buckets=2)
    store.merge(staged(log, "run0"), START)
    commit, store._commit = store._commit, lambda entry: 1 / 0
    with pytest.raises(ZeroDivisionError):
        store.merge(staged(log, "run1"), START + timedelta(days=1))
    store._commit = commit
    # Another run is merged under the version that the dead one had begun.
    store.merge(staged(log, "run2"), START + timedelta(days=2))
    rows = sorted((r["egid"], r["gstat"], r["is_current"]) for r in store.read().collect())
    assert rows == [(1, 1, True), (2, 1, True)]
    # A new session's view of the folders is the same.
    spark.sql(f"DROP TABLE {store._name}_current")
    again = HistoryStore(spark, store.base, SCHEMA)
    assert sorted((r["egid"], r["gstat"], r["is_current"]) for r in again.read().collect()) == rows


def test_a_relative_folder_is_the_same_to_all(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    store = HistoryStore(spark, "some/folder/", SCHEMA)
    assert store.base.startswith("file:/") and store.base.endswith("/some/folder")


def test_the_number_of_buckets_follows_from_the_size():
    assert buckets_for(0) == buckets_for(1 << 30) == 8
    assert buckets_for((1 << 30) + 1) == 16 and buckets_for(10**15) == 1 << 16


def test_a_missing_required_value_fails_the_merge(spark):
    log = bronze(spark, [{1: (1, "AG")}])
    rows = staged(log).withColumn("record_hash", F.lit(None).cast("string"))
    store = HistoryStore(spark, scratch_path(spark, "null"), SCHEMA)
    with pytest.raises(Exception, match="NULL in required column record_hash"):
        store.merge(rows, START)
    assert store.head() is None and store.commits().count() == 0


@pytest.fixture(scope="module")
def example(spark):
    """Planned, then under construction, then finished; a second building that never changes."""
    days = [datetime(2024, 1, 15), datetime(2024, 9, 22), datetime(2025, 3, 10)]
    rows = []
    for code, at in zip((1, 3, 4), days):
        rows.append((12345, code, at.isoformat(), f"r{code}"))
        rows.append((777, 4, at.isoformat(), f"r{code}"))
    log = spark.createDataFrame(rows, "egid bigint, gstat int, _ingested_at string, _run_id string")
    log = log.withColumns({c: F.lit(None).cast("int") for c in ("ganzwhg",)})
    return scd2_replay(
        build_staging(log, hash_columns=["gstat"], per_run=True), list_runs(log), columns=["egid", "gstat", "ganzwhg"]
    )


def test_point_in_time(example):
    def state(at):
        return {r["egid"]: r["gstat"] for r in H.as_of_view(example, at).collect()}

    assert state(datetime(2024, 1, 14)) == {}
    assert state(datetime(2024, 9, 21)) == {12345: 1, 777: 4}
    assert state(datetime(2024, 9, 22)) == {12345: 3, 777: 4}
    assert state(datetime(2030, 1, 1)) == {12345: 4, 777: 4}


def test_change_view(example):
    [row] = gold.change_view(example).collect()
    assert (row["egid"], row["version_count"]) == (12345, 3)
    assert (row["latest_gstat"], row["initial_gstat"]) == (4, 1)
    assert (row["last_gstat"], row["first_gstat"]) == (4, 1)
    assert row["gstat_history"] == [1, 3, 4]
    assert gold.most_changed_key(example).first()["egid"] == 12345


def test_change_view_leaves_null_codes_out_of_the_list(spark):
    runs = [{1: (1004, "AG")}, {1: (None, "AG")}, {1: (1001, "AG")}]
    log = bronze(spark, runs)
    history = scd2_replay(staged(log, per_run=True), list_runs(log), columns=["egid", "gstat", "gdekt"])
    [row] = gold.change_view(history).collect()
    assert row["version_count"] == 3 and row["gstat_history"] == [1004, 1001]
    assert (row["latest_gstat"], row["last_gstat"]) == (1004, 1001)


def test_transitions_and_history_of_a_key(example):
    got = {(r["prev_gstat"], r["gstat"]): r["anzahl"] for r in profile.transitions(example).collect()}
    assert got == {(1, 3): 1, (3, 4): 1}
    spans = [(r["gstat"], r["is_current"]) for r in gold.history_of(example, 12345).collect()]
    assert spans == [(1, False), (3, False), (4, True)]
    totals = profile.row_counts(example).first()
    assert tuple(totals) == (4, 2, 2, 0)


def test_violations_are_found(spark):
    day = [datetime(2024, 1, d) for d in range(1, 6)]
    rows = [
        (1, None, None, day[0], OPEN, True, "h", False, day[0]),
        (1, None, None, day[1], OPEN, True, "h", False, day[1]),
        (2, None, None, day[0], day[2], False, "h", False, day[2]),
        (2, None, None, day[1], day[3], False, "h", False, day[3]),
        (3, None, None, day[2], day[2], False, "h", False, day[2]),
        (4, None, None, day[0], day[1], True, "h", False, day[0]),
        (5, None, None, day[0], day[1], False, "h", False, day[1]),
    ]
    found = H.history_violations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r["egid"] for r in found) == [1, 2, 3, 4]


def test_a_building_with_most_of_the_log(spark):
    """A third of all log rows belong to one key; the result is that of a plain computation."""
    rng = random.Random(11)
    rows = []
    for n in range(3000):
        key = 1 if n % 3 == 0 else rng.randrange(2, 200)
        day = rng.randrange(20)
        rows.append((key, rng.choice([1001, 1003, 1004]), "AG", f"2024-01-{day + 1:02d}T00:00:00", f"run{day:02d}", n))
    log = spark.createDataFrame(
        rows, "egid bigint, gstat int, gdekt string, _ingested_at string, _run_id string, n int"
    ).repartition(6)
    best = {}
    for key, gstat, gdekt, at, run, n in rows:
        if (key, run) not in best or n > best[key, run][0]:
            best[key, run] = (n, gstat, gdekt)
    expected = []
    for day in range(20):
        run = {k: v[1:] for (k, r), v in best.items() if r == f"run{day:02d}"}
        expected = merge_by_hand(expected, run, START + timedelta(days=day), lambda r: True)
    replayed = scd2_replay(
        staged(log, per_run=True, tie_break=[F.desc("n")]), list_runs(log), columns=["egid", "gstat", "gdekt"]
    )
    assert plain(replayed.collect()) == plain(expected)
