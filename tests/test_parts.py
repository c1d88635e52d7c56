"""Stored parts and states: merchant totals, type 2 history, batches, gathered files, several days at once, as-of lookups."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardmill import files
from cardmill.operators import asof, dims, features, marts, quality, rollup
from cardmill.plans import bucketed, checks, history, incremental, labels, repack
from cardmill.plans import rollup as stored_rollup
from cardmill.plans.layout import Lake
from cardmill.session import materialize
from cardmill.sinks import overwrite_days, overwrite_partitions, swap
from cardmill.sources import read_table

START = datetime(2024, 1, 28)
PAYMENT = (
    "transaction_id string, user_id string, transaction_date timestamp, amount decimal(18,2), merchant_id string, merchant_city string, "
    "merchant_state string, mcc int, mcc_description string, is_fraud boolean, is_valid boolean, card_on_dark_web boolean, _batch_id string, "
    "year int, month int, day int"
)


def payments(n, seed=1, days=8):
    rng = random.Random(seed)
    for i in range(n):
        at = START + timedelta(seconds=rng.randrange(days * 86400))
        yield (
            f"t{i:04d}", f"u{rng.randrange(4)}", at, rng.choice([None, Decimal(rng.randint(-500, 5000)) / 100]), rng.choice([None, "m1", "m2", "m3"]),
            rng.choice([None, "A", "B"]), rng.choice([None, "CA", "Italy"]), rng.choice([None, 1, 2]), rng.choice([None, "one", "two"]),
            rng.choice([None, False, True]), rng.random() < 0.9, None, "b", at.year, at.month, at.day,
        )


def content(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def same(left, right):
    return content(left) == content(right) and set(left.columns) == set(right.columns)


# Merchant totals


def test_merged_parts_equal_totals_of_the_rows(spark):
    txns = spark.createDataFrame(list(payments(400)), PAYMENT)
    days = rollup.merchant_days(txns)
    assert same(rollup.merchant_dimension(days), dims.merchant_dimension(txns.filter("is_valid")))
    months = rollup.merchant_months(days)
    assert same(rollup.merchant_dimension(months), dims.merchant_dimension(txns.filter("is_valid")))
    assert same(rollup.merchant_risk_score(months), marts.merchant_risk_score(txns))


def test_changed_days_are_merged_into_the_stored_totals(spark, tmp_path):
    lake, rows = Lake(str(tmp_path)), list(payments(400))
    write = lambda kept: overwrite_partitions(spark.createDataFrame(kept, PAYMENT), lake.staging("transactions"), stored_rollup.DAY)
    write(rows)
    stored_rollup.refresh(spark, lake, [date(2024, 1, 28)])  # nothing is stored yet: everything is built
    fewer = [r for r in rows if r[2].day != 29 or r[0] < "t0200"]
    write([r for r in fewer if r[2].day == 29])
    overwrite_days(spark.createDataFrame([], PAYMENT), lake.staging("transactions"), [date(2024, 2, d) for d in (1, 2, 3, 4)])
    kept = [r for r in fewer if r[2].month == 1]
    days = [date(2024, 1, 29), *(date(2024, 2, d) for d in (1, 2, 3, 4))]
    for _ in range(2):
        result = stored_rollup.refresh(spark, lake, days)
        txns = spark.createDataFrame(kept, PAYMENT)
        assert same(read_table(spark, lake.warehouse("dim_merchants")), dims.merchant_dimension(txns.filter("is_valid")))
        assert same(read_table(spark, lake.warehouse("merchant_risk_score")), marts.merchant_risk_score(txns))
        assert result["dim_merchants"] == 3 and not files.exists(spark, f"{lake.warehouse('merchant_months')}/year=2024/month=2")


def test_all_days_can_go(spark, tmp_path):
    lake = Lake(str(tmp_path))
    overwrite_partitions(spark.createDataFrame([r for r in payments(50, days=1)], PAYMENT), lake.staging("transactions"), stored_rollup.DAY)
    stored_rollup.build_all(spark, lake)
    overwrite_partitions(spark.createDataFrame([(*r[:10], False, *r[11:]) for r in payments(50, days=1)], PAYMENT), lake.staging("transactions"), stored_rollup.DAY)
    assert stored_rollup.refresh(spark, lake, [START.date()]) == {"dim_merchants": 0, "merchant_risk_score": 0}
    assert stored_rollup.refresh(spark, lake, [START.date()]) == {"dim_merchants": 0, "merchant_risk_score": 0}


# Several days at once


def test_spans():
    day = lambda n: date(2024, 1, n)
    assert features.spans([]) == []
    assert features.spans([day(5), day(3), day(3), day(4)]) == [(day(3), day(5))]
    assert features.spans([day(1), day(9), day(20)], 7) == [(date(2023, 12, 25), day(9)), (day(13), day(20))]
    assert features.spans([date(2024, 3, 1), date(2024, 2, 29)]) == [(date(2024, 2, 29), date(2024, 3, 1))]


@pytest.mark.parametrize("hot_rows", [10**6, 20])
@pytest.mark.parametrize("days", [[0], [30, 3, 4], [12, 13, 14, 29], list(range(31)), [40]])
def test_days_at_once_equal_the_whole(spark, days, hot_rows):
    txns = spark.createDataFrame([r for r in payments(700, 5, 31) if r[2] is not None], PAYMENT)
    days = [START.date() + timedelta(days=d) for d in days]
    whole = features.on_days(features.fraud_features(txns), days)
    assert content(features.features_on_days(txns, days, features.daily_amounts(txns), hot_rows)) == content(whole)


def test_no_days(spark):
    txns = spark.createDataFrame(list(payments(20)), PAYMENT)
    assert features.features_on_days(txns, [], features.daily_amounts(txns)).count() == 0


def test_days_without_rows_go(spark, tmp_path):
    path, rows = str(tmp_path / "t"), list(payments(200))
    overwrite_partitions(spark.createDataFrame(rows, PAYMENT), path, stored_rollup.DAY)
    days = [date(2024, 1, 28), date(2024, 1, 29), date(2024, 5, 1)]
    new = spark.createDataFrame([r for r in rows if r[2].day == 28][:3], PAYMENT)
    for _ in range(2):
        assert overwrite_days(new, path, days) == 3
        kept = [r for r in rows if r[2].day not in (28, 29)] + [r for r in rows if r[2].day == 28][:3]
        assert sorted(r[0] for r in spark.read.parquet(path).select("transaction_id").collect()) == sorted(r[0] for r in kept)


# As-of lookups

LOOKUP = "n int, key string, at timestamp, valid_to string"
VERSION = "key string, valid_from timestamp, valid_to timestamp, name string"


def day(n):
    return None if n is None else datetime(2020, 1, 1) + timedelta(days=n)


def plain_as_of(facts, versions):
    out = {}
    for n, key, at in facts:
        begun = [v for v in versions if None not in v[:3] and v[1] < v[2] and v[0] == key and at is not None and v[1] <= at]
        last = max(begun, key=lambda v: (v[1], v[2], v[3] or ""), default=None)
        out[n] = last[3] if last and at < last[2] else None
    return out


@pytest.mark.parametrize("limits", [{}, {"hot_rows": 30, "range_rows": 40}])
def test_as_of_equals_a_plain_lookup(spark, limits):
    rng = random.Random(4)
    versions = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(200)]), rng.choice([None, *range(220)]), f"v{i}") for i in range(600)]
    versions += [("one", i, i + 1, f"o{i}") for i in range(0, 300, 2)] + [("late", 500, 501, "z")]
    facts = [(i, rng.choice(["a", "b", "one", "none", "late", None]), rng.choice([None, *range(230)])) for i in range(900)]
    left = spark.createDataFrame([(n, k, day(at), "own") for n, k, at in facts], LOOKUP)
    right = spark.createDataFrame([(k, day(s), day(e), v) for k, s, e, v in versions], VERSION)
    found = asof.as_of(left, right, "key", "at", ["name"], **limits).collect()
    assert {r.n: r.name for r in found} == plain_as_of(facts, versions) and len(found) == len(facts)
    assert {r.valid_to for r in found} == {"own"}


def test_as_of_has_no_join_on_time(spark):
    left = spark.createDataFrame([(1, "a", day(3), "")], LOOKUP)
    right = spark.createDataFrame([("a", day(1), day(9), "v")], VERSION)
    looked_up = asof.as_of(left, right, "key", "at", ["name"])
    plan = looked_up._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1 and looked_up.first().name == "v"
    assert asof.as_of(left.limit(0), right, "key", "at", ["name"]).count() == 0
    assert asof.as_of(left, right.limit(0), "key", "at", ["name"]).first().name is None


# Type 2 history

SNAPSHOT = "user_id string, city string"
T = [datetime(2020 + i, 1, 1) for i in range(5)]


def users(spark, **cities):
    return spark.createDataFrame(list(cities.items()), SNAPSHOT)


def merge(spark, path, at, **cities):
    return history.merge(spark, path, users(spark, **cities), tracked=["city"], as_of=at)


def test_merges_leave_older_closed_files_alone(spark, tmp_path):
    path = str(tmp_path / "dim")
    assert merge(spark, path, T[0], a="X", b="X") == {"open": 2, "closed": 0}
    assert merge(spark, path, T[1], a="Y", b="X", c="Z") == {"open": 3, "closed": 1}
    older = sorted(p.name for p in (tmp_path / "dim").glob("closed_at=2021*/*.parquet"))
    assert merge(spark, path, T[2], a="Z", b="Y") == {"open": 3, "closed": 2}
    assert older and older == sorted(p.name for p in (tmp_path / "dim").glob("closed_at=2021*/*.parquet"))
    dim = dims.first_versions(users(spark, a="X", b="X"), "user_id", T[0])
    dim = dims.type2_merge(dim, users(spark, a="Y", b="X", c="Z"), tracked=["city"], as_of=T[1])
    dim = dims.type2_merge(dim, users(spark, a="Z", b="Y"), tracked=["city"], as_of=T[2])
    assert same(history.read_history(spark, path), dim)
    assert same(history.read_open(spark, path), dim.filter("is_current"))


def test_a_merge_can_be_repeated_and_corrected_at_its_instant(spark, tmp_path):
    path = str(tmp_path / "dim")
    merge(spark, path, T[0], a="X", b="X")
    for _ in range(2):
        merge(spark, path, T[1], a="Y", b="X")
    before = content(history.read_history(spark, path))
    assert merge(spark, path, T[1], a="Y", b="X") == {"open": 2, "closed": 0} and content(history.read_history(spark, path)) == before
    assert merge(spark, path, T[1], a="Y", b="Y") == {"open": 2, "closed": 2}
    found = sorted((r.user_id, r.city, r.valid_from.year, r.valid_to.year) for r in history.read_history(spark, path).collect())
    assert found == [("a", "X", 2020, 2021), ("a", "Y", 2021, 9999), ("b", "X", 2020, 2021), ("b", "Y", 2021, 9999)]
    with pytest.raises(ValueError, match="is stored"):
        merge(spark, path, T[0], a="Z")


@pytest.mark.parametrize("stop", ["close", "commit"])
def test_a_stopped_merge_is_not_seen_and_can_be_run_again(spark, tmp_path, monkeypatch, stop):
    path = str(tmp_path / "dim")
    merge(spark, path, T[0], a="X", b="X")
    merge(spark, path, T[1], a="Y", b="X")
    before = content(history.read_history(spark, path))
    real = history.replace_table

    def failing(df, target, *rest, **more):
        if target.endswith("open") == (stop == "commit"):
            raise OSError("stopped")
        return real(df, target, *rest, **more)

    monkeypatch.setattr(history, "replace_table", failing)
    with pytest.raises(OSError, match="stopped"):
        merge(spark, path, T[2], a="Z", b="Z")
    monkeypatch.setattr(history, "replace_table", real)
    assert content(history.read_history(spark, path)) == before
    assert merge(spark, path, T[3], a="Z", b="Z") == {"open": 2, "closed": 2}
    found = sorted((r.user_id, r.city, r.valid_from.year, r.valid_to.year) for r in history.read_history(spark, path).collect())
    assert found == [("a", "X", 2020, 2021), ("a", "Y", 2021, 2023), ("a", "Z", 2023, 9999), ("b", "X", 2020, 2023), ("b", "Z", 2023, 9999)]


def test_new_columns_are_null_in_older_versions(spark, tmp_path):
    path = str(tmp_path / "dim")
    merge(spark, path, T[0], a="X", b="X")
    merge(spark, path, T[1], a="Y", b="X")
    wider = users(spark, a="Z", b="X").withColumn("phone", F.lit("1"))
    history.merge(spark, path, wider, tracked=["city"], as_of=T[2])
    found = {(r.user_id, r.city): r.phone for r in history.read_history(spark, path).collect()}
    assert found == {("a", "X"): None, ("a", "Y"): None, ("a", "Z"): "1", ("b", "X"): None}


# Batches


def test_batches_and_their_watermark(spark, tmp_path):
    path = str(tmp_path / "t")
    load = lambda rows, names: incremental.load_batches(spark, path, spark.createDataFrame(rows, names), "k")
    assert incremental.read_batches(spark, path) is None
    assert load([("a", 1, "b1"), ("b", 1, "b1"), (None, 9, "b1"), ("x", 9, None)], "k string, v int, _batch_id string") == {"loaded": 2, "rows": 2}
    names = "k string, w string, _batch_id string"
    assert load([("b", "new", "b2"), ("c", "new", "b2"), ("c", "old", "b1")], names) == {"loaded": 2, "rows": 3}
    for _ in range(2):
        assert load([("c", "newer", "b3")], names) == {"loaded": 1, "rows": 3}
    assert load([("a", "late", "b2")], names) == {"loaded": 0, "rows": 3}
    found = sorted((r.k, r.v, r.w, r._batch_id) for r in incremental.read_batches(spark, path).collect())
    assert found == [("a", 1, None, "b1"), ("b", None, "new", "b2"), ("c", None, "newer", "b3")]


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(500).selectExpr("string(id) as k", "id as v", "'b1' as _batch_id")
    incremental.load_batches(spark, path, rows, "k")
    before = {(p.parent.name, p.name) for p in (tmp_path / "t").glob("*/*.parquet")}
    incremental.load_batches(spark, path, spark.createDataFrame([("7", -1, "b2")], rows.schema), "k")
    after = {(p.parent.name, p.name) for p in (tmp_path / "t").glob("*/*.parquet")}
    assert len(before & after) >= incremental.BUCKETS - 1
    stored = incremental.read_batches(spark, path)
    assert stored.count() == 500 and stored.filter("v = -1").count() == 1


# Gathered files


def test_bins():
    assert repack.bins([], 100) == [] and repack.bins([("a", 10)], 100) == [] and repack.bins([("a", 10), ("b", 60)], 100) == []
    assert repack.bins([("a", 10), ("b", 10), ("c", 500)], 100) == [["a", "b"]]
    rng = random.Random(3)
    for _ in range(500):
        sizes = [(f"f{i:03d}", rng.choice([1, 5, rng.randint(1, 49), rng.randint(1, 300)])) for i in range(rng.randint(1, 60))]
        size, made = dict(sizes), repack.bins(sizes, 100)
        named = [n for each in made for n in each]
        assert len(named) == len(set(named)) and all(size[n] < 50 for n in named) and all(len(each) > 1 for each in made)
        total = sum(s for _, s in sizes if s < 50)
        totals = [sum(size[n] for n in each) for each in made]
        assert all(50 <= t <= 150 for t in totals) or (len(made) == 1 and total < 50)
        assert sum(1 for _, s in sizes if s < 50) - len(named) <= 1


def wide(spark, start, end):
    return spark.range(start, end, numPartitions=1).selectExpr("string(id) as transaction_id", "string(id % 5) as user_id", "sha2(string(id), 512) as noise")


def test_small_files_are_gathered_and_large_ones_stay(spark, tmp_path):
    folder = str(tmp_path / "t" / "year=2024" / "month=1" / "day=1")
    wide(spark, 0, 3000).write.parquet(folder)
    large = files.data_files(spark, folder)
    wanted = large[0][1]
    for i in range(24):
        wide(spark, 3000 + i * 300, 3300 + i * 300).write.mode("append").parquet(folder)
    before = content(spark.read.parquet(folder))
    done = repack.repack_day(spark, str(tmp_path / "t"), date(2024, 1, 1), wanted=wanted)
    after = files.data_files(spark, folder)
    assert large[0] in after and content(spark.read.parquet(folder)) == before
    assert (done.before, done.kept, done.rows, done.copies, done.after) == (24, 1, 7200, 0, len(after) - 1)
    assert all(wanted / 2 <= size <= 1.5 * wanted for _, size in after), (wanted, after)
    assert repack.repack_day(spark, str(tmp_path / "t"), date(2024, 1, 1), wanted=wanted).before == 0
    assert files.data_files(spark, folder) == after


def test_gathering_does_not_shuffle(spark, tmp_path):
    folder = str(tmp_path / "t")
    for i in range(4):
        wide(spark, i * 10, i * 10 + 10).write.mode("append").parquet(folder)
    names = [n for n, _ in files.data_files(spark, folder)]
    plan = repack._together(repack._read(spark, folder, names), "transaction_id")._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 1" in plan and "Exchange" not in plan


def test_only_files_with_copies_are_brought_together(spark, tmp_path):
    folder = str(tmp_path / "t")
    stamped = lambda a, b, at: wide(spark, a, b).withColumn("_loaded_at", F.lit(at).cast("timestamp"))
    stamped(0, 2000, "2024-01-01").write.parquet(folder)
    alone = files.data_files(spark, folder)
    stamped(2000, 4000, "2024-01-01").write.mode("append").parquet(folder)
    stamped(3900, 4100, "2024-01-02").unionByName(stamped(0, 0, "2024-01-01")).coalesce(1).write.mode("append").parquet(folder)
    no_key = wide(spark, 5, 7).selectExpr("string(null) as transaction_id", "user_id", "noise", "timestamp'2024-01-01' as _loaded_at")
    no_key.unionByName(no_key).coalesce(1).write.mode("append").parquet(folder)
    done = repack.repack_folder(spark, folder, "transaction_id", wanted=alone[0][1])
    assert alone[0] in files.data_files(spark, folder) and done.copies == 100
    stored = spark.read.parquet(folder)
    assert stored.count() == 4100 + 4 and stored.filter("transaction_id = '3950'").first()["_loaded_at"] == datetime(2024, 1, 2)
    assert stored.filter("transaction_id IS NULL").count() == 4


@pytest.mark.parametrize("stop", ["before", "after"])
def test_an_exchange_of_files_ends_after_a_stop(spark, tmp_path, monkeypatch, stop):
    folder = str(tmp_path / "t" / "day=1")
    for i in range(4):
        wide(spark, i * 10, i * 10 + 10).write.mode("append").parquet(folder)
    before, names = content(spark.read.parquet(folder)), [n for n, _ in files.data_files(spark, folder)]
    real = {"before": files.mkdirs, "after": files.rename}[stop]

    def failing(spark_, source, *rest):
        if stop == "after" or source.endswith(swap.READY):
            raise OSError("stopped")
        return real(spark_, source, *rest)

    monkeypatch.setattr(files, real.__name__, failing)
    with pytest.raises(OSError, match="stopped"):
        repack.repack_folder(spark, folder, wanted=10**6)
    monkeypatch.setattr(files, real.__name__, real)
    assert swap.recover_partitions(spark, str(tmp_path / "t")) == 1
    assert content(spark.read.parquet(folder)) == before
    left = [n for n, _ in files.data_files(spark, folder)]
    assert left == names if stop == "before" else len(left) == 1
    assert not files.exists(spark, swap.pack_folder(folder))


def test_a_month_is_gathered_into_the_warm_tier(spark, tmp_path):
    path, warm = str(tmp_path / "t"), str(tmp_path / "warm")
    for d in (1, 2, 3):
        for i in range(3):
            wide(spark, i * 100, i * 100 + 100).write.parquet(f"{path}/year=2024/month=1/day={d}", mode="append")
    for _ in range(2):
        done = repack.repack_month(spark, path, warm, 2024, 1, "transaction_id")
        assert (done.before, done.rows, done.copies) == (9, 300, 600)
    stored = spark.read.parquet(warm)
    assert stored.count() == stored.select("transaction_id").distinct().count() == 300 and "day" in stored.columns
    assert all(".zstd." in n for n, _ in files.data_files(spark, f"{warm}/year=2024/month=1"))
    whole = repack.repack_month(spark, path, warm, 2024, 1)
    assert (whole.rows, whole.copies, whole.after) == (900, 0, 1)
    assert repack.repack_month(spark, path, warm, 2023, 1) == repack.Repacked(f"{warm}/year=2023/month=1")


@pytest.mark.parametrize("key", ["transaction_id", None])
def test_a_bin_too_large_for_one_sort_is_sorted_as_ranges(spark, tmp_path, monkeypatch, key):
    path, warm, ranges = str(tmp_path / "t"), str(tmp_path / "warm"), []
    for d in (1, 2):
        for i in (0, 200, 400):
            wide(spark, i, i + 300 if d == 1 else i + 200).write.parquet(f"{path}/year=2024/month=1/day={d}", mode="append")
    monkeypatch.setattr(repack, "SORT_BYTES", 3000, raising=False)
    real = repack._sorted_in_ranges

    def counted(large, *rest):
        found = real(large, *rest)
        ranges.extend(map(len, found))
        return found

    monkeypatch.setattr(repack, "_sorted_in_ranges", counted)
    done = repack.repack_month(spark, path, warm, 2024, 1, key)
    assert max(ranges) > 2 and done.after == 1  # sorted by several tasks, one file
    assert (done.rows, done.copies) == ((700, 800) if key else (1500, 0))
    name = files.data_files(spark, f"{warm}/year=2024/month=1")[0][0]
    order = [tuple(r) for r in spark.read.parquet(f"{warm}/year=2024/month=1/{name}").select("user_id", *([key] if key else [])).collect()]
    assert order == sorted(order)
    before, after = spark.read.parquet(path), spark.read.parquet(warm)
    columns = [c for c in before.columns if c not in ("year", "month", "day")]
    assert same(after.select(columns).distinct(), before.select(columns).distinct())
    stored = content(after.select(columns))
    many = repack.repack_month(spark, path, warm, 2024, 1, key, wanted=9000)
    assert many.rows == done.rows and many.after > 1 and content(spark.read.parquet(warm).select(columns)) == stored


def test_scratch_tables_are_dropped_by_merges(spark, tmp_path):
    kept = materialize(spark.range(3), "other")
    merge(spark, str(tmp_path / "dim"), T[0], a="X")
    assert kept.count() == 3


# Checks as state

CHECKED = "transaction_id string, user_id string, kind string, year int, month int, day int"


def checked_rows(rng, n, days=(1, 2, 3)):
    return [(rng.choice([None, *(f"t{i}" for i in range(60))]), rng.choice([None, "u"]), rng.choice([None, "a", "b", "c"]), 2024, 1, rng.choice(days)) for _ in range(n)]


def test_stored_counts_equal_the_report_of_the_whole_table(spark, tmp_path):
    rng = random.Random(9)
    stored = checks.DayChecks(str(tmp_path / "t"), str(tmp_path / "state"), "transaction_id", ["user_id"], {"kind": ("a", "b")}, "x.", CHECKED)
    table = {d: checked_rows(rng, 30, (d,)) for d in (1, 2, 3)}
    for changed in ([1, 2, 3], [2], [2, 3], [1], [3]):
        for d in changed:
            table[d] = checked_rows(rng, rng.choice([0, 5, 30]), (d,))
        rows = [r for d in changed for r in table[d]]
        days = [date(2024, 1, d) for d in changed]
        overwrite_days(spark.createDataFrame(rows, CHECKED), stored.table, days)
        every = spark.createDataFrame([r for d in table for r in table[d]], CHECKED)
        stored.refresh(spark, days)
        assert same(stored.report(spark), quality.table_checks(every, "transaction_id", ["user_id"], {"kind": ("a", "b")}, "x."))


def test_only_candidates_are_grouped(spark):
    df = spark.createDataFrame(checked_rows(random.Random(1), 20), CHECKED)
    plan = quality.repeated_keys(df, "transaction_id", df.limit(1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")


# Late labels


def test_late_labels_rewrite_their_days_only(spark, tmp_path):
    lake, rows = Lake(str(tmp_path)), list(payments(200))
    overwrite_partitions(spark.createDataFrame(rows, PAYMENT), lake.staging("transactions"), stored_rollup.DAY)
    own = next(r for r in rows if r[9] is True)
    other = next(r for r in rows if r[9] is not True and r[2].day != own[2].day)
    delta = [(own[0], "Yes"), (other[0], "yes"), ("unknown", "Yes")]
    folder = tmp_path / "staging" / "transactions"
    before = {p for p in folder.rglob("*.parquet")}
    raw = spark.createDataFrame(delta, "transaction_id string, is_fraud string")
    assert labels.stage_labels(spark, lake, raw) == [other[2].date()]
    gone = before - {p for p in folder.rglob("*.parquet")}
    assert {p.parent.name for p in gone} == {f"day={other[2].day}"}
    want = [(r[0], True if r[0] == other[0] else r[9]) for r in rows]
    found = read_table(spark, lake.staging("transactions")).select("transaction_id", "is_fraud").collect()
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert labels.stage_labels(spark, lake, raw) == []


def test_a_label_taken_back(spark):
    txns = spark.createDataFrame([("a", True, 1), ("b", True, 1)], "transaction_id string, is_fraud boolean, n int")
    back = spark.createDataFrame([("a", None)], "transaction_id string, is_fraud boolean")
    assert {r.transaction_id: r.is_fraud for r in labels.relabel(txns, back).collect()} == {"a": None, "b": True}


# Buckets


def test_the_widest_join_of_the_mart_needs_no_exchange(spark, tmp_path):
    txns = spark.createDataFrame(list(payments(300)), PAYMENT).filter("is_valid")
    missing = [c for c in marts.FACT_COLUMNS if c not in txns.columns]
    valid = txns.withColumns({c: F.lit(None).cast("boolean" if c.startswith(("error", "is_", "has_")) else "string") for c in missing})
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "-1")
    try:
        stored, built = bucketed.store_pair(valid, "bucket_test", str(tmp_path), 4)
        people = dims.first_versions(spark.createDataFrame([("u1", 3, "F", 700, 1.0)], "user_id string, current_age int, gender string, credit_score int, yearly_income double"), "user_id", START)
        mart = marts.fraud_mart(marts.fact_transactions(stored), people, built, dims.merchant_dimension(stored))
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(transaction_id" not in plan and "hashpartitioning(user_id" in plan
        assert same(mart, marts.fraud_mart(marts.fact_transactions(valid), people, features.fraud_features(valid), dims.merchant_dimension(valid)))
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
        spark.sql("DROP DATABASE IF EXISTS bucket_test CASCADE")
