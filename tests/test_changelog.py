"""Table state from change logs: decoding, merging, bucketed storage."""

import json
import random

import pytest
from pyspark.sql import functions as F

from txnlake.operators import changelog
from txnlake.sources import cdc
from txnlake.sources.buckets import BucketedTable
from txnlake.sources.tables import VersionedTable

COLUMNS = "_partition INT, _offset LONG, op STRING, id STRING, status STRING"


def model(changes):
    """Last change per key, one at a time."""
    last = {}
    for p, o, op, key, status in changes:
        if key not in last or (p, o) > last[key][:2]:
            last[key] = (p, o, op, status)
    return sorted((k, v[3]) for k, v in last.items() if v[2] != "d")


def log(seed, rows=400):
    rng = random.Random(seed)
    out = []
    for offset in range(rows):
        key = "hot" if rng.random() < .34 else f"k{rng.randrange(40)}"
        op = rng.choice("cuuud")
        out.append((sum(map(ord, key)) % 3, offset, op, key, f"s{offset}"))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_state_is_the_same_for_any_order_and_split(spark, seed):
    """Shuffled, repeated and split changes; a third of them on one key."""
    changes, rng = log(seed), random.Random(seed + 100)
    dealt = changes + rng.sample(changes, 60)
    rng.shuffle(dealt)
    state = None
    for cut in range(0, len(dealt), 170):
        batch = spark.createDataFrame(dealt[cut:cut + 170], COLUMNS)
        state = spark.createDataFrame(changelog.merge_changes(state, batch, "id").collect(), COLUMNS)
    got = sorted((r.id, r.status) for r in changelog.live_rows(state).collect())
    assert got == model(changes) and any(c[2] == "d" for c in changes)
    assert changelog.live_rows(state).columns == ["id", "status"]


def test_a_late_older_change_does_not_bring_a_deleted_row_back(spark):
    df = lambda *rows: spark.createDataFrame(list(rows), COLUMNS)
    state = changelog.merge_changes(None, df((0, 9, "d", "a", None)), "id")
    state = changelog.merge_changes(state, df((0, 3, "u", "a", "old"), (0, 1, "c", "a", "new")), "id")
    assert changelog.live_rows(state).collect() == [] and state.count() == 1


def _record(key, value, op=None, header="op", offset=0, partition=0):
    return (key, value if value is None or isinstance(value, str) else json.dumps(value),
            None if op is None else [(header, op)], partition, offset)


def test_decode_rows_forms(spark):
    at = "2024-01-02T03:04:05.000006Z"
    rows = [
        _record("x", {"id": "a", "amount": "1.50", "at": at}, "c", offset=1),
        _record("x", {"payload": {"id": "b", "amount": 2}, "schema": "s"}, "r", "__op", offset=2),
        _record("x", {"id": "c", "__op": "u", "amount": "not a number"}, offset=3),
        _record("x", {"id": "d", "__deleted": "true"}, "u", offset=4),
        _record("e", None, "d", offset=5),
        _record('{"id": "f"}', None, offset=6),
        _record('{"schema": 1, "payload": {"id": "g"}}', None, offset=7),
        _record("x", {"id": "h", "amount": "3"}, "D", "OP", offset=8),
        _record("x", {"id": "i"}, offset=9),
        _record("x", "no json", "c"), _record("x", "[1]", "c"), _record(None, None, "d"),
        _record("x", {"id": "t"}, "t"), _record(None, {"amount": "1"}, "c"), _record("x", {"id": ""}, "c"),
    ]
    got = cdc.decode_rows(spark.createDataFrame(rows, cdc.RECORD_SCHEMA),
                          "id STRING, amount DECIMAL(20,6), at TIMESTAMP_NTZ").orderBy("_offset").collect()
    assert [(r.id, r.op, None if r.amount is None else str(r.amount)) for r in got] == [
        ("a", "c", "1.500000"), ("b", "r", "2.000000"), ("c", "u", None), ("d", "d", None),
        ("e", "d", None), ("f", "d", None), ("g", "d", None), ("h", "d", "3.000000"), ("i", "c", None)]
    assert got[0]["at"].isoformat() == "2024-01-02T03:04:05.000006"


@pytest.mark.parametrize("name", sorted(cdc.TABLES))
def test_records_round_trip(spark, name):
    """Every captured table's rows survive rendering and decoding in every form."""
    ddl = cdc.TABLES[name]
    from pyspark.sql import types as T
    fields = T.StructType.fromDDL(ddl).fields
    rows = spark.range(12).select(
        (F.col("id") % 2).cast("int").alias("_partition"), F.col("id").alias("_offset"),
        F.when(F.col("id") % 4 == 3, "d").otherwise("u").alias("op"),
        *[(F.timestamp_seconds(F.col("id") * 86_461 + 7).cast("timestamp_ntz")
           if f.dataType.simpleString() == "timestamp_ntz"
           else F.concat(F.lit("é\"x"), F.col("id").cast("string")) if f.dataType == T.StringType()
           else F.col("id").cast(f.dataType)).alias(f.name) for f in fields])
    back = cdc.decode_rows(cdc.to_change_records(rows, ddl), ddl)
    assert back.columns == rows.columns and back.select(rows.columns).count() == 12
    assert sorted(map(str, back.where("op <> 'd'").collect())) == sorted(map(str, rows.where("op <> 'd'").collect()))
    assert sorted(r.id for r in back.where("op = 'd'").collect()) == sorted(
        r.id for r in rows.where("op = 'd'").collect())


def _files(root):
    import os
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "t")
    table = BucketedTable(spark, root, "id", buckets=16)
    assert table.read() is None and table.manifest() is None
    rows = spark.range(400).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("v"))
    table.flip(table.write(rows, range(16), top=7))
    before = _files(root)
    change = spark.createDataFrame([("3", 9), ("new", 9)], "id STRING, v INT")
    buckets = table.touched(change)
    assert 1 <= len(buckets) <= 2
    kept = table.read(buckets).join(change, "id", "left_anti")
    name = table.write(kept.unionByName(change), buckets)
    assert table.read().where("v = 9").isEmpty()                 # not flipped yet
    table.flip(name)
    new = {f for f in _files(root) - before}
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in new} == set(buckets)
    again = BucketedTable(spark, root, "id", buckets=99)          # the stored number counts
    assert again.buckets == 16 and again.manifest()["facts"] == {"top": 7}
    assert sorted(r.id for r in again.read().where("v = 9").collect()) == ["3", "new"]
    assert again.read().count() == 401 and VersionedTable(spark, root).read().count() == 401


def test_old_buckets_go_when_no_kept_manifest_names_them(spark, tmp_path):
    root = str(tmp_path / "t")
    table = BucketedTable(spark, root, "id", buckets=4, keep=2)
    rows = spark.range(40).select(F.col("id").cast("string").alias("id"))
    table.flip(table.write(rows, range(4)))
    (bucket,) = table.touched(rows.where("id = '5'"))
    sizes = []
    for _ in range(5):
        table.flip(table.write(table.read([bucket]), [bucket]))
        assert sorted(r.id for r in table.read().collect()) == sorted(str(i) for i in range(40))
        sizes.append(len(_files(root)))
    assert len(set(sizes[2:])) == 1 and len(table._pointers()) == 2
    # a bucket that loses all its rows
    table.flip(table.write(rows.limit(0), [bucket]))
    assert table.read().count() == 40 - rows.where(table.bucket() == bucket).count()
