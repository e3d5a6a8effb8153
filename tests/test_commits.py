"""Optimistic commits and part-wise upserts."""

import glob
import os
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from depotlens.operators import labels as LB
from depotlens.plans import ml as ML
from depotlens.sinks.parts import PartedTable
from depotlens.sinks.tables import CommitConflict, Pointers, VersionedTable, merge_upsert, write_clustered
from tests.helpers import d

KEYS = ["Depotnummer", "stichtag"]


def root():
    return os.path.join(tempfile.mkdtemp(prefix="depotlens-test-"), "t")


def labels(spark, rows, column="label_T7"):
    return spark.createDataFrame([(k, d(day), v) for k, day, v in rows], f"Depotnummer string, stichtag date, {column} int")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def by_key(existing, new):
    return LB.upsert_labels(existing, new)


def test_a_commit_from_an_old_version_is_refused(spark):
    table = VersionedTable(spark, root())
    a = spark.createDataFrame([(1,)], "a int")
    table.commit(a)
    base, rows = table.snapshot()
    table.commit(rows.union(a))
    with pytest.raises(CommitConflict):
        table.commit(rows.union(a).union(a), base)
    assert table.read().count() == 2 and len(glob.glob(f"{table.root}/v=*")) == 2


def test_interleaved_upserts_keep_both(spark):
    table = VersionedTable(spark, root())
    merge_upsert(table, labels(spark, [("1", "2025-01-01", 0)]), KEYS, by_key)
    others = [("2", "2025-01-01", 1), ("3", "2025-01-01", 1)]

    def interrupted(existing, new):
        if others:  # another writer commits between our read and our commit
            merge_upsert(table, labels(spark, [others.pop()]), KEYS, by_key)
        return by_key(existing, new)

    got = merge_upsert(table, labels(spark, [("4", "2025-01-01", 1), ("1", "2025-01-01", 1)]), KEYS, interrupted)
    assert [(r[0], r[2]) for r in rows_of(got)] == [("1", 1), ("2", 1), ("3", 1), ("4", 1)]


@pytest.mark.parametrize("scheme", ["file", "other"])
def test_a_pointer_is_created_once(spark, scheme, monkeypatch):
    p = Pointers(spark, root())
    if scheme == "other":  # the way of file systems without links
        fs = p._fs(p._Path(p.root))
        class Fs:  # noqa: E306
            def __getattr__(self, name):
                return getattr(fs, name)
            def getUri(self):  # noqa: E301, N802
                class Uri:
                    def __getattr__(self, name):
                        return getattr(fs.getUri(), name)
                    def getScheme(self):  # noqa: E301, N802
                        return "other"
                    def _get_object_id(self):
                        return fs.getUri()._get_object_id()
                return fs.getUri() if self.asked else (setattr(self, "asked", True) or Uri())
            asked = False
        monkeypatch.setattr(Pointers, "_fs", lambda self, path: Fs() if "_next" in path.toString() else fs)
    p.create(1, "one")
    with pytest.raises(CommitConflict):
        p.create(1, "two")
    assert p.newest() == (1, "one") and not glob.glob(f"{p.root}/_next*")


def test_registry_keeps_both_models_of_two_writers(spark):
    table = VersionedTable(spark, root())
    table.commit(spark.createDataFrame([], ML.REGISTRY_SCHEMA))
    entry = lambda v: {"model_name": "buy", "version": v, "horizon_days": 7, "path": v}
    calls = []

    def change(rows):
        if not calls:
            calls.append(1)
            table.update(lambda r: ML.register_model(r, entry("T7-v1-iso90d")))
        return ML.register_model(rows, entry("T7-v2-iso90d"))

    got = table.update(change)
    assert {(r["model_id"], r["version"], r["is_active"]) for r in got.collect()} == {(1, "T7-v1-iso90d", False), (2, "T7-v2-iso90d", True)}


def part_files(table):
    return {n: sorted((f, os.stat(f).st_mtime_ns) for f in glob.glob(f"{table.root}/{path}/*.parquet")) for n, path in table.manifest().parts.items()}


def test_only_touched_parts_are_written(spark):
    parted = PartedTable(spark, root(), KEYS, "stichtag", buckets=3)
    whole = VersionedTable(spark, root())
    days = [f"2025-{m:02}-{k:02}" for m in (1, 2, 3) for k in (5, 15)]
    first = labels(spark, [(str(k), day, k % 2) for k in range(12) for day in days])
    steps = [
        (first, None), (labels(spark, [(str(k), "2025-02-15", 1) for k in range(4)] + [("99", "2025-02-15", 0)]), "202502"),
        (labels(spark, [("1", "2025-03-05", 1), ("1", "2025-04-01", 1)], "label_T14"), None),
        (labels(spark, [("5", "2025-01-05", None)]), "202501"),
    ]
    before = {}
    for new, month in steps:
        parted.upsert(new, by_key)
        merge_upsert(whole, new, KEYS, by_key)
        got = parted.read()
        assert rows_of(got.select(*whole.read().columns)) == rows_of(whole.read())
        now = part_files(parted)
        changed = {n for n in now if now[n] != before.get(n)}
        assert before == {} or len(changed) < len(now)
        if month:
            assert changed and all(n.startswith(month) for n in changed)
        before = now
    assert len(before) > 9


def test_interleaved_part_upserts(spark):
    keep = lambda existing, new: existing.join(new, KEYS, "left_anti").unionByName(new)
    table = PartedTable(spark, root(), KEYS, "stichtag", buckets=2)
    table.upsert(labels(spark, [("1", "2025-01-01", 0), ("2", "2025-02-01", 0)]), keep)
    for day, merges in (("2025-02-01", 1), ("2025-01-01", 2)):  # the other writer changes another part, then the same one
        calls = []

        def interrupted(existing, new, calls=calls, day=day):
            calls.append(1)
            if len(calls) == 1:
                other = PartedTable(spark, table.root, KEYS, "stichtag", buckets=2)
                other.upsert(labels(spark, [(k, day, 5) for k in ("2", "7", "8", "9")]), keep)
            return keep(existing, new)

        table.upsert(labels(spark, [(k, "2025-01-01", 6) for k in ("1", "3", "4", "5")]), interrupted)
        assert len(calls) == merges
        got = {(r[0], str(r[1])): r[2] for r in table.read().collect()}
        assert all(got[k, day] == 5 for k in ("2", "7", "8", "9")) and all(got[k, "2025-01-01"] == 6 for k in ("1", "3", "4", "5"))
    with pytest.raises(ValueError, match="laid out"):
        PartedTable(spark, table.root, KEYS, "stichtag", buckets=4).read()


def test_clustered_files_do_not_overlap(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") * 7919 % 500).cast("string")).alias("k"), (F.col("id") * 31 % 30_011).alias("d"))
    path = root()
    write_clustered(df, path, ["k", "d"], rows_per_file=2000)
    ranges, sizes = [], []
    for f in glob.glob(f"{path}/*.parquet"):
        rows = pq.read_table(f, columns=["k", "d"]).to_pylist()
        keys = [(r["k"], r["d"]) for r in rows]
        assert keys == sorted(keys)
        ranges.append((keys[0], keys[-1]))
        sizes.append(len(keys))
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert max(sizes) <= 2500 and sum(sizes) == 30_000
    assert sum(a[0] <= "hot" <= b[0] for a, b in ranges) >= 4  # the large key is spread
    write_clustered(df.limit(0), path, ["k"])
    assert spark.read.schema(df.schema).parquet(path).count() == 0
