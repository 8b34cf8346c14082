import random
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from rosterlake.operators import history as h
from rosterlake.plans import directory

T0 = datetime(2024, 1, 1)
SCHEMA = "k long, at timestamp, a string, b string, late boolean"


def make(n, seed):
    r = random.Random(seed)
    pick = lambda: r.choice([None, "X", "x ", "Y", "y  z", "Y Z"])
    return [(r.randint(1, 6), T0 + timedelta(days=d), pick(), pick(), r.random() < 0.3) for d in r.sample(range(900), n)]


def brute(data):
    fold = lambda v: None if v is None else " ".join(v.lower().split())
    out = []
    for k in {x[0] for x in data}:
        state, chain = (None, None), []
        for _, at, a, b, _ in sorted((x for x in data if x[0] == k), key=lambda x: x[1]):
            new = (fold(a) or state[0], fold(b) or state[1])
            if new != state:
                chain.append((k, *new, at))
                state = new
        out += [(*c, chain[i + 1][3] if i + 1 < len(chain) else None) for i, c in enumerate(chain)]
    return sorted((tuple(None if v is None else str(v) for v in r) for r in out), key=repr)


def replayed(spark, path, df, late="late", key="k", at="at", attrs=("a", "b")):
    store = h.ChainStore(f"file://{path}", key, at, list(attrs), buckets=4)
    late = F.col(late) if isinstance(late, str) else late
    store.apply(df.where(~late))
    store.apply(df.where(late))
    return store.chains(spark)


def test_store_equals_brute_force(spark, tmp_path):
    for seed in range(3):
        data = make(60, seed)
        df = spark.createDataFrame(data, SCHEMA)
        assert rows(replayed(spark, f"{tmp_path}/{seed}", df)) == brute(data)


def test_store_takes_late_and_corrected_updates(spark, tmp_path):
    data = make(60, 9)
    store = h.ChainStore(f"file://{tmp_path}/s", "k", "at", ["a", "b"])
    first, late = [x for x in data if not x[4]], [x for x in data if x[4]]
    assert store.apply(spark.createDataFrame(first, SCHEMA)) == 0
    assert rows(store.chains(spark)) == brute(first)
    assert store.apply(spark.createDataFrame(late, SCHEMA)) == 1
    assert rows(store.chains(spark)) == brute(data)
    before = store.manifest(spark)
    store.apply(spark.createDataFrame(late, SCHEMA))
    # Nothing new was said: no bucket is written.
    assert rows(store.chains(spark)) == brute(data) and store.manifest(spark)["buckets"] == before["buckets"]


def test_store_writes_touched_buckets_only_and_removes_old_files(spark, tmp_path):
    store = h.ChainStore(f"file://{tmp_path}/s", "k", "at", ["a", "b"], buckets=8)
    data = [(k, T0, "x", None, False) for k in range(40)]
    store.apply(spark.createDataFrame(data, SCHEMA))
    for n in range(3):
        store.apply(spark.createDataFrame([(7, T0 + timedelta(n + 1), f"y{n}", None, True)], SCHEMA))
    versions = store.manifest(spark)["buckets"]
    assert sorted(versions.values()) == [0] * 7 + [3]
    files = {str(f.relative_to(f"{tmp_path}/s/chains")) for f in (tmp_path / "s" / "chains").glob("v*/bucket=*")}
    mine = next(b for b, v in versions.items() if v == 3)
    assert f"v0/bucket={mine}" not in files and f"v3/bucket={mine}" in files and f"v2/bucket={mine}" in files
    assert rows(store.chains(spark).where("k = 7"), "a") == [("x",), ("y0",), ("y1",), ("y2",)] and store.chains(spark).count() == 43


def test_nulls_ties_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(None, T0, "a", "b", False), (1, None, "a", "b", False), (1, T0, None, None, False), (1, T0, "q", None, False), (1, T0, "p", None, True)], SCHEMA)
    assert rows(replayed(spark, f"{tmp_path}/a", df), "k", "a", "b") == [("1", "q", None)]
    assert replayed(spark, f"{tmp_path}/b", df.limit(0)).count() == 0


def test_p4_applies_the_last_delivery_to_stored_chains(spark, tmp_path, monkeypatch):
    data = [(i, T0 + timedelta(days=d), s, "x", r) for i, d, s, r in [(1, 0, "A", 1), (1, 2, "B", 2), (1, 1, "C", 3), (2, 0, "A", 1), (2, 5, "B", 2), (2, 0, "a ", 3), (3, 0, "A", None)]]
    df = spark.createDataFrame(data, "provider_id long, updated_date timestamp, specialty string, primary_site_of_care string, run_id long")
    calls, real = [], h.replaced

    def spy(chains, before, new, *rest):
        calls.append((chains.count(), before.count(), new.count()))
        return real(chains, before, new, *rest)

    monkeypatch.setattr(h, "replaced", spy)
    for name, rows_ in (("full", df), ("empty", df.limit(0))):
        rows_.write.parquet(f"{tmp_path}/{name}/provider_snapshots.parquet")
        got = rows(directory.p4_versions(spark, f"{tmp_path}/{name}"))
        assert got == rows(replayed(spark, f"{tmp_path}/{name}/s", rows_, F.coalesce(F.col("run_id") == 3, F.lit(False)), "provider_id", "updated_date", ("specialty", "primary_site_of_care")).select("provider_id", "specialty", "primary_site_of_care", directory._stamp("valid_from").alias("valid_from"), F.coalesce(directory._stamp("valid_to"), F.lit("open")).alias("valid_to")))
    # The load, and of the update what it says anew, against the raw changes of its buckets only.
    assert calls[0] == (0, 0, 5) and calls[1][2] == 1 and calls[1][0] <= 5
