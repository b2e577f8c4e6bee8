from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_mart import GROUPS, listing, raw_listings, raw_places, wide

from geomart.operators import star as M
from geomart.plans.mart import run
from geomart.session import materialize
from geomart.sources.star_store import StarStore
from geomart.sources.tables import FolderTables, load_star
from geomart.sources.versions import CommitConflict

FIRST = [(1, 7, "x", 40.0, 20240101), (2, 8, "y", 41.0, 20240102)]
SECOND = [(3, 7, "z", 42.0, 20240103), (4, 9, "x", 40.0, 20240101)]


def contents(store, number=None):
    version = store.version(number)
    return {n: rows(store.read(n, version)) for n in version.tables}


@pytest.fixture
def store(spark, tmp_path):
    made = StarStore(spark, str(tmp_path / "star"))
    made.load(M.build_star(wide(spark, FIRST)))
    return made


def size(store, name=None):
    return store.fs.getContentSummary(store._path(f"data/{name}" if name else "data")).getLength()


def test_a_batch_writes_only_its_own_rows(spark, tmp_path):
    store = StarStore(spark, str(tmp_path / "big"))
    many = [(i, i % 50, "x", 40.0 + i % 90 / 100, 20240101 + i % 28) for i in range(1, 4001)]
    store.load(M.build_star(wide(spark, many)))
    before, parts = size(store), {n: p for n, (_, p) in store.version().tables.items()}
    assert store.append(wide(spark, [(5000, 7, "x", 40.0, 20240101), (5001, 99, "q", 50.0, 20240301)]), "b1")
    new = {n: p[len(parts[n]) :] for n, (_, p) in store.version().tables.items()}
    assert {n: sum(x.rows for x in p) for n, p in new.items()} == {
        "dim_host": 1, "dim_property_location": 1, "dim_property": 2, "dim_date": 1, "fact_publication": 2,
    }
    written = size(store) - before
    assert written == sum(x.bytes for p in new.values() for x in p) < before / 3
    assert all(p[: len(parts[n])] == parts[n] for n, (_, p) in store.version().tables.items())  # old folders as they were


def test_append_equals_whole_load_and_a_repeated_batch_adds_nothing(spark, store):
    assert store.append(wide(spark, SECOND), "b1")
    written, number = size(store), store.version().number
    assert not store.append(wide(spark, SECOND), "b1")
    assert (size(store), store.version().number) == (written, number)
    assert store.version().batches["b1"] == {"dim_host": (3, 3), "dim_property_location": (3, 3), "dim_property": (3, 4)}
    assert store.append(wide(spark, [(5, 10, "x", 40.0, 20240101)]), "b2")
    whole = M.build_star(wide(spark, [*FIRST, *SECOND, (5, 10, "x", 40.0, 20240101)]))
    for name, natural in (("dim_host", ["host_id"]), ("dim_property", ["publication_key"]), ("dim_property_location", M.LOCATION_KEY)):
        assert rows(store.read(name).select(*natural)) == rows(whole[name].select(*natural))
    facts = store.read("fact_publication").join(store.read("dim_host"), "host_key").join(store.read("dim_property"), "property_key")
    assert rows(facts.select("publication_key", "host_id")) == [(1, 7), (2, 8), (3, 7), (4, 9), (5, 10)]
    assert store.read("dim_host").agg(F.max("host_key")).first()[0] == 4 == store.version().top["dim_host"]


def test_a_failure_at_any_step_leaves_the_old_star(spark, store, monkeypatch):
    """Steps 0 to 4 fail while a table is staged, 5 at the commit; for a batch and for a refresh."""
    old, before = contents(store), store.version()
    rows_ = M.new_rows(wide(spark, SECOND), {n: store.read(n) for n in M.LOAD_ORDER}, before.top)
    fresh = {n: materialize(df, "fresh") for n, df in M.build_star(wide(spark, SECOND)).items()}
    real, done = store.stage, []

    def stage(name, df):
        if len(done) == step:
            raise OSError("lost")
        done.append(name)
        return real(name, df)

    def rename(*args):
        raise OSError("lost")

    for step in range(6):
        for work in (lambda: store.commit(store.grown(before, rows_, "b1")), lambda: store.load(fresh)):
            done.clear()
            monkeypatch.setattr(store, "stage", stage)
            if step == 5:
                monkeypatch.setattr(store, "commit", rename)
            with pytest.raises(OSError):
                work()
            monkeypatch.undo()
            assert store.version() == before and StarStore(spark, store.base).version() == before
    assert contents(store) == old
    store.commit(store.grown(before, rows_, "b1"))
    assert store.read("fact_publication").count() == 4 and "b1" in store.version().batches


def test_bad_batches_are_refused(spark, store):
    old = contents(store)
    for bad, said in (
        ([FIRST[0]], "already"),
        ([(5, None, "x", 40.0, 20240101)], "host_key"),
    ):
        with pytest.raises(M.LoadError, match=said):
            store.append(wide(spark, bad), "b1")
    assert contents(store) == old


def test_two_writers(spark, store, monkeypatch):
    other = StarStore(spark, store.base)
    ahead = store.version()
    store.append(wide(spark, SECOND), "b1")
    with pytest.raises(CommitConflict):
        other.commit(other.grown(ahead, {n: store.read(n).limit(0) for n in M.LOAD_ORDER}, "b2"))
    real, calls = other.grown, []

    def grown(old, new, batch_id):  # another batch is committed while this one is made
        made = real(old, new, batch_id)
        if not calls:
            calls.append(1)
            store.append(wide(spark, [(8, 20, "x", 40.0, 20240101)]), "b3")
        return made

    monkeypatch.setattr(other, "grown", grown)
    assert other.append(wide(spark, [(9, 21, "x", 40.0, 20240101)]), "b4")
    assert rows(other.read("dim_host").select("host_key", "host_id")) == [(1, 7), (2, 8), (3, 9), (4, 20), (5, 21)]
    assert set(store.version().batches) == {"b1", "b3", "b4"}


def test_commit_fails_where_the_number_is_taken(spark, store, monkeypatch):
    version = store.version()
    taken = [version.number]
    monkeypatch.setattr(store, "numbers", lambda: [taken[0] - 1])  # looked before the other writer was done
    with pytest.raises(CommitConflict, match="taken"):
        store.commit(version)
    monkeypatch.undo()
    assert store.version() == version


def test_rollback_compact_expire(spark, store):
    old, number = contents(store), store.version().number
    store.append(wide(spark, SECOND), "b1")
    grown = contents(store)
    store.compact("fact_publication")
    assert contents(store) == grown and len(store.version().tables["fact_publication"][1]) == 1
    store.rollback(number)
    assert contents(store) == old and not store.version().batches
    assert contents(store, number + 1) == grown
    assert store.expire(keep=1) > 0 and contents(store) == old and len(store.numbers()) == 1


def test_load_refuses_broken_keys(spark, tmp_path, store):
    old = contents(store)
    good = {n: materialize(df, "good") for n, df in M.build_star(wide(spark, SECOND)).items()}
    fact, host = good["fact_publication"], good["dim_host"]
    for bad, said in (
        ({"fact_publication": fact.withColumn("host_key", F.lit(None).cast("long"))}, "host_key is missing"),
        ({"fact_publication": fact.withColumn("host_key", F.lit(77).cast("long"))}, "host_key has no member"),
        ({"dim_host": host.unionByName(host)}, "comes twice"),
        ({"dim_date": good["dim_date"].limit(0)}, "has no member"),
    ):
        with pytest.raises(M.LoadError, match=said):
            load_star({**good, **bad}, store)
        with pytest.raises(M.LoadError, match=said):
            load_star({**good, **bad}, FolderTables(spark, str(tmp_path / "plain")))
    assert contents(store) == old and not FolderTables(spark, str(tmp_path / "plain")).exists("dim_host")


def test_run_into_a_store(spark, tmp_path):
    items = [listing(i, lat=str(40.6 + i / 100), **{"host id": str(i % 2)}) for i in range(1, 6)]
    store = StarStore(spark, str(tmp_path / "mart"))
    run(raw_listings(spark, items), raw_places(spark), GROUPS, store, k=2)
    old = contents(store)
    assert store.read("fact_publication").count() == 5
    with pytest.raises(M.LoadError, match="host_key is missing"):
        run(raw_listings(spark, [*items, listing(9, **{"host id": None})]), raw_places(spark), GROUPS, store, k=2)
    assert contents(store) == old
