from __future__ import annotations

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
from records import history, live

from millrace.operators.store import Store
from millrace.sources import versions
from millrace.streaming.incremental import merge_histories, merge_rounds


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def write(path, payload, at):
    path.write_text(payload if isinstance(payload, str) else json.dumps(payload))
    os.utime(path, (at, at))


def fetched(folder, stamp, bodies):
    """A folder of bodies as a fetch writes it; a null body is a failure."""
    own = folder / stamp.replace(":", "").replace("+", "Z")
    own.mkdir(parents=True)
    shape = pa.schema([("endpoint", pa.string()), ("id", pa.string()), ("status", pa.int32()), ("body", pa.string()), ("fetched_at", pa.string())])
    rows = [{"endpoint": "x", "id": str(k), "status": 200, "body": b, "fetched_at": stamp} for k, b in bodies.items()]
    pq.write_table(pa.Table.from_pylist(rows, shape), own / "part-0.parquet")


def test_every_version_is_merged_once(spark, tmp_path, monkeypatch):
    raw, store = tmp_path / "raw", Store(spark, str(tmp_path / "db"))
    (raw / "fetched/live/2024-01-01/_temporary").mkdir(parents=True)
    given = []
    merge = Store.upsert_records

    def counting(self, name, records, *more, **also):
        found = merge(self, name, records, *more, **also)
        given.append(found[0].fetched)
        return found

    monkeypatch.setattr(Store, "upsert_records", counting)

    def stream():
        given.clear()
        query = merge_rounds(spark, store, str(raw), str(tmp_path / "checkpoint"))
        assert query.awaitTermination(120) and query.exception() is None
        return rows(store.read("gameweeks").select("element_id", "round", "minutes")), list(given)

    assert stream() == ([], [])  # nothing there yet
    write(raw / "gw_1.json", live(1, 2), 1_700_000_000)
    write(raw / "gw_7.json", live(1), 1_700_000_000)
    write(raw / "gw_8.json", "{no json", 1_700_000_000)
    assert stream() == ([(1, 1, 90), (1, 7, 90), (2, 1, 90)], [3])
    assert stream()[1] == []  # seen
    write(raw / "gw_7.json", live(1, 3, minutes=12), 1_700_000_100)  # written over: the other round stays unread
    assert stream() == ([(1, 1, 90), (1, 7, 12), (2, 1, 90), (3, 7, 12)], [2])
    fetched(raw / "fetched/live", "2024-01-02T00:00:00+00:00", {9: json.dumps(live(5)), 7: json.dumps(live(3, minutes=13)), 10: None})
    assert stream() == ([(1, 1, 90), (1, 7, 12), (2, 1, 90), (3, 7, 13), (5, 9, 90)], [2])
    write(raw / "gw_1.json", live(1, minutes=1), 1_600_000_000)  # older than what is there, yet another version
    (raw / "gw_7.json").unlink()
    assert stream() == ([(1, 1, 1), (1, 7, 12), (2, 1, 90), (3, 7, 13), (5, 9, 90)], [1])


def test_later_version_wins_within_a_batch(spark, tmp_path):
    raw, store = tmp_path / "raw", Store(spark, str(tmp_path / "db"))
    (raw / "players").mkdir(parents=True)
    old, new = history(4), history(4, rows=1)
    new["history"][0]["value"] = 99
    write(raw / "players/4.json", old, 1_700_000_000)  # before both fetches
    fetched(raw / "fetched/history", "2024-01-02T00:00:00+00:00", {4: json.dumps(new)})
    fetched(raw / "fetched/history", "2024-01-01T00:00:00+00:00", {4: json.dumps(old)})
    query = merge_histories(spark, store, str(raw), str(tmp_path / "checkpoint"))
    assert query.awaitTermination(120) and query.exception() is None
    assert rows(store.read("player_histories").select("element_id", "round", "value")) == [(4, 1, 99), (4, 2, 7)]


def test_offsets(spark, tmp_path):
    for name in ("a.json", "b.json", "c.txt"):
        write(tmp_path / name, "{}", 1_700_000_000)
    listing = versions.Listing(spark, [f"{tmp_path}/*.json", f"{tmp_path}/none/*.json"]).start()
    try:
        reader = versions.VersionReader({"listing": listing.address})
        first = reader.latestOffset()
        assert [p.rsplit("/", 1)[1] for p in first] == ["a.json", "b.json"] and set(first.values()) == {1_700_000_000_000}
        write(tmp_path / "b.json", "[]", 1_700_000_001)
        second = reader.latestOffset()
        assert [p.rsplit("/", 1)[1] for p, _ in versions.changed(first, second)] == ["b.json"]
        (part,) = reader.partitions(first, second)  # from the offsets alone: the same after a restart
        assert list(reader.read(part)) == versions.changed(first, second) and versions.changed(second, second) == []
        listing.globs = ["nowhere://x/*"]
        try:
            reader.latestOffset()
            raise AssertionError("a listing that fails is an error")
        except OSError as e:
            assert "listing failed" in str(e)
    finally:
        listing.close()
