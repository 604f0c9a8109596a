from datetime import datetime

from tests.conftest import rows

from foliomill.operators.snapshots import SnapshotIndex, snapshot_changes

SCHEMA = (
    "snapshot_no int, source_identifier string, document_url string, sha256 string, recorded_at timestamp, delivered_at timestamp, extra string"
)
T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def changes(spark, data):
    return rows(snapshot_changes(spark.createDataFrame(data, SCHEMA), buckets=3))


def row(n, key, url, sha, at=T1, delivered=T1):
    return (n, key, url, sha, at, delivered, "x")


def test_added_removed_changed_and_null_hash(spark):
    got = changes(
        spark,
        [
            row(1, "a", "http://h/1", "s1"),
            row(1, "b", "http://h/2", "s2"),
            row(1, "c", "http://h/3", None),
            row(2, "a", "http://h/1", "s9"),
            row(2, "c", "http://h/3", "s3"),
            row(2, "d", "http://h/4", None),
        ],
    )
    assert got == [
        (2, "a", "http://h/1", "changed"),
        (2, "b", "http://h/2", "removed"),
        (2, "c", "http://h/3", "changed"),
        (2, "d", "http://h/4", "added"),
    ]


def test_spelling_is_no_change(spark):
    got = changes(
        spark,
        [
            row(1, " a\t", "HTTP://Host.Example/Path?Q=1", " ABC "),
            row(2, "a", "http://host.example/Path?Q=1\n", "abc"),
            row(1, "b", "http://User@Host/x", "s"),
            row(2, "b", "http://user@host/x", "s"),
        ],
    )
    assert got == [(2, "b", "http://User@host/x", "removed"), (2, "b", "http://user@host/x", "added")]


def test_latest_row_counts_and_repeats_do_not(spark):
    got = changes(
        spark,
        [
            row(1, "a", "u", "new", T2),
            row(1, "a", "u", "old", T1, T2),
            row(1, "a", "u", None, None, T2),
            row(2, "a", "u", "new", T1),
            row(2, "a", "u", "new", T1),
        ],
    )
    assert got == []


def test_null_keys_empty_and_single(spark):
    assert changes(spark, []) == []
    assert changes(spark, [row(1, None, None, "s")]) == []
    got = changes(spark, [row(1, None, "a", "s"), row(2, "a", None, "s"), row(2, "", None, "s"), row(None, "z", "z", "s")])
    assert got == sorted(
        [(2, None, "a", "removed"), (2, "a", None, "added"), (2, "", None, "added")], key=repr
    )


def test_skips_to_the_snapshot_before(spark):
    assert changes(spark, [row(1, "a", "u", "s"), row(4, "a", "u", "t")]) == [(4, "a", "u", "changed")]


def test_deliveries_one_by_one_swap_the_index(spark, tmp_path):
    data = [
        [row(1, "a", "u", "s1"), row(1, "b", "u", "s2")],
        [row(2, "a", "u", "s3"), row(2, "c", "u", "s2")],
        [row(3, "a", "u", "s3"), row(3, "b", "u", "s2"), row(4, "b", "u", None)],
    ]
    path = f"file://{tmp_path}/index"
    got = []
    for delivery in data:
        got += rows(SnapshotIndex(spark, path, buckets=3).apply(spark.createDataFrame(delivery, SCHEMA)))
    assert sorted(got, key=repr) == changes(spark, [r for d in data for r in d]) and len(got) == 7
    # only the last index is kept, and the session holds no table of it
    held = [p for p in (tmp_path / "index").iterdir() if p.name.startswith("index-")]
    assert len(held) == 1 and [p.name for p in held[0].iterdir() if p.is_dir()] == ["snapshot_no=4"]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("snapshot_")]
    again = SnapshotIndex(spark, path).apply(spark.createDataFrame(data[2], SCHEMA))
    assert rows(again) == []
