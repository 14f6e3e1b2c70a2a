"""Problems 3 and 7 on small tables: nulls, ties, repeated rows, empty tables, clashing columns, brute force."""

import random
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from harrowmill.operators import messages as M, timestamps as T

REF = "topic string, delivery_id bigint, delivered_at timestamp, id string, url string, message string, late string"


def t(s):
    return datetime(2024, 1, 1, 0, 0, s)


def refs(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], REF)


def test_redundant_copies(spark):
    rows = [
        ("n", 1, t(5), "a", "http://X.example/1/"), ("n", 2, t(3), "a", "https://x.example/1"), ("n", 3, t(9), None, "https://x.example/1?u=1"), ("n", 4, t(9), "", "https://x.example/1#c"),
        ("v", 5, t(1), "a", "https://x.example/1"), ("n", 6, t(3), "b", "https://x.example/1"), ("n", 7, None, "a", None), ("n", 8, t(1), None, None), ("n", 9, t(1), None, None),
        ("n", 10, t(2), "c", "u"), ("n", 11, t(2), "c", "u"), (None, 12, t(1), "a", None), ("n", None, t(1), "a", None),
    ]
    assert sorted(r[0] for r in M.redundant_deliveries(refs(spark, rows)).collect()) == [1, 3, 4, 7, 11]
    assert sorted(r.delivery_id for r in M.unique_deliveries(refs(spark, rows)).collect()) == [2, 5, 6, 8, 9, 10, 12]


def test_repeated_rows_and_empty(spark):
    rows = [("n", 1, t(1), "a", "u")] * 3 + [("n", 2, t(1), "a", "u")]
    assert [r[0] for r in M.redundant_deliveries(refs(spark, rows)).collect()] == [2]
    assert M.redundant_deliveries(refs(spark, [])).count() == 0 and M.unique_deliveries(refs(spark, [])).count() == 0


def test_new_messages(spark):
    old, new = refs(spark, [("n", 1, t(1), "a", "u")]), refs(spark, [("n", 2, t(2), "a", "u"), ("n", 3, t(2), "b", "u"), ("n", 4, t(3), "b", "u")])
    assert [r.delivery_id for r in M.new_messages(new, M.first_deliveries(old)).collect()] == [3]


def test_new_messages_share_identities_with_the_store(spark):
    old = refs(spark, [("n", 1, t(1), "a", "u"), ("n", 2, t(1), None, "v")])
    new = refs(spark, [("n", 3, t(2), None, "u"), ("n", 4, t(2), "b", "v"), ("n", 5, t(3), "c", "v"), ("n", 6, t(3), "", "v"), ("m", 7, t(3), "b", "v")])
    assert sorted(r.delivery_id for r in M.new_messages(new, M.first_deliveries(old)).collect()) == [5, 7]


def test_further_url_of_a_stored_id(spark):
    stored = M.store_after(M.first_deliveries(refs(spark, [("n", 1, t(1), "a", "u")])), refs(spark, [("n", 2, t(2), "a", "v"), ("n", 3, t(2), "a", "u")]))
    assert [(r.message, r.delivery_id, r.copies, sorted(u.url for u in r.urls)) for r in stored.collect()] == [("i:a", 1, 3, ["u", "v"])]
    assert M.new_messages(refs(spark, [("n", 4, t(3), None, "v")]), stored).count() == 0


def test_batches_keep_what_the_whole_keeps(spark):
    # An id keeps to its url, else two kept deliveries may turn out to be one only after both were stored.
    rng, rows = random.Random(7), []
    for i in range(60):
        url = rng.choice(["u", "v", "w", "x", "y", "z", None])
        rows.append((rng.choice("nm"), i, t(i // 5), rng.choice([f"{url}1", f"{url}2", None, ""]), url))
    stored, kept = M.first_deliveries(refs(spark, rows[:15])), []
    kept += [r.delivery_id for r in stored.collect()]
    for lo in (15, 30, 45):
        batch = refs(spark, rows[lo : lo + 15])
        kept += [r.delivery_id for r in M.new_messages(batch, stored).collect()]
        stored = M.store_after(stored, batch).localCheckpoint()
    assert sorted(kept) == sorted(r.delivery_id for r in M.unique_deliveries(refs(spark, rows)).collect())


def read(spark, rows):
    df = spark.createDataFrame([(i, *r, "x", "y") for i, r in enumerate(rows)], "i int, text string, zone string, country string, status string, offset_s string")
    return [tuple(r) for r in T.normalize_timestamps(df).orderBy("i").select("epoch_ms", "status").collect()]


def ms(*a):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1000)


def test_notations(spark):
    ny = "America/New_York"
    got = read(spark, [
        ("2024-11-03T01:30:00", ny, "US"), ("2024-03-10 02:30:00", ny, "US"), ("03/04/2024 10:00", ny, "US"), ("03/04/2024 10:00", ny, "GB"),
        ("2024-07-01", ny, "US"), ("Fri, 01 Aug 2025 04:51:19 +0100", None, None), ("5 octobre 2025 à 8h10", "Europe/Paris", "FR"), ("2024년 2월 24일 오전 12:31", "Asia/Seoul", "KR"),
        ("1705879424", ny, "US"), ("2024-01-06 07:02:44.783364125 +0000 UTC", None, None), ("yesterday", ny, "US"), ("", ny, "US"), (None, None, None), ("2024-02-30 10:00", ny, "US"),
        ("2024-01-15T12:26:02", None, "US"), ("2024-01-15T12:26:02", "No/Zone", "US"), ("10. Dezember 2025, 03:20 Uhr", "Europe/Berlin", "DE"), ("April 7, 2024 3:12 AM AEST", "Australia/Sydney", "AU"),
        ("20240119T081733+0100", None, None), ("Fri Apr  5 09:36:33 2024", "UTC", None), ("x" * 100_000, ny, "US"), ("12/31/2024, 12:05 AM", "UTC", "US"), ("10 de mayo de 2024, 01:51", "UTC", "ES"),
    ])
    assert got == [
        (ms(2024, 11, 3, 5, 30), "ambiguous"), (None, "nonexistent"), (ms(2024, 3, 4, 15), "exact"), (ms(2024, 4, 3, 14), "exact"),
        (ms(2024, 7, 1, 4), "exact"), (ms(2025, 8, 1, 3, 51, 19), "direct"), (ms(2025, 10, 5, 6, 10), "exact"), (ms(2024, 2, 23, 15, 31), "exact"),
        (1705879424000, "direct"), (ms(2024, 1, 6, 7, 2, 44) + 783, "direct"), (None, "unreadable"), (None, "absent"), (None, "absent"), (None, "unreadable"),
        (None, "no_zone"), (None, "no_zone"), (ms(2025, 12, 10, 2, 20), "exact"), (ms(2024, 4, 6, 17, 12), "direct"),
        (ms(2024, 1, 19, 7, 17, 33), "direct"), (ms(2024, 4, 5, 9, 36, 33), "exact"), (None, "unreadable"), (ms(2024, 12, 31, 0, 5), "exact"), (ms(2024, 5, 10, 1, 51), "exact"),
    ]


def test_empty_timestamps(spark):
    assert read(spark, []) == []


@pytest.mark.parametrize("zone", ["Europe/London", "Australia/Sydney", "America/Los_Angeles", "Asia/Seoul", "Australia/Lord_Howe"])
def test_intervals_against_zone_database(zone):
    spans = T._zone_intervals(zone)
    z = ZoneInfo(zone)

    @settings(max_examples=300, deadline=None)
    @given(st.integers(min_value=0, max_value=2_500_000_000))
    def check(sec):
        local = datetime.fromtimestamp(sec, timezone.utc).replace(tzinfo=None)
        real = {int(u.timestamp()) for fold in (0, 1) for u in [local.replace(tzinfo=z, fold=fold).astimezone(timezone.utc)] if u.astimezone(z).replace(tzinfo=None) == local}
        assert {sec - o for a, b, o in spans if a <= sec * 1000 < b} == real

    check()


def test_found_instants(spark):
    c = spark.createDataFrame([("c1", "s", "2024-01-01T00:00:00Z", "US"), ("c2", "s", "2024-01-01 00:00", "US"), ("c3", None, "n/a", None)], "id string, source_id string, published_at string, country string")
    r = spark.createDataFrame([("r1", "1700000000000", '{"node_tz": "UTC"}', ("US",))], "id string, fetched_at string, metadata string, source struct<country:string>")
    s = spark.createDataFrame([("s", "UTC", "US"), ("s", "UTC", "US")], "source_id string, timezone string, country string")
    assert sorted(map(tuple, T.found_instants(c, r, s).collect())) == [("contents", "c2", ms(2024, 1, 1)), ("raw_contents", "r1", 1700000000000)]


def test_instants_before_1970(spark):
    """Zone intervals reach as far back as the parser does; nothing is lost for its age."""
    rows = [(1, "1965-07-01T10:00:00", "Europe/Paris", "FR"), (2, "1912-01-01T12:00:00", "UTC", "FR"), (3, "1899-01-01T12:00:00", "UTC", "FR")]
    got = T.normalize_timestamps(spark.createDataFrame(rows, "k int, text string, zone string, country string")).orderBy("k").collect()
    assert [(r.epoch_ms, r.status) for r in got] == [(-142_095_600_000, "exact"), (-1_830_340_800_000, "exact"), (None, "unreadable")]
