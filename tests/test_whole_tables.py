"""Queries on whole tables against brute force."""

import datetime as dt
import statistics

import pandas as pd
import pytest

from verdance.operators import raster as R
from verdance.plans import registry

TYPES = ["view", "click", "error", "purchase"]
EVENTS = [(i, TYPES[i * 7 % 11 % 4], i * 37 % 101 / 10) for i in range(6000)]
SUPPLIERS = range(1, 61)
FIRST = dt.date(1996, 11, 1)
#: (orderkey, custkey, status, date), (partkey, date): no key is a multiple of 7, 97 or 50.
ORDERS = [(50 * i + 1, 7 * i + 1, "OOF"[i % 3 if i % 4 else 0], FIRST + dt.timedelta(i * 3 % 170)) for i in range(200)]
ITEMS = [(97 * i + 1, FIRST + dt.timedelta(i * 11 % 180)) for i in range(30)]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    d = tmp_path_factory.mktemp("whole")
    pd.DataFrame(EVENTS, columns=["event_id", "event_type", "value"]).to_parquet(d / "events.parquet")
    pd.DataFrame({"s_suppkey": list(SUPPLIERS)}).to_parquet(d / "supplier.parquet")
    orders = pd.DataFrame(ORDERS, columns=["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    items = pd.DataFrame(ITEMS, columns=["l_partkey", "l_shipdate"])
    orders.assign(o_orderdate=pd.to_datetime(orders.o_orderdate).astype("datetime64[us]")).to_parquet(d / "orders.parquet")
    items.assign(l_shipdate=pd.to_datetime(items.l_shipdate).astype("datetime64[us]")).to_parquet(d / "lineitem.parquet")
    return str(d)


def rows(spark, tables, name):
    return [tuple(r) for r in registry.queries()[name](spark, tables).collect()]


def near(a, b):
    return a == b or isinstance(a, float) and isinstance(b, float) and abs(a - b) < 1e-6


def same(got, want):
    got, want = sorted(got, key=repr), sorted(want, key=repr)
    return len(got) == len(want) and all(len(x) == len(y) and all(map(near, x, y)) for x, y in zip(got, want))


def zone_cells():
    """(zone, row, col, shared area, whether it holds the centre) by going over every cell around each zone."""
    side = lambda a, b, c, d: max(0.0, min(b, d) - max(a, c))
    for k in SUPPLIERS:
        x, y, w, h = k % 10 * 10 + 0.3, k // 10 * 10 + 0.25, 7.0, 4.0
        for r in range(60):
            for c in range(100):
                share = side(c, c + 1, x, x + w) * side(r, r + 1, y, y + h) - side(c, c + 1, x + w / 4, x + w / 2) * side(r, r + 1, y + h / 4, y + h / 2)
                hole = x + w / 4 < c + 0.5 < x + w / 2 and y + h / 4 < r + 0.5 < y + h / 2
                yield k, r, c, share, x < c + 0.5 < x + w and y < r + 0.5 < y + h and not hole


def test_zones_meet_all_cells(spark, tables):
    cells = list(zone_cells())
    value = {(i // 100, i % 100): v for i, _, v in EVENTS}
    assert same(rows(spark, tables, "cell_intersection_area"), [(k, r, c, round(a, 9)) for k, r, c, a, _ in cells if a > 1e-12])
    held = {}
    for k, r, c, _, centre in cells:
        if centre:
            held.setdefault(k, []).append((r, c))
    assert max(held) > 40 and max(r for x in held.values() for r, _ in x) >= 40
    want = [(k, len(x), statistics.fmean(value[p] for p in x), statistics.median(value[p] for p in x)) for k, x in held.items()]
    assert same(rows(spark, tables, "zone_pixel_join"), want)
    burnt = {}
    for k, r, c, a, _ in cells:
        if a > 1e-12:
            burnt[r, c] = float(max(k, burnt.get((r, c), 0)))
    assert same(rows(spark, tables, "rasterize_burn"), [(r, c, burnt.get((r, c))) for r, c in value])
    assert same(rows(spark, tables, "clip_centre"), [(r, c, value[r, c]) for r, c in {p for x in held.values() for p in x}])
    assert same(rows(spark, tables, "zone_box_filter"), [(k,) for k in SUPPLIERS if k % 10 * 10 + 0.3 <= 30 and k % 10 * 10 + 7.3 >= 12 and k // 10 * 10 + 4.25 >= 2])


def test_grids_to_their_last_row(spark, tables):
    whole = {(i // 100, i % 100): v for i, _, v in EVENTS}
    holed = {(i // 100, i % 100): None if t == "error" else v for i, t, v in EVENTS}
    mirror = lambda i, n: -1 - i if i < 0 else 2 * n - 1 - i if i >= n else i
    want = []
    for r, c in whole:
        x = [whole[mirror(r + i, 60), mirror(c + j, 100)] for i in (-1, 0, 1) for j in (-1, 0, 1)]
        want.append((r, c, sum(x) / 9, statistics.pvariance(x)))
    got = rows(spark, tables, "focal_mean_var")
    assert len(got) == 6000
    for x, y in zip(sorted(got), sorted(want)):
        assert x[:2] == y[:2] and abs(x[2] - y[2]) < 1e-5 and abs(x[3] - y[3]) < 1e-3
    nearest = lambda r, c: min(((r - i) ** 2 + (c - j) ** 2, i, j) for i in range(r - 9, r + 10) for j in range(c - 9, c + 10) if holed.get((i, j)) is not None)
    assert same(rows(spark, tables, "nearest_fill"), [(r, c, holed[nearest(r, c)[1:]] if v is None else v) for (r, c), v in holed.items()])
    want = []
    for r in range(30):
        for c in range(50):
            # the target's centre lies in the middle of source cell (2 r, 2 c)
            want.append((r, c, holed[2 * r, 2 * c]))
    assert same(rows(spark, tables, "resample_bilinear"), want)


def test_nearest_fill_looks_on_where_nothing_is_close(spark):
    cells = spark.createDataFrame([(r, c, 1.0 * r + c if (r, c) in ((0, 0), (0, 40), (30, 3)) else None) for r in range(40) for c in range(45)], "row int, col int, value double")
    held = [(0, 0), (0, 40), (30, 3)]
    got = {(x.row, x.col): x.value for x in R.nearest_fill(cells, "value", 20).collect()}
    assert len(got) == 1800
    for (r, c), v in got.items():
        d, i, j = min(((r - i) ** 2 + (c - j) ** 2, i, j) for i, j in held)
        assert v == (1.0 * i + j if d <= 400 else None)


def test_the_forest_sees_all_events(spark, tables, monkeypatch):
    from verdance.operators import cloud

    seen = []
    monkeypatch.setattr(cloud, "remove_clouds", lambda target, previous, radar, bands, **more: seen.append((target.count(), more)) or target.withColumn("source", target.SCL))
    registry.queries()["vegetation_forest"](spark, tables)
    assert seen == [(6000, {})]


def test_dates_of_all_orders_and_lineitems(spark, tables):
    def close(day):
        s = min({d for _, d in ITEMS}, key=lambda s: (abs((s - day).days), -s.toordinal()))
        return s, abs((s - day).days)

    days = {d for *_, d in ORDERS}
    assert same(rows(spark, tables, "nearest_date_join"), [(d, *close(d)) for d in days])
    assert same(rows(spark, tables, "inference_window"), [(k, d + dt.timedelta(i)) for k, _, _, d in ORDERS for i in range(5)])
    share = {d: 100.0 * sum(x[3] == d and x[2] == "O" for x in ORDERS) / sum(x[3] == d for x in ORDERS) for d in days}
    chosen = max(d for d in days if dt.date(1997, 3, 1) <= d <= dt.date(1997, 3, 30) and share[d] >= 95)
    past = sorted((d for d in days if d < chosen and share[d] >= 95), reverse=True)[:5]
    want = [(d, i, f"prev{i:02d}" if i else "inference", *close(d)) for i, d in enumerate([chosen, *past])]
    assert same(rows(spark, tables, "scene_selection"), want)
