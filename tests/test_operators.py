"""Edge cases on small literal frames."""

import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from littoral import schemas, sinks
from littoral.functions import core
from littoral.operators import dedupe, entity, fits, gates, metrics, models, rates, serving, spatial, temporal
from littoral.plans import catalog, registry
from littoral.sources import datastore, readers
from littoral.streaming import jobs as streams
from pyspark.sql import functions as F


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("text,want", [(None, None), ("", None), ("  ", None), ("nan", None), ("NaN", None), ("inf", None), ("12.5", 12.5), (" 3 ", 3.0), ("abc", None), ("-4e2", -400.0)])
def test_safe_float(spark, text, want):
    assert one(spark, core.safe_float(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text,want", [("true", True), ("no", False), ("1", True), ("unknown", None), (None, None), ("F", False)])
def test_safe_bool(spark, text, want):
    assert one(spark, core.safe_bool(F.lit(text).cast("string"))) is want


def test_thresholds_are_strict_and_null_never_exceeds(spark):
    rows = spark.createDataFrame([("culture", 104.0), ("culture", 104.1), ("ddPCR", 1413.0), ("ddPCR", 1504.0), ("ddPCR", 1268.0), ("culture", None)], "m string, v double")
    found = rows.select(core.exceeds(F.col("v"), core.action_value(core.is_molecular(F.col("m")))).alias("x"))
    assert [r.x for r in found.collect()] == [False, True, False, True, False, False]


def test_cutoff_follows_daylight_saving(spark):
    days = spark.createDataFrame([(date(2026, 3, 7),), (date(2026, 3, 8),)], "d date")
    assert [r.x.hour for r in days.select(core.local_cutoff_utc(F.col("d")).cast("timestamp_ntz").alias("x")).collect()] == [13, 12]


def test_clip_keeps_null_and_ladder_edges(spark):
    assert one(spark, core.clip(F.lit(None).cast("double"), 0, 1)) is None and one(spark, core.clip(F.lit(7.0), 0, 1)) == 1
    rows = spark.createDataFrame([(None,), (0.1999,), (0.2,), (0.5,), (0.9,)], "p double")
    assert [r.b for r in rows.select(core.risk_band(F.col("p")).alias("b")).collect()] == [None, "low", "moderate", "high", "high"]


def test_serving_floors(spark):
    rows = spark.createDataFrame([(0.05, True, False), (0.05, False, True), (0.05, False, None), (0.9, True, True)], "p double, posted boolean, x boolean")
    assert [r.s for r in rows.select(core.serve_probability(F.col("p"), F.col("posted"), F.col("x")).alias("s")).collect()] == [0.3, 0.2, 0.05, 0.9]


def test_route_weight(spark):
    rows = spark.createDataFrame([(None,), (1,), (3,), (4,), (5,), (9,)], "a int")
    assert [r.w for r in rows.select(core.route_weight(F.col("a")).alias("w")).collect()] == [1.0, 0.0, 0.0, 0.5, 1.0, 1.0]


def test_slug_and_web_address(spark):
    assert one(spark, core.slug(F.lit("São"), F.lit(" Beach #1 "))) == "s-o-beach-1"
    assert one(spark, core.web_address(F.lit("nan"))) is None and one(spark, core.web_address(F.lit("https://a.example"))) == "https://a.example"


def test_worst_of_day_and_ties(spark):
    d = date(2026, 1, 1)
    rows = [(1, d, False, 500.0, datetime(2026, 1, 1, 9), 1), (1, d, True, 200.0, datetime(2026, 1, 1, 8), 2), (1, d, True, None, datetime(2026, 1, 1, 10), 3), (2, d, False, 5.0, None, 4), (2, d, False, 5.0, datetime(2026, 1, 1), 5)]
    df = spark.createDataFrame(rows, "site int, day date, x boolean, v double, t timestamp, id int")
    assert {r.site: r.id for r in dedupe.worst_of_day(df, ["site", "day"], "x", "v", "t", "id").collect()} == {1: 2, 2: 5}


def test_history_is_strictly_prior(spark):
    d = date(2026, 1, 1)
    df = spark.createDataFrame([("a", d + timedelta(n), float(n)) for n in (0, 1, 2, 9, 40)], "s string, d date, v double")
    rows = {r.d: r for r in temporal.rolling(df, ["s"], "d", "v").collect()}
    assert rows[d].v_mean_7d is None and rows[d + timedelta(1)].v_mean_7d == 0.0 and rows[d + timedelta(1)].v_std_7d is None
    assert rows[d + timedelta(9)].v_mean_7d == 2.0 and rows[d + timedelta(40)].v_mean_30d is None and rows[d + timedelta(9)].days_since_sample == 7
    geo = {r.d: r for r in temporal.regulatory_geomean(df, ["s"], "d", "v").collect()}
    assert geo[d].samples_30d is None and geo[d + timedelta(1)].geomean_30d is None and geo[d].geomean_30d_above is False
    tensor = temporal.history_tensor(df, ["s"], "d", ["v"]).collect()
    assert [r.d for r in tensor] == [d + timedelta(9)] and len(tensor[0].history) == 30 and tensor[0].history[-7] == [2.0] and tensor[0].history[-1] == [0.0]


def test_wetness_against_a_loop(spark):
    rng = np.random.default_rng(1)
    data = [(k, i, None if rng.random() < 0.1 else float(rng.integers(0, 40))) for k, n in (("a", 700), ("b", 3), ("c", 1)) for i in range(n)]
    for alpha in (0.2, 0.02, 0.9):
        got = {(r.s, r.d): r.wetness for r in temporal.wetness_index(spark.createDataFrame(data, "s string, d int, v double"), ["s"], "d", "v", alpha).collect()}
        now = {}
        for s, d, v in data:
            assert math.isclose(got[s, d], now.get(s, 0.0), rel_tol=1e-12, abs_tol=1e-15)
            now[s] = now.get(s, 0.0) * (1 - alpha) + (v or 0.0) * alpha


def test_golden_rates(spark):
    d = date(2026, 1, 15)
    obs = spark.createDataFrame([("a", d - timedelta(7), True), ("a", d - timedelta(20), False), ("a", d, True)], "s string, d date, x boolean")
    r = rates.shrunk_rate(obs, obs, "s", "d", "x", "2026-01-15", 365).first()
    assert (r.n, r.pos) == (2, 1)  # a sample on the day itself is not counted
    assert math.isclose(one(spark, core.freshness(F.lit(7))), math.exp(-2))


def test_beta_quantiles_invert_the_distribution():
    a, b = np.array([0.5, 1, 3, 40]), np.array([0.5, 2, 7, 3])
    for q in (0.05, 0.5, 0.95):
        assert np.allclose(rates.beta_cdf(rates.beta_quantile(q, a, b), a, b), q, atol=1e-9)
    assert np.allclose(rates.beta_cdf(np.array([0.3]), np.array([1.0]), np.array([2.0])), 1 - 0.7**2)


def test_asof_excludes_equal_times_only_if_strict(spark):
    t = datetime(2026, 1, 1)
    left, right = spark.createDataFrame([(1, t)], "k int, t timestamp"), spark.createDataFrame([(1, t, 5), (1, t - timedelta(1), 4)], "k int, r timestamp, v int")
    assert temporal.asof_backward(left, right, "k", "t", "r", ["v"]).first().asof_v == 4
    assert temporal.asof_backward(left, right, "k", "t", "r", ["v"], strict=False).first().asof_v == 5


def test_open_intervals_and_lifted_ones(spark):
    now = datetime(2026, 1, 20)
    rows = [(1, "posting", now - timedelta(3), None, "active"), (2, "posting", now - timedelta(9), None, "active"), (3, "closure", now - timedelta(300), None, "active"), (4, "posting", now - timedelta(3), now, "active"), (5, "posting", now - timedelta(3), None, "historical"), (6, "posting", None, None, "active")]
    df = spark.createDataFrame(rows, "id int, kind string, started timestamp, ended timestamp, status string")
    assert {r.id for r in df.where(serving.active_now(F.lit(now))).collect()} == {1, 3, 6}
    old = [(1, "posting", now - timedelta(15), "active"), (2, "posting", now - timedelta(14), "active"), (3, "Chronic posting", now - timedelta(90), "active")]
    z = serving.expire_zombies(spark.createDataFrame(old, "id int, kind string, started timestamp, status string").withColumn("last_seen", F.lit(None).cast("timestamp")), F.lit(now))
    assert {r.id: r.status for r in z.collect()} == {1: "historical", 2: "active", 3: "active"}


def test_interval_window_edges(spark):
    d = date(2026, 1, 20)
    spans = spark.createDataFrame([(1, d - timedelta(40), d - timedelta(14)), (2, d - timedelta(40), d - timedelta(13)), (3, d, d + timedelta(2)), (4, d - timedelta(1), d + timedelta(400))], "k int, s date, e date")
    out = temporal.interval_features(spark.createDataFrame([(k, d) for k in range(1, 6)], "k int, d date"), spans, "k", "d", "s", "e")
    assert {r.k: (r.active, r.days_since_end) for r in out.collect()} == {1: (False, 14), 2: (True, 13), 3: (False, None), 4: (True, None), 5: (False, None)}


def test_collapse_physical_units(spark):
    t = datetime(2026, 1, 1, 9)
    rows = [("a", t, 10.0, "x", 1), ("a", t + timedelta(minutes=30), 10.0, "y", 2), ("a", t + timedelta(minutes=31), 10.0, "z", 3), ("a", t, 11.0, "y", 4), ("a", t + timedelta(minutes=1), 10.0, "x", 5), ("b", t, 10.0, "x", 6)]
    out = dedupe.collapse_physical(spark.createDataFrame(rows, "k string, t timestamp, v double, s string, id int"), ["k"], "t", "v", "s", "id")
    assert sorted(r.id for r in out.collect()) == [1, 4, 5, 6]  # 3 joins the unit of 5


def test_near_joins_against_brute_force(spark):
    rng = np.random.default_rng(3)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(32, 34, 80), rng.uniform(-119, -117, 80), strict=True))]

    def km(p, q):
        a = math.sin(math.radians(q[1] - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(q[1])) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2
        return 2 * 6371 * math.atan2(math.sqrt(a), math.sqrt(1 - a))

    df = spark.createDataFrame(pts, "id int, lat double, lon double")
    got = {(r.id, r.r_id) for r in spatial.within_km(df, df, 25.0).collect()}
    assert got == {(p[0], q[0]) for p in pts for q in pts if km(p, q) <= 25}
    near = {r.id: r.nearest_other for r in spatial.nearest(df.limit(20), df.where("id >= 40").withColumnRenamed("id", "other"), "id", "other").collect()}
    assert near == {p[0]: min(pts[40:], key=lambda q: (km(p, q), q[0]))[0] for p in pts[:20]}
    line = spark.createDataFrame([(i, 33 + i * 0.01, -118 + i * 0.01 / math.cos(math.radians(33))) for i in range(7)], "id int, lat double, lon double")
    # the shore runs to the northeast, and inland lies to its northwest
    assert all(abs(r.azimuth - 315) < 0.5 for r in spatial.shore_azimuth(line, "id").collect())
    alone = spatial.shore_azimuth(line.limit(2), "id").collect()
    assert [(r.neighbours, r.azimuth) for r in alone] == [(1, 270.0)] * 2


def globe_km(p, q):
    a = math.sin(math.radians(q[1] - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(q[1])) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2
    return 2 * 6371 * math.atan2(math.sqrt(a), math.sqrt(max(0.0, 1 - a)))


def test_near_joins_all_over_the_globe(spark):
    """High latitudes, the poles, the date line, and places far from all others."""
    rng = np.random.default_rng(4)
    spots = [(75.0, 10.0, 1.5), (89.9, 0.0, 0.2), (-89.95, 100.0, 0.1), (0.0, 179.99, 0.3), (52.0, -179.9, 0.4), (33.0, -118.0, 0.3)]
    pts = [(i, float(min(90, max(-90, la + rng.normal() * s))), float((lo + rng.normal() * s * 3 + 180) % 360 - 180)) for i, (la, lo, s) in enumerate(spots[k % 6] for k in range(90))]
    pts += [(90, 90.0, 5.0), (91, -90.0, 0.0), (92, 75.0, 10.0), (93, 75.0, 10.645), (94, 0.0, 180.0), (95, 0.0, -179.98)]
    df = spark.createDataFrame(pts, "id int, lat double, lon double")
    for km in (20.0, 400.0, 12000.0):
        got = sorted((r.id, r.r_id) for r in spatial.within_km(df, df, km).collect())
        assert got == sorted((p[0], q[0]) for p in pts for q in pts if globe_km(p, q) <= km)
    right = [p for p in pts if p[0] % 3 == 0 and p[0] < 60 and p[1] > 60]
    other = spark.createDataFrame(right, "other int, lat double, lon double")
    near = {r.id: (r.nearest_other, r.nearest_km) for r in spatial.nearest(df, other, "id", "other").collect()}
    limited = {r.id: r.nearest_other for r in spatial.nearest(df, other, "id", "other", 500.0).collect()}
    for p in pts:
        best = min(globe_km(p, q) for q in right)
        assert math.isclose(near[p[0]][1], best, rel_tol=1e-6, abs_tol=1e-6) and (limited[p[0]] is not None) == (best <= 500)
    assert {r.nearest_other for r in spatial.nearest(df, other.limit(0), "id", "other").collect()} == {None}


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(9)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(60, 2)) ** 3)] + [(99, 60.0, 100.0)]
    got = {}
    for r in spatial.neighbours(spark.createDataFrame(pts, "id int, lat double, lon double"), "id", 5).collect():
        got.setdefault(r.id, []).append((r.place, r.r_id))
    for p in pts:
        want = sorted((q for q in pts if q[0] != p[0]), key=lambda q: ((q[1] - p[1]) ** 2 + (q[2] - p[2]) ** 2, q[0]))[:5]
        assert [x for _, x in sorted(got[p[0]])] == [q[0] for q in want]


def test_a_long_chain_is_one_parent(spark):
    rows = [(i * 37 % 120, 0, 33.0 + i * 0.02, -118.0) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, g int, lat double, lon double")
    assert {r.parent for r in spatial.parent_groups(df, "id", "g", 3.0).collect()} == {0}


def test_parent_groups_are_connected(spark):
    rows = [(1, 0, 33.0, -118.0), (2, 0, 33.02, -118.0), (3, 0, 33.04, -118.0), (4, 0, 33.5, -118.0), (5, 1, 33.0, -118.0)]
    df = spark.createDataFrame(rows, "id int, g int, lat double, lon double")
    assert {r.id: r.parent for r in spatial.parent_groups(df, "id", "g", 3.0).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


def test_resolver_layers():
    assert entity.token_set_ratio(["santa", "monica", "pier"], ["pier", "monica", "santa"]) == 100.0
    assert entity.token_set_ratio(["a"], []) == 0.0 and 40 < entity.token_set_ratio(["north", "cove"], ["south", "cove"]) < 100
    assert entity.indel_ratio("abcd", "abxd") == 75.0


def test_resolver(spark):
    names = spark.createDataFrame([(1, "Cove  Beach"), (2, "Pier Beach at 5th"), (3, "old pier"), (4, "Lagoon Mouht Beach"), (5, "zzz")], "name_id int, name string")
    labels = spark.createDataFrame([("t1", "cove beach"), ("t2", "pier beach"), ("t3", "lagoon mouth beach")], "target string, label string")
    aliases = spark.createDataFrame([("Old Pier", "t2")], "alias string, target string")
    out = {r.name_id: (r.target, r.layer) for r in entity.resolve(names, labels, aliases).collect()}
    assert out == {1: ("t1", 0), 2: ("t2", 2), 3: ("t2", 1), 4: ("t3", 3), 5: (None, None)}


def test_ranking_with_ties_against_brute_force(spark):
    rng = np.random.default_rng(9)
    s, y = rng.integers(0, 8, 200) / 8, rng.random(200) < 0.3
    r = metrics.ranking(spark.createDataFrame([(float(a), bool(b)) for a, b in zip(s, y, strict=True)], "s double, y boolean"), "s", "y").first()
    pos, neg = s[y], s[~y]
    assert math.isclose(r.auroc, ((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2))
    ap = sum(y[s == t].sum() * y[s >= t].mean() for t in set(s)) / y.sum()
    assert math.isclose(r.average_precision, ap)


def test_offset_logit_recovers_coefficients(spark):
    rng = np.random.default_rng(4)
    x, off = rng.normal(size=(8000, 2)), rng.normal(size=8000)
    p = 1 / (1 + np.exp(-(off + 0.4 + x @ [0.8, -0.5])))
    rows = [(float(a), float(b), float(o), bool(u < q)) for (a, b), o, u, q in zip(x, off, rng.random(8000), p, strict=True)]
    m = models.OffsetLogit(["a", "b"], "o").fit(spark.createDataFrame(rows, "a double, b double, o double, y boolean"), "y")
    assert np.allclose([*m.weights, m.intercept], [0.8, -0.5, 0.4], atol=0.12) and m.sane()


def test_isotonic_top_step_is_capped(spark):
    rows = [(i / 100, i % 3 == 0) for i in range(90)] + [(0.99, True)] * 3
    df = spark.createDataFrame(rows, "s double, y boolean")
    free, capped = models.isotonic_knots(df, "s", "y"), models.isotonic_knots(df, "s", "y", 20)
    assert max(v for _, v in free) == 1.0 and max(v for _, v in capped) < 1.0
    assert all(a <= b + 1e-9 for (_, a), (_, b) in zip(free, free[1:]))


def test_baselines_and_ensemble(spark):
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b) if i % 9 else None, int(a + 0.2 * b > 0.8)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    out = models.baseline(["a", "b"], "y").fit(df).transform(df)
    assert out.where("prediction = y").count() > 270
    full = df.na.fill(0.0)
    scored = models.ensemble_probability(models.undersampled_ensemble(full, ["a", "b"], "y", draws=2, trees=3), full, ["a", "b"])
    r = metrics.ranking(scored, "probability", "y").first()
    assert r.auroc > 0.9


def test_gates(spark):
    now = datetime(2026, 1, 2)
    good = spark.createDataFrame([(i / 100, now) for i in range(60)], "p double, t timestamp")
    assert gates.forecast_validity(good, "p", "t", F.lit(now)).first().valid
    for bad in (good.limit(40), good.withColumn("p", F.lit(0.3)), good.withColumn("p", F.when(F.col("p") > 0.5, float("nan")).otherwise(F.col("p"))), good.withColumn("t", F.lit(now - timedelta(days=4)))):
        assert not gates.forecast_validity(bad, "p", "t", F.lit(now)).first().valid
    assert gates.agreement(4, 0) and not gates.agreement(10, 2) and gates.agreement(10, 3)
    assert gates.carry_health({"training": 1, "x": 2}, {"y": 3}) == {"training": 1, "y": 3}
    assert gates.retrain_due({"xor": 1, "rows": 10}, {"xor": 2, "rows": 900}) and not gates.retrain_due({"xor": 1, "rows": 10}, {"xor": 1, "rows": 900})
    assert models.promotion({"auroc": 0.8, "brier": 0.1}, {"auroc": 0.7, "brier": 0.2}) == [] and models.promotion({"auroc": 0.6, "brier": 0.3}, {"auroc": 0.7, "brier": 0.2}) == ["auroc", "brier"]


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,day,note\n1,2026-01-01,x\n2,2026-02-01,y\n3,bad,z\n", encoding="utf-8")
    assert [r.id for r in readers.read_csv_since(spark, str(tmp_path / "a.csv"), "day", "2026-01-15").collect()] == ["2"]
    (tmp_path / "s.csv").write_text("# comment\nname,to\na,b\n")
    assert readers.read_static(spark, str(tmp_path / "s.csv")).collect() == [("a", "b")]
    (tmp_path / "u.csv").write_text("time,temp\nUTC,degree_C\n2026,15.1\n")
    assert [r.temp for r in readers.read_units_csv(spark, str(tmp_path / "u.csv"), "time", "UTC").collect()] == ["15.1"]
    for text in ('[{"a":1},{"a":2}]', '{"results":[{"a":1},{"a":2}]}'):
        (tmp_path / "j.json").write_text(text)
        assert [r.a for r in readers.read_json_records(spark, str(tmp_path / "j.json"), "struct<a:int>").collect()] == [1, 2]
    (tmp_path / "j.json").write_text('{"a":7}')
    assert [r.a for r in readers.read_json_records(spark, str(tmp_path / "j.json"), "struct<a:int>").collect()] == [7]
    page = spark.createDataFrame([("c", "CLOSURES 1/2/2026 Cove closed\nWARNINGS No warnings in effect. ADVISORIES 1/3/2026 Pier\n1/4/2026 Lagoon")], "county string, text string")
    assert [(r.section, str(r.started)) for r in readers.notice_sections(page, "text", ["CLOSURES", "WARNINGS", "ADVISORIES"]).collect()] == [("CLOSURES", "2026-01-02"), ("ADVISORIES", "2026-01-03"), ("ADVISORIES", "2026-01-04")]
    bullets = spark.createDataFrame([("• Cove Beach 100 yards up coast\n• ab\n• Pier, south",)], "text string")
    assert [r.name for r in readers.bulletin_names(bullets, "text").collect()] == ["Cove Beach", "Pier"]


def test_paged_datastore(spark):
    def fetch(sql):
        assert sql.count("LIMIT 2") == 1
        offset = int(sql.rsplit(" ", 1)[1])
        code = sql.split("IN ('")[1].split("'")[0]
        return [(code, i) for i in range(offset, min(5, offset + 2))]

    spark.dataSource.register(datastore.datastore(fetch, "code string, n int", "paged_test"))
    rows = spark.read.format("paged_test").option("codes", "a,b,c").option("batch", 1).option("page", 2).option("resource", "r").load().collect()
    assert sorted((r.code, r.n) for r in rows) == [(c, i) for c in "abc" for i in range(5)]
    assert "O''Neill" in datastore.station_sql("r", ["O'Neill"], 1, 0)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "k int, v double")
    assert [r.j for r in sinks.finite_columns(df).select(sinks.strict_json("k", "v").alias("j")).collect()] == ['{"k":1,"v":null}', '{"k":2,"v":1.5}']
    path = str(tmp_path / "t")
    sinks.replace_atomically(df, path)
    sinks.replace_atomically(df.limit(1), path)
    assert spark.read.parquet(path).count() == 1
    assert not sinks.publish_unless(["worse"], df, str(tmp_path / "p")) and sinks.publish_unless([], df, str(tmp_path / "p"))
    assert sinks.markdown_table(df.where("k = 2")).splitlines()[-1] == "| 2 | 1.5 |"
    sinks.write_bundle({"a": df}, str(tmp_path / "b"), {"a": ["k"]})
    assert spark.read.parquet(str(tmp_path / "b/a")).count() == 2


def test_schema_guards(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    assert schemas.missing_columns(df, ["a", "c"], ["b", "d"]) == (["c"], ["d"])
    assert [r.column_name for r in schemas.suspicious_columns(schemas.null_profile(df, ["a", "b"])).collect()] == ["b"]
    bad = spark.createDataFrame([("x", "1.5"), ("2", "y")], "site string, value string")
    assert [(r.site, r.value) for r in schemas.conform(bad, schemas.SITE_DAY).collect()] == [(None, 1.5), (2, None)]
    assert one(spark.range(1).sparkSession, schemas.column_or(spark.range(1), "absent", "z")) == "z"


def test_plans_push_filters_and_prune(spark):
    plan = readers.read_parquet_where(spark, "/root/testdata/sf0.001/lineitem.parquet", ["l_orderkey"], "l_suppkey", 7)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_suppkey,7)" in plan and "l_comment" not in plan and "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in plan


def test_feature_tripwire():
    from littoral.operators import normalize

    assert normalize.feature_columns(["ratio_lag_1", "y", "rain"], ["y"], ["value"]) == ["ratio_lag_1", "rain"]
    with pytest.raises(ValueError):
        normalize.feature_columns(["value_lag_1", "rain"], [], ["value"])


def test_entry_point_without_the_optional_package(monkeypatch):
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "littoral.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    sys.modules.pop("__spark_entry__", None)
    entry = importlib.import_module("__spark_entry__")
    assert "a17_shrunk_rate" in entry.queries() and not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    sys.modules.pop("__spark_entry__", None)


def test_nearest_series_answers_every_place(spark):
    d = "/root/testdata/sf0.001"
    got = catalog.QUERIES["j07_nearest_series"](spark, d).groupBy("site").agg(F.count(F.lit(1)).alias("n"), F.sum("rain").alias("rain")).collect()
    stations, sums = registry.places(spark, d).collect(), {r.site: (r.n, r.rain) for r in registry.shipments(spark, d).groupBy("site").agg(F.count(F.lit(1)).alias("n"), F.sum("rain").alias("rain")).collect()}

    def km(a, b):
        h = math.sin(math.radians(b.lat - a.lat) / 2) ** 2 + math.cos(math.radians(a.lat)) * math.cos(math.radians(b.lat)) * math.sin(math.radians(b.lon - a.lon) / 2) ** 2
        return 2 * 6371.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    customers = registry.places(spark, d, "customer").collect()
    want = {a.site: sums[min(stations, key=lambda b: (round(km(a, b), 9), b.site)).site] for a in customers}
    assert len(want) > 100 and {r.site: (r.n, r.rain) for r in got} == want


def test_paired_bootstrap_against_repeated_rows(spark):
    rng = np.random.default_rng(5)
    data = [(f"c{rng.integers(6)}", float(rng.integers(8)) / 8, float(rng.integers(8)) / 8, int(rng.integers(2))) for _ in range(80)] + [("c0", None, 0.5, 1)]
    rows = spark.createDataFrame(data, "c string, a double, b double, y int")
    got = {(r.metric, r.side): r for r in metrics.bootstrap_pair(rows, "c", "a", "b", "y", 40).collect()}
    weights = {(r.c, r.replicate): r._w for r in metrics.draws(rows.select("c").distinct(), "c", 40, 11).collect()}

    def scores(some):
        p, y = np.array([x[0] for x in some]), np.array([x[1] for x in some])
        steps = [(y[p >= t].sum(), (p >= t).sum()) for t in sorted(set(p), reverse=True)]
        aucpr = sum((k - j) / y.sum() * k / n for (k, n), (j, _) in zip(steps, [(0, 0), *steps], strict=False))
        return aucpr, np.mean([(i > j) + (i == j) / 2 for i in p[y == 1] for j in p[y == 0]]), np.mean((p - y) ** 2)

    want = []
    for k in range(1, 41):
        some = [x for x in data if x[1] is not None for _ in range(weights[x[0], k])]
        if len({x[3] for x in some}) == 2:
            want.append([scores([(x[i], x[3]) for x in some]) for i in (1, 2)])
    want = np.array(want)
    for i, name in enumerate(("aucpr", "auroc", "brier")):
        for side, values in (("a", want[:, 0, i]), ("b", want[:, 1, i]), ("delta", want[:, 0, i] - want[:, 1, i])):
            r = got[name, side]
            assert r.replicates == len(want)
            assert np.allclose((r.low, r.low_90, r.mid, r.high_90, r.high), np.quantile(values, (0.025, 0.05, 0.5, 0.95, 0.975)))
    assert got["within_auroc", "delta"].low <= got["within_auroc", "delta"].high
    assert metrics.bootstrap_pair(rows.where("c = 'c1'"), "c", "a", "b", "y", 5).count() == 0


def test_ensemble_is_registered_with_all_draws_and_trees(spark, monkeypatch):
    seen, fit = {}, models.undersampled_ensemble

    def small(*a, draws, trees):
        seen.update(draws=draws, trees=trees)
        return fit(*a, draws=2, trees=1)

    monkeypatch.setattr(models, "undersampled_ensemble", small)
    assert catalog.QUERIES["m06_undersampled_ensemble"](spark, "/root/testdata/sf0.001").count() > 0
    assert seen == {"draws": 12, "trees": 250}


@pytest.mark.parametrize("name", ["j29_metadata_chain", "j05_inner"])
def test_joins_keep_every_row(spark, name):
    d = "/root/testdata/sf0.001"
    assert catalog.QUERIES[name](spark, d).count() == registry.table(spark, d, "lineitem").count()


def newton(x, y, offset=None, ridge=1e-4):
    """A plain logistic fit; the intercept is last and has no ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.array([ridge] * (x.shape[1] - 1) + [0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-(x @ w + (0 if offset is None else offset))))
        w = w - np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
    return w


def fit_rows(n=400, seed=2):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 9, n) / 4, rng.integers(0, 5, n) / 2
    y = (rng.random(n) < 1 / (1 + np.exp(-(a - b)))).astype(int)
    return [(i, f"g{i % 3}", float(a[i]), float(b[i]), int(y[i]), date(2019, 1, 1) + timedelta(days=int(rng.integers(0, 2400)))) for i in range(n)]


FIT_SCHEMA = "id int, g string, a double, b double, y int, day date"


def test_group_fits_against_plain_newton(spark):
    rows = fit_rows()
    df = spark.createDataFrame([*rows, (999, "one class", 0.5, 0.5, 1, date(2020, 1, 1))], FIT_SCHEMA).withColumn("o", F.col("a") / 3)
    got = fits.group_logits(fits.counted(df, ["g"], ["a", "b"], "y", "o"), "g", ["a", "b"], "o")
    assert set(got) == {"g0", "g1", "g2"}
    for g, w in got.items():
        own = np.array([r[2:5] for r in rows if r[1] == g])
        assert np.allclose(w, newton(own[:, :2], own[:, 2], own[:, 0] / 3), atol=1e-6)


def test_fits_of_features_with_any_name(spark):
    rows = fit_rows()
    w = newton(np.array([r[2:4] for r in rows]), np.array([r[4] for r in rows]))
    for a, b in (("p", "w"), ("z", "n"), ("pos", "loss"), ("month", "refit")):
        df = spark.createDataFrame(rows, FIT_SCHEMA).select(F.lit(0).alias("g"), F.col("a").alias(a), F.col("b").alias(b), "y")
        assert np.allclose(fits.group_logits(fits.counted(df, ["g"], [a, b], "y"), "g", [a, b])[0], w, atol=1e-6)


def test_scoped_fits_fall_back(spark):
    rows = [(*r[:2], "n0" if r[0] % 2 else "n1", *r[2:5]) for r in fit_rows()] + [(1000 + i, "few", "n0", float(i), 1.0, i % 2) for i in range(9)] + [(2000 + i, None, None, 1.0, 1.0, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "id int, g string, h string, a double, b double, y int")
    got = {r.id: r for r in fits.scoped_fits(df, ["g", "h"], ["a", "b"], "y", 20).collect()}
    assert len(got) == len(rows)
    for scope, of in (("g", lambda r: r[1]), ("h", lambda r: r[2]), ("all", lambda r: 0)):
        for r in rows[::29] + rows[-12:]:
            if got[r[0]].scope == scope:
                own = np.array([q[3:] for q in rows if of(q) == of(r)])
                w = newton(own[:, :2], own[:, 2])
                assert math.isclose(got[r[0]].p, 1 / (1 + math.exp(-(r[3] * w[0] + r[4] * w[1] + w[2]))), rel_tol=1e-5)
    assert got[1003].scope == "h" and got[2000].scope == "all" and got[5].scope == "g"


def test_folds_and_months_are_fitted_on_other_rows(spark):
    rows = fit_rows()
    df = spark.createDataFrame(rows, FIT_SCHEMA)
    x, y = np.array([r[2:4] for r in rows]), np.array([r[4] for r in rows])
    held = {r.id: r.p for r in fits.held_out_fits(df, "g", ["a", "b"], "y").collect()}
    for g in ("g0", "g1", "g2"):
        w = newton(x[[r[1] != g for r in rows]], y[[r[1] != g for r in rows]])
        for r in rows:
            if r[1] == g:
                assert math.isclose(held[r[0]], 1 / (1 + math.exp(-(r[2] * w[0] + r[3] * w[1] + w[2]))), rel_tol=1e-5)
    got = {r.id: (r.month, r.p) for r in fits.walk_forward_fits(df, "day", ["a", "b"], "y", years=4).collect()}
    seen = 0
    for r in rows[::17]:
        month = r[5].replace(day=1)
        start = month.replace(year=month.year - 4)
        train = np.array([start <= q[5].replace(day=1) < month for q in rows])
        assert got[r[0]][0] == month
        if len(set(y[train])) < 2:
            assert got[r[0]][1] is None
        elif train.sum() > 60:
            w = newton(x[train], y[train])
            seen += 1
            assert math.isclose(got[r[0]][1], 1 / (1 + math.exp(-(r[2] * w[0] + r[3] * w[1] + w[2]))), rel_tol=1e-4)
    assert seen > 5


def test_level_calibration_against_plain_loops(spark):
    rng = np.random.default_rng(7)
    n = 900
    county, site = rng.integers(0, 4, n), rng.integers(0, 30, n)
    station, p = rng.integers(0, 12, n), np.round(rng.random(n) * 0.9 + 0.05, 2)
    y = (rng.random(n) < np.clip(p + (county - 1.5) * 0.1, 0.02, 0.98)).astype(int)
    county[:10] = 9  # too few rows for a fit of its own
    rows = [(i, f"c{county[i]}" if i % 50 else None, f"s{site[i]}", f"t{station[i]}", float(p[i]), int(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, county string, site string, station string, p double, y int")
    got = {r.id: r for r in fits.LevelCalibrator().fit(df, "p", "y").transform(df).collect()}
    lg, ex = lambda v: np.log(v / (1 - v)), lambda v: 1 / (1 + np.exp(-v))
    names, z = np.array([r[1] or "" for r in rows]), lg(p)
    b, a = newton(z[:, None], y, ridge=1.0)
    whole, zz, counts = (a, b), a + b * z, np.zeros((3, n))
    for c in set(names) - {""}:
        own = names == c
        if own.sum() >= 24:
            slope, start = newton(z[own][:, None], y[own], ridge=1.0)
            w = own.sum() / (own.sum() + 64)
            zz[own] = whole[0] * (1 - w) + start * w + (whole[1] * (1 - w) + slope * w) * z[own]
            counts[0, own] = own.sum()
    base, out = zz.copy(), zz.copy()
    for level, (values, least) in enumerate(((site, 8), (station, 16)), 1):
        for v in set(values):
            own = values == v
            if own.sum() >= least:
                out[own] += (lg((y[own].sum() + 0.5) / (own.sum() + 1)) - lg(ex(base[own]).mean())) * own.sum() / (own.sum() + 24)
                counts[level, own] = own.sum()
    half = 1.64 * np.sqrt(max(0.01, np.var(y - ex(out))) + (1 / (counts + 1)).sum(0))
    for i in range(n):
        assert np.allclose([got[i].calibrated, got[i].low, got[i].high], [ex(out[i]), ex(out[i] - half[i]), ex(out[i] + half[i])], atol=1e-5)


def test_two_tier_offsets_and_draws(spark):
    rows = fit_rows(600, 4)
    df = spark.createDataFrame(rows, FIT_SCHEMA)
    got = {r.id: r for r in fits.two_tier(df, "g", ["a", "b"], "y", {"a": F.lit(0.0)}, draws=1, ratio=1e9, tie="id").collect()}
    y = np.array([r[4] for r in rows])
    g = {k: np.array([r[1] == k for r in rows]) for k in ("g0", "g1", "g2")}
    rate = {k: (y[m].sum() + 4 * y.mean()) / (m.sum() + 4) for k, m in g.items()}
    margin = np.array([math.log(rate[r[1]] / (1 - rate[r[1]])) for r in rows])
    x = np.array([r[2:4] for r in rows])
    w = newton(np.concatenate([x, x * [0, 1]]), np.concatenate([y, y]), np.concatenate([margin, margin]))
    for i, r in enumerate(rows):  # one draw of all rows: both copies fitted around the level
        assert math.isclose(got[i].margin, margin[i], rel_tol=1e-9)
        assert math.isclose(got[i].p, 1 / (1 + math.exp(-(margin[i] + x[i] @ w[:2] + w[2]))), rel_tol=1e-5)
    few = fits.two_tier(df, "g", ["a", "b"], "y", {"a": F.lit(0.0)}, tie="id")
    assert few.where("p <= 0 or p >= 1 or p is null").count() == 0


def test_station_residuals_are_boosted_within_bounds(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        x, s = float(rng.integers(0, 10)), "few" if i < 20 else "flat" if i < 80 else f"s{i % 2}"
        rows.append((i, s, x if i % 40 else None, 0.3, 0 if s == "flat" else int(rng.random() < (0.8 if x > 5 else 0.1))))
    df = spark.createDataFrame(rows, "id int, s string, x double, p double, y int").withColumn("p", F.when(F.col("s") == "flat", 0.0).otherwise(F.col("p")))
    got = {r.id: r for r in fits.station_residuals(df, "s", "p", "y", ["x"]).collect()}
    assert all(got[i].corrected == got[i].p and got[i].residual == 0 for i in range(80))
    assert all(abs(r.residual) <= 0.3 and (r.id < 80 or 0.001 <= r.corrected <= 0.999) for r in got.values())
    before = np.mean([(r[4] - 0.3) ** 2 for r in rows[80:]])
    assert np.mean([(r[4] - got[r[0]].corrected) ** 2 for r in rows[80:]]) < before * 0.85
    # cells with counts give the same trees as the rows themselves
    bins = rng.integers(0, 6, (200, 2))
    target = rng.normal(size=200)
    cells, place = np.unique(bins, axis=0, return_inverse=True)
    n = np.bincount(place.ravel())
    mean = np.bincount(place.ravel(), target) / n
    assert np.allclose(fits.boosted(bins, target, np.ones(200)), fits.boosted(cells, mean, n.astype(float))[place.ravel()])


def test_snapshot_is_published_whole(spark, tmp_path):
    root = f"file://{tmp_path}/snap"
    df = spark.createDataFrame([(2, float("nan")), (1, 1.5)], "k int, v double")
    for _ in range(2):
        sinks.write_snapshot({"a": (df, "k"), "b": (df.where("k = 1"), "k")}, root, {"n": 2, "bad": float("inf")})
    assert [r.v for r in spark.read.parquet(f"{root}/a").orderBy("k").collect()] == [1.5, None]
    assert {r.key: r.payload for r in spark.read.parquet(f"{root}/system_health").collect()} == {"n": "2", "bad": "null"}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["snap"]


def test_datastore_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Away:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="share"):
        registry.shared_path(Away(), "x")


def test_collapse_physical_against_the_whole_greedy_rule(spark):
    rng = np.random.default_rng(12)
    start = datetime(2026, 1, 1)
    rows = [(f"k{rng.integers(2)}", start + timedelta(minutes=int(rng.integers(0, 900))), float(rng.integers(3)) if rng.random() < 0.95 else None, f"s{rng.integers(3)}", i) for i in range(300)]
    want = []
    for k in ("k0", "k1"):
        units = []
        for r in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[4])):
            for u in units:
                if r[2] is not None and u[1] == r[2] and r[3] not in u[2] and r[1] - u[0] <= timedelta(minutes=30):
                    u[2].add(r[3])
                    break
            else:
                units.append((r[1], r[2], {r[3]}))
                want.append(r[4])
    out = dedupe.collapse_physical(spark.createDataFrame(rows, "k string, t timestamp, v double, s string, id int"), ["k"], "t", "v", "s", "id")
    assert sorted(r.id for r in out.collect()) == sorted(want)


def test_a_key_of_two_batches_is_in_the_log_once(spark, tmp_path):
    source, path = tmp_path / "in", f"file://{tmp_path}/log"
    schema = "k int, v string, at int"
    for rows in ([(1, "a", 1), (1, "b", 2), (2, "x", 1)], [(1, "b", 2), (2, "y", 3), (3, "z", 1)], []):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{source}")
        stream = streams.parquet_stream(spark, f"file://{source}", schema)
        streams.append_once(stream, path, ["k"], f"file://{tmp_path}/offsets", "at").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.k, r.v) for r in streams.read_once(spark, path, ["k"]).collect()) == [(1, "b"), (2, "y"), (3, "z")]
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, "b"), (2, "x"), (2, "y"), (3, "z")]


def test_late_rows_are_dropped_behind_the_watermark(spark, tmp_path):
    source, t = f"file://{tmp_path}/in", datetime(2026, 1, 10)
    schema = "k int, t timestamp, v double"
    batches = [[(1, t, 1.0)], [(1, t + timedelta(days=9), 2.0)], [(1, t, 4.0), (1, t + timedelta(days=9), 8.0)]]  # the third has a row nine days late
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        daily = streams.daily(streams.parquet_stream(spark, source, schema), "k", "t", "v", "2 days", "0 hours")
        streams.run_to_table(daily, f"file://{tmp_path}/out{i}", "update", f"file://{tmp_path}/offsets")
    last = {r.until.day: r.total for r in spark.read.parquet(f"file://{tmp_path}/out2").collect()}
    assert last == {20: 10.0}


def test_can_be_like_never_rules_out_a_likeness(spark):
    rng = np.random.default_rng(3)
    words = ["beach", "cove", "point", "pointe", "north", "nort", "pier", "peer", "san", "santa"]
    pairs = [(list(rng.choice(words, rng.integers(1, 5))), list(rng.choice(words, rng.integers(1, 5)))) for _ in range(400)]
    pairs = [([str(x) for x in a], [str(x) for x in b]) for a, b in pairs]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>").withColumn("can", entity._can_be_like(F.col("a"), F.col("b"), 70.0))
    rows = df.collect()
    assert all(r.can for r in rows if entity.token_set_ratio(r.a, r.b) >= 70) and not all(r.can for r in rows)


def test_collapse_physical_carries_clusters_across_batches(spark):
    """Clusters pass through Python in order, not one call each; a dense one takes a step a row."""
    start = datetime(2026, 1, 1)
    rows = [("k", start + timedelta(seconds=i // 3), float(c), "a" if i % 4 else "b", c * 100_000 + i) for c, n in ((0, 2_000), (1, 50)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double, s string, id int")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = dedupe.collapse_physical(df, ["k"], "t", "v", "s", "id", 90)
        assert "FlatMapGroups" not in out._jdf.queryExecution().toString()
        got = sorted(r.id for r in out.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = []
    for c in (0.0, 1.0):
        count = {"a": 0, "b": 0}  # no unit goes out of reach: a row is kept while its source leads
        for r in (r for r in rows if r[2] == c):
            count[r[3]] += 1
            if count[r[3]] > max(n for s, n in count.items() if s != r[3]):
                want.append(r[4])
    assert got == want


def test_ensemble_of_distinct_rows_is_sparks_learner(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(float(a), float(b), int(rng.random() < (0.1 + 0.25 * (a > 20) + 0.3 * (b > 3)))) for a, b in zip(rng.integers(0, 60, 900), rng.integers(0, 7, 900), strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    jobs, fits = [], models.GBTClassifier
    monkeypatch.setattr(models, "GBTClassifier", lambda **k: jobs.append(1) or fits(**k))
    fast = models.ensemble_probability(models.undersampled_ensemble(df, ["a", "b"], "y", draws=2, trees=12, ratio=1.0), df, ["a", "b"])
    got = {(r.a, r.b): r.probability for r in fast.collect()}
    assert not jobs  # no job for each level of each tree
    monkeypatch.setattr(models, "DISTINCT_ROWS", 10)
    slow = models.ensemble_probability(models.undersampled_ensemble(df, ["a", "b"], "y", draws=2, trees=12, ratio=1.0), df, ["a", "b"])
    assert len(jobs) == 2 and all(abs(got[r.a, r.b] - r.probability) < 1e-6 for r in slow.collect())


def _pairs_read(df):
    """The most rows that a join of the executed plan has put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    most, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if "Join" in node.nodeName():
            most = max(most, node.metrics().apply("numOutputRows").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return most


def test_radius_counts_equal_places_once(spark):
    spots = [(33.0, -118.0), (33.05, -118.0), (33.2, -118.0), (40.0, -118.0)]
    left = spark.createDataFrame([(i, *spots[i % 4]) for i in range(400)] + [(400, None, None)], "id int, lat double, lon double")
    right = spark.createDataFrame([(i, *spots[i % 3]) for i in range(300)], "id int, lat double, lon double")
    df = spatial.radius_features(left, right, "id", 30.0, 10.0)
    assert _pairs_read(df) <= 1000
    want = {0: (300, 200), 1: (300, 200), 2: (300, 100), 3: (0, 0)}
    for r in df.collect():
        assert (r.assets, r.assets_near) == (want[r.id % 4] if r.id < 400 else (0, 0)) and (r.nearest_km is None) == (r.assets == 0)


def test_neighbours_of_many_points_at_few_spots(spark, monkeypatch):
    rng = np.random.default_rng(2)
    spots = [(float(a), float(b)) for a, b in rng.normal(size=(12, 2)).round(1)] + [(50.0, 60.0)]
    pts = [(i, *spots[min(12, int(x))]) for i, x in enumerate(rng.exponential(3, 400))] + [(900, -40.0, 10.0)]
    rows, kept = [], spatial.cut
    monkeypatch.setattr(spatial, "cut", lambda df: (out := kept(df), rows.append(out.count()))[0])
    got = {}
    for r in spatial.neighbours(spark.createDataFrame(pts, "id int, lat double, lon double"), "id", 5).collect():
        got.setdefault(r.id, []).append((r.place, r.r_id, r.r_lat, r.r_lon, r.d2))
    assert max(rows) <= 14 * 6  # rows of spots, not of points
    for p in pts:
        want = sorted((((q[1] - p[1]) ** 2 + (q[2] - p[2]) ** 2, q[0], q[1], q[2]) for q in pts if q[0] != p[0]))[:5]
        assert [(i + 1, q[1], q[2], q[3]) for i, q in enumerate(want)] == [x[:4] for x in sorted(got[p[0]])]
        assert np.allclose([q[0] for q in want], [x[4] for x in sorted(got[p[0]])])


def test_history_counts_days_of_zero(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1 + i, 9), 1, "view", v) for i, v in enumerate([0.0, 5.0, 0.0, 2.0, 7.0])]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.day.day: (r.rows, r.checksum) for r in catalog.QUERIES["w14_history_tensor"](spark, str(tmp_path)).collect()}
    assert got == {4: (3, 10.0), 5: (4, 17.0)}


def test_parents_link_spots_not_points(spark, monkeypatch):
    spots = [(33.0, -118.0), (33.02, -118.0), (33.04, -118.0), (33.5, -118.0)]
    rows = [(1000 - i, i // 4 % 2, *spots[i % 4]) for i in range(400)] + [(2000, 0, None, -118.0), (2001, 0, None, -118.0), (2002, None, *spots[0]), (2003, None, *spots[0]), (2004, 0, float("nan"), -118.0)]
    most, kept = [], spatial.cut
    monkeypatch.setattr(spatial, "cut", lambda df: (out := kept(df), most.append(out.count()))[0])
    got = {r.id: r.parent for r in spatial.parent_groups(spark.createDataFrame(rows, "id int, g int, lat double, lon double"), "id", "g", 3.0).collect()}
    assert max(most) <= 8  # nodes and links of four spots in two groups
    together = {}
    for i, g, lat, _ in rows[:400]:
        together.setdefault((g, lat == 33.5), []).append(i)
    assert got == {i: min(ids) for ids in together.values() for i in ids} | {i: i for i in range(2000, 2005)}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_window_to_cutoff_adds_in_the_order_of_time(spark, parts):
    """1e16 - 1e16 + 1 is 1 and 1e16 + 1 - 1e16 is 0: the order of time decides, not the order or the split of the rows."""
    at = lambda day, hour: datetime(2024, 1, day, hour)
    data = [("a", at(2, 12), 1.0), ("a", at(2, 8), 1e16), ("a", at(2, 10), -1e16), ("a", at(2, 11), None), ("a", at(2, 13), 5.0), ("a", None, 9.0), ("b", at(2, 7), 2.0), ("b", at(2, 6), 4.0), ("c", at(2, 9), None)]
    cuts = spark.createDataFrame([(date(2024, 1, d), at(d, 13)) for d in (2, 3, 5)], "day date, cut timestamp_ntz")
    readings = spark.createDataFrame(data, "s string, t timestamp_ntz, v double").repartition(parts, "v")
    got = {(r.s, r.day.day): (r.latest, r.readings, r.sum_6h, r.mean_6h, r.max_6h, r.sum_72h, r.mean_72h, r.max_72h) for r in temporal.window_to_cutoff(readings, "s", "t", "v", cuts, "cut", [6, 72]).collect()}
    assert got == {
        ("a", 2): (1.0, 3, 1.0, 1 / 3, 1e16, 1.0, 1 / 3, 1e16), ("a", 3): (5.0, 4, 0.0, None, None, 6.0, 1.5, 1e16), ("a", 5): (5.0, 1, 0.0, None, None, 5.0, 5.0, 5.0),
        ("b", 2): (2.0, 2, 2.0, 2.0, 2.0, 6.0, 3.0, 4.0), ("b", 3): (2.0, 2, 0.0, None, None, 6.0, 3.0, 4.0), ("c", 2): (None, 0, 0.0, None, None, 0.0, None, None), ("c", 3): (None, 0, 0.0, None, None, 0.0, None, None),
    }


def test_round_scaled_equals_sql(spark):
    """Ties at the seventh decimal as the SQL rounds them, the scaled double half away from zero; nulls and values without a finite scaled double stay."""
    import duckdb

    values = [k + (2 * j + 1) / 2e6 for k in (0, 1, 7, 55, 1000) for j in range(0, 900, 7)] + [x / 32 + 0.01 for x in range(50)] + [0.0, 1e300, 1e305, 0.49999999999999994e-6]
    values += [-x for x in values] + [math.inf, -math.inf, None]
    con = duckdb.connect()
    want = [con.execute("SELECT round(?::DOUBLE, 6)", [x]).fetchone()[0] for x in values]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x double").select("i", core.round_scaled(F.col("x"), 6).alias("y")).orderBy("i")
    assert [r.y for r in rows.collect()] == want
    assert math.isnan(one(spark, core.round_scaled(F.lit(math.nan), 6)))
