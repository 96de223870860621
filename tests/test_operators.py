"""Contracts of single operators, on inputs that can be followed by hand."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from agroloom.functions import arrays, bands, dates, geo, text
from agroloom.operators import classes, evaluate, inputs, records, scoring, spatial, splits, survey, tables
from agroloom.sources import readers, writers


def one(spark, **columns):
    """The values of expressions over no table."""
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def wide_row(**more):
    row = {"sample_id": "s", "lat": 45.1, "lon": 5.1, "start_date": "2021-01-01", "end_date": "2022-01-01", "available_timesteps": 12, "valid_position": 6}
    for t in range(18):
        for b in bands.OPTICAL:
            row[bands.BAND_COLUMNS[b].format(t)] = 1000 + 10 * t
        for b in bands.SAR:
            row[bands.BAND_COLUMNS[b].format(t)] = 0.01 + 0.001 * t
        for b in bands.METEO:
            row[bands.BAND_COLUMNS[b].format(t)] = 10 + t
    return row | {"DEM-alt-20m": 100, "DEM-slo-20m": 5, "finetune_class": "cropland"} | more


def wide(spark, *rows):
    names = list(rows[0])
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], names)
    series = [b for b in bands.BAND_COLUMNS if b not in bands.DEM]
    df = inputs.pack_wide(df, series, 12)
    return df.withColumnsRenamed({"DEM-alt-20m": "elevation", "DEM-slo-20m": "slope"})


def test_inputs_are_in_units(spark):
    row = inputs.model_inputs(wide(spark, wide_row()), 12, "month").first()
    got = row["inputs"]
    assert row["label_position"] == 6
    assert len(got["s2"]["B2"]) == 12 and got["s2"]["B8A"][3] == 1030
    assert got["s1"]["VH"][0] == pytest.approx(-123)
    assert got["meteo"]["precipitation"][0] == pytest.approx(1e-4)
    assert got["meteo"]["temperature"][0] == pytest.approx(0.1)
    assert (got["dem"]["elevation"], got["dem"]["slope"]) == (100, 5)
    assert [tuple(x) for x in got["timestamps"]][:2] == [(1, 1, 2021), (1, 2, 2021)]


def test_a_window_has_the_length_and_holds_the_valid_position(spark):
    for available in (12, 16):
        for vp in range(available):
            row = one(
                spark,
                a=arrays.window_start(F.lit(vp), F.lit(available), 12),
                b=arrays.augmented_start(F.lit(vp), F.lit(available), 12, 1, F.lit(f"s{vp}")),
            )
            for start in row:
                assert 0 <= start <= available - 12 and start <= vp < start + 12


def test_a_window_of_missing_bands_is_all_no_data(spark):
    df = wide(spark, wide_row()).drop("B3")
    got = inputs.model_inputs(df, 12, "month").first()["inputs"]["s2"]["B3"]
    assert got == [bands.NODATA] * 12


def test_labels(spark):
    row = one(
        spark,
        binary=arrays.label_vector(text.binary_label(F.lit("not_cropland")), 1),
        every=arrays.label_vector(F.lit(1), 4),
        window=arrays.label_positions(F.array(F.lit(3)), 7, F.lit(1), 1),
        edge=arrays.label_positions(F.array(F.lit(0), F.lit(2)), 4, F.lit(2), 1),
        index=arrays.label_positions(F.array(F.lit(4)), 5, arrays.class_index(F.lit("shrubland"), ["cropland", "shrubland", "trees", "other"])),
    )
    no = bands.NODATA
    assert row["binary"] == [0] and row["every"] == [1] * 4
    assert row["window"] == [no, no, 1, 1, 1, no, no]
    assert row["edge"] == [2, 2, 2, 2]
    assert row["index"] == [no] * 4 + [1]


def test_labels_at_a_list_of_positions(spark):
    no, key = bands.NODATA, F.lit("k")
    gap = F.array(F.lit(2), F.lit(5))
    nothing = F.lit(None).cast("array<int>")
    row = one(
        spark,
        exact=arrays.label_positions(gap, 7, F.lit(1)),
        wide=arrays.label_positions(gap, 7, F.lit(1), window=1),
        every=arrays.label_positions(nothing, 3, F.lit(1), window=1),
        scalar=arrays.label_at(F.lit(3), 7, F.lit(1), window=1),
        none=arrays.label_at(F.lit(None).cast("int"), 3, F.lit(1), jitter=1, window=1, key=key),
    )
    assert row["exact"] == [no, no, 1, no, no, 1, no]
    assert row["wide"] == [no, 1, 1, 1, 1, 1, 1]
    assert row["every"] == [1] * 3 and row["none"] == [1] * 3
    assert row["scalar"] == [no, no, 1, 1, 1, no, no]
    # by a hash of the key: all positions move together, or the window is taken
    keys = spark.range(60).select(F.col("id").cast("string").alias("k"))
    moved = keys.select(arrays.label_positions(gap, 7, F.lit(1), jitter=1, key=F.col("k")).alias("l")).distinct().collect()
    assert sorted([i for i, v in enumerate(r["l"]) if v == 1] for r in moved) == [[1, 4], [2, 5], [3, 6]]
    either = keys.select(arrays.label_positions(gap, 7, F.lit(1), window=1, jitter=1, key=F.col("k")).alias("l")).distinct().collect()
    assert sorted([i for i, v in enumerate(r["l"]) if v == 1] for r in either) == [[1, 2, 3, 4, 5, 6], [1, 4], [2, 5], [3, 6]]


def test_mask_positions_lean_to_the_start(spark):
    got = spark.range(4000).select(arrays.mask_position(3, 11, 42, F.col("id")).alias("k"))
    counts = {r["k"]: r["count"] for r in got.groupBy("k").count().collect()}
    assert set(counts) <= set(range(3, 12)) and counts[4] > counts[9]
    mean = got.agg(F.avg("k")).first()[0]
    assert abs(mean - (3 + 8 * 1.5 / 4 - 0.5)) < 0.15  # the distribution's mean, less what the floor takes


def test_projections_there_and_back(spark):
    places = [(28.8, 47.0), (27.1, -3.5), (24.01, 83.0), (29.99, 0.01)]
    df = spark.createDataFrame(places, "lon double, lat double")
    for epsg in (32635, 32735, 3857, 4326):
        there = geo.reprojected(F.col("lon"), F.col("lat"), F.lit(4326), F.lit(epsg))
        rows = df.select("lon", "lat", there.alias("p"))
        back = rows.select("lon", "lat", geo.reprojected(F.col("p.x"), F.col("p.y"), F.lit(epsg), F.lit(4326)).alias("q"))
        for r in back.collect():
            assert abs(r["q"]["x"] - r["lon"]) < 1e-8 and abs(r["q"]["y"] - r["lat"]) < 1e-8
    assert df.select(geo.reprojected(F.col("lon"), F.col("lat"), F.lit(9999), F.lit(4326)).alias("q")).where("q is not null").count() == 0


def test_tables_are_aligned_to_one_code(spark):
    left = spark.createDataFrame([(4326,), (4326,)], "epsg int")
    right = spark.createDataFrame([(1, 500000.0, 0.0, 32635), (2, 27.0, 1.0, 4326), (3, None, None, 32635)], "id int, x double, y double, epsg int")
    got = {r["id"]: (r["x"], r["y"], r["epsg"]) for r in spatial.align_crs(left, right).collect()}
    assert got[1] == pytest.approx((27.0, 0.0, 4326)) and got[2] == (27.0, 1.0, 4326) and got[3][:2] == (None, None)
    with pytest.raises(ValueError):
        spatial.align_crs(right, left)


def test_well_known_binary(spark, tmp_path):
    ring = [(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (0.0, 0.0)]
    df = spark.createDataFrame([(1, [[{"x": x, "y": y} for x, y in ring]]), (2, None)], "id int, rings array<array<struct<x:double,y:double>>>")
    df.select("id", writers.wkb("rings").alias("geometry")).write.parquet(f"{tmp_path}/a.parquet")
    with pytest.raises(ValueError):
        readers.scan_features(spark, f"{tmp_path}/a.parquet")
    got = {r["id"]: r for r in readers.scan_features(spark, f"{tmp_path}/a.parquet", 4326).collect()}
    assert [(p["x"], p["y"]) for p in got[1]["rings"][0]] == ring and got[2]["rings"] is None
    assert len(got[1]["polygons"]) == 1 and got[1]["epsg"] == 4326
    df.select("id").withColumn("epsg", F.lit(1)).write.parquet(f"{tmp_path}/b.parquet")
    with pytest.raises(ValueError):
        readers.scan_features(spark, f"{tmp_path}/b.parquet")


def test_reports_by_group_are_those_of_each_group(spark):
    rows = [(g, "ab"[(i * g) % 2], "ab"[(i // 2) % 2]) for g in (1, 2, 3) for i in range(20)]
    df = spark.createDataFrame(rows, "g int, t string, p string")
    by = evaluate.classification_report(evaluate.confusion_matrix(df, "t", "p", by=["g"]), ["g"])
    for g in (1, 2, 3):
        own = evaluate.classification_report(evaluate.confusion_matrix(df.where(F.col("g") == g), "t", "p"))
        assert sorted(map(tuple, own.collect())) == sorted(map(tuple, by.where(F.col("g") == g).drop("g").collect()))


def test_an_unknown_class_or_band_is_an_error(spark):
    with pytest.raises(PySparkException):
        one(spark, x=arrays.class_index(F.lit("sea"), ["land"]))
    with pytest.raises(ValueError):
        bands.in_units("B99", F.lit(1))


def test_dates(spark):
    def day(s):
        return F.to_date(F.lit(s))

    row = one(
        spark,
        a=dates.align(day("2021-01-03"), "dekad").cast("string"), b=dates.align(day("2021-01-24"), "dekad").cast("string"),
        c=dates.align(day("2021-01-15"), "month").cast("string"), d=dates.align(day("2021-02-10"), "month").cast("string"),
        months=dates.timestamps(day("2021-01-03"), day("2021-12-24"), "month"),
        dekads=dates.timestamps(day("2021-01-03"), day("2021-01-24"), "dekad"),
    )
    assert list(row)[:4] == ["2021-01-01", "2021-01-21", "2021-01-01", "2021-02-01"]
    assert [tuple(x) for x in row["months"]] == [(1, m, 2021) for m in range(1, 13)]
    assert [tuple(x) for x in row["dekads"]] == [(d, 1, 2021) for d in (1, 11, 21)]


def test_class_weights(spark):
    def weights(rows, **options):
        df = spark.createDataFrame([(r,) for r in rows], "c string")
        return {r["c"]: r["weight"] for r in splits.class_weights(df, "c", **options).collect()}

    even = weights("xxyy")
    assert even["x"] == even["y"]
    skewed = weights("aaaaab")
    assert skewed["b"] / skewed["a"] == pytest.approx(5)
    logs = weights("a" * 99 + "b", method="log", clip_range=(0.2, 1), normalize=False)
    assert logs == {"a": pytest.approx(0.2), "b": pytest.approx(1)}


def test_resampling_keeps_the_total_and_evens_the_classes(spark):
    df = spark.range(60).select(F.col("id").alias("k"), F.when(F.col("id") < 50, "a").otherwise("b").alias("c"))
    drawn = splits.balanced_resample(df, "c", "k", splits.class_weights(df, "c"))
    got = {r["c"]: r["n"] for r in drawn.groupBy("c").agg(F.sum("copies").alias("n")).collect()}
    assert abs(got["a"] - 30) <= 1 and abs(got["b"] - 30) <= 1


def test_folds_and_splits_are_complete(spark):
    df = spark.range(103).select(F.col("id").alias("k"), (F.col("id") % 2).cast("string").alias("c"))
    folds = splits.stratified_folds(df, "c", "k").groupBy("c", "fold").count().collect()
    for c in "01":
        sizes = [r["count"] for r in folds if r["c"] == c]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert sum(r["count"] for r in folds) == 103


def test_report(spark):
    rows = [("crop", "crop")] * 3 + [("crop", "not_crop")] + [("not_crop", "not_crop")] * 4 + [("not_crop", "crop")] * 2
    df = spark.createDataFrame(rows, "t string, p string")
    matrix = evaluate.confusion_matrix(df, "t", "p")
    report = {r["class"]: r for r in evaluate.classification_report(matrix).collect()}
    assert set(report) == {"crop", "not_crop", "accuracy", "macro avg", "weighted avg"}
    assert report["crop"]["precision"] == pytest.approx(3 / 5) and report["crop"]["recall"] == pytest.approx(3 / 4)
    assert report["accuracy"]["support"] == pytest.approx(0.7)
    assert evaluate.summary_metrics(matrix, "crop").first()["OA"] == pytest.approx(0.7)
    empty = evaluate.normalised(evaluate.confusion_matrix(df, "t", "p", ["crop", "not_crop", "sea"]))
    assert {r["share"] for r in empty.where("true_class = 'sea'").collect()} == {0}


def test_mgrs(spark):
    names = ["31UFS", "05QLF", "36LYR", "1CAA", "1C", "61ABC", "ABC", None]
    df = spark.createDataFrame([(n,) for n in names], "tile string")
    got = [r[0] for r in df.select(text.mgrs_to_epsg(F.col("tile"))).collect()]
    assert got == [32631, 32605, 32736, 32701, None, None, None, None]


def test_utm_of_a_published_point(spark):
    lon, lat = -(79 + 23 / 60 + 13.7 / 3600), 43 + 38 / 60 + 33.24 / 3600
    p = one(spark, p=geo.utm(F.lit(lon), F.lit(lat), F.lit(32617)))["p"]
    assert p["x"] == pytest.approx(630084, abs=1) and p["y"] == pytest.approx(4833438, abs=1)


def test_projection_and_text_round_trips(spark):
    x, y = geo.mercator_x(F.lit(28.5)), geo.mercator_y(F.lit(47.0))
    ring = geo.rectangle(F.lit(1.0), F.lit(2.5), F.lit(4.125), F.lit(6.0))
    row = one(spark, lon=geo.mercator_lon(x), lat=geo.mercator_lat(y), wkt=geo.to_wkt(ring), back=geo.bounds(geo.from_wkt(geo.to_wkt(ring))))
    assert row["lon"] == pytest.approx(28.5, abs=1e-9) and row["lat"] == pytest.approx(47.0, abs=1e-9)
    assert row["wkt"] == "POLYGON ((1 2.5, 4.125 2.5, 4.125 6, 1 6, 1 2.5))"
    assert tuple(row["back"]) == (1.0, 2.5, 4.125, 6.0)


def test_a_hole_moves_the_centroid_and_is_outside(spark):
    outer = geo.rectangle(F.lit(0.0), F.lit(0.0), F.lit(4.0), F.lit(4.0))
    hole = geo.rectangle(F.lit(2.0), F.lit(0.0), F.lit(4.0), F.lit(4.0))
    rings = F.concat(outer, hole)
    row = one(spark, c=geo.centroid(rings), a=geo.contains(rings, F.lit(1.0), F.lit(1.0)), b=geo.contains(rings, F.lit(3.0), F.lit(1.0)))
    assert tuple(row["c"]) == (1.0, 2.0) and row["a"] and not row["b"]


def test_snapping_is_half_even(spark):
    row = one(spark, **{f"x{c}": geo.snapped(F.lit(float(c)), 20) for c in (30, 50, 70)})
    assert list(row) == [40, 40, 80]


def test_tiles_cover_the_box(spark):
    box = spark.createDataFrame([(510_000.0, 30_000.0, 565_000.0, 71_000.0)], "west double, south double, east double, north double")
    tiles = spatial.tile_cover(box, 20_000.0, in_metres=True)
    area = tiles.select(F.sum((F.col("east") - F.col("west")) * (F.col("north") - F.col("south")))).first()[0]
    assert tiles.count() == 12 and area == 55_000 * 41_000
    names = [r[0] for r in spatial.block_names(tiles, "T").orderBy("x", "y").select("tile_name").collect()]
    assert names == [f"T_{i:03d}" for i in range(12)]


def test_triage_and_tokens(spark):
    lists = spark.createDataFrame([(1, "maize", ["maize"]), (2, "rice", ["rice"])], "ordinal int, cls string, spellings array<string>")
    df = spark.createDataFrame([("yes_rice maize",), ("rice",), ("tea",), (None,)], "label string")
    kinds = [r[0] for r in df.select(text.triage(F.col("label"))).collect()]
    assert kinds == ["mixed", "clean", "clean", "clean"]
    crops = {r["label"]: r["crops"] for r in classes.normalise_tokens(df, "label", lists).collect()}
    assert crops == {"yes_rice maize": ["maize", "rice"], "rice": ["rice"], "tea": ["other_crops"]}
    compat = {r["label"]: r["crops"] for r in classes.normalise_tokens(df, "label", lists, compat=True).collect()}
    assert compat["rice"] == ["other_crops", "rice"]


def test_land_use(spark):
    rows = [(None, None, None), ("3", "2.0", None), ("3.0", "orchard", "plum")]
    df = spark.createDataFrame(rows, "lu_code string, landuse string, croptype string")
    got = [tuple(r) for r in survey.recode_land_use(df).collect()]
    assert got == [("9", "undecided", "undecided"), ("3", "natural_grassland", "natural_grassland"), ("3", "orchard", "plum")]


def test_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    with pytest.raises(ValueError, match="duplicates"):
        tables.check_key(df, "k")
    with pytest.raises(ValueError, match="missing"):
        tables.check_key(df, "z")
    with pytest.raises(ValueError, match="nulls"):
        tables.check_key(spark.createDataFrame([(None,)], "k string"), "k")
    assert tables.check_key(df, "v") is df


def test_bad_lines_go_and_short_ones_stay(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("h1;h2\n1;2\n3;4;5\n6\n7;8\n")
    got = [tuple(r) for r in readers.scan_csv_skip_bad(spark, str(tmp_path / "bad.csv"), ["h1", "h2"]).collect()]
    assert got == [("1", "2"), ("6", None), ("7", "8")]


def test_catalog(spark):
    catalog = spark.createDataFrame([("atlantis", "month", "/a"), ("atlantis", "dekad", None)], "country string, frequency string, path string")
    assert readers.dataset_paths(catalog, "atlantis", "month") == ["/a"]
    for miss, error in ((("kenya", "month"), ValueError), (("atlantis", "year"), ValueError), (("atlantis", "dekad"), FileNotFoundError)):
        with pytest.raises(error):
            readers.dataset_paths(catalog, *miss)


def test_saved_tables_are_used_again(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return {"a": spark.range(3), "b": spark.range(5).repartition(2)}

    def sizes(fingerprint="x"):
        return {name: df.count() for name, df in writers.load_or_compute(spark, str(tmp_path), compute, fingerprint).items()}

    assert sizes() == sizes() == {"a": 3, "b": 5} and len(calls) == 1
    assert sizes("y") == sizes("y") == {"a": 3, "b": 5} and len(calls) == 2  # what they are made from has changed
    (part, *_) = sorted(p for p in tmp_path.glob("b-*/part-*.parquet"))
    for p in tmp_path.glob("b-*/part-*.parquet"):
        p.unlink()  # a file was lost
    assert sizes("y") == {"a": 3, "b": 5} and len(calls) == 3 and not part.exists()


def test_a_write_that_stops_halfway_is_computed_again(spark, tmp_path):
    def broken():
        stop = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("bigint")).alias("id"))
        return {"a": spark.range(3), "b": stop}

    with pytest.raises(PySparkException):
        writers.load_or_compute(spark, str(tmp_path), broken, "x")
    got = writers.load_or_compute(spark, str(tmp_path), lambda: {"a": spark.range(2), "b": spark.range(4)}, "x")
    assert {n: df.count() for n, df in got.items()} == {"a": 2, "b": 4}
    with pytest.raises(PySparkException):  # and what was published before stays whole
        writers.load_or_compute(spark, str(tmp_path), broken, "z")
    again = writers.load_or_compute(spark, str(tmp_path), broken, "x")
    assert {n: df.count() for n, df in again.items()} == {"a": 2, "b": 4}


def test_the_downstream_order_puts_other_first():
    assert classes.class_order(["maize", "other"]) == ["other", "maize"]
    assert classes.class_order(["b", "other", "a"]) == ["a", "b", "other"]


def test_image_dates(spark):
    row = one(
        spark,
        a=text.image_date(F.lit("Sentinel-2 S2A_MSIL2A_N0500_R036_T35TPN_20250601T101010.zip")).cast("string"),
        b=text.image_date(F.lit("Sentinel-1 S1A_IW_GRDH_1SDV_20250530T040506_052936.zip")).cast("string"),
        c=text.image_date(F.lit("a note")).cast("string"),
        name=text.product_name(F.lit("crop_2024-10-01_2025-09-30"), F.lit("2025-06-01"), F.lit("T1")),
    )
    assert list(row) == ["2025-06-01", "2025-05-30", None, "crop_2024-10-01_2025-06-01_T1.tif"]


def test_the_classifier_learns_and_ranks(spark):
    df = spark.range(200).select(
        F.col("id"), F.array((F.col("id") % 2).cast("float"), (F.col("id") % 7).cast("float")).alias("embedding"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c"), F.lit(1.0).alias("weight"),
    )
    model = scoring.fit_classifier(df, "c", 2, trees=2, depth=2)
    assert scoring.predict(df, model).where("c != y_pred").count() == 0
    assert scoring.feature_importance(spark, model).first()["name"] == "emb_0"


def test_a_size_is_selected_refitted_and_tested(spark):
    df = spark.range(300).select(
        F.col("id"), F.array((F.col("id") % 3).cast("float"), (F.col("id") % 5).cast("float")).alias("embedding"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("three"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("two"), F.lit(1.0).alias("weight"),
    )
    train, test = df.where("id % 5 > 0"), df.where("id % 5 = 0")
    table, size = scoring.select_by_folds(train, "three", "id", 3, 4, patience=1, k=2)
    rows = [tuple(r) for r in table.orderBy("fold", "trees").collect()]
    for fold in (0, 1):
        losses = [loss for f, _, loss, _ in rows if f == fold]
        best, _ = scoring.stopped(losses, 1)
        assert [t for f, t, _, chosen in rows if f == fold and chosen] == [best] and losses[best - 1] == min(losses)
    assert 1 <= size <= 4
    for label, n in (("two", 2), ("three", 3)):
        _, found = scoring.fit_and_test(train, test, label, "id", n, 3, patience=1, k=2)
        assert found.where(f"{label} = y_pred and prob > 0.5").count() > 0.9 * test.count()


def test_boosting_stops_after_the_least_loss():
    assert scoring.stopped([3, 2, 1, 2, 2, 0], 2) == (3, True)
    assert scoring.stopped([3, 2, 1, 2], 2) == (3, False)
    assert scoring.stopped([3, 3, 3], 2) == (1, True)
    assert scoring.stopped([1], 5) == (1, False)


def test_losses_are_those_of_the_predictions(spark):
    df = spark.range(90).select(
        F.col("id"), F.array((F.col("id") % 3).cast("float"), (F.col("id") % 7).cast("float")).alias("embedding"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), ((F.col("id") % 3 + (F.col("id") % 11 == 0).cast("int")) % 3 + 1).cast("int")).alias("c"),
        (1 + F.col("id") % 2).cast("double").alias("weight"),
    )
    model = scoring.fit_classifier(df, "c", 3, trees=2, depth=2)
    losses = model.losses(df, "c")
    shares = model.margins(scoring.with_features(df)).select("c", "weight", scoring._shares(F.col("margins")).alias("s")).collect()
    wanted = sum(r["weight"] * -np.log(r["s"]["abc".index(r["c"])]) for r in shares) / sum(r["weight"] for r in shares)
    assert len(losses) == 2 and losses[-1] == pytest.approx(wanted)


def test_embeddings_that_lack_numbers_get_no_prediction(spark):
    df = spark.range(60).select(
        F.col("id"), F.array((F.col("id") % 2).cast("float"), F.lit(1.0).cast("float")).alias("embedding"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c"), F.lit(1.0).alias("weight"),
    )
    odd = spark.createDataFrame(
        [(100, [1.0, None], "b", 1.0), (101, [float("nan"), 1.0], "b", 1.0), (102, None, "a", 1.0), (103, [1.0, 1.0], "b", 1.0)],
        "id bigint, embedding array<float>, c string, weight double",
    )
    model = scoring.fit_classifier(df.unionByName(odd), "c", 2, trees=2, depth=2)
    got = {r["id"]: (r["y_pred"], r["prob"]) for r in scoring.predict(df.unionByName(odd), model).where("id >= 100").collect()}
    assert got[100] == got[101] == got[102] == (None, None) and got[103][0] == "b"


def test_records_become_blocks(spark):
    rows = wide(spark, *[wide_row(sample_id=f"s{k}", lat=float(k)) for k in range(7)])
    rows = inputs.model_inputs(rows, 12, "month")
    ragged = F.col("inputs").withField("s2", F.col("inputs.s2").withField("B2", F.array(F.lit(5.0), F.lit(None).cast("double"))))
    rows = rows.withColumn("inputs", F.when(F.col("sample_id") == "s3", ragged).when(F.col("sample_id") != "s5", F.col("inputs")))
    sizes = spark.sparkContext.accumulator(0)

    def load():
        def encode(blocks):
            assert blocks["s2"].shape[1:] == (12, len(bands.OPTICAL)) and blocks["timestamps"].shape[1:] == (12, 3)
            assert blocks["dem"].shape[1] == blocks["latlon"].shape[1] == 2 and len(blocks["s1"]) <= 3
            sizes.add(len(blocks["s1"]) == 3)
            return np.stack([blocks["s2"][:, 0, 0], blocks["s2"][:, 1, 0], blocks["s2"][:, 11, 0], blocks["latlon"][:, 0], blocks["timestamps"][:, 11, 1]], 1)

        return encode

    got = {r["sample_id"]: r["embedding"] for r in records.embed_records(rows.coalesce(1), load, 12, batch=3).collect()}
    no = bands.NODATA
    assert got["s1"] == [1000, 1010, 1110, 1, 12] and got["s3"] == [5, no, no, 3, 12] and got["s5"] == [no] * 5
    assert len(got) == 7 and sizes.value == 2
    assert records.embed_records(rows.where("false"), load, 12).count() == 0
    with pytest.raises(PySparkException):
        records.embed_records(rows, load, 11).collect()
