"""The whole chain from two small CSV files."""

import random

import pytest

from tesserae.__main__ import main
from tesserae.plans import footprints
from tesserae.sources import files


def box(lon, lat, w, h):
    dx, dy = w / 55800, h / 111300
    p = [(lon, lat), (lon + dx, lat), (lon + dx, lat + dy), (lon, lat + dy), (lon, lat)]
    return "POLYGON ((" + ", ".join(f"{x:.7f} {y:.7f}" for x, y in p) + "))"


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    rnd, folder = random.Random(1), tmp_path_factory.mktemp("in")
    a, b = ["id,title,tags,geometry,area_sq_m,gkh_address,gkh_floor_count_min,gkh_floor_count_max"], ["subject,district,type,locality,type_street,name_street,number,letter,fraction,housing,building,purpose_of_building,stairs,avg_floor_height,height,wkt"]
    for i in range(90):
        lon, lat = 30.2 + (i % 10) * 0.002, 59.9 + (i // 10) * 0.001
        w, h, floors = rnd.uniform(15, 40), rnd.uniform(15, 40), rnd.randint(1, 16)
        a.append(f"{i},дом,\"['жилое здание']\",\"{box(lon, lat, w, h)}\",{w * h:.1f},\"г. СПб, ул. Ленина, д. {i + 1}\",{floors},{floors}")
        height = "" if i % 5 == 0 else f"{floors * 3 + rnd.uniform(-1, 1):.1f}"
        if i % 9 == 4:  # two parts for one building
            for k in (0, 1):
                b.append(f"r,d,t,l,улица,Ленина,{i + 1},,,,{k},Жилое,{floors},3.0,{height},\"{box(lon + k * w / 2 / 55800, lat, w / 2, h)}\"")
        elif i % 9 != 7:
            b.append(f"r,d,t,l,улица,Ленина,{i + 1},,,2.0,,Жилое,{floors},3.0,{height},\"{box(lon + 1e-6, lat, w, h)}\"")
    a.append(a[5])  # a copy
    a.append("bad,,,POINT (1 1),100,,,")
    for name, rows in (("a", a), ("b", b)):
        (folder / f"{name}.csv").write_text("\n".join(rows))
    return folder


def test_chain(spark, inputs, tmp_path):
    out = footprints.run(spark, f"{inputs}/a.csv", f"{inputs}/b.csv", f"{tmp_path}/out", trees=10)
    fused = spark.read.parquet(f"{tmp_path}/out/buildings")
    cleaned = spark.read.parquet(f"{tmp_path}/out/cleaned_a")
    assert cleaned.count() == 90 and cleaned.filter("addr_norm like 'г санкт петербург ул ленина %'").count() == 90
    assert spark.read.parquet(f"{tmp_path}/out/cleaned_b").filter("housing = '2'").count() > 0
    rows = {r.a_source_ids: r for r in fused.collect()}
    assert set(rows) == {str(i) for i in range(90) if i % 9 != 7}  # rows without a partner don't reach the result
    assert rows["1"].comp_type == "1x1" and rows["1"].iou_ab > 0.9 and rows["1"].category_A_mode == "Жилое"
    assert rows["4"].n_b == 2 and rows["4"].support_a > 0.9 and rows["4"].addr_norm == "спб, ленина, 5"
    missing = [i for i in range(90) if i % 5 == 0 and i % 9 != 7]
    got = out.collect()
    assert len(got) == len(missing) and all(2 < r.predicted_height_m < 80 for r in got)
    meta = files.read_metadata(spark, f"{tmp_path}/out/metadata")
    assert "height_from_stairs" not in meta["features"] or meta["holdout_r2"] > 0.3
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/predictions").count() == len(missing)

    # the saved model predicts every row, also of a table that lacks features
    table = spark.read.parquet(f"{tmp_path}/out/features")
    everything, quality = footprints.predict(spark, table, f"{tmp_path}/out", f"{tmp_path}/all")
    by_id = {r.building_id: r.predicted_height_m for r in everything.collect()}
    assert len(by_id) == len(rows) and all(abs(by_id[r.building_id] - r.predicted_height_m) < 1e-9 for r in got)
    assert sorted(by_id) == list(range(len(rows)))
    assert quality.first().mae < 10
    less = table.drop("kde_50m", meta["features"][0], "height_B_median")
    everything, quality = footprints.predict(spark, less, f"{tmp_path}/out", f"{tmp_path}/less")
    assert everything.count() == len(rows) and quality is None
    main(["predict", f"{tmp_path}/out/features", f"{tmp_path}/out", f"{tmp_path}/again"])
    assert spark.read.option("header", True).csv(f"{tmp_path}/again").count() == len(rows)
