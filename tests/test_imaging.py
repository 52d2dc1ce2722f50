import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cityflow.operators import imaging, slices, spectral
from cityflow.plans.dataflows import image_slice, score_image_folder
from cityflow.sources.images import read_images, read_images_checked
from frames import rows
from test_sources import png


def test_resize_samples_source_positions():
    ramp = np.arange(4, dtype=np.float32)[:, None, None] * np.ones((1, 4, 3), np.float32)
    assert imaging.resize_bilinear(ramp, (2, 4))[:, 0, 0].tolist() == [0.0, 2.0]
    assert imaging.resize_bilinear(ramp, (8, 4))[:, 0, 0].tolist() == [0, 0.5, 1, 1.5, 2, 2.5, 3, 3]
    assert imaging.resize_bilinear(ramp, (2, 4), half_pixel=True)[:, 0, 0].tolist() == [0.5, 2.5]
    same = imaging.resize_bilinear(ramp, (4, 4))
    assert np.array_equal(same, ramp)


def test_model_input_crops_and_scales():
    image = np.zeros((240, 320, 3), np.float32)
    image[80:240, 80:300] = 255
    tensor = imaging.model_input(image)
    assert tensor.shape == (160, 160, 3) and tensor.min() == tensor.max() == 1.0
    assert imaging.model_input(image, None, imaging.UNCROPPED_SIZE).shape == (240, 240, 3)
    with pytest.raises(ValueError, match="too small"):
        imaging.model_input(image[:100])


def test_channels_are_turned_to_rgb():
    assert imaging.decode_pixels(bytes([1, 2, 3]), 1, 1, 3)[0, 0].tolist() == [3, 2, 1]
    assert imaging.decode_pixels(bytes([7]), 1, 1, 1)[0, 0].tolist() == [7, 7, 7]


def test_scores_follow_the_images(spark, tmp_path):
    def red_share():
        return lambda batch: batch[:, :, :, 0].mean(axis=(1, 2))

    for i in range(5):
        level = 51 * i
        (tmp_path / f"689-2019-04-04-08-3{i}-00.jpg").write_bytes(
            png(4, 4, lambda r, c: (level, 0, 255))
        )
    frames = read_images(spark, str(tmp_path))
    scored = imaging.score_images(frames, red_share, crop=(1, 1, 2, 2), size=(2, 2), batch_size=2)
    assert [round(r.predict, 6) for r in scored.orderBy("origin").collect()] == [
        0.0, 0.2, 0.4, 0.6, 0.8,
    ]
    sliced = score_image_folder(
        spark, str(tmp_path), red_share, 1, 3, crop=(1, 1, 2, 2), size=(2, 2)
    )
    got = [(s, round(p, 6), f) for s, p, f in rows(sliced)]
    assert got == [("2019-04-04-08-31", 0.2, None), ("2019-04-04-08-32", 0.4, None)]


def test_broken_images_are_reported_and_others_not_opened(spark, tmp_path):
    def red_share():
        return lambda batch: batch[:, :, :, 0].mean(axis=(1, 2))

    for i in range(4):
        (tmp_path / f"689-2019-04-04-08-3{i}-00.png").write_bytes(png(4, 4, lambda r, c: (51 * i, 0, 0)))
    (tmp_path / "689-2019-04-04-08-35-00.png").write_bytes(b"no image")
    (tmp_path / "notes.txt").write_text("no image either")
    options = {"crop": (1, 1, 2, 2), "size": (2, 2)}
    got = rows(score_image_folder(spark, str(tmp_path), red_share, 3, None, **options))
    assert [(s, p if p is None else round(p, 6), f) for s, p, f in got] == [
        ("2019-04-04-08-33", 0.6, None), ("2019-04-04-08-35", None, "undecodable"),
    ]
    assert score_image_folder(spark, str(tmp_path), red_share, 9, None, **options).count() == 0
    assert score_image_folder(spark, str(tmp_path), red_share, **options).count() == 5
    chosen = read_images_checked(spark, image_slice(spark, str(tmp_path), 1, 3))
    files = {f.rsplit("/", 1)[1] for f in chosen.inputFiles()}
    assert files == {"689-2019-04-04-08-31-00.png", "689-2019-04-04-08-32-00.png"}


def test_sorted_slice(spark):
    frame = spark.createDataFrame([(c,) for c in "fbdace"], "name STRING")
    assert [r.name for r in imaging.sorted_slice(frame, ["name"], 1, 4).collect()] == list("bcd")
    assert imaging.sorted_slice(frame, ["name"], 5, 50).count() == 1
    assert imaging.sorted_slice(frame, ["name"], None, 2).count() == 2
    assert imaging.sorted_slice(frame, ["name"]).count() == 6
    assert imaging.sorted_slice(frame.limit(0), ["name"], 1).count() == 0


def test_slices_cut_ranges_and_skip_the_rest(spark):
    rng = random.Random(2)
    values = [rng.randrange(30) if rng.random() < 0.6 else 7 for _ in range(5000)]  # a hot value
    frame = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v INT, i INT").repartition(7)
    ordered = slices.lay_out(frame, ["v", "i"], ranges=16)
    want = sorted((v, i) for i, v in enumerate(values))
    assert ordered.count == 5000 and max(n for _, n in ordered.starts.values()) < 1000
    for first, last in ((0, 10), (1234, 3456), (4990, 6000), (17, 17), (None, None), (2500, None)):
        got = sorted(map(tuple, ordered.slice(first, last).collect()))
        assert got == want[first:last]
    plan = ordered.slice(2400, 2600)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "PartitionFilters: [range_no" in plan
    assert len({f for f in ordered.slice(2400, 2600).inputFiles()}) >= 1
    placed = ordered.places().orderBy("place").collect()
    assert [(r.v, r.i) for r in placed] == want and [r.place for r in placed] == list(range(5000))


def test_window_is_symmetric():
    w = spectral.blackman_harris(1024)
    assert np.allclose(w, w[::-1]) and w.max() == pytest.approx(1.0, abs=1e-4) and w[0] < 1e-4
    assert spectral.blackman_harris(1).tolist() == [1.0]


def test_a_tone_peaks_in_its_bin(spark):
    n, tone = 1024, 100
    t = np.arange(n)
    wave = np.exp(2j * np.pi * tone * t / n)
    frame = spark.createDataFrame(
        [(0, wave.real.tolist(), wave.imag.tolist()), (1, [0.0] * 8, [0.0] * 8), (2, None, None)],
        "id INT, re ARRAY<DOUBLE>, im ARRAY<DOUBLE>",
    )
    got = {r.id: r.power for r in spectral.power_spectrum(frame).collect()}
    assert int(np.argmax(got[0])) == n // 2 + tone and len(got[0]) == n
    assert got[1] == pytest.approx([-180.0] * 8) and got[2] is None


def test_real_frames_have_a_symmetric_spectrum(spark):
    frame = spark.createDataFrame([(list(map(float, range(16))),)], "re ARRAY<DOUBLE>")
    power = spectral.power_spectrum(frame, "re", None).select(F.col("power")).first()[0]
    assert power[1:8] == pytest.approx(power[:8:-1])
