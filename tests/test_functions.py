import base64
import json

import pytest
from pyspark.sql import functions as F

from inkloom.functions import bits, geometry, text
from inkloom.operators import dedup, panels
from inkloom.plans import training
from inkloom.settings import Settings, training_settings, wizard_settings


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0]["v"]


def box(*v):
    return F.struct(*[F.lit(x).alias(n) for x, n in zip(v, "xywh")])


@pytest.mark.parametrize(
    ("given", "border", "page", "expected"),
    [((10, 10, 100, 100), 5, 400, (15, 15, 90, 90)), ((-10, -10, 500, 500), 0, 400, (0, 0, 400, 400)), ((0, 0, 10, 10), 8, 400, None)],
)
def test_shrink_box(spark, given, border, page, expected):
    got = one(spark, geometry.shrink_box(box(*given), border, F.lit(page), F.lit(page)))
    assert (tuple(got) if got else None) == expected


@pytest.mark.parametrize(
    ("axis", "run", "side", "expected"),
    [("FFTTTFF", 2, 1, [(0, 2), (5, 7)]), ("FFTFF", 2, 1, [(0, 5)]), ("FTTFFF", 2, 2, [(3, 6)])],
)
def test_content_spans(spark, axis, run, side, expected):
    rows = spark.createDataFrame([(1, i) for i, c in enumerate(axis) if c == "F"], "k int, i int")
    got = panels.content_spans(rows, ["k"], run, side)
    assert sorted((r["start"], r["stop"]) for r in got.collect()) == expected


def test_reasons(spark):
    reason = lambda *v: one(spark, geometry.page_reason(*map(F.lit, v), max_panels=12, splash_ratio=0.85))
    assert reason(0, 0, 100) == "no panels detected"
    assert reason(13, 5, 100) == "too many panels (13 > 12)"
    assert reason(1, 85, 100) == "splash page (single full-page panel)"
    assert reason(1, 84, 100) is None and reason(1, 1, 0) is None
    assert one(spark, geometry.mask_reason(F.lit(0.625), 0.6)) == "excessive mask coverage (62% > 60%)"
    assert one(spark, geometry.mask_reason(F.lit(0.6), 0.6)) is None


@pytest.mark.parametrize(
    ("given", "expected"),
    [("a  b\n c", "t, a b c"), ("T, a", "t, a"), ("", "t,"), (None, "t,"), ("tt a", "t, t a"), ("a b", "t, a b")],
)
def test_normalize_caption(spark, given, expected):
    assert one(spark, text.normalize_caption(F.lit(given).cast("string"), F.lit("t"))) == expected


def test_build_caption(spark):
    made = lambda *tags: one(spark, text.build_caption(F.lit("Sty"), F.array(*map(F.lit, tags)).cast("array<string>")))
    assert made("b", "a", "b", "sTY") == "Sty, b, a"
    assert made("sty") == "Sty" and made() == "Sty"


def test_select_tags(spark):
    got = text.select_tags(F.array(*map(F.lit, (0.99, 0.8, 0.2, 0.95))), F.array(*map(F.lit, ("rating", "1girl", "long_hair", "who"))), F.array(*map(F.lit, (False, True, True, False))), 0.5)
    assert one(spark, got) == ["1girl"]


def test_service_reply(spark):
    said = lambda v: one(spark, text.service_reply(F.lit(v).cast("string")))
    assert said('["{\\"caption\\": \\"x\\", \\"in_tokens\\": 3}"]')["caption"] == "x"
    assert said(None)["error"] == said("")["error"] == "empty_response"
    assert said("junk")["error"] == "parse_failed"
    assert said('["{\\"error\\": \\"http_400\\"}"]')["error"] == "http_400"


def test_training_progress(spark):
    said = lambda v: tuple(one(spark, text.training_progress(F.lit(v))))
    assert said("epoch 1/10") == (None, None, 1, 10, None)
    assert said("steps: 10%| 200/2000 [01:30<13:30, avr_loss=0.0987]") == (200, 2000, None, None, 0.0987)
    assert said("caching 3/7") == (None,) * 5
    assert said("5/9 [x, avr_loss=1e-05]")[4] == 1e-05 and said("5/9 [x, avr_loss=..]") == (5, 9, None, None, None)


def test_names(spark):
    assert one(spark, text.stem(F.lit("/a/b.c.png"))) == "b.c"
    assert one(spark, text.stem(F.lit("x"))) == "x"
    assert one(spark, text.is_image(F.lit("/a/B.PNG"))) and not one(spark, text.is_image(F.lit("/a/b.txt")))
    assert one(spark, text.file_name(F.lit("../../etc/p.png"))) == "p.png"


def test_fraction(spark):
    f = lambda *v: one(spark, text.progress_fraction(F.lit(v[0]), F.lit(v[1]), F.lit(v[2])))
    assert (f(1, 4, "running"), f(1, 4, "done"), f(1, 0, "done")) == (0.0, 0.25, 1.0)


def test_hamming(spark):
    assert one(spark, bits.hamming(F.lit(0b1011).cast("bigint"), F.lit(0b0001).cast("bigint"))) == 2
    assert one(spark, bits.hamming(F.lit(-1).cast("bigint"), F.lit(0).cast("bigint"))) == 64


@pytest.mark.parametrize("fold_rows", [100, 0])
@pytest.mark.parametrize("distance", [0, 6, 20])
def test_greedy_dedup(spark, fold_rows, distance):
    import random

    rng = random.Random(7)
    hashes = [0, 0b111, 0b1111111111]
    for _ in range(60):
        h = rng.choice(hashes)
        for _ in range(rng.randrange(6)):
            h ^= 1 << rng.randrange(64)
        hashes.append(h)
    kept = []
    for i, h in enumerate(hashes):
        if all((h ^ hashes[k]).bit_count() >= distance for k in kept):
            kept.append(i)
    rows = spark.createDataFrame([(i, h - (1 << 64) if h >> 63 else h) for i, h in enumerate(hashes)], "ord bigint, h bigint")
    assert sorted(r["ord"] for r in dedup.greedy_dedup(rows, distance, fold_rows).collect()) == kept


def test_settings():
    assert Settings.from_env({"APP_MAX_PANELS": "3", "APP_RUN_TRAIN": "true", "OTHER": "x"}).max_panels == 3
    for bad in ({"dataset_repeats": 0}, {"splash_area_ratio": 0.0}, {"caption_threshold": 1.1}):
        with pytest.raises(ValueError, match="out of range"):
            Settings().having(**bad)
    assert wizard_settings(Settings(), " ", 12.9).dataset_repeats == 12
    assert wizard_settings(Settings(), "x", 0).dataset_repeats == 1
    assert training_settings(Settings(), " SDXL ", 5, -1).train_learning_rate == 1e-4


def test_training():
    s = Settings(train_base_model="m", train_sd_scripts_dir="/k")
    p = training.plan(s, "c.toml", "/o")
    assert p.output_path == "/o/comicstyle.safetensors" and p.command[0] == "/k/venv/bin/python" and "--clip_skip=2" in p.command
    sdxl = training.arguments(s.having(train_model_type="sdxl"), "c", "o", "n")
    assert "--no_half_vae" in sdxl and "--cache_text_encoder_outputs" in sdxl
    with pytest.raises(ValueError, match="APP_TRAIN_FLUX_AE"):
        training.arguments(s.having(train_model_type="flux"), "c", "o", "n")
    with pytest.raises(NotImplementedError):
        training.arguments(s.having(train_model_type="x"), "c", "o", "n")
    with pytest.raises(ValueError, match="base"):
        training.arguments(Settings(), "c", "o", "n")
    assert "max_bucket_reso = 1024" in training.dataset_file("/d", 10, 512, 1, training.bucket_limit("sd15"))


def test_request_body_of_a_long_image_is_one_line(spark):
    image = bytes(range(256)) * 3
    said = one(spark, text.request_body(F.lit("m"), F.lit("p"), F.lit(image)))
    assert json.loads(said) == {"data": ["m", "p", base64.b64encode(image).decode()]}


def test_keys_of_close_pairs_are_never_broadcast(spark):
    rows = spark.range(300).select(F.col("id").alias("ord"), F.xxhash64("id").alias("h"))
    made = dedup.close_pairs(rows, 12)
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()


def test_size_guesses_of_rounds_stay_numbers_of_few_digits(spark):
    rows = spark.range(14).select(F.col("id").alias("ord"), F.col("id").alias("h"))
    left = dedup.resolve(rows, spark.createDataFrame([(i, i + 1) for i in range(13)], "a long, b long"))
    gone = left._jdf.queryExecution().optimizedPlan().collectLeaves().last()
    assert len(str(gone.stats().sizeInBytes())) < 60
    assert sorted(r["ord"] for r in left.collect()) == list(range(0, 14, 2))


def test_boxes_are_shuffled_once_and_not_their_grid_rows(spark):
    boxes = spark.range(100).selectExpr("id % 7 page", "id % 11 * 30 - 20 x", "id % 13 * 25 - 20 y", "90L w", "120L h")
    made = panels.mask_rows(boxes, 20, 400, 400)
    assert panels.coverage(made, 400)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    panels.WIDE, wide = 0, panels.WIDE
    try:
        assert sorted(map(tuple, panels.mask_rows(boxes, 20, 400, 400).collect())) == sorted(map(tuple, made.collect()))
    finally:
        panels.WIDE = wide
