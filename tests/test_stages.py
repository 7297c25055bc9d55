import numpy as np
import pytest

from inkloom.cli import checks, initialise, report
from inkloom.operators import pixels
from inkloom.plans import runner, stages
from inkloom.settings import Settings
from inkloom.sources import images, sinks
from inkloom.streaming import ingest


def page(cols, rows, size=1000, gutter=40):
    out = np.full((size, size, 3), 255, np.uint8)
    w, h = (size - gutter * (cols + 1)) // cols, (size - gutter * (rows + 1)) // rows
    for r in range(rows):
        for c in range(cols):
            y, x = gutter + r * (h + gutter), gutter + c * (w + gutter)
            out[y : y + h, x : x + w] = 40
    return out


@pytest.fixture()
def workspace(tmp_path):
    root = str(tmp_path / "w")
    initialise(root)
    pages = {"a": page(2, 2), "b": page(3, 2), "splash": page(1, 1, gutter=20), "many": page(4, 4)}
    for name, image in pages.items():
        (tmp_path / "w/00_pages" / f"{name}.png").write_bytes(pixels.encode_png(image))
    (tmp_path / "w/00_pages/bad.png").write_bytes(b"no image")
    (tmp_path / "w/00_pages/empty.png").write_bytes(b"")
    (tmp_path / "w/00_pages/notes.txt").write_text("x")
    return root


def test_all_stages(spark, workspace, tmp_path):
    settings = Settings(max_panels=12, min_side_px=64, target_side=256, dedup_hamming_distance=0)
    tag = lambda image: [0.9, 0.1, 0.8]
    c = runner.Context(spark, runner.Workspace(workspace), settings.having(inpaint_backend="flat"), detect_text=lambda image: [(0, 0, 20, 20)], tag=tag, vocabulary=[("1girl", True), ("hat", True), ("rating", False)])
    events = list(runner.progress(c))
    assert [(e.name, e.phase) for e in events if e.phase != "running"] == [(n, "skipped" if n == "train" else "done") for n, _, _ in runner.STAGES], events[-1]
    assert events[0].fraction == 0.0 and events[-1].fraction == 1.0
    assert {r["stem"] for r in c.read("panels").collect()} == {f"a_{i:02d}" for i in range(4)} | {f"b_{i:02d}" for i in range(6)}
    aside = {r["stem"]: r["reason"] for r in spark.read.parquet(c.workspace.quarantine("panels")).collect()}
    assert aside == {"splash": "splash page (single full-page panel)", "many": "too many panels (16 > 12)", "bad": "unreadable page", "empty": "unreadable page"}
    done = spark.read.parquet(runner.output_of("caption", c))
    assert {r["caption"] for r in done.collect()} == {"comicstyle, 1girl"} and done.count() == 10
    again = runner.run_all(c)
    assert all(r.skipped for r in again)
    files = tmp_path / "w/05_dataset/10_comicstyle"
    assert sorted(p.name for p in files.glob("[!.]*")) == sorted(r["stem"] + x for r in done.collect() for x in (".png", ".txt"))
    review = tmp_path / "w/manual_review"
    assert (review / "splash.png").read_bytes() == (tmp_path / "w/00_pages/splash.png").read_bytes() and (review / "bad.png").read_bytes() == b"no image"
    assert (review / "many.reason.txt").read_text() == "too many panels (16 > 12)\n" and (review / "empty.png").exists()

    assert runner.promote(c, ["../x/splash.png", "bad.png", "none.png"]) == 1
    assert not (review / "splash.png").exists() and not (review / "splash.reason.txt").exists() and (review / "bad.png").exists()
    assert [r.name for r in runner.run_all(c) if not r.skipped] == ["caption"] and (files / "splash.png").exists()

    def ask(image):  # the promoted picture is the largest
        return {"caption": " Said "} if int.from_bytes(image[16:20], "big") != 1000 else {"error": "http_404"}

    calls = []
    assert "token" in runner.recaption(c)["errors"][0]
    got = runner.recaption(c, ask=ask, retries=2, pause=0)
    assert got["written"] == 10 and got["failed"] == 1 and got["errors"] == ["splash.png: http_404"] and not calls
    assert (files / "a_00.txt").read_text() == "comicstyle, Said\n" and (files / "splash.txt").read_text() == "comicstyle, 1girl\n"
    nowhere = runner.Context(spark, runner.Workspace(str(tmp_path / "none")), settings)
    assert "no data set" in runner.recaption(nowhere, ask=ask)["errors"][0]

    def launch(plan):
        (tmp_path / "w/06_lora/comicstyle.safetensors").write_bytes(b"x")
        calls.append(plan)
        return plan.output_path

    c.settings, c.launch = c.settings.having(run_train=True, train_base_model="m", train_sd_scripts_dir="s"), launch
    assert [r.name for r in runner.run_all(c) if not r.skipped] == ["train"] and calls[0].output_path.endswith("06_lora/comicstyle.safetensors")
    assert "image_dir = '" + str(files) in (tmp_path / "w/06_lora/dataset.toml").read_text()
    assert [r["path"].rsplit("/")[-1] for r in images.weights(spark, str(tmp_path / "w/06_lora")).collect()] == ["comicstyle.safetensors"]
    c.settings = c.settings.having(run_train=False)
    done = spark.read.parquet(runner.output_of("caption", c)).where("stem <> 'splash'")
    assert sinks.write_dataset(done, str(tmp_path / "set"), 10, "comicstyle") == 10
    assert (tmp_path / "set/10_comicstyle/a_00.txt").read_text() == "comicstyle, 1girl\n"
    assert sinks.zip_folder(str(tmp_path / "set/10_comicstyle"), str(tmp_path / "z.zip")) and sinks.zip_folder(str(tmp_path / "no"), "x") is None
    back = images.read_images(spark, str(tmp_path / "set/10_comicstyle"))
    assert back.where("data is null").count() == 0 and back.count() == 10
    assert images.sidecars(spark, str(tmp_path / "set/10_comicstyle")).count() == 10
    assert {r["label"].strip(): r["n"] for r in runner.summary(c).collect()}["01_panels"] == 10
    assert {r["label"].strip(): r["n"] for r in runner.summary(c).collect()}["manual_review"] == 4
    assert report(checks(workspace)).endswith("all good")


def image_rows(spark, named):
    return spark.createDataFrame([(s, a.shape[0], a.shape[1], a.tobytes()) for s, a in named.items()], f"stem string, {images.PIXELS}")


def test_clean(spark):
    noise = lambda n, seed: np.random.default_rng(seed).integers(0, 256, (n, n, 3), dtype=np.uint8)
    near = noise(300, 1).copy()
    near[0, 0] ^= 1
    rows = image_rows(spark, {"a": noise(300, 1), "b": near, "c": noise(300, 1), "d": noise(120, 2), "e": noise(40, 3)})
    out, aside = stages.clean_stage(rows, Settings(min_side_px=64, target_side=256))
    assert {r["stem"]: (r["height"], r["upscaled"]) for r in out.collect()} == {"a": (300, False), "d": (256, True)}
    assert [(r["stem"], r["reason"]) for r in aside.collect()] == [("e", "too small after inpaint")]


def test_bubbles_and_paint(spark):
    grey = np.full((256, 256, 3), 90, np.uint8)
    dark = np.full((256, 256, 3), 9, np.uint8)
    rows = image_rows(spark, {"clean": dark, "sfx": grey})
    masks, aside = stages.bubbles_stage(rows, Settings(mask_dilation_px=2), lambda i: [], lambda i: [(10, 10, 60, 60)] if i[0, 0, 0] == 90 else [])
    cover = {r["stem"]: r["coverage"] for r in masks.collect()}
    assert cover["clean"] == 0 and cover["sfx"] > 0 and aside.count() == 0
    _, aside = stages.bubbles_stage(rows, Settings(), lambda i: [], lambda i: [(0, 0, 256, 256)])
    assert aside.count() == 2
    calls = lambda image, mask: np.zeros_like(image)
    out, _ = stages.inpaint_stage(rows, masks, calls)
    got = {r["stem"]: np.frombuffer(r["data"], np.uint8).reshape(256, 256, 3) for r in out.collect()}
    assert (got["clean"] == dark).all() and not got["sfx"][30, 30].any() and (got["sfx"][200, 200] == 90).all()
    with pytest.raises(ValueError, match="unknown painter"):
        stages.backend(stages.PAINTERS, "nothing", "painter")


def test_recaption(spark):
    rows = image_rows(spark, {s: np.full((8, 8, 3), i, np.uint8) for i, s in enumerate("abc")})
    replies = {0: {"caption": " A  cat "}, 1: {"error": "http_400"}, 2: {"caption": ""}}

    def ask(png):
        import zlib

        data = zlib.decompress(png[png.index(b"IDAT") + 4 : png.index(b"IEND") - 8])
        return replies[data[1]]

    got = {r["stem"]: (r["caption"], r["error"]) for r in stages.recaption(rows, ask, "t", retries=2, pause=0, concurrency=2).collect()}
    assert got == {"a": ("t, A cat", None), "b": (None, "http_400"), "c": (None, "empty_caption")}


def test_promote(spark):
    rows = image_rows(spark, {"a": np.zeros((10, 10, 3), np.uint8)}).selectExpr("'/q/a.png' as path", "*")
    names = spark.createDataFrame([("../x/a.png",), ("a.reason.txt",)], "name string")
    assert [(r["stem"], r["height"]) for r in stages.promote(rows, names, Settings(target_side=20)).collect()] == [("a", 20)]


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.png").write_bytes(b"1")
    (tmp_path / "in/a.txt").write_text("x")
    out, mark = str(tmp_path / "t"), str(tmp_path / "c")
    ingest.new_pages(spark, str(tmp_path / "in"), out, mark).awaitTermination()
    (tmp_path / "in/b.png").write_bytes(b"2")
    ingest.new_pages(spark, str(tmp_path / "in"), out, mark).awaitTermination()
    assert sorted(r["stem"] for r in spark.read.parquet(out).collect()) == ["a", "b"]
    (tmp_path / "log").mkdir()
    (tmp_path / "log/l.txt").write_text("epoch 1/2\nx\n3/9 [a, avr_loss=0.5]\nmodel saved.\n")
    ingest.watch_log(spark, str(tmp_path / "log"), str(tmp_path / "p"), str(tmp_path / "pc")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    assert ingest.saved(spark.read.text(str(tmp_path / "log"))).collect()[0]["saved"]


def test_vocabulary(spark, tmp_path):
    (tmp_path / "v.csv").write_text("tag_id,name,category,count\n1,general,9,1\n2,1girl,0,9\n3,long_hair,0,8\n4,who,4,7\n")
    assert images.vocabulary(spark, str(tmp_path / "v.csv")) == [("general", False), ("1girl", True), ("long_hair", True), ("who", False)]


def test_listing_is_numbered_by_path(spark, tmp_path):
    for n in ("b.PNG", "a.jpg", "c.txt", ".png", "d.webp"):
        (tmp_path / n).write_bytes(b"")
    assert [(r["ord"], r["path"].rsplit("/")[-1]) for r in images.list_images(spark, str(tmp_path)).orderBy("ord").collect()] == [(0, "a.jpg"), (1, "b.PNG"), (2, "d.webp")]
    assert images.list_images(spark, str(tmp_path / "no")).count() == 0
    assert sinks.save_uploads(spark, [str(tmp_path / "a.jpg"), str(tmp_path / "c.txt")], str(tmp_path / "up")) == 1
    assert [p.name for p in (tmp_path / "up").glob("[!.]*")] == ["a.jpg"] and sinks.save_uploads(spark, None, str(tmp_path / "up")) == 0


def test_service():
    import io
    import json
    import urllib.error

    from inkloom.sources.service import Service, last_data, reply_of

    asked = []

    def opened(request, timeout):
        asked.append((request.full_url, request.data and json.loads(request.data), request.get_header("Authorization")))
        if request.data:
            return io.BytesIO(b'{"event_id": "e7"}')
        return io.BytesIO(b'event: x\ndata: ["{\\"caption\\": \\"hi\\"}"]\ndata: null\ndata:\n')

    assert Service("https://h/x", "t", "m", "p", open=opened)(b"\x00") == {"caption": "hi"}
    assert asked == [("https://h/x", {"data": ["m", "p", "AA=="]}, "Bearer t"), ("https://h/x/e7", None, "Bearer t")]

    def refused(request, timeout):
        raise urllib.error.HTTPError(request.full_url, 429, "no", {}, None)

    assert Service("https://h/x", "t", "m", "p", open=refused)(b"") == {"error": "http_429"}
    with pytest.raises(ValueError):
        Service("http://h", "t", "m", "p")
    assert last_data(["data: null", "x"]) is None and reply_of(None)["error"] == reply_of(" ")["error"] == "empty_response"
    assert reply_of("[]") == {} and reply_of('{"a": 1}') == {"a": 1} and reply_of("5")["error"] == reply_of("x")["error"] == "parse_failed"


def test_launch(tmp_path):
    import sys

    from inkloom.plans import training

    out, said = tmp_path / "w.safetensors", []
    code = f"import json, struct; h = json.dumps({{'__metadata__': 0, 'a': 1, 'b': 2}}).encode(); open({str(out)!r}, 'wb').write(struct.pack('<Q', len(h)) + h); print('epoch 1/1'); print('model saved.')"
    plan = training.TrainPlan((sys.executable, "-c", code), str(tmp_path), str(out))
    assert training.launch(plan, said.append) == str(out) and said == ["epoch 1/1", "model saved."]
    assert training.run_metadata("done", "", 1.0, 3.4, 5, str(out))["tensors"] == 2
    for bad in ("import sys; sys.exit(3)", "print('nothing')"):
        with pytest.raises(RuntimeError):
            training.launch(training.TrainPlan((sys.executable, "-c", bad), "", str(tmp_path / "none")), said.append)


def test_env_and_doctor(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    (tmp_path / ".env").write_text("# x\nAPP_TRIGGER_TOKEN='mine'\nHF_TOKEN=abc\nAPP_MAX_PANELS=3\n\nnothing\n")
    monkeypatch.setenv("APP_MAX_PANELS", "4")
    s = Settings.from_env()
    assert (s.trigger_token, s.hf_token, s.max_panels) == ("mine", "abc", 4)
    got = {n: ok for n, ok, _ in checks(str(tmp_path), s)}
    assert got["workspace"] and got["pyspark"] and not got["pages"]
    assert not {n: ok for n, ok, _ in checks(str(tmp_path), s.having(run_train=True))}["base model"]


def test_models_and_adapters():
    image, mask = np.full((20, 30, 3), 50, np.uint8), np.zeros((20, 30), np.uint8)
    paint = stages.model_inputs(lambda x, m: x * 255, stages.input_size([1, 3, "h", 64], 64))
    assert stages.input_size([1, 3, 32, "w"]) == (512, 32) and np.abs(paint(image, mask).astype(int) - 50).max() <= 1
    assert stages.tagger(lambda x: x.mean(axis=(1, 2, 3)), 16)(image)[0] > 50
    assert stages.lettering_boxes(lambda i: ([(1, 5, 2, 6)], [[(3, 4), (9, 2), (8, 8), (2, 7)]]))(image) == [(1, 2, 5, 6), (2, 2, 9, 8)]


def test_overlay_denoise_and_sheet(spark):
    image = np.full((12, 12, 3), 100, np.uint8)
    rows = image_rows(spark, {"a": image})
    masks = spark.createDataFrame([("a", np.eye(12, dtype=np.uint8).tobytes())], "stem string, bits binary")
    got = np.frombuffer(stages.overlays(rows, masks).collect()[0]["data"], np.uint8).reshape(12, 12, 3)
    assert got[0, 0].tolist() == [40, 40, 193] and (got[0, 1] == 100).all()
    noisy = np.clip(100 + np.random.default_rng(0).normal(0, 4, (24, 24, 3)), 0, 255).astype(np.uint8)
    assert pixels.denoise(noisy).std() < noisy.std() * 0.7 and (pixels.denoise(image) == image).all()
    sheet = pixels.contact_sheet({(0, 0): image, (0, 1): None, (1, 0): np.zeros((400, 200, 3), np.uint8)}, 2, 2, 64)
    assert sheet.shape == (128, 128, 3) and sheet[2, 2].tolist() == [100] * 3 and sheet[2, 66].tolist() == [60, 60, 200] and sheet[66, 2].tolist() == [0, 0, 0] and sheet[66, 40].tolist() == [245] * 3


def test_evaluation(spark, tmp_path):
    import json

    from inkloom.plans import evaluation

    (tmp_path / "p.txt").write_text(" %TRIGGER%, a cat \n\n a dog\n")
    prompts = images.prompts(spark, str(tmp_path / "p.txt"))
    assert prompts == ["%TRIGGER%, a cat", "a dog"] and images.prompts(spark, None, ("x",)) == ["x"]
    done = evaluation.evaluate(spark, str(tmp_path / "e"), "/w/n.safetensors", prompts, [0.0, 0.5], "me", lambda g: np.zeros((4, 4, 3), np.uint8) if "2" in g else None)
    assert done == 2 and (tmp_path / "e/grid_n.png").stat().st_size > 0
    g = json.loads((tmp_path / "e/graph_n_r0_w0.5.json").read_text())
    assert g["2"]["inputs"]["strength_model"] == 0.5 and g["3"]["inputs"]["text"] == "me, a cat"
    assert "2" not in json.loads((tmp_path / "e/graph_n_r1_w0.json").read_text()) and "2 of 4 pictures" in (tmp_path / "e/report.md").read_text()
    assert evaluation.graph("p", "w", 1.0, model="m.gguf")["1"]["class_type"].endswith("GGUF")


def test_markers_of_a_tree(spark, tmp_path):
    from inkloom.sources import markers

    (tmp_path / "src/node_modules").mkdir(parents=True)
    (tmp_path / "src/a b.py").write_text("x\n# <S>\n# id: one\n# <E>\n")
    (tmp_path / "src/d.md").write_text("```\n<S>\nid: no\n<E>\n```\n<S>\nid: two\nstatus: odd\n<E>\n")
    (tmp_path / "src/node_modules/e.py").write_text("<S>\nid: three\n<E>\n")
    (tmp_path / "src/f.txt").write_text("<S>\nid: four\n<E>\n")
    found = markers.extract_blocks(markers.read_tree(spark, str(tmp_path / "src")), "<S>", "<E>", ("id", "status"), ("id",), ("ok",))
    assert sorted((r["file"].rsplit("/")[-1], r["fields"]["id"], len(r["errors"])) for r in found.collect()) == [("a b.py", "one", 0), ("d.md", "two", 1)]
    assert tuple(markers.marker_counts(found).collect()[0]) == (2, 1)
    assert sorted('"id":"two"' in r["value"] for r in markers.marker_json(found).collect()) == [False, True]


def test_replies_and_prompts(spark):
    from inkloom.functions import text

    assert "me, " in text.caption_prompt("me", "rich") != text.caption_prompt("me", "optimal")
    with pytest.raises(ValueError):
        text.caption_prompt("me", "odd")
    from pyspark.sql import functions as F

    lines = ["caching latents: 50%|###| 50/100 [00:01<00:02, 30it/s]", "epoch 2/9 5/6 [avr_loss=1]", "10/20 [x, avr_loss=0.25]", "10/20 [x, avr_loss=nan]", "avr_loss=1"]
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, l string").select("i", text.training_progress(F.col("l")).alias("p")).orderBy("i").select("p.*").collect()
    assert [tuple(r) for r in rows] == [(None,) * 5, (None, None, 2, 9, None), (10, 20, None, None, 0.25), (10, 20, None, None, None), (None,) * 5]
