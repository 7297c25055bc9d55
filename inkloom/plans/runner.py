"""Stages as tables in a workspace: completion marks, single and full runs, progress, summary."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.functions import text
from inkloom.operators import dataset
from inkloom.plans import stages, training
from inkloom.settings import Settings
from inkloom.sources import service, sinks
from inkloom.sources.images import list_images, read_images
from inkloom.sources.tables import materialize

MARK = ".stage_complete"


@dataclass(frozen=True)
class Workspace:
    """Folders under one root; a stage's table is a Parquet folder."""

    root: str

    def pages(self) -> str:
        return f"{self.root}/00_pages"

    def table(self, name: str) -> str:
        return f"{self.root}/{FOLDERS[name]}"

    def quarantine(self, stage: str) -> str:
        return f"{self.root}/manual_review/.rows/stage={stage}"

    def dataset(self, settings: Settings) -> str:
        """The trainer's folder, of image and caption files."""
        return f"{self.root}/05_dataset/{settings.dataset_repeats}_{settings.trigger_token}"

    def dataset_rows(self, settings: Settings) -> str:
        return f"{self.root}/05_dataset/.rows/{settings.dataset_repeats}_{settings.trigger_token}"

    def review(self) -> str:
        return f"{self.root}/manual_review"


#: Folder of each stage's output (fixed values).
FOLDERS = {"panels": "01_panels", "bubbles": "02_masks", "inpaint": "03_inpainted", "clean": "04_clean", "caption": "05_dataset", "train": "06_lora"}


@dataclass
class Context:
    """What stages need; models are callables and default to ones that need no weights."""

    spark: SparkSession
    workspace: Workspace
    settings: Settings
    detect_bubbles: Callable = field(default=lambda image: [])
    detect_text: Callable = field(default=lambda image: [])
    paint: Callable | None = None
    tag: Callable = field(default=lambda image: [])
    vocabulary: list[tuple[str, bool]] = field(default_factory=list)
    launch: Callable[[training.TrainPlan], str] = training.launch

    def read(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(self.workspace.table(stage))


@dataclass(frozen=True)
class Result:
    name: str
    produced: int = 0
    skipped: bool = False
    reason: str = ""


@dataclass(frozen=True)
class Progress:
    index: int
    total: int
    name: str
    phase: str
    produced: int = 0
    detail: str = ""

    @property
    def fraction(self) -> float:
        return 1.0 if self.total <= 0 else (self.index - 1 + (self.phase != "running")) / self.total


def _panels(c: Context):
    return stages.panels_stage(read_images(c.spark, c.workspace.pages()), c.settings)


def _bubbles(c: Context):
    return stages.bubbles_stage(c.read("panels"), c.settings, c.detect_bubbles, c.detect_text)


def _inpaint(c: Context):
    return stages.inpaint_stage(c.read("panels"), c.read("bubbles"), c.paint or stages.backend(stages.PAINTERS, c.settings.inpaint_backend, "painter"))


def _clean(c: Context):
    return stages.clean_stage(c.read("inpaint"), c.settings)


def _caption(c: Context):
    return stages.caption_stage(c.read("clean"), c.settings, c.tag, c.vocabulary)


def _train(c: Context):
    """Writes the data set file and launches the trainer; its table tells where the weights are."""
    s, out = c.settings, c.workspace.table("train")
    if not _exists(c.spark, f"{output_of('caption', c)}/{MARK}"):
        raise RuntimeError("there is no captioned set to train on")
    sinks.make_folder(c.spark, out)
    config = f"{out}/dataset.toml"
    sinks.put_text(c.spark, config, training.dataset_file(c.workspace.dataset(s), s.dataset_repeats, s.train_resolution, s.train_batch_size, training.bucket_limit(training.family(s))))
    made = c.launch(training.plan(s, config, out))
    return c.spark.createDataFrame([(made,)], "path string"), c.spark.createDataFrame([], stages.NONE_ASIDE)


#: Stages in their order, each with the setting that enables it.
STAGES: tuple[tuple[str, str, Callable[[Context], tuple[DataFrame, DataFrame]]], ...] = (
    ("panels", "run_panels", _panels),
    ("bubbles", "run_bubbles", _bubbles),
    ("inpaint", "run_inpaint", _inpaint),
    ("clean", "run_clean", _clean),
    ("caption", "run_caption", _caption),
    ("train", "run_train", _train),
)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def output_of(name: str, c: Context) -> str:
    """A stage's table; the captioned set's has repeats and trigger in its name, so a new trigger is a new run."""
    return c.workspace.dataset_rows(c.settings) if name == "caption" else f"{c.workspace.table(name)}/runs" if name == "train" else c.workspace.table(name)


def run_stage(name: str, c: Context, force: bool = False) -> Result:
    """Run a stage unless its output is marked complete. A forced run overwrites, stale rows and files do not stay.

    What is set aside is a table, and as files, with the reason, in ``manual_review``; the captioned set is also written
    as the files that a trainer reads.
    """
    make = next(f for n, _, f in STAGES if n == name)
    out = output_of(name, c)
    if not force and _exists(c.spark, f"{out}/{MARK}"):
        return Result(name, skipped=True, reason="already complete")
    c.spark.sparkContext.setJobDescription(f"stage {name}")
    rows, aside = make(c)
    rows.write.mode("overwrite").parquet(out)
    aside.write.mode("overwrite").parquet(c.workspace.quarantine(name))
    _show_aside(name, c)
    done = c.spark.read.parquet(out)
    if name == "caption":
        sinks.delete(c.spark, c.workspace.dataset(c.settings))
        sinks.write_dataset(done, f"{c.workspace.root}/05_dataset", c.settings.dataset_repeats, c.settings.trigger_token)
    if name == "bubbles" and c.settings.bubbles_debug:
        tinted = stages.overlays(c.read("panels"), done).withColumn("stem", F.concat("stem", F.lit("_overlay")))
        sinks.write_files(sinks.png_rows(tinted), c.workspace.review())
    sinks.put_text(c.spark, f"{out}/{MARK}", name)
    return Result(name, produced=done.count())


def _show_aside(name: str, c: Context) -> None:
    """The originals of what a stage set aside, and a note with the reason, as files to look at."""
    aside, folder = c.spark.read.parquet(c.workspace.quarantine(name)), c.workspace.review()
    if aside.isEmpty():
        return
    sinks.write_quarantine(aside, folder)
    if name == "panels":
        files = list_images(c.spark, c.workspace.pages()).withColumn("stem", text.stem(F.col("path")))
        sinks.copy_files(files.join(aside, "stem", "left_semi"), folder)
    else:
        before = c.read({"bubbles": "panels", "clean": "inpaint"}[name])
        sinks.write_files(sinks.png_rows(before.join(aside, "stem", "left_semi")), folder)


def promote(c: Context, names: Sequence[str]) -> int:
    """Adds chosen images of ``manual_review`` to the clean set, takes them and their notes away from there, and has the
    captions made anew by the next run. The clean stage is not run again, as that would drop them."""
    folder = c.workspace.review()
    wanted = c.spark.createDataFrame([(n,) for n in names], "name string")
    found = read_images(c.spark, folder)
    made = stages.promote(found, wanted, c.settings).select(F.col("stem"), F.lit(None).cast("bigint").alias("phash"), "height", "width", "data", F.lit(True).alias("upscaled"))
    gone = [(r["path"], r["stem"]) for r in dataset.chosen(found.select("path", "stem", F.col("data").isNotNull().alias("good")), wanted).where("good").select("path", "stem").collect()]
    if not gone:
        return 0
    made.write.mode("append").parquet(c.workspace.table("clean"))
    for path, stem in gone:  # picked by hand, so few
        sinks.delete(c.spark, path)
        sinks.delete(c.spark, f"{folder}/{stem}.reason.txt")
    sinks.delete(c.spark, f"{output_of('caption', c)}/{MARK}")
    return len(gone)


def recaption(c: Context, style: str | None = None, ask: Callable[[bytes], dict] | None = None, retries: int = 5, pause: float = 2.0) -> dict:
    """Captions of the trainer's files made anew by a service: written, failed, and the first errors in file order. Without
    a token or a data set that is told, not raised."""
    s, folder = c.settings, c.workspace.dataset(c.settings)
    if not s.hf_token and ask is None:
        return {"written": 0, "failed": 0, "errors": ["no token: set HF_TOKEN"]}
    if not _exists(c.spark, folder):
        return {"written": 0, "failed": 0, "errors": [f"no data set yet ({folder.rsplit('/', 1)[-1]}): run the stages first"]}
    if ask is None:
        ask = service.Service(s.vlm_url, s.hf_token, s.vlm_model, text.caption_prompt(s.trigger_token, style or s.vlm_prompt_style))
    done = materialize(stages.recaption_folder(c.spark, folder, ask, s.trigger_token, retries, pause, s.vlm_concurrency))
    good = done.where("error is null")
    sinks.write_files(good.select(F.concat("stem", F.lit(".txt")).alias("name"), F.concat("caption", F.lit("\n")).alias("content")), folder)
    told = done.withColumn("said", F.when(F.col("error").isNotNull(), F.concat("name", F.lit(": "), "error"))).withColumn("all", F.lit(0))
    got = dataset.recaption_result(told, ["all"], "ord", "said").collect()
    return {"written": got[0]["written"], "failed": got[0]["failed"], "errors": list(got[0]["errors"])} if got else {"written": 0, "failed": 0, "errors": []}


def run_all(c: Context, force: bool = False, run: Callable[..., Result] = run_stage) -> list[Result]:
    """All enabled stages in order; an error ends the run and is raised."""
    return [run(name, c, force=force) for name, flag, _ in STAGES if getattr(c.settings, flag)]


def progress(c: Context, force: bool = False, run: Callable[..., Result] = run_stage) -> Iterator[Progress]:
    """As ``run_all``, told step by step: running, then done, skipped or error; an error ends it."""
    total = len(STAGES)
    for i, (name, flag, _) in enumerate(STAGES, 1):
        if not getattr(c.settings, flag):
            yield Progress(i, total, name, "skipped", detail=f"disabled by {flag}")
            continue
        yield Progress(i, total, name, "running")
        try:
            result = run(name, c, force=force)
        except Exception as e:
            yield Progress(i, total, name, "error", detail=str(e) or type(e).__name__)
            return
        yield Progress(i, total, name, "skipped", detail=result.reason) if result.skipped else Progress(i, total, name, "done", result.produced)


def summary(c: Context) -> DataFrame:
    """``(label, n)``: what each folder holds now."""
    empty = c.spark.range(0)
    paths = {FOLDERS[n]: output_of(n, c) for n, _, _ in STAGES}
    tables = {"00_pages": read_images(c.spark, c.workspace.pages())} | {k: c.spark.read.parquet(p) if _exists(c.spark, f"{p}/{MARK}") else empty for k, p in paths.items()}
    aside = [c.spark.read.parquet(p).select("stem") for n, _, _ in STAGES if _exists(c.spark, p := c.workspace.quarantine(n))]
    return dataset.run_summary(tables | {"manual_review": reduce(DataFrame.unionByName, aside) if aside else empty})
