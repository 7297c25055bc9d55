"""A trainer's command line and data set file, from settings alone."""

from __future__ import annotations

import json
import os
import shlex
import subprocess
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from inkloom.settings import Settings

#: Script and network module of each model family (fixed values).
FAMILIES = {
    "sd15": ("train_network.py", "networks.lora"),
    "sdxl": ("sdxl_train_network.py", "networks.lora"),
    "flux": ("flux_train_network.py", "networks.lora_flux"),
}
#: Arguments of each setting that is passed on as it is (fixed values).
PLAIN = (
    ("pretrained_model_name_or_path", "train_base_model"),
    ("max_train_steps", "train_max_train_steps"),
    ("network_dim", "train_network_dim"),
    ("network_alpha", "train_network_alpha"),
    ("learning_rate", "train_learning_rate"),
    ("train_batch_size", "train_batch_size"),
    ("resolution", "train_resolution"),
    ("mixed_precision", "train_mixed_precision"),
    ("seed", "train_seed"),
    ("optimizer_type", "train_optimizer_type"),
    ("lr_scheduler", "train_lr_scheduler"),
)
CACHED_TEXT = ("--cache_text_encoder_outputs", "--cache_text_encoder_outputs_to_disk")


@dataclass(frozen=True)
class TrainPlan:
    command: tuple[str, ...]
    cwd: str
    output_path: str


def family(settings: Settings) -> str:
    name = settings.train_model_type.strip().lower()
    if name not in FAMILIES:
        raise NotImplementedError(f"model type {name!r} is none of {', '.join(FAMILIES)}")
    return name


def bucket_limit(name: str) -> int:
    return 1024 if name == "sd15" else 1536


#: The data set file (keys and fixed values of the trainer's format).
DATASET = """[general]
caption_extension = '.txt'
shuffle_caption = false
keep_tokens = 1

[[datasets]]
resolution = {resolution}
batch_size = {batch_size}
enable_bucket = true
min_bucket_reso = 256
max_bucket_reso = {most}
bucket_no_upscale = true
bucket_reso_steps = {steps}

  [[datasets.subsets]]
  image_dir = '{image_dir}'
  num_repeats = {repeats}
"""


def dataset_file(image_dir: str, repeats: int, resolution: int, batch_size: int, most: int, steps: int = 64) -> str:
    """The data set as TOML: captions in ``.txt`` files, the first tag kept in its place."""
    return DATASET.format(image_dir=image_dir, repeats=repeats, resolution=resolution, batch_size=batch_size, most=most, steps=steps)


def arguments(settings: Settings, config: str, output_dir: str, output_name: str) -> list[str]:
    """The trainer's arguments; an unknown family, or a missing base model or part, is an error."""
    name = family(settings)
    if not settings.train_base_model:
        raise ValueError("train_base_model is not set")
    parts = {k: getattr(settings, f"train_flux_{k}") for k in ("clip_l", "t5xxl", "ae")} if name == "flux" else {}
    if missing := [f"APP_TRAIN_FLUX_{k.upper()}" for k, v in parts.items() if not v]:
        raise ValueError(f"not set: {', '.join(missing)}")
    valued = {"network_module": FAMILIES[name][1], "output_dir": output_dir, "output_name": output_name, "dataset_config": config, "save_model_as": "safetensors"}
    valued |= {k: getattr(settings, v) for k, v in PLAIN}
    flags = ["--sdpa"]
    if settings.train_gradient_checkpointing:
        flags.append("--gradient_checkpointing")
    if settings.train_cache_latents:
        flags += ["--cache_latents", "--cache_latents_to_disk"]
    if settings.train_save_every_n_epochs:
        valued["save_every_n_epochs"] = settings.train_save_every_n_epochs
    if settings.train_logging_dir is not None:
        valued |= {"logging_dir": settings.train_logging_dir, "log_with": "tensorboard"}
    if name == "sd15":
        valued["clip_skip"] = settings.train_clip_skip
    elif name == "sdxl":
        flags.append("--no_half_vae")
        if settings.train_unet_only:
            flags += ["--network_train_unet_only", *CACHED_TEXT]
        elif settings.train_text_encoder_lr is not None:
            flags += ["--text_encoder_lr", *[str(settings.train_text_encoder_lr)] * 2]
    else:
        valued |= parts | {"guidance_scale": 1.0, "timestep_sampling": "flux_shift", "model_prediction_type": "raw"}
        flags += ["--network_train_unet_only", "--fp8_base", *(CACHED_TEXT if settings.train_cache_latents else ())]
        if settings.train_flux_blocks_to_swap:
            valued["blocks_to_swap"] = settings.train_flux_blocks_to_swap
    return [f"--{k}={v}" for k, v in valued.items()] + flags


def plan(settings: Settings, config: str, output_dir: str) -> TrainPlan:
    """What to launch, where, and the file it leaves; the trigger names it unless a name is set."""
    name = settings.train_output_name.strip() or settings.trigger_token
    python = settings.train_python or f"{settings.train_sd_scripts_dir}/venv/bin/python"
    one = {"num_processes": 1, "num_machines": 1, "num_cpu_threads_per_process": 1, "mixed_precision": settings.train_mixed_precision, "dynamo_backend": "no"}
    launch = [python, "-m", "accelerate.commands.launch", *[str(x) for k, v in one.items() for x in (f"--{k}", v)]]
    return TrainPlan((*launch, FAMILIES[family(settings)][0], *arguments(settings, config, output_dir, name)), settings.train_sd_scripts_dir, f"{output_dir}/{name}.safetensors")


def launch(plan: TrainPlan, tell: Callable[[str], None] = print, start: Callable[..., Any] = subprocess.Popen) -> str:
    """Runs a plan, tells each line of its log, and gives the file it left. A trainer that fails, or leaves no file, or
    doesn't say that the model was saved, is an error."""
    process = start(list(plan.command), cwd=plan.cwd or None, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, text=True)
    saved = False
    for line in process.stdout:
        saved = saved or "model saved." in line
        tell(line.rstrip())
    if code := process.wait():
        raise RuntimeError(f"training failed (exit {code}): {shlex.join(plan.command)}")
    if not saved or not os.path.isfile(plan.output_path) or not os.path.getsize(plan.output_path):
        raise RuntimeError(f"training ended but {plan.output_path} is missing or empty")
    return plan.output_path


def run_metadata(status: str, reason: str, started: float, ended: float, images: int, output: str | None) -> dict[str, Any]:
    """What a training run leaves on record: state, reason, numbers, and the file's size and tensors."""
    there = output is not None and os.path.isfile(output)
    return {"status": status, "reason": reason, "images": images, "seconds": round(ended - started), "output": output, "bytes": os.path.getsize(output) if there else 0, "tensors": tensor_count(output) if there else 0}


def tensor_count(path: str) -> int:
    """Tensors of a weights file, by its header: eight bytes of length, then JSON."""
    with open(path, "rb") as f:
        size = int.from_bytes(f.read(8), "little")
        try:
            return sum(k != "__metadata__" for k in json.loads(f.read(min(size, 100_000_000))))
        except ValueError:
            return 0
