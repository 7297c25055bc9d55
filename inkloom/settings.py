"""Plan parameters: typed, read from ``APP_`` variables, checked whenever they are made or changed."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from typing import Any

#: Bounds of numeric settings: least, whether it is allowed itself, and most (fixed values).
BOUNDS: dict[str, tuple[float, bool, float | None]] = {
    "dataset_repeats": (1, True, None),
    "vlm_concurrency": (1, True, None),
    "min_panel_area": (0, True, None),
    "panel_border": (0, True, None),
    "max_panels": (1, True, None),
    "splash_area_ratio": (0.0, False, 1.0),
    "dedup_hamming_distance": (0, True, None),
    "min_side_px": (1, True, None),
    "target_side": (1, True, None),
    "bubble_confidence": (0.0, True, 1.0),
    "mask_dilation_px": (0, True, None),
    "max_mask_coverage": (0.0, False, 1.0),
    "caption_threshold": (0.0, True, 1.0),
    "train_network_dim": (1, True, None),
    "train_network_alpha": (1, True, None),
    "train_learning_rate": (0.0, False, None),
    "train_max_train_steps": (1, True, None),
    "train_resolution": (64, True, None),
    "train_batch_size": (1, True, None),
    "train_seed": (0, True, None),
    "train_save_every_n_epochs": (0, True, None),
    "train_clip_skip": (1, True, None),
    "train_flux_blocks_to_swap": (0, True, 35),
}


@dataclass(frozen=True)
class Settings:
    """Defaults are those of a fresh workspace."""

    workspace: str = "workspace"
    trigger_token: str = "comicstyle"
    dataset_repeats: int = 10
    hf_token: str = ""
    vlm_url: str = ""
    vlm_model: str = "gemini-2.5-flash"
    vlm_prompt_style: str = "rich"
    vlm_concurrency: int = 8
    min_panel_area: int = 10_000
    panel_border: int = 8
    max_panels: int = 12
    splash_area_ratio: float = 0.85
    panel_resplit: bool = True
    dedup_hamming_distance: int = 6
    min_side_px: int = 256
    target_side: int = 1024
    bubble_confidence: float = 0.5
    ocr_languages: str = "en"
    mask_dilation_px: int = 10
    max_mask_coverage: float = 0.6
    bubbles_debug: bool = False
    inpaint_backend: str = "lama"
    clean_denoise: bool = False
    caption_backend: str = "wd14"
    caption_threshold: float = 0.35
    train_model_type: str = "sd15"
    train_base_model: str = ""
    train_sd_scripts_dir: str = ""
    train_python: str = ""
    train_network_dim: int = 32
    train_network_alpha: int = 16
    train_learning_rate: float = 1e-4
    train_max_train_steps: int = 1600
    train_resolution: int = 512
    train_batch_size: int = 1
    train_seed: int = 42
    train_mixed_precision: str = "fp16"
    train_gradient_checkpointing: bool = True
    train_cache_latents: bool = True
    train_output_name: str = ""
    train_optimizer_type: str = "AdamW8bit"
    train_lr_scheduler: str = "constant"
    train_save_every_n_epochs: int = 1
    train_logging_dir: str | None = None
    train_clip_skip: int = 2
    train_unet_only: bool = True
    train_text_encoder_lr: float | None = None
    train_flux_clip_l: str = ""
    train_flux_t5xxl: str = ""
    train_flux_ae: str = ""
    train_flux_blocks_to_swap: int = 18
    run_panels: bool = True
    run_bubbles: bool = True
    run_inpaint: bool = True
    run_clean: bool = True
    run_caption: bool = True
    run_train: bool = False

    def __post_init__(self) -> None:
        for name, (least, allowed, most) in BOUNDS.items():
            value = getattr(self, name)
            if value < least or value == least and not allowed or most is not None and value > most:
                raise ValueError(f"{name}={value!r} is out of range")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        """Settings of ``APP_<NAME>`` variables, and of ``HF_TOKEN``; unknown ones are ignored. Without ``env`` those of an
        ``.env`` file in the working folder count too, where the environment doesn't have them."""
        env = {**read_env(".env"), **os.environ} if env is None else env
        given = {k.upper(): v for k, v in env.items()}
        if "HF_TOKEN" in given:
            given.setdefault("APP_HF_TOKEN", given["HF_TOKEN"])
        return cls(**{f.name: _parse(str(f.type), given[key]) for f in fields(cls) if (key := f"APP_{f.name.upper()}") in given})

    def having(self, **changes: Any) -> Settings:
        """A changed copy, checked like any other."""
        return replace(self, **changes)


def read_env(path: str) -> dict[str, str]:
    """``KEY=value`` lines of a file; comments and blank lines are passed over, quotes around a value taken off."""
    if not os.path.isfile(path):
        return {}
    out = {}
    with open(path, encoding="utf-8") as f:
        for line in f:
            key, sign, value = line.strip().removeprefix("export ").partition("=")
            if sign and not key.startswith("#"):
                value = value.strip()
                out[key.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def _parse(kind: str, text: str) -> Any:
    if kind.startswith("bool"):
        value = text.strip().lower()
        if value not in {"1", "true", "yes", "on", "0", "false", "no", "off"}:
            raise ValueError(f"{text!r} is not a truth value")
        return value in {"1", "true", "yes", "on"}
    if "None" in kind and not text:
        return None
    return int(text) if kind.startswith("int") else float(text) if kind.startswith("float") else text


def wizard_settings(base: Settings, trigger: str, repeats: float) -> Settings:
    """What a form asks for: a blank trigger keeps the base's, repeats are cut to a whole number of at least one."""
    return base.having(trigger_token=trigger.strip() or base.trigger_token, dataset_repeats=max(1, int(repeats)))


def training_settings(base: Settings, model_type: str, steps: float, learning_rate: float) -> Settings:
    """As ``wizard_settings`` for training: steps are at least one, a learning rate of zero or less keeps the base's."""
    rate = learning_rate if learning_rate > 0 else base.train_learning_rate
    return base.having(train_model_type=model_type.strip().lower(), train_max_train_steps=max(1, int(steps)), train_learning_rate=rate)
