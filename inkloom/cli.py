"""Command line: init, doctor, one command per stage, run-all, recaption, promote, summary."""

from __future__ import annotations

import argparse
import importlib.metadata
import importlib.util
import os
import shutil
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from inkloom.functions.text import IMAGE_SUFFIXES, PROMPT_STYLES
from inkloom.plans import runner
from inkloom.settings import Settings


def initialise(root: str) -> list[str]:
    """Make the workspace's folders and an ``.env`` to start from; what is there is left alone."""
    made = []
    for folder in (root, f"{root}/00_pages", f"{root}/manual_review"):
        if not Path(folder).is_dir():
            Path(folder).mkdir(parents=True)
            made.append(folder)
    env = Path(root, ".env")
    if not env.exists():
        env.write_text(f"APP_WORKSPACE={root}\n")
        made.append(str(env))
    return made


def checks(root: str, settings: Settings | None = None) -> list[tuple[str, bool, str]]:
    """What a run needs: ``(name, ok, detail)``. Models and the token are told but not needed by every run."""
    settings = settings or Settings()
    pages = Path(root, "00_pages")
    found = sum(p.suffix.lower().lstrip(".") in IMAGE_SUFFIXES for p in pages.iterdir()) if pages.is_dir() else 0
    free = shutil.disk_usage(root if Path(root).is_dir() else ".").free / 1e9
    java = shutil.which("java") or os.environ.get("JAVA_HOME", "")
    rows = [
        ("python", sys.version_info >= (3, 11), sys.version.split()[0]),
        ("workspace", Path(root).is_dir(), root),
        ("pages", found > 0, f"{found} images"),
        ("disk", free >= 1, f"{free:.0f} GB free"),
        ("java", bool(java), java or "not found"),
        ("trigger", bool(settings.trigger_token.strip()), settings.trigger_token),
    ]
    for name in ("pyspark", "pyarrow", "pandas", "numpy"):
        there = importlib.util.find_spec(name) is not None
        rows.append((name, there, importlib.metadata.version(name) if there else "not installed"))
    if settings.run_train:
        rows += [("base model", bool(settings.train_base_model), settings.train_base_model or "not set"), ("trainer", Path(settings.train_sd_scripts_dir or "-").is_dir(), settings.train_sd_scripts_dir or "not set")]
    return rows


def report(rows: list[tuple[str, bool, str]]) -> str:
    wide = max((len(n) for n, _, _ in rows), default=0)
    lines = [f"{'ok  ' if ok else 'MISS'} {name:<{wide}} {detail}" for name, ok, detail in rows]
    return "\n".join([*lines, "all good" if all(ok for _, ok, _ in rows) else "not ready"])


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="inkloom", description=__doc__)
    names = [n for n, _, _ in runner.STAGES]
    parser.add_argument("command", choices=["init", "doctor", "run-all", "recaption", "promote", "summary", *names])
    parser.add_argument("names", nargs="*", help="of the images to promote")
    parser.add_argument("--style", choices=sorted(PROMPT_STYLES))
    parser.add_argument("--workspace")
    parser.add_argument("--force", action="store_true")
    args = parser.parse_args(argv)
    settings = Settings.from_env()
    root = args.workspace or settings.workspace
    if args.command == "init":
        print("\n".join(initialise(root)) or "nothing to do")
        return 0
    if args.command == "doctor":
        rows = checks(root, settings)
        print(report(rows))
        return int(not all(ok for _, ok, _ in rows))
    spark = SparkSession.builder.appName("inkloom").getOrCreate()
    context = runner.Context(spark, runner.Workspace(root), settings)
    try:
        if args.command == "summary":
            runner.summary(context).show(truncate=False)
        elif args.command == "recaption":
            got = runner.recaption(context, args.style)
            print("\n".join([f"written {got['written']}, failed {got['failed']}", *got["errors"]]))
            return int(got["failed"] > 0 or not got["written"])
        elif args.command == "promote":
            print(f"{runner.promote(context, args.names)} promoted")
        elif args.command == "run-all":
            for r in runner.run_all(context, args.force):
                print(f"{r.name}: {r.reason or f'{r.produced} produced'}")
        else:
            r = runner.run_stage(args.command, context, args.force)
            print(f"{r.name}: {r.reason or f'{r.produced} produced'}")
    except (ValueError, RuntimeError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
