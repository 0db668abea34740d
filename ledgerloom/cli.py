"""Command line: update, convert, check."""

from __future__ import annotations

import argparse
import logging
import sys
import zipfile
from datetime import datetime
from pathlib import Path

from .errors import DateAxisError, UpdateError
from .operators import checks, quality  # noqa: F401 - the checks of a module are known once it is imported
from .plans.results import UpdateResult
from .session import session
from .sources import layout


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerloom")
    top.add_argument("--log-dir", default="logs")
    commands = top.add_subparsers(dest="command", required=True)
    up = commands.add_parser("update", help="merge a delivery into the history")
    up.add_argument("--delivery", required=True)
    up.add_argument("--data", default="data/full")
    up.add_argument("--rtol", type=float, default=1e-7)
    up.add_argument("--atol", type=float, default=1e-7)
    for flag in ("--dry-run", "--verbose", "--trusted-pickle"):
        up.add_argument(flag, action="store_true")
    co = commands.add_parser("convert", help="write changed sources as canonical Parquet")
    co.add_argument("--input", default="data/full")
    co.add_argument("--output", default="data/out")
    co.add_argument("--part", choices=("all", "regular", "minute"), default="all")
    co.add_argument("--workers", type=int, default=None, help="minute files read at once at most")
    for flag in ("--overwrite", "--copy-other", "--dry-run"):
        co.add_argument(flag, action="store_true")
    ch = commands.add_parser("check", help="run a quality check").add_subparsers(dest="name", required=True)
    for name in checks.names():
        one = ch.add_parser(name, help=checks.about(name))
        one.add_argument("--input", default="data/full")
        for p in checks.parameters(name):
            one.add_argument("--" + p.name.replace("_", "-"), type=p.type, default=p.default, help=f"{p.help} (default {p.default})")
    return top


def show(result: UpdateResult) -> None:
    for level, text in result.issues:
        logging.log(logging.ERROR if level == "error" else logging.WARNING, text)


def ask(result: UpdateResult) -> bool:
    """The issues come before the question: the answer is a judgement on them."""
    show(result)
    while True:
        try:
            answer = input("Commit? [y/N] ").strip().lower()
        except (EOFError, KeyboardInterrupt):
            return False
        if answer in ("y", "yes"):
            return True
        if answer in ("", "n", "no"):
            return False


def configure_logging(folder: str, name: str, verbose: bool = False, tag: str | None = None) -> Path | None:
    """Console and a new file for each run, the file always with debug records; ``tag`` marks its name. An unwritable
    folder only costs the file."""
    path = Path(folder) / f"{name}_{datetime.now():%Y%m%d_%H%M%S_%f}{f'_{tag}' if tag else ''}.log"
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    handlers[0].setLevel(logging.DEBUG if verbose else logging.INFO)
    try:
        path.parent.mkdir(parents=True, exist_ok=True)
        handlers.append(logging.FileHandler(path, encoding="utf-8"))
    except OSError as e:
        print(f"no log file: {e}", file=sys.stderr)
        path = None
    logging.getLogger("py4j").setLevel(logging.WARNING)
    logging.basicConfig(level=logging.DEBUG, handlers=handlers, force=True, format="%(asctime)s %(levelname)s %(message)s")
    return path


def _update(args: argparse.Namespace) -> int:
    from .plans.update import Tolerance, UpdateConfig, update_dataset

    config = UpdateConfig(Path(args.data), layout.delivery_dir(args.delivery), Tolerance(args.rtol, args.atol), args.trusted_pickle, args.dry_run)
    asked: list[bool] = []
    result = update_dataset(session("ledgerloom update"), config, lambda found: asked.append(True) or ask(found))
    if not asked:
        show(result)
    logging.info(result.summary())
    return 2 if result.errors else 0


def _convert(args: argparse.Namespace) -> int:
    from .plans.convert import ConversionConfig, convert_dataset

    config = ConversionConfig(Path(args.input), Path(args.output), args.part, args.overwrite, args.copy_other, args.dry_run, workers=args.workers)
    logging.info(convert_dataset(session("ledgerloom convert"), config).summary())
    return 0


def _check(args: argparse.Namespace) -> int:
    from .sources.daily import load_day

    context = checks.Context(session("ledgerloom check"), Path(args.input), load_day)
    print(checks.run(args.name, context, **{p.name: getattr(args, p.name) for p in checks.parameters(args.name)}))
    return 0


def main(arguments: list[str] | None = None) -> int:
    """0, or 2 where the data or the arguments don't allow what was asked for: one line says why."""
    args = parser().parse_args(arguments)
    configure_logging(args.log_dir, args.command, getattr(args, "verbose", False), "dryrun" if getattr(args, "dry_run", False) else None)
    logging.info("arguments: %s", vars(args))
    try:
        return {"update": _update, "convert": _convert, "check": _check}[args.command](args)
    except (UpdateError, DateAxisError, ValueError, FileNotFoundError, zipfile.BadZipFile) as e:
        logging.error("%s stops: %s", args.command, e)
        return 2


if __name__ == "__main__":
    sys.exit(main())
