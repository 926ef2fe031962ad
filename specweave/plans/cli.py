"""Command line: ``run PATH --out DIR``, ``stages``, ``config``.  Exit codes: 0 done, 2 wrong use or settings, 3 a stage failed."""

from __future__ import annotations

import argparse
import json
import logging
import sys

from specweave import config
from specweave.plans.pipeline import STAGES, StageError, run_pipeline
from specweave.session import local_session
from specweave.sources.files import blocks_of_files, read_files, unread
from specweave.sources.lexicons import Lexicon


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="specweave")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="run the pipeline over files")
    run.add_argument("path")
    run.add_argument("--out", required=True)
    run.add_argument("--config")
    run.add_argument("--resume", action="store_true")
    run.add_argument("--resume-from")
    stages = commands.add_parser("stages", help="list the stages")
    stages.add_argument("--json", action="store_true")
    show = commands.add_parser("config", help="show the settings and their hash")
    show.add_argument("--config")
    return parser


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    try:
        args = _parser().parse_args(argv)
    except SystemExit as stop:
        return int(stop.code or 0)
    if args.command == "stages":
        rows = [{"stage": s.name, "needs": s.needs, "makes": s.makes} for s in STAGES]
        print(json.dumps(rows, indent=2) if args.json else "\n".join(f"{r['stage']}: {', '.join(r['needs'])} -> {', '.join(r['makes'])}" for r in rows))
        return 0
    try:
        settings = config.load(path=args.config)
    except (OSError, ValueError) as wrong:
        print(wrong, file=sys.stderr)
        return 2
    if args.command == "config":
        print(json.dumps({"settings": settings, "hash": config.fingerprint(settings, Lexicon())}, indent=2))
        return 0
    try:
        spark = local_session()
        files = read_files(spark, args.path)
        left = unread(files)
        left.write.mode("overwrite").json(f"{args.out}/unread")
        for row in left.limit(20).collect():  # the whole list is in the output folder
            print(f"not read: {row.file_name} ({row.why})", file=sys.stderr)
        done = run_pipeline(blocks_of_files(files), args.out, settings, resume=args.resume, resume_from=args.resume_from)
    except StageError as failed:
        print(failed, file=sys.stderr)
        return 3
    print(json.dumps(done.records, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
