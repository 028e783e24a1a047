"""The analysis from the command line: ``python -m chatloom --db a.db --script script.yaml --folder out``."""

from __future__ import annotations

import argparse
import importlib
import json
from collections.abc import Callable
from pathlib import Path

from .functions.text import vocabulary_tokens
from .plans.analysis import Analysis, Settings, asking
from .session import session


def named(name: str) -> Callable[[str, str], str]:
    """A function from instructions and a question to a text, as ``module:function``."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="chatloom", description=__doc__)
    for name in ("db", "script"):
        p.add_argument(f"--{name}", type=Path, required=True)
    p.add_argument("--folder", required=True, help="where tables, report and manifests go; any path that Spark reaches")
    for name in ("config", "labels", "phones"):
        p.add_argument(f"--{name}", type=Path)
    p.add_argument("--chat-limit", type=int)
    p.add_argument("--budget", type=float)
    p.add_argument("--stage", type=int)
    p.add_argument("--from", dest="first", type=int, default=1)
    p.add_argument("--to", dest="last", type=int)
    p.add_argument("--force", action="store_true", help="run stages again whose inputs are as they were")
    p.add_argument("--restart", action="store_true", help="forget all stages first")
    p.add_argument("--dry-run", action="store_true", help="only say which stages would run")
    p.add_argument("--data", help="folder of tables (FOLDER/data)")
    p.add_argument("--output", help="folder of the report and its tables (FOLDER/output)")
    p.add_argument("--prompts", type=Path, help="folder of instructions, one file a task")
    p.add_argument("--ask", action="append", type=named, default=[], metavar="MODULE:FUNCTION", help="what answers questions; further ones are asked when those before fail")
    p.add_argument("--vocabulary", type=Path, help="vocabulary file that counts the tokens of transcripts")
    p.add_argument("--sample", metavar="FOLDER", help="after the stages: write chats out for people to judge")
    p.add_argument("--compare", metavar="CSV", help="after the stages: compare outcomes with those that people found")
    p.add_argument("--master")
    a = p.parse_args(argv)
    if a.phones and a.chat_limit is not None:
        p.error("--phones and --chat-limit exclude each other")
    if a.ask and not a.prompts:
        p.error("--ask needs --prompts")
    settings = Settings.load(a.db, a.script, a.folder, config=a.config, phones=a.phones, labels=a.labels, chat_limit=a.chat_limit, budget=a.budget, prompts=a.prompts, data_folder=a.data, output_folder=a.output)
    spark = session(a.master)
    more = {"tokens": vocabulary_tokens(str(a.vocabulary))} if a.vocabulary else {}
    analysis = asking(spark, settings, a.ask, **more) if a.ask else Analysis(spark, settings, **more)
    runner = analysis.runner()
    if a.dry_run:
        print(json.dumps([s.name for s in runner.chosen(a.first, a.last, a.force or a.restart, a.stage)]))
        return 0
    if a.restart:
        runner.restart()
    done = runner.run(a.first, a.last, force=a.force, only=a.stage)
    if a.sample:
        done["sample"] = analysis.sample_for_truth(a.sample)
    if a.compare:
        done["compared"] = analysis.compared(a.compare)
    print(json.dumps(done, ensure_ascii=False, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
