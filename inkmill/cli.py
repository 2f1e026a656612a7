"""Command line: ``python -m inkmill.cli clean BOOK.epub`` and ``python -m inkmill.cli slice BOOK.txt``."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from inkmill.plans.config import CONFIG_DIR, load_cleaning, load_providers, load_slicing
from inkmill.plans.single_book import SliceRunError, clean_file, slice_file
from inkmill.sources.lines import count_non_empty_lines


class Progress:
    """A bar on stderr, by slices where their number is limited, else by lines."""

    WIDTH = 30

    def __init__(self, max_slices: int | None, lines: int | None):
        self.goal = max_slices or lines or 1
        self.by_slices = max_slices is not None

    def __call__(self, slices: int, line: int, total: int) -> None:
        done = min(1.0, (slices if self.by_slices else line) / self.goal)
        bar = "#" * int(done * self.WIDTH)
        print(f"\r[{bar:<{self.WIDTH}}] {done:4.0%} slices {slices}", end="", file=sys.stderr, flush=True)

    def finish(self) -> None:
        print(file=sys.stderr)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="inkmill")
    commands = top.add_subparsers(dest="command", required=True)
    clean = commands.add_parser("clean", help="e-book to clean text, one paragraph a line")
    clean.add_argument("epub")
    clean.add_argument("-o", "--out")
    clean.add_argument("--extracted-out", help="also write the log of rule hits, as JSON lines")
    cut = commands.add_parser("slice", help="clean text to slices")
    cut.add_argument("txt")
    cut.add_argument("--max-slices", type=int, default=0, help="0: no limit")
    cut.add_argument("--out-dir")
    cut.add_argument("--llm-config", default=str(CONFIG_DIR / "llm.json"))
    cut.add_argument("--slice-config", default=str(CONFIG_DIR / "slice.json"))
    cut.add_argument("--dry-run", action="store_true", help="cut by length alone, without a model")
    return top


def main(argv: list[str] | None = None) -> int:
    top = parser()
    args = top.parse_args(argv)
    if args.command == "slice":
        if args.max_slices < 0:
            top.error("--max-slices must be >= 0")
        for path in (args.llm_config, args.slice_config):
            if not Path(path).exists():
                top.error(f"config not found: {path}")
        providers, options = load_providers(args.llm_config), load_slicing(args.slice_config)
    spark = SparkSession.builder.appName("inkmill").getOrCreate()
    if args.command == "clean":
        rules, headings = load_cleaning()
        out = args.out or Path("book") / f"{Path(args.epub).stem}.txt"
        print(clean_file(spark, args.epub, rules, headings, out, args.extracted_out))
        return 0
    limit = args.max_slices or None
    progress = Progress(limit, None if limit else count_non_empty_lines(spark, args.txt))
    try:
        print(slice_file(spark, args.txt, providers, options, args.out_dir, limit, args.dry_run, progress))
    except SliceRunError as e:
        print(e.out_path)
        return 2
    finally:
        progress.finish()
    return 0


if __name__ == "__main__":
    sys.exit(main())
