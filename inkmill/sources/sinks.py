"""Where results go: distributed tables, and the small files of a single book."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Partitioned by book, in any of Spark's formats; null fields are left out of JSON."""
    writer = df.write.mode("overwrite").partitionBy("book_id")
    (writer.option("ignoreNullFields", "true") if form == "json" else writer).format(form).save(path)


def write_text(lines: DataFrame, path: str | Path) -> Path:
    """Lines of one book in one file, each ended by a line feed; no lines give a single one."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    n = 0
    with path.open("w", encoding="utf-8", newline="\n") as f:
        for n, r in enumerate(lines.orderBy("line_no").select("text").toLocalIterator(), 1):
            f.write(r["text"] + "\n")
        if not n:
            f.write("\n")
    return path


def write_extracted(extracted: DataFrame, path: str | Path) -> Path:
    """The rule log of one book as JSON lines of bucket, rule and text."""
    path = Path(path)
    with path.open("w", encoding="utf-8", newline="\n") as f:
        for r in extracted.orderBy("para_no", "match_no").select("bucket", "rule", "text").toLocalIterator():
            f.write(json.dumps(r.asDict(), ensure_ascii=False) + "\n")
    return path


def books_as_json(slices: DataFrame) -> DataFrame:
    """(book_id, json): the slices of each book as one JSON array, for many books at once."""
    fields = [c for c in slices.columns if c not in ("book_id", "provider", "model")]
    one = F.struct(*fields)
    return slices.groupBy("book_id").agg(F.to_json(F.array_sort(F.collect_list(one)), {"ignoreNullFields": "true"}).alias("json"))


def write_slices(slices: Iterable[dict], path: str | Path) -> Iterator[dict]:
    """Write slices to a JSON array as they come, without null fields, and pass each on."""
    with Path(path).open("w", encoding="utf-8", newline="\n") as f:
        f.write("[")
        for n, s in enumerate(slices):
            held = {k: v for k, v in s.items() if v is not None and k not in ("book_id", "provider", "model")}
            body = json.dumps(held, ensure_ascii=False, indent=2).replace("\n", "\n  ")
            f.write(("," if n else "") + "\n  " + body)
            f.flush()
            yield s
        f.write("\n]\n")


def write_run(meta: dict, path: str | Path) -> None:
    Path(path).write_text(json.dumps(meta, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")


def timestamp_dir(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
