"""Control tables and files of the ingest: registry, run logs, watermark,
mappings, versions, stages, locks.

Data stays in Spark tables; these hold a few rows a run and lie in the same
shared folder as the tables, on whatever file system it is.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import re
import time

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import RUN_ID
from .shared import copy, inside, move, names_in, read_bytes, read_text, remove, write_text

# The registry's columns.
REGISTRY = (
    "dataset string, source_file_hash string, source_file string, run_id string, status string, rows_long bigint, "
    "files_written int, archived_path string, mapping_filename string, mapping_file_hash string, ingested_at_utc string, message string"
)


def new_run_id(now: dt.datetime, file_hash: str = "") -> str:
    """Sorts by time; two files of one second differ by the file's hash."""
    return now.strftime("%Y%m%dT%H%M%SZ") + (f"-{file_hash[:8]}" if file_hash else "")


def existing(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A Parquet table, None where there is none yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


class Registry:
    """Append-only, typed table of file events."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def append(self, rows: list[dict]) -> None:
        names = [c.split()[0] for c in REGISTRY.split(", ")]
        self.spark.createDataFrame([[r.get(n) for n in names] for r in rows], REGISTRY).coalesce(1).write.mode("append").parquet(self.folder)

    def rows(self) -> DataFrame:
        found = existing(self.spark, self.folder, REGISTRY)
        return self.spark.createDataFrame([], REGISTRY) if found is None else found

    def unseen(self, files: DataFrame) -> DataFrame:
        """Files whose content was not ingested yet; a rejected file may come again."""
        done = self.rows().filter("status = 'ingested'").select("source_file_hash")
        return files.join(done, "source_file_hash", "left_anti")


def write_run_log(folder: str, run_id: str, **facts) -> str:
    """One JSON file a run, as ``sources.files.run_logs`` reads them."""
    path = f"{folder.rstrip('/')}/run_{run_id}.json"
    write_text(path, json.dumps({"run_id": run_id, **facts}, default=str))
    return path


class Watermark:
    """The greatest run processed so far, replaced atomically and never moved back."""

    def __init__(self, path: str):
        self.path = path

    def get(self) -> str | None:
        return (read_text(self.path) or "").strip() or None

    def commit(self, run_ids: list[str]) -> str | None:
        top = max([r for r in [self.get(), *run_ids] if r], default=None)
        if top and top != self.get():
            write_text(self.path, top)
        return top


class Lock:
    """One writer at a time: a file that only one process can create.

    Waits ``patience_s`` seconds; a lock older than ``stale_s`` was left by a
    process that died and is taken over."""

    def __init__(self, spark: SparkSession, path: str, patience_s: float = 0.0, stale_s: float = 3600.0):
        self.path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.at = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.patience_s, self.stale_s = patience_s, stale_s

    def _taken(self) -> bool:
        try:
            return bool(self.at.createNewFile(self.path))
        except Exception as e:  # Hadoop tells a taken name either way
            if "FileAlreadyExists" in str(e):
                return False
            raise

    def __enter__(self) -> Lock:
        end = time.monotonic() + self.patience_s
        while not self._taken():
            if self.at.exists(self.path) and time.time() - self.at.getFileStatus(self.path).getModificationTime() / 1000 > self.stale_s:
                self.at.delete(self.path, False)
                continue
            if time.monotonic() >= end:
                raise TimeoutError(f"{self.path} is held by another writer")
            time.sleep(0.2)
        return self

    def __exit__(self, *_) -> None:
        self.at.delete(self.path, False)


def next_version(folder: str, stem: str, extension: str = "") -> str:
    """``stem_vNNN`` with the next free number, for files and folders."""
    taken = [int(m[1]) for n in names_in(folder) if (m := re.fullmatch(rf"{re.escape(stem)}_v(\d+){re.escape(extension)}", n))]
    return os.path.join(folder, f"{stem}_v{max(taken, default=0) + 1:03d}{extension}")


class Mappings:
    """Versions of the header mapping in a folder, and the one in force.

    A version is a CSV file ``mapping_vNNN.csv`` of original and clean names;
    ``current.json`` names the active one with its content hash."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def current(self) -> tuple[str, str] | None:
        """Path and hash of the active version; None before the first.  A file
        that was altered since raises."""
        pointer = read_text(f"{self.folder}/current.json")
        if pointer is None:
            return None
        about = json.loads(pointer)
        path = f"{self.folder}/{about['file']}"
        if self.hash_of(path) != about["sha256"]:
            raise ValueError(f"{path} was altered after it became current")
        return path, about["sha256"]

    @staticmethod
    def hash_of(path: str) -> str:
        data = read_bytes(path)
        if data is None:
            raise FileNotFoundError(path)
        return hashlib.sha256(data).hexdigest()

    def _versions(self) -> list[str]:
        return [n for n in names_in(self.folder) if re.fullmatch(r"mapping_v\d+\.csv", n)]

    def names(self) -> dict[str, str]:
        """Original to clean names over all versions; later versions hold."""
        import csv

        out: dict[str, str] = {}
        for n in self._versions():
            rows = list(csv.reader((read_text(f"{self.folder}/{n}") or "").splitlines()))
            out |= {r[0]: r[1] for r in rows[1:] if len(r) == 2}
        return out

    def update(self, headers: list[str], clean) -> tuple[str, bool]:
        """Union of all versions with new headers (``clean`` names a list of
        them); a new version is written, and becomes current, only if something
        changed.  The current path, and whether it is new."""
        import csv
        import io

        known = self.names()
        new = [h for h in dict.fromkeys(headers) if h not in known]
        current = self.current()
        if not new and current:
            return current[0], False
        merged = known | dict(zip(new, clean(new)))
        text = io.StringIO()
        out = csv.writer(text, lineterminator="\n")
        out.writerows([("original", "sanitized"), *merged.items()])
        path = next_version(self.folder, "mapping", ".csv")
        write_text(path, text.getvalue())
        self.point_to(os.path.basename(path))
        return path, True

    def point_to(self, name: str) -> None:
        write_text(f"{self.folder}/current.json", json.dumps({"file": name, "sha256": self.hash_of(f"{self.folder}/{name}")}))


def beyond_retention(names: list[str], keep: int | None) -> list[str]:
    """Stages (names sort by run) that go when the last ``keep`` stay; None keeps all."""
    return [] if keep is None else sorted(names)[: max(0, len(names) - keep)]


def write_stage(df: DataFrame, folder: str, run_id: str, keep: int | None = None) -> list[str]:
    """Write the stage of a run, then remove stages beyond retention (their names)."""
    folder = folder.rstrip("/")
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/run_id={run_id}")
    gone = beyond_retention([n for n in names_in(folder) if n.startswith("run_id=")], keep)
    for n in gone:
        remove(inside(folder, f"{folder}/{n}"))
    return gone


def reset(root: str, *parts: str, backup: str | None = None) -> list[str]:
    """Remove parts (tables, registry, watermark) below a root, and nothing
    else; with ``backup`` they are moved there instead.  What was there."""
    paths = [inside(root, f"{root.rstrip('/')}/{p}") for p in parts]
    there = [p for p in paths if os.path.basename(p) in names_in(os.path.dirname(p))]
    for p in there:
        if backup:
            move(p, f"{backup.rstrip('/')}/{os.path.basename(p)}")
        else:
            remove(p)
    return there


def filed(path: str, folder: str, day: dt.date, file_hash: str = "", reason: str = "") -> str:
    """Move a file that was ingested, seen before or rejected to its dated
    folder; the name tells its hash and the reason (``name__reason``)."""
    stem, extension = os.path.splitext(os.path.basename(path))
    slug = re.sub("[^a-z0-9]+", "_", reason.lower()).strip("_")
    name = "__".join(p for p in (stem, slug) if p) + (f"_{file_hash[:8]}" if file_hash else "") + extension
    return move(path, f"{folder.rstrip('/')}/year={day.year}/month={day.month:02d}/day={day.day:02d}/{name}")


def restored(path: str, inbox: str) -> str:
    """Copy a rejected file back to the inbox under its name before the reason."""
    stem, extension = os.path.splitext(os.path.basename(path))
    return copy(path, f"{inbox.rstrip('/')}/{stem.split('__')[0]}{extension}")


def write_with_sidecar(df: DataFrame, path: str, **facts) -> None:
    """A small report as one CSV file, with a JSON file of facts beside it;
    an empty report writes nothing."""
    if df.isEmpty():
        return
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    write_text(path.rstrip("/") + ".meta.json", json.dumps(facts, indent=1, default=str))


def markdown(df: DataFrame, title: str, most_rows: int = 1000) -> str:
    """A report table; what is beyond ``most_rows`` is named, not hidden."""
    rows = df.limit(most_rows + 1).collect()
    text = lambda v: "" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v)
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines += ["| " + " | ".join(map(text, r)) + " |" for r in rows[:most_rows]]
    return "\n".join(lines + ([f"\nMore than {most_rows} rows."] if len(rows) > most_rows else [])) + "\n"
