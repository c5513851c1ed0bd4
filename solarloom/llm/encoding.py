"""Problem 8: encoding of the whole corpus with a public tokenizer.

Pieces are counted over the corpus; the frequent ones are merged once and
compiled into a minimal acyclic transducer (``automaton``), which workers
memory-map from the shared folder; pieces outside it are merged exactly where
they occur, so the lexicon's size changes speed and never a result.

Defined results: null, and empty texts have the empty list of ids.  Marker
strings in a text are ordinary text; no special tokens are added.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .automaton import Lexicon, build, dumps

#: Most pieces in the lexicon, and the least count of one.
LEXICON_SIZE, LEAST_COUNT = 100_000, 3
#: Pieces that a worker remembers.
REMEMBERED = 300_000
#: Longer pieces never enter the lexicon.
LONGEST = 64


def piece_counts(texts: DataFrame) -> DataFrame:
    """``piece, n`` over the column ``text``, counted inside each batch first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = bpe.splitter().findall
        for b in batches:
            seen: Counter = Counter()
            for t in b.column(0).to_pylist():
                if t:
                    seen.update(find(t))
            rows = [(p, n) for p, n in seen.items() if len(p) <= LONGEST]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["piece", "n"])

    return texts.select("text").mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def frequent_pieces(texts: DataFrame, size: int = LEXICON_SIZE, least: int = LEAST_COUNT) -> list[str]:
    """The most frequent pieces, at most ``size`` (the bound of the lexicon)."""
    rows = piece_counts(texts).filter(F.col("n") >= least).orderBy(F.desc("n"), "piece").limit(size)
    return [r[0] for r in rows.select("piece").collect()]


def compile_lexicon(pieces: list[str], path: str = bpe.DEFAULT_PATH) -> bytes:
    rank = bpe.ranks(path)
    words = [p.encode("utf-8") for p in pieces]
    return dumps(build(words, [bpe.merge(w, rank) for w in words]))


def shared(spark: SparkSession, data: bytes) -> str | bytes:
    """Path of the data in the session's shared folder where that is a file
    system that workers can map; else the data, which travel with the task."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder or "://" in folder and not folder.startswith("file://"):
        return data
    local = folder.removeprefix("file://")
    os.makedirs(local, exist_ok=True)
    name = os.path.join(local, f"lexicon-{uuid.uuid4().hex}.bin")
    with open(name + ".part", "wb") as f:
        f.write(data)
    os.replace(name + ".part", name)
    return name


class Encoder:
    """Ids of texts; remembers pieces, asks the lexicon, else merges."""

    def __init__(self, lexicon: Lexicon | None, path: str = bpe.DEFAULT_PATH):
        self.lexicon, self.rank, self.find = lexicon, bpe.ranks(path), bpe.splitter().findall
        self.known: dict[str, list[int]] = {}

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their offsets."""
        pieces = [self.find(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set(chain.from_iterable(pieces)).difference(self.known))
        raw = [p.encode("utf-8") for p in new]
        numbers = self.lexicon.numbers(raw).tolist() if self.lexicon else [-1] * len(new)
        for p, w, k in zip(new, raw, numbers):
            self.known[p] = self.lexicon.ids_of(k) if k >= 0 else bpe.merge(w, self.rank)
        ids = [list(chain.from_iterable(map(self.known.__getitem__, p))) for p in pieces]
        offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
        return np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1])), offsets


_ENCODERS: dict = {}


def encoder(lexicon: str | bytes | None, path: str) -> Encoder:
    """One encoder per worker and lexicon."""
    key = lexicon if isinstance(lexicon, str) or lexicon is None else (len(lexicon), hash(lexicon))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Lexicon(lexicon) if lexicon else None, path)
    return _ENCODERS[key]


def encoded(documents: DataFrame, keys: list[str], path: str = bpe.DEFAULT_PATH, only_sizes: bool = False, size: int = LEXICON_SIZE) -> DataFrame:
    """``keys`` with ``ids`` (or ``n_tokens``) of the column ``text``."""
    spark = documents.sparkSession
    lexicon = shared(spark, compile_lexicon(frequent_pieces(documents, size), path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(lexicon, path)
        for b in batches:
            text = b.column(b.num_columns - 1)
            for at in range(0, max(1, b.num_rows), 500):
                part = b.slice(at, 500)
                ids, offsets = e.encode(text.slice(at, 500).to_pylist())
                out = pa.array(np.diff(offsets).astype(np.int64)) if only_sizes else pa.ListArray.from_arrays(offsets, pa.array(ids))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(b.num_columns - 1)), out], [*keys, "n_tokens" if only_sizes else "ids"])

    rows = documents.select(*keys, "text")
    kinds = ", ".join(f"{k} {t}" for k, t in rows.dtypes[:-1])
    return rows.mapInArrow(run, f"{kinds}, " + ("n_tokens long" if only_sizes else "ids array<int>"))
