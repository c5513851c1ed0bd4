import datetime as dt
import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from solarloom.llm import history, suffix
from solarloom.llm.suffix import RangeMin, SuffixArray, suffix_keys

TOL = 0.001
VALUES = [0.0, 1.0, 1.0005, 1.002, -1.0, -1.0005, 50.0]
RECORDS = st.lists(st.tuples(st.tuples(*[st.integers(-2, 2)] * 3), st.sampled_from(VALUES), st.integers(0, 12)), max_size=30)


def arrays(records):
    return np.array([r[0] for r in records], np.int64).reshape(-1, 3), np.array([r[1] for r in records], float), np.array([f"r{r[2]:02d}".encode() for r in records] or [b""])[: len(records)]


@given(st.lists(RECORDS, min_size=1, max_size=4), RECORDS)
@settings(max_examples=100, deadline=None)
def test_search_and_merge_against_brute_force(tmp_path_factory, batches, queries):
    folder = str(tmp_path_factory.mktemp("sa"))
    parts = []
    for i, b in enumerate(batches):
        words, value, run = arrays(b)
        SuffixArray.of(suffix_keys(words, value), run).write(f"{folder}/{i:06d}.0.sa")
        parts.append(suffix.read(f"{folder}/{i:06d}.0.sa"))
    chunks, runs = suffix.merged(parts, step=3)
    suffix._write(f"{folder}/000009.0.sa", chunks, runs)
    whole = suffix.read(suffix.files_of(folder, {9})[0])
    records = [r for b in batches for r in b]
    assert len(whole) == len({r[:2] for r in records}) and list(whole.keys) == sorted(whole.keys)
    words, value, _ = arrays(queries)
    got, covered = whole.earliest(words, value, TOL), whole.covered(suffix_keys(words, value))
    for i, (w, v, _) in enumerate(queries):
        like = [r for x, u, r in records if x == w and abs(u - v) <= TOL * max(abs(u), abs(v))]
        assert got[i] == (f"r{min(like):02d}".encode() if like else b"")
        common = [next((k for k in range(3) if x[k] != w[k]), 3) for x, _, _ in records]
        assert covered[i] == pytest.approx(max(common, default=0) / 3)


def test_a_search_reads_some_pages_of_a_mapped_file(tmp_path):
    """What a small batch reads grows with the logarithm of the history only."""
    path, n = str(tmp_path / "000001.0.sa"), 2_000_000
    words = np.repeat(np.arange(n)[:, None], 3, axis=1)
    SuffixArray(suffix_keys(words, np.zeros(n)), np.zeros(n, np.int32), np.array([b"r"])).write(path)
    array = suffix.read(path)
    assert isinstance(array.keys, np.memmap) and array.earliest(words[[5, n // 3, n - 1]], np.zeros(3), TOL).tolist() == [b"r"] * 3
    resident = lambda: sum(int(line.split()[1]) for line in block(path) if line.startswith("Rss:"))
    assert resident() * 1024 < os.path.getsize(path) / 2  # the kernel maps neighbours of a probed page as well


def block(path):
    """Lines of the process's map of a file."""
    inside = False
    for line in open("/proc/self/smaps"):
        if "-" in line.split()[0] and ":" not in line.split()[0]:
            inside = line.rstrip().endswith(path)
        if inside:
            yield line


def test_range_minimum():
    v = np.array([5, 3, 8, 1, 9])
    pairs = [(a, b) for a in range(6) for b in range(a + 1, 6)]
    got = RangeMin(v).query(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    assert [v[a:b].min() for a, b in pairs] == got.tolist()


def row(key, run, value=250.0, ts="2024-05-02 00:00:00", park="p_100_kwp_x", signal="pcc_active_energy_export", unit="kwh", day=dt.date(2024, 5, 1)):
    return {"ingest_key": key, "run_id": run, "value": value, "ts_local": ts, "park_id": park, "signal_name": signal, "unit": unit, "interval_start_date": day, "park_capacity_kwp": 100.0}


def test_repeats(silver, meta):
    rows = [
        row("a", "r1"), row("a", "r1"), row("a", "r2"), row("b", "r2", 250.1), row("c", "r3", 251.0), row("d", "r4", 0.25, unit="MWh"), row("e", "r3", ts="2024-05-01T21:00:00Z"),
        row("f", "r1", float("nan")), row("f", "r5", float("nan")), row("g", "r6", None), row("h", "r6", None), row("i", "r2", park="q_100_kwp_x"), row("j", "r3", park=None), row("k", "r4", park=None),
        row(None, "r9"), row("l", None), row("m", "r1", ts="2024-05-03 00:00:00", day=dt.date(2024, 5, 2)), row("n", "r0", 0.0, ts="2024-05-04 00:00:00", day=dt.date(2024, 5, 3)), row("o", "r2", 0.0, ts="2024-05-04 00:00:00", day=dt.date(2024, 5, 3)),
        row("x" * 3000, "r1", 1.0, ts="no time"), row("x" * 3000, "r2", 1.0, ts="no time"),
    ]
    got = sorted(tuple(r) for r in history.repeats(silver(rows, extra=("w1", "w2", "since", "key", "cell")), meta([])).collect())
    assert got == sorted([("a", "r2"), ("b", "r2"), ("d", "r4"), ("e", "r3"), ("f", "r5"), ("o", "r2"), ("x" * 3000, "r2")])


def test_a_hot_reading_and_small_buckets(silver, meta, monkeypatch):
    monkeypatch.setattr(history, "ROWS", 20)
    monkeypatch.setattr(history, "HOT", 40)
    rows = [row(f"k{i}", f"r{i:03d}", 100.0 * 1.0004 ** (i % 40)) for i in range(200)]
    got = {tuple(r) for r in history.repeats(silver(rows), meta([])).collect()}
    want = set()
    for i, r in enumerate(rows):
        if any(abs(q["value"] - r["value"]) <= TOL * max(q["value"], r["value"]) for q in rows[:i]):
            want.add((r["ingest_key"], r["run_id"]))
    assert got == want


def accepted(kept, spark, silver, meta, batches):
    """Batches one by one, the history resumed from its state each time."""
    got = set()
    for rows in batches:
        got |= {tuple(r) for r in kept.accept(silver(rows), meta([])).collect()}
        kept = history.AcceptedHistory(spark, kept.folder, kept.shards, kept.live)
    return got, kept


@pytest.mark.parametrize("hot", [10**6, 8])
def test_batches_as_they_come(spark, silver, meta, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(history, "HOT", hot)
    monkeypatch.setattr(history, "ROWS", min(hot, 60_000) // 2)
    rng = np.random.default_rng(5)
    rows = [row(f"k{rng.integers(60)}", f"r{run:02d}", float(rng.choice([100.0, 100.05, 102.0])), f"2024-0{m}-02 00:00:00", day=dt.date(2024, m, 1)) for run in range(9) for m in rng.integers(1, 5, 12).tolist()]
    rows = list({(r["ingest_key"], r["run_id"]): r for r in rows}.values())
    batches = [[r for r in rows if f"r{a:02d}" <= r["run_id"] < f"r{b:02d}"] for a, b in ((0, 1), (1, 4), (4, 5), (5, 9))]
    got, kept = accepted(history.AcceptedHistory(spark, str(tmp_path), 3), spark, silver, meta, batches)
    want = set()
    for r in rows:
        like = lambda q: q["ingest_key"] == r["ingest_key"] or (q["ts_local"] == r["ts_local"] and abs(q["value"] - r["value"]) <= TOL * max(q["value"], r["value"]))  # noqa: E731, B023
        if any(q["run_id"] < r["run_id"] and like(q) for q in rows):
            want.add((r["ingest_key"], r["run_id"]))
    assert got == want and got
    assert got == {tuple(r) for r in history.repeats(silver(rows), meta([])).collect()}
    files = [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".sa")]
    assert len(kept.live) == 1 and {int(f.split(".")[0]) for f in files} == {n for n, _ in kept.live}


def test_a_copy_booked_on_another_day_is_found(spark, silver, meta, tmp_path):
    """Links that partitions by booking date would lose."""
    other = {"day": dt.date(2024, 4, 30)}
    batches = [[row("x", "r1", **other), row("z", "r1", ts="2024-06-02 00:00:00", day=dt.date(2024, 6, 1))], [row("y", "r2"), row("z", "r2", ts="2024-06-02 00:00:00", day=None)], []]
    got, _ = accepted(history.AcceptedHistory(spark, str(tmp_path), 5), spark, silver, meta, batches)
    assert got == {("y", "r2"), ("z", "r2")} == {tuple(r) for r in history.repeats(silver(sum(batches, [])), meta([])).collect()}


def test_empty(silver, meta):
    assert history.repeats(silver([]), meta([])).count() == 0
    assert history.repeats(silver([{}, {}]), meta([])).count() == 0
