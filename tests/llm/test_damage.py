"""Damaged archives are errors, and the mix comes as near to its targets as its documents allow."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from placaflow.llm import mixing, warc


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc"))
    rng = np.random.default_rng(5)
    rows = [(i, f"u{i}", rng.bytes(3000).hex()) for i in range(9)]
    df = spark.createDataFrame(rows, "k long, u string, h string").coalesce(1)
    (row,) = warc.write_warc(df, "k", "u", "h", "file:" + folder).collect()
    return row["path"], row["bytes"]


def _records(path, size, split):
    return [r for at in range(0, size, split) for r in warc.read_range(path, at, min(at + split, size), size)]


@pytest.mark.parametrize("split", [700, 3500, 10_000, 1 << 20])
def test_every_damaged_or_cut_member_raises(archive, tmp_path, split):
    path, size = archive
    assert sorted(int(r[0]) for r in _records(path, size, split)) == list(range(9))
    data = open(path.removeprefix("file:"), "rb").read()
    starts = [i for i in range(size) if data.startswith(warc.MAGIC, i) and warc._member(_window(data), i)]
    assert len(starts) == 9
    for number, start in enumerate(starts):
        damaged = bytearray(data)
        damaged[start + 200] ^= 1
        copy = tmp_path / f"{number}.warc.gz"
        copy.write_bytes(damaged)
        with pytest.raises(warc.Damaged):
            _records(f"file:{copy}", size, split)
    for cut in (size - 40, starts[-1], starts[4] + 10):
        copy.write_bytes(data[:cut])
        with pytest.raises(warc.Damaged):
            _records(f"file:{copy}", size, split)
        if cut not in starts:
            with pytest.raises(warc.Damaged):
                _records(f"file:{copy}", cut, split)


def _window(data):
    import pyarrow as pa

    return warc._Window(pa.BufferReader(data), 0, len(data), len(data))


def test_mix_fills_past_a_document_of_a_third_of_its_source(spark):
    rng = np.random.default_rng(7)
    rows = []
    for source in ("a", "b", "c", None):
        sizes = rng.integers(5, 60, 300).tolist()
        rows += [(source, s) for s in [*sizes, sum(sizes) * 3 // 7]]
    rows = [(i, s, n) for i, (s, n) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, source string, words long")
    plan = mixing.mix_plan(df, "doc_id", "source", F.col("words")).toPandas()
    plan["taken"] = plan["size"] * plan.placements.map(len)
    sums = plan.fillna({"source": "-"}).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert len(sums) == 4 and (abs(sums.taken - sums.target) <= 60).all()
