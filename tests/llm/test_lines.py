"""The steps of the line deduplication that bound its work."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from vigilseries.llm import lines, regions


def test_keys_are_shuffled_packed():
    texts = [f"line {i} of {i * i} words and no other" for i in range(3000)]
    batch = pa.record_batch([pa.array(range(3000), pa.int64()), pa.array(texts)], ["line", "text"])
    packs = pa.Table.from_batches(list(lines._bander(iter([batch, batch]))))
    assert packs.column_names == ["bucket", "pairs"] and packs.num_rows <= 1 << lines.BUCKET_BITS
    pairs = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in packs.column("pairs").to_pylist()]
    for bucket, part in zip(packs.column("bucket").to_pylist(), pairs, strict=True):
        assert (part[:, 0] >> (lines.KEY_BITS - lines.BUCKET_BITS) == bucket).all()
    assert np.array_equal(np.sort(np.concatenate(pairs)[:, 1]), np.repeat(np.arange(3000), 2 * lines.BANDS))


@pytest.mark.parametrize("held", [1, 40, 1 << 18])
def test_neighbours_join_all_lines_of_a_key(monkeypatch, held):
    """However few pairs are looked at at once, a key's lines hang together and no others do."""
    monkeypatch.setattr(lines, "HELD", held)
    rng = random.Random(held)
    shift = lines.KEY_BITS - lines.BUCKET_BITS
    rows = [((rng.randrange(3) << shift) + rng.randrange(40), rng.randrange(-60, 60)) for _ in range(700)] + [(1 << shift, 7)] * 3
    packs = [(b, [x for x in part if x[0] >> shift == b]) for part in (rows[k: k + 50] for k in range(0, len(rows), 50)) for b in range(3)]
    packs = sorted((p for p in packs if p[1]), key=lambda p: p[0])
    batches = [pa.record_batch([pa.array([b for b, _ in some], pa.int32()), pa.array([np.array(p, np.int64).tobytes() for _, p in some], pa.binary())],
                               ["bucket", "pairs"]) for some in (packs[k: k + 2] for k in range(0, len(packs), 2))]
    found = pa.Table.from_batches(list(lines._neighbours(iter([*batches, batches[0].slice(0, 0)]))))
    expected, group = defaultdict(set), {}
    for key, line in rows:
        expected[key].add(line)
        group[key, line] = {line}
    for key, a, b in zip(*(found.column(c).to_pylist() for c in ("key", "a", "b")), strict=True):
        assert a != b
        joined = group[key, a] | group[key, b]
        for x in joined:
            group[key, x] = joined
    assert all(group[key, line] == expected[key] for key, line in rows)


def test_equal_regions_are_looked_at_once(spark):
    rows = [(x, region, 1 if x == 1 else 2) for region in ("p", "q", "r") for x in (1, 2, 3)]
    rows += [(x, "s", 2) for x in (2, 3)] + [(x, "t", x) for x in (1, 4, 5)] + [(x, "u", x) for x in (1, 4)]
    rows += [(x, "v", x) for x in (4, 4, 1, 5)] + [(x, "w", x) for x in (1, 1, 4, 5)]  # a repeated id counts
    held = spark.createDataFrame(rows, "id long, region string, component long")
    assert sorted(map(tuple, regions.mixed_regions(held, 2).select("region", "size").collect())) == [("p", 3), ("t", 3), ("u", 2), ("v", 4), ("w", 4)]
    assert sorted(r["region"] for r in regions.mixed_regions(held, 3).collect()) == ["p", "t", "v", "w"]


@pytest.mark.parametrize("few", [-1, 10**6])
def test_links_one_by_one_and_by_bit_rows(monkeypatch, few):
    monkeypatch.setattr(regions, "FEW", few)
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 40, size)).astype(np.uint64) for size in rng.integers(1, 120, 30)]
    comp = rng.integers(0, 4, 30)
    def similar(x, y):
        return 100 * len({*x.tolist()} & {*y.tolist()}) >= 75 * len({*x.tolist()} | {*y.tolist()})
    expected = [(i, j) for i in range(30) for j in range(i + 1, 30) if comp[i] != comp[j] and similar(sets[i], sets[j])]
    assert expected and [(int(i), int(j)) for i, j in zip(*regions._linked(sets, comp, 75), strict=True)] == expected


def test_lines_are_trimmed_like_strip(spark):
    texts = ["a b", " a", "a ", "\ta\r", "a \t\r ", " \t", " a ", "é ", " é", "a\r\n b \n\n\t\n語 語", "\x0ba\x0b", "\n", ""]
    found = lines._lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text").select("id", "no", "text")
    expected = [(i, k, x.strip(" \t\r")) for i, text in enumerate(texts) for k, x in enumerate(text.split("\n")) if x.strip(" \t\r")]
    assert sorted(map(tuple, found.collect())) == expected
