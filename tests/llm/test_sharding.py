import hashlib
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from conftest import TABLES
from sojourn.llm import sharding
from sojourn.llm.queries import QUERIES
from sojourn.llm.sharding import interleave


def brute_force(rows, shards, seed=17):
    strata = defaultdict(list)
    for d, text, source in rows:
        raw = (text or "").encode()
        draw = hashlib.md5(f"{seed}:{d}".encode()).hexdigest()
        strata[source].append((draw, d, zlib.crc32(raw), len(raw) + 16))
    placed = sorted(
        (float(Fraction(2 * k + 1, 2 * len(own))), source is None, source or "", row)
        for source, own in strata.items()
        for k, row in enumerate(sorted(own))
    )
    out = []
    seen = Counter()
    for place, (_, _, _, (_, d, crc, size)) in enumerate(placed):
        shard = place * shards // len(placed)
        out.append((d, size, crc, "rows", shard, seen[shard], None))
        seen[shard] += 1
    return sorted(out)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op8_sharding"](spark, TABLES).collect())) == brute_force(rows, 40)


def test_shards_match_the_mixture_with_a_hot_source(spark):
    rows = [(k, "t" * (k % 7), "hot" if k % 3 else None if k % 5 == 0 else f"s{k % 4}") for k in range(1003)]
    got = interleave(spark.createDataFrame(rows, "doc_id long, text string, source string"), 10).collect()
    assert sorted(map(tuple, got)) == brute_force(rows, 10)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    source = {d: s for d, _, s in rows}
    for s, total in Counter(source.values()).items():
        share = Counter(r.shard for r in got if source[r.doc_id] == s)
        assert all(abs(share[k] - total / 10) <= 1 + len(set(source.values())) for k in range(10))


@pytest.mark.parametrize("rows_per_bucket, digits", [(1, 1), (17, 2), (400, 3)])
def test_buckets_do_not_show(spark, monkeypatch, rows_per_bucket, digits):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", rows_per_bucket)
    monkeypatch.setattr(sharding, "BUCKET_DIGITS", digits)
    rows = [(k // 2, "t" * (k % 7), "hot" if k % 3 else None if k % 5 == 0 else f"s{k % 11}") for k in range(601)]
    got = interleave(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), 7).collect()
    assert sorted(map(tuple, got)) == brute_force(rows, 7)


def test_odd_tables(spark):
    schema = "doc_id long, text string, source string, size string, place string, total string, rank string"
    rows = [(1, None, None), (1, None, None), (2, "é", ""), (3, "x" * 500_000, "a")]
    got = interleave(spark.createDataFrame([(*r, "", "", "", "") for r in rows], schema), 40).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == [(1, 16, 0), (1, 16, 0), (2, 18, zlib.crc32("é".encode())), (3, 500_016, zlib.crc32(b"x" * 500_000))]
    assert [r.slot for r in got] == [0] * 4 and len({r.shard for r in got}) == 4
    assert interleave(spark.createDataFrame([], schema)).collect() == []
