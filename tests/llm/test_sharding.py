import zlib

import numpy as np
import pytest

from binlens.llm import sharding as S


@pytest.mark.parametrize("n", [1, 2, 3, 5, 40, 41, 99, 1000, 4097])
def test_permutation(n):
    p = S.permute(np.arange(n), n)
    assert sorted(p.tolist()) == list(range(n))
    assert [int(S.permute(np.array([i]), n)[0]) for i in range(0, n, 17)] == p[::17].tolist()
    if n > 900:
        assert abs(np.corrcoef(p, np.arange(n))[0, 1]) < 0.1 and (S.permute(np.arange(n), n, 1) != p).mean() > 0.9


def test_whole_table(spark, tmp_path, odd_docs):
    path = str(tmp_path / "docs")
    odd_docs.unionByName(odd_docs).repartition(5).write.parquet(path)
    table = spark.read.parquet(path)
    got = S.shuffle_into_shards(table).collect()
    want = sorted((r.doc_id if r.doc_id is not None else -1, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in table.collect())
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in got) == want
    places = sorted(r.slot * 40 + r.shard for r in got)
    assert places == list(range(len(got))) and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    again = S.shuffle_into_shards(spark.read.parquet(path)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    few = S.shuffle_into_shards(table, shards=3).groupBy("shard").count().collect()
    assert max(r["count"] for r in few) - min(r["count"] for r in few) <= 1


def test_empty_table(spark, tmp_path, odd_docs):
    path = str(tmp_path / "none")
    odd_docs.where("false").write.parquet(path)
    assert S.shuffle_into_shards(spark.read.parquet(path)).count() == 0
