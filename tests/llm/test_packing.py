import zlib
from collections import defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from binlens.llm import packing as P
from binlens.llm.queries import tokenizer_path

JSON = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_are_those_of_the_tokenizer_file(documents):
    texts = [r.text for r in documents.limit(120).collect()] + [
        "", "\n", " a", "a  b", "x\n\ny", "don't we'll 12\nété <|endoftext|>", "hi <|endoftext|> there", "<|endoftext|><|endoftext|>\n<|endoftext",  "日本語 テスト　x 🙂", "a\tb\r\nc \n d", "a\0b"]
    ranks, plain = P.encoder(tokenizer_path()), Tokenizer.from_file(JSON)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ranks(t) for t in texts] == want and [P.encoder(JSON)(t) for t in texts] == want
    assert ranks("hi <|endoftext|> there") == [5303, 220, 50256, 612]


@given(st.lists(st.integers(1, 12), max_size=6))
@settings(max_examples=60, deadline=None)
def test_bound_and_bins_around_the_optimum(lengths):
    sizes = np.array(lengths, np.int64)
    bins, offsets, n = P.best_fit_decreasing(sizes, 12)
    filled = defaultdict(int)
    for b, o, s in sorted(zip(bins, offsets, sizes)):
        assert o == filled[b]
        filled[b] += s
    assert all(v <= 12 for v in filled.values()) and len(filled) == n

    def first_fit(order):
        rooms = []
        for s in order:
            for i, r in enumerate(rooms):
                if r >= s:
                    rooms[i] -= s
                    break
            else:
                rooms.append(12 - s)
        return len(rooms)
    best = min((first_fit(p) for p in permutations(lengths)), default=0)
    assert P.lower_bound(sizes, 12) <= best <= n


def test_cut():
    assert P.cut(1, 4) == [(0, 1)] and P.cut(4, 4) == [(0, 4)] and P.cut(9, 4) == [(0, 1), (1, 4), (5, 4)] and P.cut(8, 4) == [(0, 4), (4, 4)]


def check_layout(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_layout(spark, odd_docs):
    odd_docs = odd_docs.unionByName(odd_docs.where("doc_id = 10").withColumn("text", F.lit("a <|endoftext|> in the text <|endoftext|>")))
    encode = Tokenizer.from_file(JSON)
    rows = P.pack_documents(odd_docs, tokenizer_path()).collect()
    check_layout(rows, P.CAPACITY)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = []
    for d in odd_docs.collect():
        ids = encode.encode(d.text or "", add_special_tokens=False).ids + [0]
        head = len(ids) % 2048 or 2048
        cuts = [0, *range(head, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((d.doc_id if d.doc_id is not None else -1, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert got == sorted(want)
    assert P.pack_documents(odd_docs.where("false"), tokenizer_path()).count() == 0


def test_exchange_rounds(spark):
    rng = np.random.default_rng(3)
    rows = [(i, 0, 0, int(s), 0) for i, s in enumerate(rng.choice([400, 700, 1100, 1300], 900))]
    table = spark.createDataFrame(rows, P.PIECE).repartition(4)
    many = P.pack(table, per_partition=60).collect()
    alone = P.pack(table, per_partition=60, exchange=False).collect()
    assert len(many) == 900 and {r.doc_id for r in many} == set(range(900))
    assert P.lower_bound(np.array([r[3] for r in rows]), 2048) <= check_layout(many, 2048) <= check_layout(alone, 2048)


def test_near_the_bound(spark, documents):
    rows = P.pack_documents(documents, tokenizer_path())
    total = rows.agg(F.ceil(F.sum("length") / P.CAPACITY)).first()[0]
    assert rows.select("sequence_id").distinct().count() <= total + 2
