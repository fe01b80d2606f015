import re
from itertools import permutations

import duckdb
import pandas as pd
import pyarrow as pa
import pytest

from binlens.llm import filter_audit as A

SF = "/root/testdata/sf0.01"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain_fails(text, doc_id, smallest):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, bad in zip("ABCDE", (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        bool(re.search(r"[#$%&*|]", text)), smallest is not None and (doc_id is None or doc_id > smallest))) if bad}


def plain_audit(docs, labels):
    """docs: (doc_id, text, source); labels: {doc_id: (good, toxic)}."""
    smallest = {}
    for i, text, _ in docs:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    rows = [(src or "", plain_fails(text or "", i, smallest.get(text or "")), *labels.get(i, (False, False))) for i, text, src in docs]
    out, removed_by = {}, {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            gone = [False] * len(mine)
            for step, f in enumerate(order, 1):
                hit = [f in r[1] for r in mine]
                now = [h and not g for h, g in zip(hit, gone)]
                redundant = sum(h and g for h, g in zip(hit, gone))
                gone = [g or n for g, n in zip(gone, now)]
                out[part, "".join(order), step] = [gone.count(False), sum(now), redundant, sum(r[1] == {f} for r in mine),
                                                   sum(n and r[2] for n, r in zip(now, mine)), sum(n and r[3] for n, r in zip(now, mine))]
                removed_by[part, f] = removed_by.get((part, f), 0) + sum(now)
    return {(*k, *v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, path, labels, batches):
    got = [tuple(r) for r in A.audit(spark, str(path), labels, batches).select(*COLUMNS).collect()]
    assert len(got) == len(set(got))
    return set(got)


def text(n, distinct, extra=""):
    return " ".join(f"w{i % distinct}" for i in range(n)) + extra


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_retractions_over_micro_batches(spark, tmp_path, batches):
    """Smaller ids of a text arrive in later files; the result is the same however the files are dealt."""
    long, short, loud = text(250, 240), text(30, 30), text(260, 250, " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 4 + " 5% off")
    files = [[(50, long, "a"), (51, short, "b"), (52, long, "b"), (None, long, "a"), (53, None, None)],
             [(40, long, "b"), (41, short, "a"), (60, loud, "a"), (61, "", "a")],
             [(30, loud, "c"), (40, long, "b"), (None, "only without id", None), (None, "only without id", "a")],
             [(70, long, "c"), (29, loud, "a"), (1, "one", "a"), (2, text(300, 3), "b")],
             [(10, long, "a"), (10, long, "a"), (10, long, "c"), (71, short, "c")],
             [(11, long, "b"), (None, None, "b"), (3, text(300, 3), "b")],
             [(12, " \n\t", "a"), (13, "x" * 200_000, "b")]]
    schema = "doc_id long, text string, source string, part string, mask int, n long, digest string"
    for k, rows in enumerate(files):
        spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    labels = {10: (True, False), 40: (False, True), 51: (True, True), 3: (True, False), 29: (False, True)}
    table = spark.createDataFrame([(i, int(g), int(t)) for i, (g, t) in labels.items()] + [(None, 1, 1), (10, 0, None), (99, 1, 1)],
                                  "doc_id long, quality int, toxic int")
    assert audited(spark, tmp_path / "docs", table, batches) == plain_audit([r for f in files for r in f], labels)


def test_oracle_agrees(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = set(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({A.ORACLE})").fetchall())
    assert audited(spark, f"{SF}/documents.parquet", spark.read.parquet(f"{SF}/labels.parquet"), 4) == want


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(str(tmp_path / "none"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = A.audit(spark, str(tmp_path / "none"), labels)
    assert out.count() == 0 and sorted(out.columns) == sorted(COLUMNS)


def test_changes_retract_exactly_what_was_counted():
    def rows(*values):
        return pd.DataFrame([dict(zip(["digest", "no_id", "id", "part", "mask", "good", "toxic", "holder", "n"], v)) for v in values])

    old, first = A.changes(pd.DataFrame(columns=A.STATE_COLUMNS), rows((b"t", False, 9, "a", 3, 1, 0, True, 2)))
    assert first[["part", "mask", "n"]].values.tolist() == [["a", 3, 2]]
    after, delta = A.changes(old, rows((b"t", False, 4, "b", 3, 0, 0, True, 1), (b"t", False, 0, "c", 3, 0, 0, False, 5)))
    assert sorted(delta[["part", "mask", "n"]].values.tolist()) == [["a", 3, -2], ["a", 19, 2], ["b", 3, 1], ["c", 19, 5]]
    assert after[["id", "part", "n"]].values.tolist() == [[4, "b", 1]]


def test_masks():
    texts = [text(199, 199), text(200, 200), text(200, 99), text(200, 100), "A" * 3 + "b" * 97, "AAb" + "b" * 97, "5 % ", None, "", "ÄÖÜ"]
    assert A.masks(pa.array(texts)).tolist() == [1, 0, 2, 0, 5, 1, 9, 1, 1, 1]
