import duckdb

from binlens.llm import quality_rules as Q




def test_rules(spark):
    good = "This is a plain sentence of ten words for the test. And here is one more of them for good measure, too."
    other = "Nobody knew what the second paragraph would say until somebody wrote it down for all of us."
    cases = {
        1: good,
        2: good + "\nHome | News | Sport | Weather | About | Contact\n" + other,
        3: "Home | News | Sport | Weather | About | Contact | Home | News | Sport | Weather | About | Contact " * 3,
        4: good + "\nAll Rights Reserved by the owner of this page since long ago.",
        5: "WORD!! " * 1 + "HERE!! IS!! A!! LOT!! OF!! NOISE!! FOR!! YOU!! AND!! ME!! TO!! READ!! ALL!! DAY!! LONG!! WITHOUT!! ANY!! END!! SO!! BE!! IT!!",
        6: "no sentence ends here at all and so the line has nothing that would tell a reader where to stop reading it",
        7: "a b c d e f g h. " * 5, 8: "too few words.", 9: good + "\n" + good,
        10: "go go go go go go go stop stop stop stop stop run run run run run sit sit sit sit sit now now. ",
    }
    df = spark.createDataFrame(list(cases.items()), "doc_id long, text string")
    rows = {r.doc_id: r for r in Q.clean(df, with_text=True).collect()}
    kept = {i for i, r in rows.items() if r.kept}
    assert kept == {1, 2, 4}  # 9: every word is in a window found twice
    assert rows[1].cleaned_text == good and rows[2].cleaned_text == good + "\n" + other
    assert rows[4].cleaned_text == good and rows[9].n_dup_lines == 1 and rows[9].base_failed and rows[7].base_failed
    assert not rows[6].base_failed and not rows[5].base_failed and not rows[3].n_dup_lines


def test_odd_rows_match_the_oracle(spark, odd_docs):
    rows = odd_docs.where("text is null or not text like '%\\u0000%'")
    got = sorted([tuple(-1 if v is None else v for v in r) for r in Q.clean(rows).collect()])
    con = duckdb.connect()
    con.register("documents", rows.select("doc_id", "text").toArrow())
    order = ["doc_id", *Q.COUNTS, "base_failed", "kept", "lost_words"]
    want = sorted([tuple(-1 if v is None else v for v in r) for r in con.sql(f"SELECT {', '.join(order)} FROM ({Q.ORACLE})").fetchall()])
    assert got == want
    assert Q.clean(odd_docs).count() == odd_docs.count() and Q.clean(odd_docs.where("false"), with_text=True).count() == 0
    none = [r for r in Q.clean(odd_docs).collect() if r.doc_id in (2, 3, 4)]
    assert len(none) == 3 and all(r.n_words == 0 and not r.kept and r.base_failed for r in none)


def test_quality_labels(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = Q.clean(documents).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in good) / len(good) > 0.98
    assert not any(r.kept for r in rows if r.quality == 0)
