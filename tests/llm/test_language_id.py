import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from binlens.llm import language_id as L
from binlens.llm.common import split_remainder


def pieces(reference: str, text: str) -> int:
    """Longest-match parse by substring search."""
    n = i = 0
    while i < len(text):
        k = 0
        while i + k < len(text) and text[i:i + k + 1] in reference:
            k += 1
        i += max(k, 1)
        n += 1
    return n


@given(st.lists(st.text(alphabet="abcé", min_size=1, max_size=9), min_size=1, max_size=6),
       st.lists(st.text(alphabet="abcdé", min_size=1, max_size=12), min_size=1, max_size=6))
@settings(max_examples=80, deadline=None)
def test_parse_matches_brute_force(reference, ask):
    text = " " + " ".join(reference) + " "
    parser = L.Parser({"x": L.Automaton(text), "y": L.Automaton(" zz ")})
    costs = parser.costs(pa.array([" ".join(ask)]))
    assert costs[0, 0] == sum(map(len, ask))
    assert abs(costs[0, 1] - sum(pieces(text, f" {w} ") for w in ask) * parser.bits[0]) < 1e-9


def test_held_out_accuracy(spark, documents):
    rest = split_remainder("doc_id", 5)
    found = L.identify(documents.where(rest == 0), L.fit(documents.where(rest != 0)), passthrough=("doc_id", "lang"))
    right, total = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 150 and right / total > 0.97


def test_odd_rows(spark, odd_docs, documents):
    models = L.fit(documents)
    rows = L.identify(odd_docs, models).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (2, 3, 4, 5))
    assert by_id[6].lang_pred == "de" and by_id[1].lang_pred in models and 0 < by_id[1].score <= 1
    again = {r.doc_id: r for r in L.identify(odd_docs.repartition(3), models).collect()}
    assert again[1] == by_id[1]


def test_nothing_to_learn_from(spark, odd_docs):
    models = L.fit(odd_docs.where("false"))
    assert models == {} and {r.lang_pred for r in L.identify(odd_docs, models).collect()} == {"und"}
    assert L.identify(odd_docs.where("false"), models).count() == 0
