import hashlib

import duckdb
import numpy as np
import pytest

from binlens.llm import vector_codes as V

SF = "/root/testdata/sf0.01"


def brute(vectors, entries=256, rounds=4):
    """Codes, errors and the digest by full scans; ``vectors`` is sorted by id."""
    x = np.floor(np.array(vectors, np.float64) * 1024).astype(np.int64).reshape(len(vectors), 4, -1)
    book = x[:entries].transpose(1, 0, 2).copy()

    def nearest():
        return np.stack([((x[:, p, None] - book[p][None]) ** 2).sum(2) for p in range(4)], 1)

    for _ in range(rounds):
        code = nearest().argmin(2)
        for p in range(4):
            for e in range(book.shape[1]):
                mine = x[code[:, p] == e, p]
                if len(mine):
                    book[p, e] = mine.sum(0) // len(mine)
    d = nearest()
    return d.argmin(2), d.min(2).sum(1), hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


@pytest.mark.parametrize("scale, dims, spread", [(0.2, 64, 6), (10_000, 8, 40), (0.004, 16, 3)])
def test_codes_equal_full_scans(spark, scale, dims, spread):
    """Small components, large ones (integer distances), and a coarse grid full of ties."""
    rng = np.random.default_rng(dims)
    x = (rng.normal(size=(spread, dims))[rng.integers(0, spread, 1500)] + 0.3 * rng.normal(size=(1500, dims))) * scale
    rows = [(i, v.tolist(), None if i % 7 == 0 else i % 3) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    got = {r["vec_id"]: r for r in V.compress(df).collect()}
    code, error, digest = brute(x)
    label_error = {}
    for (i, _, label), e in zip(rows, error):
        label_error[label] = label_error.get(label, 0) + int(e)
    assert len(got) == len(rows)
    for i, _, label in rows:
        assert got[i]["code"] == "".join(f"{c:02x}" for c in code[i])
        assert (got[i]["error"], got[i]["label_error"], got[i]["codebooks_sha256"]) == (error[i], label_error[label], digest)


def test_oracle_agrees(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want = sorted(con.sql(f"SELECT {', '.join(names)} FROM ({V.oracle()})").fetchall())
    got = sorted(tuple(r) for r in V.compress(spark.read.parquet(f"{SF}/embeddings.parquet")).select(names).collect())
    assert got == want


def carried(x, history, groups, accumulate):
    """Exact distances computed when bounds are carried by net displacements, or by accumulated drifts."""
    state = np.zeros(len(x), V.state_type())
    _, done = V.first_scan(x, history[0], groups, state)
    counts = [done]
    for t in range(1, len(history)):
        if accumulate:  # age every bound by the last drift, as if it had been made in the round before
            step = np.sqrt(((history[t - 1] - history[t - 2]).astype(float) ** 2).sum(1)) if t > 1 else np.zeros(len(history[0]))
            late = state["at"] < t - 1
            state["upper"][late] += step[state["code"][late]]
            state["at"] = t - 1
            for g, members in enumerate(groups):
                stale = state["stamp"][:, g] < t - 1
                state["lower"][stale, g] -= step[members].max()
                state["stamp"][:, g] = t - 1
        counts.append(V.reassign(x, t, history, groups, state))
        d = V.squared_distances(x, history[t])
        assert (state["code"] == d.argmin(1)).all()
        # every stored bound holds for the codebook of its own round
        for g, members in enumerate(groups):
            for s in np.unique(state["stamp"][:, g]):
                r = np.flatnonzero(state["stamp"][:, g] == s)
                if accumulate and s != t:
                    continue
                old = np.sqrt(V.squared_distances(x[r], history[s][members]).astype(float))
                old[members[None] == state["code"][r][:, None]] = np.inf
                assert (state["lower"][r, g] <= old.min(1)).all()
    return counts


def test_bounds_hold_and_net_displacement_saves_scans():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(64, 16)) * 300
    x = np.floor(centres[rng.integers(0, 64, 4000)] + 60 * rng.normal(size=(4000, 16))).astype(np.int64)
    history = [x[:128].copy()]
    for _ in range(8):
        code = V.squared_distances(x, history[-1]).argmin(1)
        history.append(np.stack([x[code == e].sum(0) // (code == e).sum() if (code == e).any() else history[-1][e] for e in range(128)]))
    groups = V.entry_groups(history[0][None])[0]
    net, summed = carried(x, history, groups, False), carried(x, history, groups, True)
    full = 4000 * 128
    assert sum(net) <= sum(summed)
    assert net[-1] < full / 4 and max(net[1:]) < full


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, 0.2, 0.3, 0.4], "a", 1), (2, None, "a", 1), (3, [0.1, None, 0.3, 0.4], "a", 1), (4, [nan, 0.0, 0.0, 0.0], "a", 1),
            (5, [inf, 0.0, 0.0, 0.0], "a", 1), (6, [], None, 1), (7, [0.1, 0.2, 0.3, 0.4, 0.5], None, 1), (1, [0.1, 0.2, 0.3, 0.4], "a", 1),
            (None, [-0.1, 1e30, 0.0, 0.0], "b", 1), (8, [0.1, 0.2, 0.3, 0.4], "b", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string, code int")
    got = V.compress(df.withColumn("x", df["code"]).withColumn("sums", df["code"])).collect()
    assert sorted(str(r["vec_id"]) for r in got) == ["1", "1", "6", "7", "8", "None"]
    assert all(r["error"] == 0 for r in got)  # six rows, six entries
    assert {r["code"] for r in got if r["vec_id"] in (1, 8)} == {"00000000"}  # equal entries: the lowest index
    empty = V.compress(df.limit(0))
    assert empty.count() == 0 and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert V.compress(df.where("vec_id = 2")).count() == 0
