"""Sources and sinks: round trips through files written to a scratch folder."""

import json
import os
import tempfile

from binlens.operators import bundle as U
from binlens.sources import io


def test_functions_tsv_round_trip(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "function_boundaries.tsv")
    with open(p, "w") as f:
        f.write("name\tentry_address\tend_address\tsize\tparam_count\treturn_type\tcalling_convention\tis_thunk\tis_external\n")
        f.write("FUN_1\t100001000\t1000010ff\t256\t2\tvoid\tdefault\tfalse\tfalse\n")
        f.write("_main\t100002000\t10000200f\t16\t0\tint\tdefault\tfalse\tfalse\n")
    df = io.read_functions(spark, p)
    assert df.count() == 2 and df.where("size = 256").first()["name"] == "FUN_1"
    assert io.read_functions(spark, os.path.join(d, "missing.tsv")).count() == 0
    out = os.path.join(d, "index")
    io.write_function_index(df, out)
    assert spark.read.csv(out, sep="\t", header=True).count() == 2


def test_source_tree_lines(spark):
    d = tempfile.mkdtemp()
    os.makedirs(os.path.join(d, "src"))
    with open(os.path.join(d, "src", "a.c"), "w", newline="") as f:
        f.write("int a(void) {\r\n  return 1;\r\n}\n")
    rows = io.read_source_tree(spark, d).orderBy("line_no").collect()
    assert [(r["rel_path"], r["line_no"], r["text"]) for r in rows] == [
        ("src/a.c", 1, "int a(void) {"), ("src/a.c", 2, "  return 1;"), ("src/a.c", 3, "}")]


def test_binary_strings_and_symbols(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "bin"), "wb") as f:
        f.write(b"\x00\x01hello world\x00abc\x00\xffredis-server v7.2.4\x00")
    rows = io.read_binary_strings(spark, os.path.join(d, "bin")).orderBy("ord").collect()
    assert [r["s"] for r in rows] == ["hello world", "redis-server v7.2.4"]
    with open(os.path.join(d, "syms.txt"), "w") as f:
        f.write("_napi_a\n_uv_b\n")
    assert [r["symbol"] for r in io.read_symbols(spark, os.path.join(d, "syms.txt")).orderBy("ord").collect()] == [
        "_napi_a", "_uv_b"]


def test_identity_and_plan_json(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "identity.json"), "w") as f:
        json.dump({"name": "redis", "version": "7.2.4", "languages": ["c"], "evidence": ["x"]}, f, indent=2)
    assert io.read_identity(spark, os.path.join(d, "identity.json")).first()["name"] == "redis"
    assert io.read_identity(spark, os.path.join(d, "none.json")).count() == 0
    with open(os.path.join(d, "plan.json"), "w") as f:
        json.dump({"binaryTarget": "b", "cycle": 1, "userStories": [
            {"id": "US-1", "priority": 2, "passes": False, "targetSourceFile": "x.c"},
            {"id": "US-2", "priority": 1, "passes": True}]}, f, indent=2)
    tasks = io.read_plan(spark, os.path.join(d, "plan.json")).orderBy("pos").collect()
    assert [(t["id"], t["priority"], t["passes"]) for t in tasks] == [("US-1", 2, False), ("US-2", 1, True)]


def test_corpus_writers(spark):
    d = tempfile.mkdtemp()
    ft = spark.createDataFrame([(0, "FUN_1", "100001000", "void f(){}"), (0, "op<<", "100001200", "void g(){}")],
                               "binary_id int, name string, entry_address string, code string")
    io.write_partitioned_corpus(ft, os.path.join(d, "parts"))
    back = spark.read.parquet(os.path.join(d, "parts"))
    assert sorted(r["file_name"] for r in back.collect()) == ["FUN_1_100001000.c", "op___100001200.c"]
    names = spark.createDataFrame([(0, "target")], "binary_id int, target_name string")
    io.write_combined_corpus(ft, names, os.path.join(d, "all"))
    text = "".join(open(os.path.join(root, f)).read() for root, _, fs in sorted(os.walk(os.path.join(d, "all")))
                   for f in sorted(fs) if f.startswith("part-"))
    assert text.startswith("// Ghidra decompilation of: target\n// Functions: 2\n")
    assert text.index("// FUN_1 @ 100001000") < text.index("// op<< @ 100001200")


def test_map_alias_report_and_module_writers(spark):
    d = tempfile.mkdtemp()
    fm = spark.createDataFrame([(0, "FUN_2", "200", "a.c", 3, "low", "callgraph_iter1", "x", "c"),
                                (0, "main", "100", "a.c", 1, "high", "direct_symbol", "main", "c")],
                               "binary_id int, ghidra_function_name string, ghidra_address string, source_file string, "
                               "source_line int, confidence string, match_method string, original_name string, "
                               "source_language string")
    io.write_function_map(fm, os.path.join(d, "fm"))
    back = io.read_function_map(spark, os.path.join(d, "fm"), binary_id=None)
    assert sorted(r["ghidra_function_name"] for r in back.collect()) == ["FUN_2", "main"]
    al = spark.createDataFrame([(0, "FUN_b", "y"), (0, "FUN_a", "z")], "binary_id int, ghidra_name string, original_name string")
    io.write_aliases(al, os.path.join(d, "al"))
    rows = spark.read.csv(os.path.join(d, "al"), sep="\t", header=True).collect()
    assert sorted(r["ghidra_name"] for r in rows) == ["FUN_a", "FUN_b"]
    io.write_json_report(spark.createDataFrame([(0, 2, 1.5)], "binary_id int, total_functions long, pct double"),
                         os.path.join(d, "stats"))
    assert spark.read.json(os.path.join(d, "stats")).first()["total_functions"] == 2
    mc = spark.createDataFrame([(0, "1000b0", 2), (0, "1000a0", 1)], "binary_id int, prefix string, function_count long")
    io.write_module_chunks(mc, os.path.join(d, "mc"))
    assert spark.read.csv(os.path.join(d, "mc"), sep="\t", header=True).count() == 2


def test_paths_with_blanks_schemes_and_keys(spark):
    d = os.path.join(tempfile.mkdtemp(), "test", "my trees")
    for tree, name in ((3, "a b+c%.c"), (4, "x.h"), (4, "note.md")):
        os.makedirs(os.path.join(d, f"t{tree}", "my src"), exist_ok=True)
        with open(os.path.join(d, f"t{tree}", "my src", name), "w") as f:
            f.write("one\ntwo\n")
    want = [(3, "t3/my src/a b+c%.c"), (4, "t4/my src/x.h")]
    for root in (d, "file:" + d, "file://" + d + "/"):
        rows = io.read_source_tree(spark, root, key_pattern=r"/t(\d+)/my src/", extensions=[".c", ".h"]).collect()
        assert sorted({(r["tree_id"], r["rel_path"]) for r in rows}) == want and len(rows) == 4
    assert io.read_source_tree(spark, d + "/none").count() == io.read_function_corpus(spark, d + "/none").count() == 0
    assert io.read_symbols(spark, d + "/none").count() == io.read_plan(spark, d + "/none.json").count() == 0


def test_triage_labels_of_a_plan(spark):
    p = os.path.join(tempfile.mkdtemp(), "plan.json")
    with open(p, "w") as f:
        json.dump({"binaryTarget": "b", "triageResults": [{"prefix": "1032be", "classification": "custom", "reason": "r"}], "userStories": []}, f)
    rows = io.read_triage(spark, p, binary_id=5).collect()
    assert [(r["binary_id"], r["prefix"], r["label"]) for r in rows] == [(5, "1032be", "custom")]


def test_nested_reports_round_trip(spark, inputs):
    from binlens.operators import bundle as U
    from binlens.operators import compose as O
    from binlens.operators import identify as I
    from binlens.operators import reports as R
    from binlens.functions import catalog as C
    d = tempfile.mkdtemp()
    comp = O.composition(inp_functions := inputs.functions(), inputs.mapped(), inputs.call_graph())
    maps = spark.createDataFrame([(0, "f", "high", "direct_symbol", "c", "f"), (0, "g", "low", "callgraph_iter1", "zig", "h")],
                                 "binary_id int, name string, confidence string, match_method string, source_language string, original_name string")
    lines = inputs.table("fx_bundle_lines")
    reports = {
        "composition": R.composition_report(comp, inputs.call_graph()),
        "mapping": R.mapping_report(inp_functions, maps),
        "chunks": R.chunk_index(lines, U.declaration_chunks(lines)),
        "identity": I.identity(inputs.strings(), inputs.symbols(), C.software_catalog(spark)),
    }
    for name, df in reports.items():
        path = os.path.join(d, name)
        io.write_json_report(df, path, partition_by=())
        back = spark.read.schema(df.schema).json(path)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())) and back.count() > 0
    r = reports["composition"].first()
    assert r["categories"]["unknown"]["cluster_count"] >= len(r["categories"]["unknown"]["top_clusters"]) > 0
    assert sum(r["categories"][c]["count"] for c in C.CATEGORY_DESCRIPTIONS) == r["total_functions"]
    assert reports["mapping"].first()["by_confidence"] == {"high": 1, "low": 1}
    # an identity that was written can be read as one
    assert io.read_identity(spark, os.path.join(d, "identity")).where("size(evidence) > 0").count() > 0


def test_corpus_as_text(spark):
    d = tempfile.mkdtemp()
    rows = spark.createDataFrame([(0, "f::g", "100001000", "int f() {\n}")], "binary_id int, name string, entry_address string, code string")
    io.write_partitioned_corpus(rows, os.path.join(d, "out"), as_text=True)
    back = spark.read.text(os.path.join(d, "out"), wholetext=True).first()
    assert back["value"] == "// f::g @ 100001000\nint f() {\n}\n" and back["file_name"] == "f__g_100001000.c"


def _small_ranges(spark, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    return before


def _restore(spark, before):
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_numbers_are_counted_over_byte_ranges(spark):
    """Listings, sources and binaries in ranges of 700 bytes: the same rows and numbers as in one piece."""
    import random
    import re
    d = tempfile.mkdtemp()
    r = random.Random(3)
    lines = [f"line {i} " + "x" * r.randint(0, 90) for i in range(400)]
    os.makedirs(f"{d}/tree/src")
    for name, part, end in (("a.c", lines, "\n"), ("b.c", lines[:150], "\r\n"), ("empty.c", [], "\n"), ("one.c", ["no end"], "")):
        with open(f"{d}/tree/src/{name}", "w", newline="") as f:
            f.write("".join(x + end for x in part))
    pieces = [bytes(r.randint(0, 255) for _ in range(r.randint(1, 60))) + r.choice([b"\0", b"\0\0", b"", b"\n"]) + b"printable run %d" % i for i in range(300)]
    raw = b"".join(pieces) + b"y" * 5000 + b"\0end of file"
    os.makedirs(f"{d}/bins/7")
    with open(f"{d}/bins/7/prog", "wb") as f:
        f.write(raw)
    with open(f"{d}/functions.tsv", "w") as f:
        f.write("name\tentry_address\tend_address\tsize\tparam_count\treturn_type\tcalling_convention\tis_thunk\tis_external\n")
        f.writelines(f"f{i}\t{i // 2:06x}\t\t{i}\t0\tint\tdefault\tfalse\tfalse\n" for i in range(500))
    before = _small_ranges(spark, 700)
    try:
        tree = io.read_source_tree(spark, f"{d}/tree")
        got = sorted((x["rel_path"], x["line_no"], x["text"]) for x in tree.collect())
        want = [("src/a.c", i + 1, t) for i, t in enumerate(lines)] + [("src/b.c", i + 1, t) for i, t in enumerate(lines[:150])] + [("src/one.c", 1, "no end")]
        assert got == sorted(want)
        symbols = io.read_symbols(spark, f"{d}/tree/src/a.c")
        assert [x["symbol"] for x in symbols.orderBy("ord").collect()] == lines
        strings = io.read_binary_strings(spark, f"{d}/bins", key_pattern=r"/bins/(\d+)/").orderBy("ord").collect()
        runs = [m.decode() for m in re.findall(rb"[\x20-\x7E\t]{6,}", raw)]
        assert [(x["binary_id"], x["ord"], x["s"]) for x in strings] == [(7, i, s) for i, s in enumerate(runs)]
        functions = io.read_functions(spark, f"{d}/functions.tsv")
        assert [x["name"] for x in functions.orderBy("row_no").collect()] == [f"f{i}" for i in range(500)]
        assert spark.read.text(f"{d}/tree/src/a.c").rdd.getNumPartitions() > 10
    finally:
        _restore(spark, before)


def test_last_row_of_an_address_counts(spark):
    from binlens.operators import compose as O
    p = os.path.join(tempfile.mkdtemp(), "f.tsv")
    with open(p, "w") as f:
        f.write("name\tentry_address\tend_address\tsize\tparam_count\treturn_type\tcalling_convention\tis_thunk\tis_external\n")
        f.write("zz\t10\t1f\t1\t0\tint\tdefault\tfalse\tfalse\naa\t10\t1f\t1\t0\tint\tdefault\tfalse\tfalse\n")
    assert [r["name"] for r in O.by_address(io.read_functions(spark, p)).collect()] == ["aa"]


def test_missing_paths_are_empty(spark):
    assert io.read_binary_strings(spark, "/tmp/there-is-no-such-folder").columns == ["binary_id", "ord", "s"]
    assert io.read_binary_strings(spark, "/tmp/there-is-no-such-folder").count() == 0
    assert "row_no" in io.read_functions(spark, "/tmp/there-is-no-such-file").columns


def _counts(spark, path, reader):
    return {r["binary_id"]: r["count"] for r in reader(path).groupBy("binary_id").count().collect()}


def test_a_write_replaces_its_own_binaries_only(spark):
    d = tempfile.mkdtemp()

    def rows(ddl, *values):
        return spark.createDataFrame(list(values), ddl)

    tsv = lambda p: spark.read.csv(p, sep="\t", header=True)
    aliases = "binary_id int, ghidra_name string, original_name string"
    chunks = "binary_id int, prefix string, function_count long"
    functions = "binary_id int, name string, entry_address string, size long, param_count int, return_type string"
    report = "binary_id int, total long"
    cases = [
        (io.write_aliases, tsv, rows(aliases, (1, "a", "x"), (1, "b", "y")), rows(aliases, (2, "c", "z")), rows(aliases, (1, "d", "w"))),
        (io.write_module_chunks, tsv, rows(chunks, (1, "10", 1), (1, "11", 2)), rows(chunks, (2, "10", 3)), rows(chunks, (1, "12", 1))),
        (io.write_function_index, tsv, rows(functions, (1, "f", "10", 1, 0, "i"), (1, "g", "11", 1, 0, "i")), rows(functions, (2, "f", "10", 1, 0, "i")), rows(functions, (1, "h", "12", 1, 0, "i"))),
        (io.write_json_report, spark.read.json, rows(report, (1, 5), (1, 6)), rows(report, (2, 7)), rows(report, (1, 8))),
    ]
    for k, (write, read, one, two, again) in enumerate(cases):
        path = os.path.join(d, str(k))
        write(one, path)
        write(two, path)
        assert _counts(spark, path, read) == {1: 2, 2: 1}
        write(again, path)
        assert _counts(spark, path, read) == {1: 1, 2: 1}
    text = "binary_id int, name string, entry_address string, code string"
    one, two = rows(text, (1, "f", "100001000", "a"), (1, "g", "100002000", "b")), rows(text, (2, "f", "100001000", "c"))
    names = rows("binary_id int, target_name string", (1, "t"), (2, "u"))
    path = os.path.join(d, "corpus")
    for part in (one, two):
        io.write_partitioned_corpus(part, path)
    assert _counts(spark, path, spark.read.parquet) == {1: 2, 2: 1}
    io.write_partitioned_corpus(one.where("name = 'g'"), path)  # a prefix that is gone goes
    assert _counts(spark, path, spark.read.parquet) == {1: 1, 2: 1}
    path = os.path.join(d, "combined")
    for part in (one, two):
        io.write_combined_corpus(part, names, path)
    assert set(_counts(spark, path, spark.read.text)) == {1, 2}


def test_an_aborted_write_leaves_the_old_rows(spark):
    import pytest
    from pyspark.sql import functions as F
    path = os.path.join(tempfile.mkdtemp(), "al")
    good = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "binary_id int, ghidra_name string, original_name string")
    io.write_aliases(good, path)
    bad = good.withColumn("original_name", F.when(F.col("ghidra_name") == "b", F.raise_error(F.lit("stop"))).otherwise(F.lit("new")))
    with pytest.raises(Exception, match="stop"):
        io.write_aliases(bad, path)
    rows = spark.read.csv(path, sep="\t", header=True).collect()
    assert sorted((r["ghidra_name"], r["original_name"]) for r in rows) == [("a", "x"), ("b", "y")]


def test_chunk_documents_replace_those_of_their_bundle(spark):
    d = os.path.join(tempfile.mkdtemp(), "chunks")

    def write(bundle, n):
        text = [f"const a{i} = 1;" for i in range(n)]
        lines = spark.createDataFrame([(bundle, i + 1, t) for i, t in enumerate(text)], "bundle_id int, line_no int, text string")
        io.write_chunk_documents(U.chunk_document_lines(lines, U.declaration_chunks(lines)), d)
        return text

    def read(bundle, file):
        folder = os.path.join(d, f"bundle_id={bundle}", f"file={file}")
        out = []
        for part in sorted(p for p in os.listdir(folder) if p.startswith("part-")):
            with open(os.path.join(folder, part)) as f:
                out += f.read().splitlines()
        return out

    one, _, two = write(1, 400), write(2, 900), write(2, 300)
    assert sorted(os.listdir(os.path.join(d, "bundle_id=1"))) == ["file=chunk_000_L1-L350.js", "file=chunk_001_L351-L400.js"]
    assert os.listdir(os.path.join(d, "bundle_id=2")) == ["file=chunk_000_L1-L300.js"]
    assert read(1, "chunk_000_L1-L350.js") == ["// Chunk 0: lines 1-350 of app_beautified.js", *one[:350]]
    assert read(1, "chunk_001_L351-L400.js") == ["// Chunk 1: lines 351-400 of app_beautified.js", *one[350:]]
    assert read(2, "chunk_000_L1-L300.js") == ["// Chunk 0: lines 1-300 of app_beautified.js", *two]
