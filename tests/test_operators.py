"""Hand-computed expectations for the quirks of SURVEY §8 and brute-force checks."""

import random
import re

import pytest
from pyspark.sql import functions as F

from binlens.functions import catalog as C
from binlens.operators import bundle as U
from binlens.operators import identify as I
from binlens.operators import mapping as M
from binlens.operators import text as X


def test_repo_rstrip_is_a_charset(spark):
    # Q1: rstrip('.git') strips characters, so 'legit' loses 'git' and the 'i' before
    s = spark.createDataFrame([(0, 1, "https://github.com/me/legit"), (0, 2, "https://github.com/me/tool.git"),
                               (0, 3, "github.com/nicbarker/clay")], "binary_id int, ord long, s string")
    rows = {r["repo"]: r["n_refs"] for r in I.repo_counts(I.repo_mentions(s)).collect()}
    assert rows == {"me/le": 1, "me/tool": 1}


def test_version_stop_overwrites_and_bare_before_stop(spark):
    s = spark.createDataFrame([(0, 1, "Version: 2.0.1"), (0, 2, "other 1.0.0"), (0, 3, "redis 7.2.4"),
                               (0, 4, "Version: 9.9.9")], "binary_id int, ord long, s string")
    v = I.first_version(I.version_mentions(s), C.software_catalog(spark)).first()
    assert (v["stop_name"], v["stop_version"], v["bare_version"]) == ("redis", "7.2.4", "2.0.1")
    assert v["bare_evidence"] == "Version string: Version: 2.0.1"


def test_definitions_and_first_posting(spark):
    lines = spark.createDataFrame([
        (0, "b.cpp", 1, "static int helper_fn(int x) {"),
        (0, "a.zig", 5, "pub fn helper_fn(a: u32) void {"),
        (0, "vendor/c.c", 1, "int helper_fn(void) {"),
        (0, "b.cpp", 2, "    if (x) {"),
        (0, "q.cpp", 1, "int A::method(int) {"),    # Q8: qualified names are not indexed
    ], "tree_id int, rel_path string, line_no int, text string")
    defs = X.source_definitions(lines)
    assert sorted((r["rel_path"], r["name"]) for r in defs.collect()) == [("a.zig", "helper_fn"), ("b.cpp", "helper_fn")]
    first = X.first_posting(defs).first()
    assert (first["def_file"], first["def_line"]) == ("a.zig", 5)   # .zig is scanned before .cpp


def test_arbitration_first_file_last_overwrite(spark):
    # evidence: (pos, k, r) order; file f1 first (setdefault), later overwritten; f2 second
    ev = spark.createDataFrame([
        (0, 0, "fn", "a1", (0, 1, 1), "f1", 10, False),
        (0, 0, "fn", "a1", (0, 1, 2), "f2", 20, False),
        (0, 0, "fn", "a1", (1, 0, 0), "f1", 30, True),
        (0, 0, "fn", "a1", (2, 0, 0), "f1", 40, True),
    ], "binary_id int, tree_id int, func_name string, entry_address string, "
       "seq struct<pos:int,k:int,r:int>, file string, line int, overwrite boolean")
    r = M.arbitrate(ev).first()
    assert (r["best_file"], r["best_line"]) == ("f1", 40)


def test_enclosing_is_first_in_window_not_nearest(spark):
    # Q14: the first definition in [L-19, L+5] wins, even if another is nearer
    lines = spark.createDataFrame([(0, "x.cpp", 2, "void early(int a) {"), (0, "x.cpp", 18, "void near(int a) {"),
                                   (0, "x.cpp", 30, "void late(int a) {")],
                                  "tree_id int, rel_path string, line_no int, text string")
    anchors = spark.createDataFrame([(0, 0, "FUN_1", "a", "x.cpp", 20)],
                                    "binary_id int, tree_id int, func_name string, entry_address string, "
                                    "best_file string, best_line int")
    assert M.enclosing_definition(anchors, lines).first()["enclosing_name"] == "early"


def test_declaration_chunks_break_at_the_first_declaration_after_350_lines(spark):
    docs = {}
    for d in range(3):
        lines = []
        for i in range(2600):
            if (i * 7 + d * 13) % 41 == 0 or (d == 1 and 900 < i < 1700):
                lines.append(("  " if i % 2 else "") + f"function f{i}() {{")
            elif (i + d) % 97 == 0:
                lines.append("   ")
            else:
                lines.append(f"  call(\"value {i} long enough\");" if i % 5 else "}")
        docs[d] = lines
    rows = [(d, i + 1, t) for d, ls in docs.items() for i, t in enumerate(ls)]
    df = spark.createDataFrame(rows, "bundle_id int, line_no int, text string")
    chunks = U.declaration_chunks(df).orderBy("bundle_id", "idx").collect()
    for d, lines in docs.items():
        mine = [c for c in chunks if c["bundle_id"] == d]
        # the chunks cover the document without gaps
        assert mine[0]["start_line"] == 1 and mine[-1]["end_line"] == len(lines)
        assert all(a["end_line"] + 1 == b["start_line"] for a, b in zip(mine, mine[1:]))
        declares = [bool(re.match(C.CHUNK_BREAK_PATTERN, t.strip())) for t in lines]
        for a, b in zip(mine, mine[1:]):
            start, stop = a["start_line"] - 1, b["start_line"] - 1
            assert stop - start >= 350 and declares[stop] and not any(declares[start + 350:stop])
        last = mine[-1]["start_line"] - 1
        assert not any(declares[last + 350:])
        assert all(c["chars"] == len("\n".join(lines[c["start_line"] - 1:c["end_line"]]).strip()) for c in mine)


def test_small_chunks_by_hand(spark):
    # 360 filler lines, then declarations at 0-based lines 349 (too early), 350 and 360
    lines = ["x" * 9] * 400
    for i in (349, 350, 360):
        lines[i] = "function f() {"
    df = spark.createDataFrame([(0, i + 1, t) for i, t in enumerate(lines)], "bundle_id int, line_no int, text string")
    got = [(r["idx"], r["start_line"], r["end_line"], r["chars"]) for r in U.declaration_chunks(df).orderBy("idx").collect()]
    # 349 lines of 9 characters and one of 14, and 349 line breaks; then 48 and 2, and 49
    assert got == [(0, 1, 350, 349 * 9 + 14 + 349), (1, 351, 400, 48 * 9 + 2 * 14 + 49)]


def test_propagation_round_uses_names_fixed_at_round_start(spark):
    lines = spark.createDataFrame([
        (0, "m.c", 1, "void top(void) {"), (0, "m.c", 2, "  alpha(); beta();"),
        (0, "m.c", 10, "void alpha(void) {"), (0, "m.c", 20, "void beta(void) {"),
    ], "tree_id int, rel_path string, line_no int, text string")
    functions = spark.createDataFrame([(0, 0, "top", "100"), (0, 0, "FUN_a", "200"), (0, 0, "FUN_b", "300")],
                                      "binary_id int, tree_id int, name string, entry_address string")
    cg = spark.createDataFrame([(0, "top", "FUN_a"), (0, "top", "FUN_b")],
                               "binary_id int, caller_name string, callee_name string")
    first = X.first_posting(X.source_definitions(lines))
    direct = M.direct_matches(functions, first, None)
    out = {r["name"]: (r["original_name"], r["match_method"])
           for r in M.call_graph_propagate(direct, cg, lines, first).collect()}
    # one caller offers its first unused candidate to all its FUN_ callees in a round
    assert out["FUN_a"] == ("alpha", "callgraph_iter1") and out["FUN_b"] == ("alpha", "callgraph_iter1")


def test_text_segments_printable_runs(spark):
    text = "x" * 150 + "\x00" + "y" * 201 + " " + "z" * 300 + "\n@getInternalField" + "w" * 10
    df = spark.createDataFrame([(1, text)], "bundle_id int, text string")
    segs = U.text_segments(df).orderBy("seg_no").collect()
    assert [(r["n_chars"], r["seg_class"]) for r in segs] == [(201, "app"), (300 + 1 + 17 + 10, "builtin")]


def test_line_numbers_beyond_any_file(spark):
    # literals may hold any number; the mapping goes on without a definition for them
    lines = spark.createDataFrame([(0, "x.c", 1, "int f(int a) {"), (0, "x.c", 2, '  puts("a literal here");')],
                                  "tree_id int, rel_path string, line_no int, text string")
    functions = spark.createDataFrame([(0, 0, "FUN_1", "1"), (0, 0, "FUN_2", "2"), (0, 0, "FUN_3", "3")],
                                      "binary_id int, tree_id int, name string, entry_address string")
    texts = [f'"x.c:{n}"' for n in ("2147483647", "9223372036854775807", "3")]
    decompiled = spark.createDataFrame([(0, f"FUN_{i + 1}", str(i + 1), t) for i, t in enumerate(texts)],
                                       "binary_id int, func_name string, entry_address string, text string")
    cg = spark.createDataFrame([(0, "FUN_1", "FUN_3")], "binary_id int, caller_name string, callee_name string")
    rows = {r["name"]: r for r in M.map_functions(functions, cg, decompiled, lines).collect()}
    assert rows["FUN_1"]["source_line"] == 2147483647 and rows["FUN_1"]["confidence"] == "medium"
    assert rows["FUN_2"]["source_line"] == 9223372036854775807 and rows["FUN_3"]["original_name"] == "f"


def test_nothing_is_cut(spark):
    # a marker, a version and a symbol far behind the sizes the analysed pipeline stops at
    n = 150_000
    filler = spark.range(n).selectExpr("0 as binary_id", "id as ord", "concat('filler ', id) as s")
    strings = filler.unionByName(spark.createDataFrame(
        [(0, n + i, s) for i, s in enumerate(["redis_version", "REDIS_PORT", "appendonly", "redis-cli", " redis 7.2.4"])],
        "binary_id int, ord long, s string"))
    r = I.signature_markers(strings, C.software_catalog(spark)).first()
    assert r["sw_name"] == "redis" and r["n_markers"] == 4 and r["markers"] == "redis_version,REDIS_PORT,appendonly,redis-cli"
    assert I.first_version(I.version_mentions(strings), C.software_catalog(spark)).first()["stop_version"] == "7.2.4"
    symbols = spark.range(6_000).selectExpr("0 as binary_id", "id as ord", "concat('_napi_', id) as symbol")
    assert I.symbol_families(symbols).first()["napi_count"] == 6_000


def test_many_postings_of_a_literal(spark):
    lines = spark.createDataFrame([(0, f"f{i:02}.c", 7, '  log("shared by many files");') for i in range(9)]
                                  + [(0, "g.zig", 3, '  log("only here, once");')],
                                  "tree_id int, rel_path string, line_no int, text string")
    first = {r["literal"]: r for r in M.first_literal_postings(X.source_literals(lines)).collect()}
    assert (first["shared by many files"]["rel_path"], first["shared by many files"]["n_postings"]) == ("f00.c", 9)
    assert M.first_literal_postings(X.source_literals(lines), 3).count() == 1
    cands = spark.createDataFrame([(0, 0, "F", "1", 0, "shared by many files"), (0, 0, "F", "1", 1, "only here, once")],
                                  "binary_id int, tree_id int, func_name string, entry_address string, pos int, literal string")
    best = M.arbitrate(M.anchor_evidence(cands, lines, X.source_literals(lines))).first()
    assert (best["best_file"], best["best_line"]) == ("f00.c", 7)


def test_gate_a_for_a_tree_without_source(spark):
    from binlens.operators import progress as P
    produced = spark.createDataFrame([(0, "a.c", i, "int f(int a) {") for i in range(600)], "tree_id int, rel_path string, line_no int, text string")
    rows = {r["tree_id"]: r for r in P.quality_gates(produced, spark.createDataFrame([(0,), (1,)], "tree_id int")).collect()}
    assert rows[0]["passed"] and rows[1]["failed_gate"] == "A" and rows[1]["message"] == C.GATE_A_MESSAGE


def test_uncovered_functions_go_by_mapped_and_cleaned_names(spark):
    from binlens.operators import progress as P
    produced = spark.createDataFrame([(0, "a.c", 1, "int foo(int a) {"), (0, "a.c", 2, "int real_name(int a) {")],
                                     "tree_id int, rel_path string, line_no int, text string")
    functions = spark.createDataFrame([(0, 0, n) for n in ("_foo", "FUN_1", "bar")], "binary_id int, tree_id int, name string")
    mapped = spark.createDataFrame([(0, "FUN_1", "real_name")], "binary_id int, name string, original_name string")
    assert [r["name"] for r in P.uncovered_functions(functions, produced, mapped).collect()] == ["bar"]


def test_last_row_wins_for_a_duplicate_address(spark):
    from binlens.operators import compose as O
    f = spark.createDataFrame([(0, "a1", "zz", 1), (0, "a1", "aa", 2)], "binary_id int, entry_address string, name string, row_no int")
    assert O.by_address(f).first()["name"] == "aa" and O.by_address(f.drop("row_no")).first()["name"] == "zz"


def test_bundle_segment_by_substring(spark):
    strings = spark.createDataFrame([(0, "x"), (1, "x")], "binary_id int, s string")
    segments = spark.createDataFrame([(0, "__BUN,__bun"), (1, "__TEXT")], "binary_id int, segment_name string")
    got = {r["binary_id"]: r["bundled_format"] for r in U.bundle_format(strings, segments).collect()}
    assert got == {0: "bun", 1: "native"}


def test_metadata_reads_every_app_segment(spark):
    segments = spark.createDataFrame([(0, i, "x" * 201, 201, "app") for i in range(6)] + [(0, 6, "Version: 1.2.3", 14, "app")],
                                     "bundle_id int, seg_no int, segment string, n_chars int, seg_class string")
    assert U.bundle_metadata(segments).first()["app_version"] == "1.2.3"
    assert U.bundle_metadata(segments, first_segments=5).first()["app_version"] is None


def test_patterns_take_linear_time(spark):
    import time
    long = ["a" * 100_000, "a" * 100_000 + "(", "a.b" * 30_000, "static " + "a " * 50_000 + "(", "x/src/" + "a" * 100_000,
            "int" + " " * 100_000 + ";(", "int" + " \t" * 50_000 + ";(", "src/" * 30_000, "src/" * 20_000 + "a.c" + "/src" * 20_000]
    lines = spark.createDataFrame([(0, f"f{i}.c", 1, t) for i, t in enumerate(long)], "tree_id int, rel_path string, line_no int, text string")
    strings = lines.selectExpr("0 as binary_id", "1 as ord", "text as s")
    functions = lines.selectExpr("0 as binary_id", "rel_path as func_name", "'1' as entry_address", "text")
    jobs = [X.definition_line_counts(lines), X.call_sites(lines), X.source_definitions(lines), X.function_literals(functions),
            I.version_mentions(strings), I.build_paths(strings), I.repo_mentions(strings),
            lines.select(M.enclosing_name(F.lit(".c"), F.col("text")))]
    for job in jobs:
        start = time.time()
        job.write.format("noop").mode("overwrite").save()
        assert time.time() - start < 8  # planning and start-up included; quadratic patterns took minutes


def test_linear_patterns_match_the_plain_ones(spark):
    texts = ["foo(bar (x), 3baz(1)", "a.c:12b.c:3 ./x/y.cpp:7:9 .c:1 z..rs:5", "lib-1.2.3 my-lib-v2.0.1 x-1.2", "a/src/b.c lib/src/x/y.z q/src/",
             "if (a) while(b)", "", "(", "::f(::g(", "p+q-r.h:99"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    pairs = [(C.CALL_SITE, C.CALL_SITE_LINEAR), (C.PATH_LINE_REF, C.PATH_LINE_REF_LINEAR),
             (C.VERSION_PATTERNS[1][0], C.VERSION_PATTERNS_LINEAR[1][0]), (C.BUILD_PATH_PATTERNS[2], C.BUILD_PATH_PATTERNS_LINEAR[2])]
    for plain, linear in pairs:
        rows = df.select(F.regexp_extract_all("t", F.lit(plain), 1).alias("a"), F.regexp_extract_all("t", F.lit(linear), 1).alias("b")).collect()
        assert [r["a"] for r in rows] == [r["b"] for r in rows]
    plain = C.BUILD_PATH_PATTERNS[1]
    paths = texts + ["src/a.c", "xsrc/b.h+c", "src/.c src/x..y/z", "src/a.b/src/c.d.", "src/src/a", "é src/ü.c/src/k.l", "src/a.c/src/b", "src/-.+", "src/a. src/b.1"]
    rows = spark.createDataFrame([(t,) for t in paths], "t string").select(
        F.regexp_extract_all("t", F.lit(plain), 1).alias("a"), I.src_paths(F.col("t")).alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows] and sum(len(r["a"]) for r in rows) > 6
    lines = ["int f(", "int  f (int a) {", "int *f(", "int * f\t(x", "int\tf(", "a\tb f(", "f(", " int f(", "int f\u00a0(", "std::vector<int> g(", "int é f(",
             "unsigned  \t long\t(a)", "x  (", "return (a)", "int f;", "", "(", "9a b(", "_a b(c(d", "T & h(", "T &h(", "a  b  c  (", "if (x) foo bar(", "int f() {\r"]
    for pattern in (C.DEFINITION_PATTERNS[".c"], C.DEFINITION_PATTERNS[".cpp"], C.ENCLOSING_PATTERN_OTHER):
        rows = spark.createDataFrame([(t,) for t in lines], "t string").select(
            F.regexp_extract("t", pattern, 1).alias("a"), X.anchored_definition(F.col("t"), pattern).alias("b"), "t").collect()
        assert [(r["t"], r["a"]) for r in rows] == [(r["t"], r["b"]) for r in rows]
    heads = ["static int f(int a) {", "unsigned long g (char *s) {", "int h(void);", "x(1)", "foo bar", "struct s *p(int) ", "ab c()", "a(b)(c)", "int f(a) b)"]
    rows = spark.createDataFrame([(0, "a.c", i, t) for i, t in enumerate(heads)], "tree_id int, rel_path string, line_no int, text string")
    want = rows.where(F.col("text").rlike(C.C_DEFINITION_LINE)).count()
    assert X.definition_line_counts(rows).first()["definitions"] == want > 0


def test_hint_literal_over_a_line_break(spark):
    text = ['say("one error', 'in two lines");', 'get("https://api.example.com/x");'] + ["x" * 60] * 5
    lines = spark.createDataFrame([(0, i + 1, t) for i, t in enumerate(text)], "bundle_id int, line_no int, text string")
    r = U.chunk_hints(lines, U.declaration_chunks(lines)).first()
    assert r["hint_errors"] == ["one error\nin two lines"] and r["hint_urls"] == ["https://api.example.com/x"] and r["hint_keywords"] == []


def scan_by_hand(lines):
    """The greedy scan and the hints of one document, line by line."""
    breaks = [0]
    for i, t in enumerate(lines):
        if i > 0 and re.match(C.CHUNK_BREAK_PATTERN, t.lstrip()) and i - breaks[-1] >= 350:
            breaks.append(i)
    out = {}
    for idx, (a, b) in enumerate(zip(breaks, [*breaks[1:], len(lines)])):
        content = "\n".join(lines[a:b])
        if len(content.strip()) >= 100:
            lits = re.findall(C.SOURCE_LITERAL, content)
            out[idx] = (a + 1, b, len(content.strip()),
                        [x for x in lits if any(w in x.lower() for w in C.HINT_ERROR_WORDS)][:5],
                        [x for x in lits if "/" in x and any(w in x for w in C.HINT_URL_WORDS)][:5],
                        [x for x in lits if any(w in x.lower() for w in C.HINT_KEYWORDS)][:5])
    return out


@pytest.mark.parametrize("fan, block", [(2, 128), (256, 1024)])
def test_chunks_and_hints_against_the_line_by_line_scan(spark, monkeypatch, fan, block):
    # small fans make several levels and small blocks many borders; documents without declarations, with runs of
    # fitting texts over many lines, without any quote, of blanks only and of one line
    monkeypatch.setattr(U, "FAN", fan)
    monkeypatch.setattr(U, "HINT_BLOCK", block)
    rng = random.Random(fan)
    words = ["error", "api/x", "http/", "config", "server", '"', '"', '"', "a b", "long enough text", " ", "invalid", "x" * 70, "é/oauth"]
    docs = []
    for d in range(6):
        rate = (0, 0.02, 0.3, 1, 0.002, 0.01)[d]
        docs.append([("  " * (i % 2) + "function " if rng.random() < rate else "")
                     + "".join(rng.choice(words) for _ in range(rng.choice((0, 0, 1, 3, 5, 9)))) for i in range(rng.choice((1500, 4000)))])
    docs.append(['"fails ten'] * 3000)  # each line's quote ends a literal and the next begins one
    docs.append(['say("an error here"); '] * 400 + [""] * 200 + ['"open'] + ["y" * 200] + ['", "model car"'] + ["  "] * 900)
    docs += [["  "] * 800, ["one"], ["const a = 1;"] * 1100, ["z" * 99], ["z" * 100]]
    rows = [(d, i + 1, t) for d, ls in enumerate(docs) for i, t in enumerate(ls)]
    rng.shuffle(rows)
    lines = spark.createDataFrame(rows, "bundle_id int, line_no int, text string")
    chunks = U.declaration_chunks(lines)
    got = {}
    for r in chunks.join(U.chunk_hints(lines, chunks), ["bundle_id", "idx"]).collect():
        got.setdefault(r["bundle_id"], {})[r["idx"]] = (r["start_line"], r["end_line"], r["chars"], r["hint_errors"],
                                                       r["hint_urls"], r["hint_keywords"])
    want = {d: scan_by_hand(ls) for d, ls in enumerate(docs)}
    assert got == {d: c for d, c in want.items() if c}
    assert sum(len(c) for c in want.values()) > 20 and any("\n" in x for c in want.values() for v in c.values() for x in v[3])


def test_a_bundle_without_lines_has_no_chunks(spark):
    lines = spark.createDataFrame([], "bundle_id int, line_no int, text string")
    chunks = U.declaration_chunks(lines)
    assert chunks.count() == 0 and U.chunk_hints(lines, chunks).count() == 0
    assert U.chunk_document_lines(lines, chunks).count() == 0


def test_chunk_document_lines_start_with_a_header(spark):
    text = ["const a = 1;"] * 400
    lines = spark.createDataFrame([(7, i + 1, t) for i, t in enumerate(text)], "bundle_id int, line_no int, text string")
    rows = U.chunk_document_lines(lines, U.declaration_chunks(lines)).orderBy("idx", "pos").collect()
    by_file = {}
    for r in rows:
        assert r["pos"] == len(by_file.setdefault(r["file"], []))
        by_file[r["file"]].append(r["text"])
    assert by_file == {"chunk_000_L1-L350.js": ["// Chunk 0: lines 1-350 of app_beautified.js", *text[:350]],
                       "chunk_001_L351-L400.js": ["// Chunk 1: lines 351-400 of app_beautified.js", *text[350:]]}


def test_a_bundle_of_a_million_lines_without_declarations(spark):
    # one chunk holds all lines; nothing puts them together
    lines = spark.range(0, 1_000_000, 1, 16).select(
        F.lit(0).alias("bundle_id"), (F.col("id") + 1).cast("int").alias("line_no"),
        F.when(F.col("id") % 9 == 0, F.concat(F.lit('  say("error number '), F.col("id"), F.lit('");'))).otherwise("}").alias("text"))
    chunks = U.cut_lineage(U.declaration_chunks(lines))
    assert [(r["start_line"], r["end_line"]) for r in chunks.collect()] == [(1, 1_000_000)]
    assert U.chunk_hints(lines, chunks).first()["hint_errors"] == [f"error number {9 * i}" for i in range(5)]


def test_propagation_goes_on_until_a_round_adds_nothing(spark):
    # top calls a1, a1 calls a2, ...: each round maps one more; six rounds and one that adds nothing
    text = [(0, "m.c", 100 * i + 1, f"void a{i:02}(void) {{") for i in range(7)]
    text += [(0, "m.c", 100 * i + 2, f"  a{i + 1:02}();") for i in range(6)]
    lines = spark.createDataFrame(text, "tree_id int, rel_path string, line_no int, text string")
    names = ["a00", *[f"FUN_{i}" for i in range(1, 7)]]
    functions = spark.createDataFrame([(0, 0, n, str(i)) for i, n in enumerate(names)],
                                      "binary_id int, tree_id int, name string, entry_address string")
    cg = spark.createDataFrame([(0, a, b) for a, b in zip(names, names[1:])], "binary_id int, caller_name string, callee_name string")
    first = X.first_posting(X.source_definitions(lines))
    direct = M.direct_matches(functions, first, None)
    out = {r["name"]: (r["original_name"], r["match_method"]) for r in M.call_graph_propagate(direct, cg, lines, first).collect()}
    assert out == {"a00": ("a00", "direct_symbol"), **{f"FUN_{i}": (f"a{i:02}", f"callgraph_iter{i}") for i in range(1, 7)}}
    assert M.call_graph_propagate(direct, cg, lines, first, rounds=3).count() == 4


def test_task_order_tiers(spark):
    from binlens.operators import progress as P
    fmap = spark.createDataFrame([(0, "FUN_1", "a1", "z.c", "high"), (0, "FUN_2", "a2", "b.c", "medium"), (0, "FUN_3", "a3", "a.c", "low")],
                                 "binary_id int, ghidra_function_name string, ghidra_address string, source_file string, confidence string")
    functions = spark.createDataFrame([(0, a) for a in ("a1", "a2", "a3", "100001000", "100001010")], "binary_id int, entry_address string")
    clusters = spark.createDataFrame([(0, "2000", 3), (0, "3000", 9)], "binary_id int, prefix string, function_count long")
    got = [(r["tier"], r["group_key"], r["n_functions"]) for r in P.task_order(fmap, clusters, functions).collect()]
    assert got == [(0, "z.c", 1), (1, "b.c", 1), (2, "a.c", 1), (3, "100001", 2), (4, "3000", 9), (4, "2000", 3)]


def test_labels_of_the_latest_cycle_hold(spark):
    from binlens.operators import compose as O
    clusters = spark.createDataFrame([(0, p, 1) for p in ("10", "11", "12", "13", "14")], "binary_id int, prefix string, n long")
    labels = spark.createDataFrame([(0, "10", "custom", 1, 0), (0, "10", "third_party", 2, 0), (0, "11", "third_party", 1, 0), (0, "11", "custom", 3, 0),
                                    (0, "12", "custom", 1, 0), (0, "12", "custom", 2, 5), (0, "13", "custom", 2, 0), (0, "13", "third_party", 2, 1),
                                    (0, "13", None, 3, 0), (1, "14", "third_party", 1, 0)], "binary_id int, prefix string, label string, cycle int, pos int")
    kept = O.triaged_clusters(clusters, labels).collect()
    assert sorted((r["prefix"], r["label"]) for r in kept) == [("11", "custom"), ("12", "custom"), ("14", None)]
    assert O.triaged_clusters(clusters, labels.drop("cycle", "pos")).count() == 5  # one row per cluster


def test_two_rows_of_a_file_give_one_task(spark):
    from binlens.operators import progress as P
    tasks = spark.createDataFrame([("p", "t1", False, "a.c"), ("p", "t2", False, "b.c")], "plan_id string, task_id string, passes boolean, target_file string")
    files = spark.createDataFrame([("a.c", 50), ("a.c", 500), ("b.c", 10), ("b.c", 20)], "path string, size long")
    assert sorted((r["task_id"], r["passes_after"]) for r in P.auto_complete_tasks(tasks, files).collect()) == [("t1", True), ("t2", False)]


def _plain_propagation(mapped, edges, candidates, rounds=None):
    """mapped: name -> (original, key); candidates: name -> its calls in order; every mapped caller takes part in each round."""
    mapped, n = dict(mapped), 0
    while rounds is None or n < rounds:
        n += 1
        used = {o for o, _ in mapped.values()}
        offers = {c: next((x for x in candidates.get(o, []) if x not in used), None) for c, (o, _) in mapped.items()}
        new = {}
        for callee in {b for _, b in edges} - set(mapped):
            first = min(((mapped[a][1], a) for a, b in edges if b == callee and a in mapped and offers[a]), default=None)
            if first:
                new[callee] = (offers[first[1]], f"2{n:06d}{first[0]}\x02{callee}")
        if not new:
            break
        mapped.update(new)
    return {k: v[0] for k, v in mapped.items()}


def test_propagation_by_deltas_equals_rounds_over_everything(spark):
    import random
    r = random.Random(17)
    n = 60
    calls = {i: r.sample(range(n), r.randint(0, 6)) for i in range(n)}
    text = []
    for i in range(n):
        text.append((0, f"s{i % 4}.c", 100 * i + 1, f"void d{i:02}(void) {{"))
        text += [(0, f"s{i % 4}.c", 100 * i + 2 + k, f"  d{c:02}();") for k, c in enumerate(calls[i])]
    lines = spark.createDataFrame(text, "tree_id int, rel_path string, line_no int, text string")
    # a call's line also follows the definition line, whose own name is a candidate as it is for the library
    candidates = {f"d{i:02}": [f"d{i:02}", *(f"d{c:02}" for c in calls[i])] for i in range(n)}
    named = [f"d{i:02}" for i in r.sample(range(n), 8)]
    hidden = [f"FUN_{i:02}" for i in range(40)]
    edges = {(r.choice(named + hidden), r.choice(hidden)) for _ in range(150)}
    functions = spark.createDataFrame([(b, 0, x, f"{i:04}") for b in (1, 2) for i, x in enumerate(named + hidden)],
                                      "binary_id int, tree_id int, name string, entry_address string")
    graph = spark.createDataFrame([(1, a, b) for a, b in edges] + [(2, a, b) for a, b in sorted(edges, reverse=True)[:70]],
                                  "binary_id int, caller_name string, callee_name string")
    first = X.first_posting(X.source_definitions(lines))
    direct = M.direct_matches(functions, first, None)
    start = {x["name"]: (x["original_name"], x["order_key"]) for x in direct.where("binary_id = 1").collect()}
    for rounds in (None, 2):
        out = M.call_graph_propagate(direct, graph, lines, first, rounds).collect()
        for b, part in ((1, edges), (2, set(sorted(edges, reverse=True)[:70]))):
            want = _plain_propagation(start, part, candidates, rounds)
            assert {x["name"]: x["original_name"] for x in out if x["binary_id"] == b} == want
            assert rounds or len(want) > 10


def test_calls_over_line_breaks(spark):
    rows = [("a.c", 1, "  x = helper"), ("a.c", 2, "   (1); other(2); tail "), ("a.c", 4, "\t"), ("a.c", 5, " (3) word"),
            ("a.c", 6, "stop;"), ("a.c", 7, "(cast) last"),
            # from one block to the next, and over blocks without any line
            ("b.c", X.BLOCK - 1, "edge"), ("b.c", X.BLOCK, "(1); far"), ("b.c", 5 * X.BLOCK + 3, "("),
            ("c.c", 1, "no(1) parenthesis"), ("c.c", 2, "here")]
    lines = spark.createDataFrame([(0, *r) for r in rows], "tree_id int, rel_path string, line_no int, text string")
    got = sorted(tuple(r) for r in X.call_sites(lines).select("rel_path", "line_no", "end_line", "pos", "callee_name").collect())
    assert got == [("a.c", 1, 2, 0, "helper"), ("a.c", 2, 2, 0, "other"), ("a.c", 2, 5, 1, "tail"),
                   ("b.c", X.BLOCK - 1, X.BLOCK, 0, "edge"), ("b.c", X.BLOCK, 5 * X.BLOCK + 3, 0, "far"), ("c.c", 1, 1, 0, "no")]
    # the same calls as the plain pattern finds in the joined text
    import re
    for path in ("a.c", "b.c", "c.c"):
        text = {n: t for p, n, t in rows if p == path}
        joined = "\n".join(text.get(i, "") for i in range(1, max(text) + 1))
        names = [g[4] for g in sorted(g for g in got if g[0] == path)]
        assert re.findall(C.CALL_SITE, joined, re.A) == names


def test_callee_window_holds_name_and_parenthesis(spark):
    lines = spark.createDataFrame([(0, "m.c", 10, "void alpha(void) {"), (0, "m.c", 60, "  alpha"), (0, "m.c", 62, "(1);")],
                                  "tree_id int, rel_path string, line_no int, text string")
    first = X.first_posting(X.source_definitions(lines))
    callers = spark.createDataFrame([(0, 0, f"f{n}", f"0{n}", "m.c", n) for n in (11, 12)],
                                    "binary_id int, tree_id int, name string, order_key string, source_file string, source_line long")
    got = [(r["caller_name"], r["line_no"]) for r in M.callee_candidates(callers, M.known_calls(lines, first)).collect() if r["line_no"] == 60]
    assert got == [("f12", 60)]


def test_hot_key_stays_where_it_is_read(spark):
    from binlens.operators.joins import join_unique
    from binlens.session import cut_lineage
    n = 30_000
    rows = cut_lineage(spark.range(0, n, 1, 8).selectExpr("0 as tree_id", "if(id % 3 = 0, 'malloc', concat('f', id)) as name", "id")
                       .unionByName(spark.createDataFrame([(0, None, -1)], "tree_id int, name string, id long")))
    lookup = spark.range(n).selectExpr("0 as tree_id", "concat('f', id) as name", "id as line").unionByName(
        spark.createDataFrame([(0, "malloc", -7)], "tree_id int, name string, line long"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = join_unique(rows, lookup, ["tree_id", "name"], hot_rows=1000)
        plain = rows.join(lookup, ["tree_id", "name"])
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] < 3 * sizes[len(sizes) // 2]
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))
        assert max(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()) >= n // 3
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
