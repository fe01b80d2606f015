"""Function -> source mapping.

Three evidence stages, each a set of joins keyed by (binary_id, name) or (tree_id, file):

* direct symbols (J1/J2): equi-join of function names with the first definition (A9);
* string anchors (J3-J6): function literals joined with source literals and files, then
  arbitrated per function and placed with a band join on (file, line bucket);
* call-graph propagation (J10): rounds of joins until one adds nothing; each round is a set
  operation because the used-name filter is fixed at round start.  Source text is read once,
  for the table of calls; the rounds move only names, lines and positions.

Precedence (U3): a later stage never replaces an earlier mapping.  Ordering ties use a
declared total order carried in ``order_key`` (stage digit, address or caller key, name),
compared bytewise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binlens.functions import catalog as C
from binlens.functions import names as N
from binlens.operators import text as X
from binlens.operators.joins import join_unique
from binlens.session import cut_lineage, let_go

B, T = "binary_id", "tree_id"
BUCKET = 64  # lines per band-join bucket; windows here span at most 55 lines
FARTHEST_LINE = 1 << 62  # line numbers come from text; beyond this the window's end would overflow
MAP_COLS = [B, T, "name", "source_file", "source_line", "confidence", "match_method",
            "original_name", "source_language", "order_key"]


def bucketed(rows: DataFrame) -> DataFrame:
    """Rows of source lines keyed for band joins: (tree_id, rel_path, line_no div BUCKET)."""
    return rows.withColumn("_b", F.expr(f"line_no div {BUCKET}"))


def in_buckets(windows: DataFrame) -> DataFrame:
    """Windows ``lo`` to ``hi``, once for each of the (at most two) buckets they span."""
    return windows.withColumn("_b", F.explode(F.sequence(F.expr(f"lo div {BUCKET}"), F.expr(f"hi div {BUCKET}"))))


def band_join(windows: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs (window, row) with ``lo <= line_no <= hi`` on the same (tree_id, rel_path).

    Both sides are keyed by ``line_no div BUCKET`` as well, so one very large file is
    spread over many join keys; a window explodes into the (at most two) buckets it spans.
    ``rows`` holds what was found in the lines, never their text.
    """
    return (in_buckets(windows).join(bucketed(rows), [T, "rel_path", "_b"])
            .where((F.col("line_no") >= F.col("lo")) & (F.col("line_no") <= F.col("hi")))
            .drop("_b"))


def window_around(line: str, before: int, after: int) -> tuple[Column, Column]:
    """(lo, hi) of the lines from ``before`` above to ``after`` below; null for a null line."""
    at = F.least(F.col(line).cast("bigint"), F.lit(FARTHEST_LINE))
    return F.greatest(F.lit(1), at - before).alias("lo"), (at + after).alias("hi")


def binary_trees(functions: DataFrame) -> DataFrame:
    return functions.select(B, T).distinct()


# ---- stage 1: symbols -------------------------------------------------------------

def direct_matches(functions: DataFrame, first: DataFrame, demangled: DataFrame | None) -> DataFrame:
    """J1 then J2 for every named (non-auto) function, one row per name; ``first`` is a written table, read for both."""
    fnames = (functions.where(~N.is_auto_name("name"))
              .groupBy(B, T, "name").agg(F.min("entry_address").alias("first_addr")))
    key = F.concat(F.lit("0"), F.col("first_addr"), F.lit("\x01"), F.col("name"))
    j1 = (fnames.withColumn("original_name", N.clean_name("name"))
          .join(first.withColumnRenamed("name", "original_name"), [T, "original_name"])
          .select(B, T, "name", F.col("def_file").alias("source_file"), F.col("def_line").alias("source_line"),
                  F.lit("high").alias("confidence"), F.lit("direct_symbol").alias("match_method"),
                  "original_name", F.col("def_lang").alias("source_language"), key.alias("order_key")))
    if demangled is None:
        return j1
    j2 = (fnames.join(j1.select(B, "name"), [B, "name"], "left_anti")
          .join(demangled.select(B, "name", "demangled_name"), [B, "name"])
          .where((F.col("demangled_name") != F.col("name")) & (F.length("demangled_name") > 0))
          .withColumn("original_name", N.symbol_tail("demangled_name"))
          .join(first.withColumnRenamed("name", "original_name"), [T, "original_name"])
          .select(B, T, "name", F.col("def_file").alias("source_file"), F.col("def_line").alias("source_line"),
                  F.lit("medium").alias("confidence"), F.lit("demangled_symbol").alias("match_method"),
                  "original_name", F.col("def_lang").alias("source_language"), key.alias("order_key")))
    return j1.unionByName(j2)


# ---- stage 2: string anchors -------------------------------------------------------

def first_literal_postings(source_lits: DataFrame, max_postings: int | None = None) -> DataFrame:
    """First posting (in index order) of every literal, with the number of its postings.

    Later postings of a literal can neither be a function's first evidence nor overwrite one,
    so the first is all that arbitration needs; both are partial aggregates, however often
    a literal occurs.  ``max_postings`` leaves out literals that occur more often (the analysed
    pipeline uses 3); by default none is left out.
    """
    order = F.struct(N.ext_rank("ext", tuple(C.LITERAL_EXTENSIONS)).alias("e"), F.col("rel_path"), F.col("line_no"), F.col("pos"))
    first = (source_lits.groupBy(T, "literal")
             .agg(F.count(F.lit(1)).alias("n_postings"), F.min_by(F.struct("rel_path", "line_no"), order).alias("p"))
             .select(T, "literal", "n_postings", "p.*"))
    return first if max_postings is None else first.where(F.col("n_postings") <= max_postings)


def anchor_evidence(cands: DataFrame, lines: DataFrame, source_lits: DataFrame,
                    max_postings: int | None = None) -> DataFrame:
    """J4 (path refs resolved to files) and J3 (literal postings) as evidence rows.

    Each row: (binary_id, tree_id, func_name, entry_address, seq, file, line, overwrite).
    ``seq`` orders rows as the reference visits them: by literal position, a path ref
    before the literal match of the same string.  ``cands`` is a written table, read for both;
    a literal that a third of all functions share does not go to one task.
    """
    files = lines.select(T, "rel_path").distinct()
    by_base = (files.groupBy(T, N.path_basename("rel_path").alias("base"))
               .agg(F.min("rel_path").alias("alt_path")))
    refs = X.path_line_refs(cands)
    path_ev = (refs
               .join(files.select(T, F.col("rel_path").alias("ref_path"), F.lit(True).alias("_exact")),
                     [T, "ref_path"], "left")
               .withColumn("base", N.path_basename("ref_path"))
               .join(by_base, [T, "base"], "left")
               .withColumn("file", F.when(F.col("_exact"), F.col("ref_path")).otherwise(F.col("alt_path")))
               .where(F.col("file").isNotNull() & F.col("ref_line").isNotNull())
               .select(B, T, "func_name", "entry_address",
                       F.struct(F.col("pos"), F.lit(0).alias("k"), F.lit(0).alias("r")).alias("seq"),
                       "file", F.col("ref_line").alias("line"), F.lit(True).alias("overwrite")))
    lit_ev = (join_unique(cands, first_literal_postings(source_lits, max_postings), [T, "literal"])
              .select(B, T, "func_name", "entry_address",
                      F.struct(F.col("pos"), F.lit(1).alias("k"), F.lit(1).alias("r")).alias("seq"),
                      F.col("rel_path").alias("file"), F.col("line_no").cast("bigint").alias("line"),
                      (F.col("n_postings") == 1).alias("overwrite")))
    return path_ev.unionByName(lit_ev)


def arbitrate(evidence: DataFrame) -> DataFrame:
    """The first file any evidence names wins; its line is the last overwriting
    evidence for that file, else the line of that first evidence.

    One scan of the evidence: a partial aggregate per (function, file), then one per
    function picking the file whose first evidence comes first."""
    keys = [B, T, "func_name", "entry_address"]
    per_file = (evidence.groupBy(*keys, "file")
                .agg(F.min("seq").alias("first_seq"),
                     F.min_by("line", "seq").alias("first_line"),
                     F.max_by(F.when(F.col("overwrite"), F.col("line")),
                              F.when(F.col("overwrite"), F.col("seq"))).alias("ow_line")))
    best = (per_file.groupBy(*keys)
            .agg(F.min_by(F.struct("file", "first_line", "ow_line"), F.col("first_seq")).alias("b")))
    return best.select(*keys, F.col("b.file").alias("best_file"),
                       F.coalesce("b.ow_line", "b.first_line").alias("best_line"))


def enclosing_name(ext, text):
    """Name the 'function at line' patterns capture ('' if none): the zig pattern anywhere
    in .zig files, the anchored C-like pattern in every other file; no name filter."""
    zig = F.regexp_extract(text, C.ENCLOSING_PATTERN_ZIG, 1)
    return F.when(ext == ".zig", zig).otherwise(X.anchored_definition(text, C.ENCLOSING_PATTERN_OTHER))


def enclosing_definition(anchors: DataFrame, lines: DataFrame) -> DataFrame:
    """First definition within lines [L-19, L+5] of the anchored file (band join).

    The pattern runs in the scan, on the head of each line; the join moves the names of the
    lines that define something, never text."""
    keys = [B, T, "func_name", "entry_address"]
    lo, hi = window_around("best_line", 19, 5)
    wins = anchors.where(F.col("best_line").isNotNull()).select(*keys, F.col("best_file").alias("rel_path"), lo, hi)
    named = (lines.select(T, "rel_path", "line_no", X.once(enclosing_name(N.path_ext("rel_path"), F.col("text"))).alias("def_name"))
             .where(F.length("def_name") > 0))
    return band_join(wins, named).groupBy(*keys).agg(F.min_by("def_name", "line_no").alias("enclosing_name"))


def string_anchor_matches(functions: DataFrame, decompiled: DataFrame, lines: DataFrame,
                          direct: DataFrame) -> DataFrame:
    """J3-J6 for every function with literals that stage 1 did not map."""
    lits = X.function_literals(decompiled)
    cands = cut_lineage(lits.join(direct.select(B, F.col("name").alias("func_name")), [B, "func_name"], "left_anti")
                        .join(binary_trees(functions), [B]))
    source_lits = X.source_literals(lines)
    anchors = arbitrate(anchor_evidence(cands, lines, source_lits))
    encl = enclosing_definition(anchors, lines)
    keys = [B, T, "func_name", "entry_address"]
    return (anchors.join(encl, keys, "left")
            .select(B, T, F.col("func_name").alias("name"), F.col("best_file").alias("source_file"),
                    F.col("best_line").alias("source_line"),
                    F.when(F.col("enclosing_name").isNotNull(), "high").otherwise("medium").alias("confidence"),
                    F.lit("string_anchor").alias("match_method"),
                    F.coalesce("enclosing_name", "func_name").alias("original_name"),
                    N.language_of_ext(N.path_ext("best_file"), with_hpp=False).alias("source_language"),
                    F.concat(F.lit("1"), F.col("entry_address"), F.lit("\x01"), F.col("func_name")).alias("order_key")))


# ---- stage 3: call-graph propagation ----------------------------------------------

def call_names(lines: DataFrame) -> DataFrame:
    """Every call in the source by its name, written: (tree_id, rel_path, line_no, end_line, pos, cand_name)."""
    return cut_lineage(X.call_sites(lines.select(T, "rel_path", "line_no", "text")).withColumnRenamed("callee_name", "cand_name"))


def known_calls(lines: DataFrame, first: DataFrame) -> DataFrame:
    """Every call in the source that names a known definition, with that definition's first
    posting: (tree_id, rel_path, line_no, end_line, pos, cand_name, def_*), without text.

    The calls are written first; a name that is called everywhere does not go to one task."""
    return join_unique(call_names(lines), first.withColumnRenamed("name", "cand_name"), [T, "cand_name"])


def call_windows(callers: DataFrame) -> DataFrame:
    """J7's window of each caller: lines [L-4, L+50] of its mapped file."""
    lo, hi = window_around("source_line", 4, 50)
    return callers.select(B, T, F.col("name").alias("caller_name"), F.col("order_key").alias("caller_key"),
                          F.col("source_file").alias("rel_path"), lo, hi).where(F.col("hi").isNotNull())


def callee_candidates(callers: DataFrame, calls: DataFrame) -> DataFrame:
    """The known calls in lines [L-4, L+50] of each caller's mapped file, ordered by (line, pos); both the name
    and the parenthesis have to stand there."""
    return band_join(call_windows(callers), calls).where(F.col("end_line") <= F.col("hi")).drop("lo", "hi", "rel_path", "end_line")


def open_names(first: DataFrame, mapped: DataFrame) -> DataFrame:
    """(tree_id, name) of the definitions that some binary mapped to their tree has not used: names that all of them
    have used stay used, so no round needs the calls of such a name."""
    pairs = mapped.select(B, T).distinct()
    used = (mapped.select(B, F.col("original_name").alias("name")).distinct().join(F.broadcast(pairs), [B])
            .groupBy(T, "name").agg(F.count(F.lit(1)).alias("_used")))
    binaries = pairs.groupBy(T).agg(F.count(F.lit(1)).alias("_all"))
    return (first.select(T, "name").join(F.broadcast(binaries), [T]).join(used, [T, "name"], "left")
            .where(F.coalesce("_used", F.lit(0)) < F.col("_all")).select(T, "name"))


def open_calls(lines: DataFrame, first: DataFrame, mapped: DataFrame) -> DataFrame:
    """Every call in the source that names a known definition with a use left, written without text or posting:
    (tree_id, rel_path, line_no, end_line, pos, cand_name)."""
    sites = call_names(lines)
    calls = cut_lineage(join_unique(sites, open_names(first, mapped).withColumnRenamed("name", "cand_name"), [T, "cand_name"]))
    let_go(sites)
    return calls


def offers(callers: DataFrame, used: Callable[[DataFrame], DataFrame], calls: DataFrame,
           written: bool) -> tuple[DataFrame, list[DataFrame]]:
    """Each caller's first candidate (J7) that its binary has not used, and the tables written for it.

    A call of a used name goes before it meets the windows: windows overlap, so a call stands in many of them, but it is
    looked up once for each binary that has a window in the call's bucket.  A task that holds a bucket keeps one candidate
    a window.  ``used`` gives the used names for the calls to look up, which are ``written`` if it reads them."""
    windows = in_buckets(call_windows(callers))
    near = windows.select(B, T, "rel_path", "_b").distinct().join(bucketed(calls), [T, "rel_path", "_b"])
    tables = [near := cut_lineage(near)] if written else []
    left = near.join(used(near), [B, "cand_name"], "left_anti")
    return (windows.join(left, [B, T, "rel_path", "_b"])
            .where((F.col("line_no") >= F.col("lo")) & (F.col("line_no") <= F.col("hi")) & (F.col("end_line") <= F.col("hi")))
            .groupBy(B, T, "caller_name", "caller_key").agg(F.min_by("cand_name", F.struct("line_no", "pos")).alias("cand_name"))), tables


def propagation_round(fresh: DataFrame, state: DataFrame, edges: DataFrame, calls: DataFrame, first: DataFrame, n: int) -> DataFrame:
    """One round of J10 by deltas; returns the new mappings only, written.

    ``fresh`` are the mappings of the round before (all of them in the first), ``state`` all so far, ``edges`` lead to
    FUN_ callees.  Only fresh callers can map anything: an older caller that still has an unused candidate
    had one in every round since it was mapped, so all its callees are mapped, and one that has none
    gets none, since used names only grow.  A round therefore joins the edges and the candidates of fresh callers,
    and of ``state`` only the names that these two mention."""
    reached = cut_lineage(edges.join(fresh.select(B, F.col("name").alias("caller_name")).distinct(), [B, "caller_name"], "left_semi"))
    callers = fresh.join(reached.select(B, F.col("caller_name").alias("name")).distinct(), [B, "name"], "left_semi")
    known, used = state.select(B, F.col("name").alias("callee_name")), state.select(B, F.col("original_name").alias("cand_name")).distinct()
    # each caller offers its first unused candidate to all its unmapped FUN_ callees
    offer, tables = offers(callers, lambda near: _mentioned(used, near) if n > 1 else used, calls, n > 1)
    open_edges = reached.join(_mentioned(known, reached) if n > 1 else known, [B, "callee_name"], "left_anti")
    # each callee takes the offer of the first mapped caller (in mapping order)
    best = (open_edges.join(offer, [B, "caller_name"]).groupBy(B, T, "callee_name")
            .agg(F.min_by(F.struct("cand_name", "caller_key"), F.col("caller_key")).alias("b")))
    found = cut_lineage(
        best.select(B, T, "callee_name", "b.*").join(first.withColumnRenamed("name", "cand_name"), [T, "cand_name"]).select(
            B, T, F.col("callee_name").alias("name"), F.col("def_file").alias("source_file"),
            F.col("def_line").cast("bigint").alias("source_line"), F.lit("low").alias("confidence"),
            F.lit(f"callgraph_iter{n}").alias("match_method"), F.col("cand_name").alias("original_name"),
            F.col("def_lang").alias("source_language"),
            F.concat(F.lit(f"2{n:06d}"), F.col("caller_key"), F.lit("\x02"), F.col("callee_name")).alias("order_key")))
    let_go(reached, *tables)
    return found


def _mentioned(names: DataFrame, rows: DataFrame) -> DataFrame:
    """The names (columns of ``names``) that occur in ``rows``: few names are sent to many, never the many shuffled."""
    return names.join(rows.select(*names.columns).distinct(), names.columns, "left_semi")


def call_graph_propagate(mapped: DataFrame, call_graph: DataFrame, lines: DataFrame, first: DataFrame,
                         rounds: int | None = None) -> DataFrame:
    """Rounds until one adds nothing (``rounds`` stops earlier; the analysed pipeline uses 3).

    The calls are found once, and a caller's edges and candidates are looked up once, in the round after it is
    mapped.  Edges to callees that are mapped at the start and calls of names that are used by then are of no
    use to any round and not kept.  Each round's new mappings are written to the session's checkpoint folder, so lineage
    stays short and a lost executor only costs the current round; what only a round reads is deleted after it."""
    state = fresh = cut_lineage(mapped.select(*MAP_COLS).withColumn("source_line", F.col("source_line").cast("bigint")))
    edges = call_graph.where(F.col("callee_name").startswith("FUN_")).select(B, "caller_name", "callee_name").distinct()
    edges = cut_lineage(edges.join(state.select(B, F.col("name").alias("callee_name")), [B, "callee_name"], "left_anti"))
    calls = open_calls(lines, first, state)
    n = 0
    while rounds is None or n < rounds:
        n += 1
        fresh = propagation_round(fresh, state, edges, calls, first, n)
        if fresh.isEmpty():
            break
        state = state.unionByName(fresh)
    let_go(edges, calls)
    return state


def map_functions(functions: DataFrame, call_graph: DataFrame, decompiled: DataFrame, lines: DataFrame,
                  demangled: DataFrame | None = None, rounds: int | None = None) -> DataFrame:
    """All mappings by precedence: symbols > string anchors > call graph."""
    first = cut_lineage(X.first_posting(X.source_definitions(lines)))
    direct = cut_lineage(direct_matches(functions, first, demangled))
    anchored = string_anchor_matches(functions, decompiled, lines, direct)
    stage12 = direct.unionByName(anchored.select(*MAP_COLS))
    return call_graph_propagate(stage12, call_graph, lines, first, rounds)


# ---- outputs ------------------------------------------------------------------------

def function_map(functions: DataFrame, mappings: DataFrame) -> DataFrame:
    """J11 (S11 rows): every function row whose name is mapped; duplicate names all
    receive the mapping (Q12)."""
    m = mappings.select(B, "name", "source_file", "source_line", "confidence", "match_method",
                        "original_name", "source_language")
    return (functions.select(B, "name", "entry_address").join(m, [B, "name"])
            .select(B, F.col("name").alias("ghidra_function_name"), F.col("entry_address").alias("ghidra_address"),
                    "source_file", "source_line", "confidence", "match_method", "original_name", "source_language"))


def helper_aliases(mappings: DataFrame) -> DataFrame:
    """U4: FUN_ names whose original name differs (string anchors), and every
    propagated name (call graph)."""
    fun = F.col("name").startswith("FUN_")
    cond = ((F.col("match_method") == "string_anchor") & fun & (F.col("original_name") != F.col("name"))) | \
        F.col("match_method").startswith("callgraph_iter")
    return mappings.where(cond).select(B, F.col("name").alias("ghidra_name"), "original_name")


def mapping_stats(functions: DataFrame, mappings: DataFrame) -> DataFrame:
    """A6 totals: functions, mapped names, coverage % (2 decimals), aliases."""
    tot = functions.groupBy(B).agg(F.count(F.lit(1)).alias("total_functions"))
    mapped = mappings.groupBy(B).agg(F.count(F.lit(1)).alias("mapped_functions"))
    al = helper_aliases(mappings).groupBy(B).agg(F.count(F.lit(1)).alias("aliases"))
    return (tot.join(mapped, [B], "left").join(al, [B], "left")
            .select(B, "total_functions",
                    F.coalesce("mapped_functions", F.lit(0)).alias("mapped_functions"),
                    F.round(F.coalesce("mapped_functions", F.lit(0)) / F.greatest("total_functions", F.lit(1)) * 100, 2)
                    .alias("coverage_percent"),
                    F.coalesce("aliases", F.lit(0)).alias("aliases")))


def mapping_breakdown(mappings: DataFrame) -> DataFrame:
    """A6 counters: by method, by confidence, by language — one grouping-sets pass."""
    g = (mappings.groupingSets([[B, "match_method"], [B, "confidence"], [B, "source_language"]],
                               B, "match_method", "confidence", "source_language")
         .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid")))
    # grouping_id bits (binary_id, match_method, confidence, source_language): 1 = rolled up
    gid = F.col("gid")
    dim = F.when(gid == 3, "by_method").when(gid == 5, "by_confidence").otherwise("by_language")
    value = (F.when(gid == 3, F.col("match_method")).when(gid == 5, F.col("confidence"))
             .otherwise(F.col("source_language")))
    return g.select(B, dim.alias("dimension"), value.alias("value"), "n")
