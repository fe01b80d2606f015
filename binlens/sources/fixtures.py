"""Deterministic input tables derived from the driver's parquet tables.

The reference exchanges a handful of tables between its stages (function table, call
graph, per-function text, source tree, strings, symbols, plan, run log).  FIXTURES.md
defines them as SQL views over the driver tables; the same text runs in Spark and in
DuckDB, so each query's oracle can inline exactly the input the Spark job read.

``fx_*`` views are the FIXTURES.md statements.  ``in_*`` views are the keyed inputs the
operators receive: construction-truth columns (``p_partkey``, ``ident``) are dropped and
the partition keys ``binary_id`` / ``tree_id`` are added.  The single-binary fixtures
are binary 0 and source tree 0.
"""

from __future__ import annotations

import hashlib
import os
import re

from pyspark.sql import DataFrame, SparkSession

from binlens.session import path_exists

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

ROW_GROUP = 16 << 20  # bytes in a Parquet row group of a written input

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["fx_functions"] = """
SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN concat('thunk_FUN_', addr)
            WHEN p_partkey % 10 = 1 THEN concat('__', ident)
            WHEN p_partkey % 10 = 2 THEN concat('_ZN', length(ident), ident, 'Ev')
            WHEN p_partkey % 10 = 3 THEN concat('caseD_', p_size)
            WHEN p_partkey % 10 IN (4, 5) THEN concat('_', ident)
            WHEN p_partkey % 10 = 6 THEN ident
            ELSE concat('FUN_', addr) END AS name,
       addr AS entry_address,
       lower(hex(4294967296 + p_partkey * 512 + p_size * 8 - 1)) AS end_address,
       CAST(p_size * 8 AS BIGINT) AS size, p_size % 6 AS param_count,
       CASE WHEN p_size % 2 = 0 THEN 'undefined8' ELSE 'void' END AS return_type,
       'default' AS calling_convention, p_partkey % 10 = 0 AS is_thunk, false AS is_external, ident
FROM (SELECT *, lower(hex(4294967296 + p_partkey * 512)) AS addr,
             concat(replace(p_name, ' ', '_'), '_', p_partkey) AS ident FROM part) p
"""

# every lineitem row is a call; functions with p_partkey % 4 = 0 are called by framework functions only
FIXTURE_SQL["fx_call_graph"] = """
SELECT DISTINCT a.name AS caller_name, a.entry_address AS caller_address,
       b.name AS callee_name, b.entry_address AS callee_address, 'CALL' AS ref_type
FROM (SELECT CASE WHEN dst % 4 = 0 THEN (src - src % 10) % n + 4 ELSE src END AS src, dst
      FROM (SELECT l_partkey AS src, (l_partkey * 31 + l_suppkey * 7 + l_linenumber) % (SELECT count(*) FROM part) AS dst,
                   (SELECT count(*) FROM part) AS n FROM lineitem) q) e
JOIN fx_functions a ON a.p_partkey = e.src JOIN fx_functions b ON b.p_partkey = e.dst
"""

FIXTURE_SQL["fx_source_defs"] = """
SELECT p_partkey, ident, concat('src/', lower(replace(p_brand, '#', '_')), ext) AS rel_path, ext,
       CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) * 8 AS INT) AS line_no
FROM (SELECT p.*, concat(replace(p_name, ' ', '_'), '_', p_partkey) AS ident,
             CASE WHEN CAST(replace(p_brand, 'Brand#', '') AS INT) % 2 = 0 THEN '.zig' ELSE '.cpp' END AS ext FROM part p) q
"""

FIXTURE_SQL["fx_source_lines"] = """
SELECT rel_path, CAST(line_no AS INT) AS line_no, text FROM (
SELECT rel_path, line_no, CASE WHEN ext = '.zig' THEN concat('pub fn ', ident, '(a: u32) void {')
                               ELSE concat('void ', ident, '(int a) {') END AS text FROM fx_source_defs
UNION ALL
SELECT rel_path, line_no + 2, concat('    note("part marker ', p_partkey, '");') FROM fx_source_defs
UNION ALL
SELECT d.rel_path, d.line_no + 3, concat('    ', JOIN_SORTED(concat(t.ident, '(x);')))
FROM fx_source_defs d JOIN fx_functions f ON f.p_partkey = d.p_partkey
JOIN fx_call_graph c ON c.caller_address = f.entry_address
JOIN fx_functions t ON t.entry_address = c.callee_address GROUP BY d.rel_path, d.line_no
UNION ALL
SELECT rel_path, line_no + 4, concat('    check(a); return ', ident) FROM fx_source_defs WHERE p_partkey % 3 = 0
UNION ALL
SELECT rel_path, line_no + 5, '  ' FROM fx_source_defs WHERE p_partkey % 6 = 0
UNION ALL
SELECT rel_path, line_no + 6, '        (x);' FROM fx_source_defs WHERE p_partkey % 3 = 0
) u
"""

FIXTURE_SQL["fx_decompiled"] = """
SELECT f.name AS func_name, f.entry_address,
       CASE WHEN f.p_partkey % 10 = 7 THEN concat('void ', f.name, '(void) { puts("part marker ', f.p_partkey, '"); }')
            WHEN f.p_partkey % 10 = 8 THEN concat('void ', f.name, '(void) { trap("', d.rel_path, ':', d.line_no + 1, '"); }')
            ELSE concat('void ', f.name, '(void) { return; }') END AS text
FROM fx_functions f JOIN fx_source_defs d ON d.p_partkey = f.p_partkey
"""

FIXTURE_SQL["fx_strings"] = """
SELECT CAST(o_orderkey % 20 AS INT) AS binary_id, CAST(o_orderkey AS BIGINT) AS ord,
       CASE o_orderkey % 9
         WHEN 0 THEN CASE WHEN o_orderkey % 20 < 12 THEN concat('see https://github.com/owner', o_orderkey % 3, '/tool', o_orderkey % 5, '.git for docs') ELSE 'no link' END
         WHEN 1 THEN CASE WHEN o_orderkey % 20 < 16 THEN concat('redis-server v7.2.', o_orderkey % 20) ELSE 'no banner' END
         WHEN 2 THEN CASE WHEN o_orderkey % 20 < 8 THEN concat('redis 7.2.', o_orderkey % 20) ELSE concat('other 7.2.', o_orderkey % 20) END
         WHEN 3 THEN concat('Version: 1.', o_orderkey % 20, '.0')
         WHEN 4 THEN concat('src/core/mod', o_orderkey % 11, '.zig')
         WHEN 5 THEN concat('/Users/ci/work/lib', o_orderkey % 13, '.cpp')
         WHEN 6 THEN CASE WHEN o_orderkey % 20 < 16 THEN 'redis_version:%s' ELSE 'printf' END
         WHEN 7 THEN CASE WHEN o_orderkey % 2 = 0 THEN '__cxa_throw std::__1' ELSE 'go.buildid' END
         ELSE concat('plain text ', o_orderkey) END AS s
FROM orders
"""

FIXTURE_SQL["fx_symbols"] = """
SELECT CAST(c_custkey % 20 AS INT) AS binary_id, CAST(c_custkey AS BIGINT) AS ord,
       CASE WHEN c_custkey % 20 < 10 THEN concat('_napi_call_', c_custkey)
            WHEN c_custkey % 20 < 15 THEN concat('_uv_loop_', c_custkey)
            ELSE concat('_node_', c_custkey) END AS symbol FROM customer
"""

FIXTURE_SQL["fx_bundle_lines"] = """
SELECT bundle_id, CAST((rn - 1) * 3 + k AS INT) AS line_no,
       CASE k WHEN 1 THEN concat('function ', ident, '() {')
              WHEN 2 THEN concat('  warn("invalid ', ident, ' config"); get("https://api.example.com/', ident, '");')
              ELSE '}' END AS text
FROM (SELECT CAST(p_partkey % 3 AS INT) AS bundle_id, concat(replace(p_name, ' ', '_'), '_', p_partkey) AS ident,
             row_number() OVER (PARTITION BY p_partkey % 3 ORDER BY p_partkey) AS rn FROM part) q
CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 UNION ALL SELECT 3) t
"""

# the bundles with every line cut in two after 20 characters, so that literals run over a line break
FIXTURE_SQL["fx_bundle_cut_lines"] = """
SELECT bundle_id, CAST(line_no * 2 - 2 + h AS INT) AS line_no, CASE h WHEN 1 THEN substr(text, 1, 20) ELSE substr(text, 21) END AS text
FROM fx_bundle_lines CROSS JOIN (SELECT 1 AS h UNION ALL SELECT 2) t
"""

FIXTURE_SQL["fx_tasks"] = """
SELECT CAST(o_custkey AS BIGINT) AS plan_id, concat('US-', o_orderkey) AS task_id,
       CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority,
       concat('output/src/m', o_orderkey, '.c') AS target_file, o_orderstatus = 'F' AS passes
FROM orders
"""

FIXTURE_SQL["fx_files"] = """
SELECT concat('output/src/m', l_orderkey, '.c') AS path, CAST(sum(l_quantity) AS BIGINT) AS size
FROM lineitem GROUP BY l_orderkey
"""

FIXTURE_SQL["fx_log"] = """
SELECT user_id AS run_id, event_id AS seq,
       CASE event_type WHEN 'error' THEN concat('HTTP 429 Too Many Requests #', event_id)
                       WHEN 'signup' THEN '<promise>CYCLE_DONE</promise>'
                       ELSE concat('step ', event_type, ' ', event_id) END AS line FROM events
"""

# ---- inputs FIXTURES.md lists under "still to add" -------------------------------

# The function map the composition step reads: the functions whose true source is
# framework code (p_partkey % 10 in 4, 5, 6), as FIXTURES.md's properties define it.
FIXTURE_SQL["fx_mapped"] = """
SELECT entry_address AS ghidra_address FROM fx_functions WHERE p_partkey % 10 IN (4, 5, 6)
"""

# What c++filt prints for the fixture's mangled names: _ZN<len><ident>Ev -> <ident>().
FIXTURE_SQL["fx_demangled"] = """
SELECT name, concat(substr(name, 4 + length(CAST(length(ident) AS STRING)), length(ident)), '()') AS demangled_name
FROM fx_functions WHERE p_partkey % 10 = 2
"""

# Tags listed by the repositories the strings point at; some are peeled (^{}).
FIXTURE_SQL["fx_remote_tags"] = """
SELECT DISTINCT concat('https://github.com/owner', o_orderkey % 3, '/tool', o_orderkey % 5, '.git') AS repo_url,
       concat(CASE o_orderkey % 4 WHEN 0 THEN 'v' WHEN 1 THEN 'redis-' ELSE 'x' END, '7.2.', o_orderkey % 20,
              CASE WHEN o_orderkey % 7 = 0 THEN '^{}' ELSE '' END) AS tag
FROM orders
"""

# Segment names of the 20 binaries: every fourth one carries a __BUN segment.
FIXTURE_SQL["fx_segments"] = """
SELECT CAST(c_custkey % 20 AS INT) AS binary_id,
       CASE WHEN c_custkey % 20 % 4 = 0 THEN '__BUN' WHEN c_custkey % 2 = 0 THEN '__TEXT' ELSE '__DATA' END AS segment_name
FROM customer
"""

# Strings of the 20 binaries plus one bundle marker per binary (format = binary_id % 5).
FIXTURE_SQL["fx_format_strings"] = """
SELECT binary_id, ord, s FROM fx_strings
UNION ALL
SELECT CAST(p_partkey % 20 AS INT) AS binary_id, CAST(1000000000 + p_partkey AS BIGINT) AS ord,
       CASE p_partkey % 20 % 5 WHEN 1 THEN concat('NODE_SEA_BLOB ', p_name)
                               WHEN 2 THEN concat('resources/electron.asar ', p_name)
                               WHEN 3 THEN concat('sys._MEIPASS ', p_name)
                               WHEN 4 THEN concat('/snapshot/pkg/prelude ', p_name)
                               ELSE p_name END AS s
FROM part
"""

# Function files already present in the per-function corpus: those with a literal.
FIXTURE_SQL["fx_corpus_files"] = """
SELECT concat(func_name, '_', entry_address, '.c') AS file_name
FROM fx_decompiled WHERE text LIKE '%("%'
"""

# Triage labels for address clusters: an agent labels a cluster by its content; here the
# label follows the last hex digit of the prefix, and prefixes ending in 'f' are unlabelled.
FIXTURE_SQL["fx_triage"] = """
SELECT DISTINCT substr(entry_address, 1, 6) AS prefix,
       CASE WHEN substr(entry_address, 6, 1) IN ('0', '1', '2', '3', '4', '5') THEN 'custom'
            WHEN substr(entry_address, 6, 1) IN ('6', '7', '8', '9', 'a') THEN 'third_party'
            ELSE 'runtime_generated' END AS label
FROM fx_functions WHERE substr(entry_address, 6, 1) <> 'f'
"""

# Source a build produced: the source tree plus the three bundles as JavaScript files.
FIXTURE_SQL["fx_produced_lines"] = """
SELECT rel_path, line_no, text FROM fx_source_lines
UNION ALL
SELECT concat('app/bundle', bundle_id, '.js') AS rel_path, line_no, text FROM fx_bundle_lines
"""

# A source tree in all eight indexed languages, with excluded folders (vendor/, bench/),
# a folder that only looks excluded by substring (latest/ contains test/), qualified C++
# names, keyword-only lines, declarations and literal lines.
FIXTURE_SQL["fx_polyglot_lines"] = """
SELECT rel_path, CAST(row_number() OVER (PARTITION BY rel_path ORDER BY p_partkey, k) AS INT) AS line_no, text
FROM (
  SELECT p_partkey, k,
         concat(CASE p_partkey % 5 WHEN 0 THEN 'vendor/' WHEN 1 THEN 'bench/' WHEN 2 THEN 'latest/' ELSE 'src/' END,
                'm', p_partkey % 13,
                CASE p_partkey % 8 WHEN 0 THEN '.c' WHEN 1 THEN '.h' WHEN 2 THEN '.hpp' WHEN 3 THEN '.rs'
                                   WHEN 4 THEN '.go' WHEN 5 THEN '.swift' WHEN 6 THEN '.zig' ELSE '.cpp' END) AS rel_path,
         CASE WHEN k = 2 THEN concat('    log("', p_name, ' literal");')
              WHEN k = 3 THEN '    if (ready) {'
              WHEN p_partkey % 8 = 0 THEN concat('static int ', ident, '(void) {')
              WHEN p_partkey % 8 = 1 THEN concat('int ', ident, '(int a);')
              WHEN p_partkey % 8 = 2 THEN concat('std::vector<int> ', ident, '(int a);')
              WHEN p_partkey % 8 = 3 THEN concat('    pub fn ', ident, '<T>(x: T) {')
              WHEN p_partkey % 8 = 4 THEN concat('func (s *Server) ', ident, '(x int) {')
              WHEN p_partkey % 8 = 5 THEN concat('  public func ', ident, '(x: Int) {')
              WHEN p_partkey % 8 = 6 THEN concat('export fn ', ident, '() void {')
              WHEN p_size % 2 = 0 THEN concat('void Widget::', ident, '(int a) {')
              ELSE concat('unsigned long ', ident, ' (char *s) {') END AS text
  FROM (SELECT *, concat(replace(p_name, ' ', '_'), '_', p_partkey) AS ident FROM part) p
  CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 UNION ALL SELECT 3) t
) q
"""

# Decoded bundle payloads: per part an app segment with a name comment, a version banner and
# a copyright line, a second segment (builtin for every seventh part) and a short tail, the
# three separated by control characters.
FIXTURE_SQL["fx_bundle_payloads"] = """
SELECT p_partkey AS payload_id,
       concat('// ', p_name, ' is a bundled tool', chr(10),
              'const banner = "Version: 1.', p_size, '.', p_partkey % 10, '";', chr(10),
              '/* (c) ', p_brand, ' Corp. All rights reserved. */', chr(10), repeat('var x = 1; ', 15),
              chr(0),
              CASE WHEN p_partkey % 7 = 0 THEN '@getInternalField ' ELSE '' END,
              'function helper', p_partkey, '() { return 1; } ', repeat('let y = 2; ', 20),
              chr(1), 'tail') AS text
FROM part
"""

# ---- keyed inputs -----------------------------------------------------------------

FIXTURE_SQL["in_functions"] = """
SELECT 0 AS binary_id, 0 AS tree_id, name, entry_address, end_address, size, param_count,
       return_type, calling_convention, is_thunk, is_external FROM fx_functions
"""
FIXTURE_SQL["in_call_graph"] = """
SELECT 0 AS binary_id, caller_name, caller_address, callee_name, callee_address, ref_type FROM fx_call_graph
"""
FIXTURE_SQL["in_source_lines"] = """
SELECT 0 AS tree_id, rel_path, line_no, text FROM fx_source_lines
"""
FIXTURE_SQL["in_decompiled"] = """
SELECT 0 AS binary_id, func_name, entry_address, text FROM fx_decompiled
"""
FIXTURE_SQL["in_mapped"] = """
SELECT 0 AS binary_id, ghidra_address FROM fx_mapped
"""
FIXTURE_SQL["in_demangled"] = """
SELECT 0 AS binary_id, name, demangled_name FROM fx_demangled
"""
FIXTURE_SQL["in_polyglot_lines"] = """
SELECT 1 AS tree_id, rel_path, line_no, text FROM fx_polyglot_lines
"""
FIXTURE_SQL["in_produced_lines"] = """
SELECT 0 AS tree_id, rel_path, line_no, text FROM fx_produced_lines
"""
FIXTURE_SQL["in_corpus_files"] = """
SELECT 0 AS binary_id, file_name FROM fx_corpus_files
"""
FIXTURE_SQL["in_triage"] = """
SELECT 0 AS binary_id, prefix, label FROM fx_triage
"""

# views that several inputs are built from: written once, the others read the copy
SHARED = ("fx_functions", "fx_source_defs", "fx_bundle_lines")

# views whose rows stand in a written input, less the input's key: read from that copy
COPIES = {"fx_source_lines": ("in_source_lines", "tree_id"), "fx_call_graph": ("in_call_graph", "binary_id")}

# The rows of a view by a statement that moves less: calls are told apart by their two keys before names are joined,
# and functions by key, name and address (an address stands for one key), so the result has no equal rows.
SPARK_SQL = {"fx_call_graph": """
SELECT a.name AS caller_name, a.entry_address AS caller_address,
       b.name AS callee_name, b.entry_address AS callee_address, 'CALL' AS ref_type
FROM (SELECT DISTINCT src, dst
      FROM (SELECT /*+ REPARTITION(src) */ CASE WHEN dst % 4 = 0 THEN (src - src % 10) % n + 4 ELSE src END AS src, dst
            FROM (SELECT l_partkey AS src, (l_partkey * 31 + l_suppkey * 7 + l_linenumber) % (SELECT count(*) FROM part) AS dst,
                         (SELECT count(*) FROM part) AS n FROM lineitem) q) r) e
JOIN (SELECT DISTINCT p_partkey, name, entry_address FROM fx_functions) a ON a.p_partkey = e.src
JOIN (SELECT DISTINCT p_partkey, name, entry_address FROM fx_functions) b ON b.p_partkey = e.dst
"""}

_REF = re.compile(r"\b((?:fx|in)_[a-z_]+)\b")


# JOIN_SORTED(x): the group's values in order, a blank between; the two dialects spell it differently
_JOIN_SORTED = {"spark": "array_join(sort_array(collect_list({0})), ' ')", "duckdb": "array_to_string(list_sort(list({0})), ' ')"}


def dialect(sql: str, name: str) -> str:
    return re.sub(r"JOIN_SORTED\((concat\([^()]*(?:\([^()]*\)[^()]*)*\))\)", lambda m: _JOIN_SORTED[name].format(m[1]), sql)


def dependencies(sql: str) -> list[str]:
    """Fixture views a SQL text refers to, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _REF.findall(FIXTURE_SQL[name]):
            if dep != name and dep in FIXTURE_SQL:
                visit(dep)
        order.append(name)

    for name in _REF.findall(sql):
        if name in FIXTURE_SQL:
            visit(name)
    return order


def with_fixtures(sql: str) -> str:
    """Prefix ``sql`` (a SELECT, optionally starting with WITH) with the fixture CTEs it uses."""
    deps = dependencies(sql)
    if not deps:
        return sql
    ctes = ",\n".join(f"{n} AS ({dialect(FIXTURE_SQL[n], 'duckdb').strip()})" for n in deps)
    body = sql.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


class Inputs:
    """Keyed input tables for one scale factor.

    With ``cache_dir`` each table is computed once, written as Parquet and read back, so
    a benchmark times the operators rather than the derivation of their inputs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, cache_dir: str | None = None, share_derived: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cache_dir = cache_dir
        self.share_derived = share_derived
        self._memo: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    def _register_base(self) -> None:
        for t in BASE_TABLES:
            path = os.path.join(self.sf_dir, f"{t}.parquet")
            if path_exists(self.spark, path):
                self.spark.read.parquet(path).createOrReplaceTempView(t)

    def table(self, name: str) -> DataFrame:
        if name in self._memo:
            return self._memo[name]
        if self.cache_dir:
            # keyed by the SQL of the table and everything it reads, so an edited view is
            # never served from an older copy
            digest = hashlib.sha1("\n".join(SPARK_SQL.get(d, FIXTURE_SQL[d]) for d in dependencies(name)).encode()).hexdigest()[:12]
            path = os.path.join(self.cache_dir, f"{name}_{digest}")
            if not path_exists(self.spark, f"{path}/_SUCCESS"):
                # small row groups: the work on a line of text is many times its compressed bytes
                self._derive(name).write.mode("overwrite").option("parquet.block.size", ROW_GROUP).option("compression", "zstd").parquet(path)
            df = self.spark.read.parquet(path)
        else:
            df = self._derive(name)
        self._memo[name] = df
        return df

    def _derive(self, name: str) -> DataFrame:
        deps, written = dependencies(name), {}
        if self.cache_dir:
            written = {d: self.table(d) for d in deps if d in SHARED and d != name}
            written |= {d: self.table(t).drop(key) for d, (t, key) in COPIES.items() if d in deps and name not in (d, t)}
        self._register_base()
        df = None
        for dep in deps:
            df = written[dep] if dep in written else self.spark.sql(dialect(SPARK_SQL.get(dep, FIXTURE_SQL[dep]), "spark"))
            df.createOrReplaceTempView(dep)
        return df

    def derived(self, name: str, build) -> DataFrame:
        """A result that several queries share, written once per application."""
        if not self.share_derived:
            return build()
        if name not in self._memo:
            path = os.path.join(self.cache_dir or "", f"{name}_{self.spark.sparkContext.applicationId}")
            if not self.cache_dir:
                self._memo[name] = build()
            else:
                if not path_exists(self.spark, f"{path}/_SUCCESS"):
                    build().write.mode("overwrite").parquet(path)
                self._memo[name] = self.spark.read.parquet(path)
        return self._memo[name]

    # named accessors used by the query plans
    def functions(self) -> DataFrame:
        return self.table("in_functions")

    def call_graph(self) -> DataFrame:
        return self.table("in_call_graph")

    def source_lines(self) -> DataFrame:
        return self.table("in_source_lines")

    def decompiled(self) -> DataFrame:
        return self.table("in_decompiled")

    def mapped(self) -> DataFrame:
        return self.table("in_mapped")

    def strings(self) -> DataFrame:
        return self.table("fx_strings")

    def symbols(self) -> DataFrame:
        return self.table("fx_symbols")
