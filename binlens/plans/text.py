"""Queries over source lines and function text: the indexes the mapping needs."""

from __future__ import annotations

from pyspark.sql import functions as F

from binlens.operators import text as X
from binlens.plans.registry import query
from binlens.plans.sqlparts import TEXT_CTE


@query("source_definitions", f"""
WITH {TEXT_CTE}
SELECT tree_id, rel_path, line_no, name, lang, ext FROM defs
""")
def source_definitions(inp):
    return X.source_definitions(inp.source_lines())


@query("first_posting", f"""
WITH {TEXT_CTE}
SELECT * FROM first_def
""")
def first_posting(inp):
    return X.first_posting(X.source_definitions(inp.source_lines()))


@query("definition_postings", f"""
WITH {TEXT_CTE}
SELECT tree_id, name, rel_path, line_no, lang, ext, count(*) OVER (PARTITION BY tree_id, name) AS n_postings FROM defs
""")
def definition_postings(inp):
    return X.definition_postings(X.source_definitions(inp.source_lines()))


@query("source_literals", f"""
WITH {TEXT_CTE}
SELECT * FROM slit
""")
def source_literals(inp):
    return X.source_literals(inp.source_lines())


@query("literal_postings", f"""
WITH {TEXT_CTE}
SELECT *, count(*) OVER (PARTITION BY tree_id, literal) AS n_postings FROM slit
""")
def literal_postings(inp):
    return X.literal_postings(X.source_literals(inp.source_lines()))


@query("call_sites", f"""
WITH {TEXT_CTE}
SELECT tree_id, rel_path, line_no, end_line, pos, cname AS callee_name FROM calls
""")
def call_sites(inp):
    return X.call_sites(inp.source_lines())


@query("function_literals", f"""
WITH {TEXT_CTE}
SELECT * FROM flit
""")
def function_literals(inp):
    return X.function_literals(inp.decompiled())


@query("path_line_refs", rf"""
WITH {TEXT_CTE}
SELECT *, regexp_extract(literal, '^([\w./+-]+\.\w{{1,4}}):(\d+)', 1) AS ref_path,
       TRY_CAST(regexp_extract(literal, '^([\w./+-]+\.\w{{1,4}}):(\d+)', 2) AS INTEGER) AS ref_line
FROM flit WHERE regexp_matches(literal, '^([\w./+-]+\.\w{{1,4}}):(\d+)')
""")
def path_line_refs(inp):
    return X.path_line_refs(X.function_literals(inp.decompiled()))


@query("corpus_function_keys", """
SELECT binary_id, file_name,
       CASE WHEN contains(regexp_replace(file_name, '\\.c$', ''), '_')
            THEN regexp_extract(regexp_replace(file_name, '\\.c$', ''), '^(.*)_[^_]*$', 1)
            ELSE regexp_replace(file_name, '\\.c$', '') END AS func_key
FROM in_corpus_files
""")
def corpus_function_keys(inp):
    """Function key of each per-function corpus file name."""
    files = inp.table("in_corpus_files")
    return files.select("binary_id", "file_name", X.corpus_function_key(F.col("file_name")).alias("func_key"))


POLY_CTE = TEXT_CTE.replace("in_source_lines", "in_polyglot_lines")


@query("polyglot_definitions", f"""
WITH {POLY_CTE}
SELECT tree_id, rel_path, line_no, name, lang, ext FROM defs
""")
def polyglot_definitions(inp):
    """X1 (+ P6, P7) over a tree in all eight languages with excluded folders."""
    return X.source_definitions(inp.table("in_polyglot_lines"))


@query("polyglot_first_posting", f"WITH {POLY_CTE} SELECT * FROM first_def")
def polyglot_first_posting(inp):
    return X.first_posting(X.source_definitions(inp.table("in_polyglot_lines")))


@query("polyglot_literals", f"WITH {POLY_CTE} SELECT * FROM slit")
def polyglot_literals(inp):
    """X4 over the same tree: .hpp files are not in the literal index and bench/ is not
    excluded from it (Q9)."""
    return X.source_literals(inp.table("in_polyglot_lines"))


@query("scan_source_lines", f"WITH {TEXT_CTE} SELECT tree_id, rel_path, line_no, text, ext FROM src")
def scan_source_lines(inp):
    """The source tree as numbered lines with the extension of each file."""
    return X.with_ext(inp.source_lines())
