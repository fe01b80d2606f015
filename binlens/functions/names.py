"""Column functions on names, addresses and paths.

Every function takes and returns a ``Column`` and uses built-in expressions only, so
it stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from binlens.functions import catalog as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_auto_name(name) -> Column:
    """Names the disassembler invented (FUN_..., thunk_...)."""
    n = _col(name)
    return n.startswith(C.AUTO_NAME_PREFIXES[0]) | n.startswith(C.AUTO_NAME_PREFIXES[1])


def clean_name(name) -> Column:
    """Strip every leading underscore."""
    return F.regexp_replace(_col(name), r"^_+", "")


def addr_cluster_key(addr, length: int = C.CLUSTER_PREFIX_LEN) -> Column:
    """First ``length`` hex digits when longer, else the whole address."""
    a = _col(addr)
    return F.when(F.length(a) > length, F.substring(a, 1, length)).otherwise(a)


def addr_dir_key(addr) -> Column:
    """Address minus its last three digits; ``misc`` when that leaves nothing."""
    a = _col(addr)
    return F.when(F.length(a) > 3, F.substring(a, F.lit(1), F.length(a) - 3)).otherwise(F.lit("misc"))


def safe_name(name) -> Column:
    """P5: characters outside [a-zA-Z0-9_] become underscores."""
    return F.regexp_replace(_col(name), r"[^a-zA-Z0-9_]", "_")


def corpus_file_name(name, addr) -> Column:
    """P5: file name of a function in the per-function corpus."""
    return F.concat(safe_name(name), F.lit("_"), _col(addr), F.lit(".c"))


def path_ext(path) -> Column:
    """Extension of the last path component including the dot ('' when none)."""
    base = F.regexp_extract(_col(path), r"([^/]*)$", 1)
    return F.regexp_extract(base, r"^.+(\.[^.]+)$", 1)


def path_basename(path) -> Column:
    return F.regexp_extract(_col(path), r"([^/]*)$", 1)


def is_excluded_path(path, fragments=tuple(C.EXCLUDED_FRAGMENTS)) -> Column:
    """The relative path contains any excluded fragment (substring test)."""
    p = _col(path)
    cond = F.lit(False)
    for frag in fragments:
        cond = cond | (F.instr(p, frag) > 0)
    return cond


def language_of_ext(ext, with_hpp: bool = True) -> Column:
    """Language of a source extension; without ``.hpp`` the lookup gives 'unknown'."""
    e = _col(ext)
    pairs = [(x, lang) for x, lang in C.DEFINITION_EXTENSIONS if with_hpp or x != ".hpp"]
    expr = None
    for x, lang in pairs:
        expr = (F.when(e == x, lang) if expr is None else expr.when(e == x, lang))
    return expr.otherwise(None if with_hpp else "unknown")


def ext_rank(ext, exts=tuple(x for x, _ in C.DEFINITION_EXTENSIONS)) -> Column:
    """Position of an extension in the index's scan order (for 'first posting')."""
    e = _col(ext)
    expr = None
    for i, x in enumerate(exts):
        expr = F.when(e == x, i) if expr is None else expr.when(e == x, i)
    return expr.otherwise(None)


def symbol_tail(demangled) -> Column:
    """After the last '::', before the first '(', trimmed."""
    d = _col(demangled)
    last = F.element_at(F.split(d, "::"), -1)
    return F.trim(F.element_at(F.split(last, r"\("), 1))


def chunk_file_name(idx, start0, end) -> Column:
    """chunk_{idx:03d}_L{start+1}-L{end}.js"""
    return F.format_string("chunk_%03d_L%d-L%d.js", _col(idx), _col(start0) + 1, _col(end))


def contains_any(col, needles) -> Column:
    c = _col(col)
    cond = F.lit(False)
    for n in needles:
        cond = cond | (F.instr(c, n) > 0)
    return cond
