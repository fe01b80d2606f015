"""Token extraction from source lines and function text.

Every extractor is a per-row built-in regex (``regexp_extract`` / ``regexp_extract_all``)
followed by ``posexplode``: no Python in the hot path, one pass over the lines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binlens.functions import catalog as C
from binlens.functions import names as N

T = "tree_id"
B = "binary_id"


def with_ext(lines: DataFrame) -> DataFrame:
    return lines.withColumn("ext", N.path_ext("rel_path"))


ANCHORED_START, ANCHORED_END = "^[a-zA-Z_]", r"*\s+(\w+)\s*\("
_TRAILING_BLANKS = r"(?<!\s)\s++$"


def once(value: Column) -> Column:
    """A column that is computed once per row, however often later filters and columns use it: the planner puts no
    expression in the place of a generated column."""
    return F.explode(F.array(value))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, where the body uses it more than once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _anchored(text: Column, fits: Callable[[Column], Column]) -> Column:
    """The name before the first '(', '' when it does not match, in linear time.

    None of its parts holds a '(', so a match ends at the line's first one.  Before that '(' and blanks stands the name,
    the last run of word characters; before the name stand blanks; what is left has to be characters of
    the pattern's class, which ``fits`` tests.  Runs are entered at their start only and never given back.  What is left
    begins the line, so a line that begins with no letter is not looked at."""
    def named(head: Column) -> Column:
        return _let(F.regexp_extract(head, r"(?<!\w)(\w++)$", 1), lambda name: _let(
            F.substring(head, F.lit(1), F.length(head) - F.length(name)), lambda before: _let(
                F.regexp_replace(before, _TRAILING_BLANKS, ""), lambda kind: F.when(
                    (F.length(name) > 0) & (F.length(kind) < F.length(before)) & fits(kind), name).otherwise(""))))
    possible = F.substring(text, 1, 1).rlike(ANCHORED_START) & (F.instr(text, "(") > 0)
    return F.when(possible, _let(F.regexp_replace(F.substring_index(text, "(", 1), _TRAILING_BLANKS, ""), named)).otherwise("")


def anchored_definition(text: Column, pattern: str) -> Column:
    """Group 1 of an anchored C-family definition pattern, '' when it does not match, in linear time."""
    return _anchored(text, lambda kind: _of_class(kind, pattern))


def _of_class(kind: Column, pattern: str) -> Column:
    """Whether ``kind`` consists of the characters that an anchored pattern allows before the name."""
    allowed = pattern.removeprefix(ANCHORED_START).removesuffix(ANCHORED_END)
    return kind.rlike(ANCHORED_START + allowed + "*+$")


def _keyword(pattern: str) -> str:
    """A word that every match of a definition pattern holds; '' if none is known."""
    return next((w for w in ("func", "fn") if w + r"\s+" in pattern and f"({w}" not in pattern), "")


def definition_name(ext: Column, text: Column, patterns=C.DEFINITION_PATTERNS) -> Column:
    """Group 1 of the extension's definition pattern, '' when it does not match.

    The anchored patterns differ in one class only, so their other parts stand once in the expression."""
    anchored = {x: p for x, p in patterns.items() if p.startswith("^[")}
    expr = F.when(F.lit(False), F.lit(""))
    for x, pat in patterns.items():
        if x not in anchored:
            expr = expr.when(ext == x, F.when(F.instr(text, _keyword(pat)) > 0, F.regexp_extract(text, pat, 1)))
    if anchored:
        by_class = [ext.isin([x for x in anchored if anchored[x] == p]) for p in dict.fromkeys(anchored.values())]

        def fits(kind: Column) -> Column:
            return reduce(or_, (at & _of_class(kind, p) for at, p in zip(by_class, dict.fromkeys(anchored.values()))))
        expr = expr.when(ext.isin(list(anchored)), _anchored(text, fits))
    return F.coalesce(expr, F.lit(""))


def source_definitions(lines: DataFrame) -> DataFrame:
    """X1 (with P6, P7): one definition per line at most, name longer than 2 characters
    and not a control keyword.  Output (tree_id, rel_path, line_no, name, lang, ext)."""
    exts = [x for x, _ in C.DEFINITION_EXTENSIONS]
    df = (lines.where(~N.is_excluded_path("rel_path")).select(T, "rel_path", "line_no", "text", once(N.path_ext("rel_path")).alias("ext"))
          .where(F.col("ext").isin(exts))
          .select(T, "rel_path", "line_no", "ext", once(definition_name(F.col("ext"), F.col("text"))).alias("name")))
    return (df.where((F.length("name") > 2) & ~F.col("name").isin(C.NOT_DEFINITION_NAMES))
            .select(T, "rel_path", "line_no", "name", N.language_of_ext("ext").alias("lang"), "ext"))


def first_posting(defs: DataFrame) -> DataFrame:
    """The first definition of each name in index order (extension scan order, path,
    line).  ``min_by`` is a partial aggregate, so a name defined a million times costs one
    row per task before the shuffle."""
    order = F.struct(N.ext_rank("ext").alias("r"), F.col("rel_path"), F.col("line_no"))
    return (defs.groupBy(T, "name")
            .agg(F.min_by(F.struct("rel_path", "line_no", "lang"), order).alias("p"))
            .select(T, "name", F.col("p.rel_path").alias("def_file"), F.col("p.line_no").alias("def_line"),
                    F.col("p.lang").alias("def_lang")))


def definition_postings(defs: DataFrame) -> DataFrame:
    """A8 (names): postings per name with the posting count alongside, flat."""
    n = defs.groupBy(T, "name").agg(F.count(F.lit(1)).alias("n_postings"))
    return defs.join(n, [T, "name"])


def source_literals(lines: DataFrame) -> DataFrame:
    """Quoted strings of 10-80 characters per line of the literal index's files."""
    df = (with_ext(lines)
          .where(F.col("ext").isin(C.LITERAL_EXTENSIONS)
                 & ~N.is_excluded_path("rel_path", tuple(C.EXCLUDED_FRAGMENTS_LITERALS))
                 & (F.instr("text", '"') > 0)))
    return (df.select(T, "rel_path", "line_no", "ext",
                      F.posexplode(F.regexp_extract_all("text", F.lit(C.SOURCE_LITERAL), 1)).alias("pos", "literal")))


def literal_postings(lits: DataFrame) -> DataFrame:
    """A8 (literals): postings with the count per literal (a partial aggregate joined back)."""
    n = lits.groupBy(T, "literal").agg(F.count(F.lit(1)).alias("n_postings"))
    return lits.join(n, [T, "literal"])


BLOCK = 1024  # lines per block of the search for a line's next line that is not blank


def call_sites(lines: DataFrame) -> DataFrame:
    """Every ``word(`` in order, also when line breaks stand between the word and its parenthesis.

    Output (tree_id, rel_path, line_no, end_line, pos, callee_name): ``line_no`` is the line of the word, ``end_line`` that of
    the parenthesis.  Calls within a line are found in the scan alone."""
    whole = (lines.where(F.instr("text", "(") > 0)
             .select(T, "rel_path", "line_no", F.col("line_no").alias("end_line"),
                     F.posexplode(F.regexp_extract_all("text", F.lit(C.CALL_SITE_LINEAR), 1)).alias("pos", "callee_name")))
    return whole.unionByName(split_call_sites(lines))


def split_call_sites(lines: DataFrame) -> DataFrame:
    """Calls whose word ends one line and whose parenthesis begins the next line that is not blank.

    Only files in which some line begins with a parenthesis are looked at, and what moves is the last word of a line, never
    its text.  A line finds its next one within a block of ``BLOCK`` lines; the last line of a block finds it
    among the first lines of the blocks, one row per block that is not blank."""
    opens = F.col("text").rlike(C.CALL_OPENING)
    files = lines.where(opens).select(T, "rel_path").distinct()
    seen = (lines.where(F.col("text").rlike(r"\S"))
            .select(T, "rel_path", "line_no", "text", F.expr(f"line_no div {BLOCK}").alias("_b"), opens.alias("opens"),
                    once(F.regexp_extract("text", C.TRAILING_WORD, 1)).alias("callee_name"))
            .select(T, "rel_path", "line_no", "_b", "opens", "callee_name",  # calls are counted where a word ends the line
                    once(F.when(F.length("callee_name") > 0, F.size(F.regexp_extract_all("text", F.lit(C.CALL_SITE_LINEAR), 1)))).alias("pos"))
            .join(files, [T, "rel_path"], "left_semi"))
    block = Window.partitionBy(T, "rel_path", "_b").orderBy("line_no")
    file = Window.partitionBy(T, "rel_path").orderBy("_b")
    heads = (seen.groupBy(T, "rel_path", "_b").agg(F.min_by(F.struct("line_no", "opens"), F.col("line_no")).alias("head"))
             .select(T, "rel_path", "_b", F.lead("head").over(file).alias("beyond")))
    inside = seen.withColumn("after", F.lead(F.struct("line_no", "opens")).over(block)).where(F.length("callee_name") > 0)
    here = inside.where(F.col("after.opens"))
    across = (inside.where(F.col("after").isNull()).drop("after")
              .join(heads.where(F.col("beyond.opens")).withColumnRenamed("beyond", "after"), [T, "rel_path", "_b"]))
    return here.unionByName(across).select(T, "rel_path", "line_no", F.col("after.line_no").alias("end_line"), "pos", "callee_name")


def function_literals(decompiled: DataFrame) -> DataFrame:
    """X2 + U1: per function, quoted strings of 6+ characters, then ``path.ext:line``
    references, order kept, duplicates kept.  Functions with neither are absent.

    Same-named functions are reduced to the one with the lowest address that has any
    literal (the per-name index of the text corpus; SURVEY Q11).
    """
    lit = F.regexp_extract_all("text", F.lit(C.FUNCTION_LITERAL), 1)
    refs = F.when(F.instr("text", ":") > 0, F.regexp_extract_all("text", F.lit(C.PATH_LINE_REF_LINEAR), 1)).otherwise(
        F.array().cast("array<string>"))
    df = (decompiled.select(B, "func_name", "entry_address", F.concat(lit, refs).alias("lits"))
          .where(F.size("lits") > 0))
    keep = df.groupBy(B, "func_name").agg(F.min("entry_address").alias("entry_address"))
    return (df.join(keep, [B, "func_name", "entry_address"], "left_semi")
            .select(B, "func_name", "entry_address", F.posexplode("lits").alias("pos", "literal")))


def path_line_refs(literals: DataFrame) -> DataFrame:
    """An anchored ``path.ext:line`` at the start of a literal -> (ref_path, ref_line)."""
    return (literals.where(F.col("literal").rlike(C.PATH_LINE_ANCHORED))
            .withColumn("ref_path", F.regexp_extract("literal", C.PATH_LINE_ANCHORED, 1))
            .withColumn("ref_line", F.regexp_extract("literal", C.PATH_LINE_ANCHORED, 2).try_cast("bigint")))


def corpus_function_key(file_name: Column) -> Column:
    """Function key of a corpus file: the stem minus its last '_' part, else the stem."""
    stem = F.regexp_replace(file_name, r"\.c$", "")
    return F.when(F.instr(stem, "_") > 0, F.regexp_extract(stem, r"^(.*)_[^_]*$", 1)).otherwise(stem)


def definition_line_counts(lines: DataFrame) -> DataFrame:
    """Definition lines of produced source by language family, and line totals."""
    df = with_ext(lines)
    c_like = F.col("ext").isin(".cpp", ".c", ".h")
    zig = F.col("ext") == ".zig"
    js = F.col("ext").isin(".js", ".ts")
    head = F.substring_index("text", "(", 1)
    c_def = ((F.instr("text", "(") > 0) & head.rlike(C.C_DEFINITION_HEAD)
             & F.substring(F.col("text"), F.length(head) + 1, F.length("text")).rlike(C.C_DEFINITION_REST))
    is_def = (F.when(c_like, c_def)
              .when(zig, F.col("text").rlike(C.ZIG_DEFINITION_LINE))
              .when(js, F.col("text").rlike(C.JS_DEFINITION_LINE))
              .otherwise(False))
    family = F.when(c_like, "c_family").when(zig, "zig").when(js, "js_ts")
    # C-family files are only counted when the tree has a .c or .cpp file (headers alone
    # are not searched)
    return (df.where(family.isNotNull())
            .groupBy(T, family.alias("family"))
            .agg(F.sum(is_def.cast("int")).cast("bigint").alias("matches"),
                 F.max(F.col("ext").isin(".c", ".cpp")).alias("has_c_source"))
            .select(T, "family", F.when((F.col("family") != "c_family") | F.col("has_c_source"), F.col("matches"))
                    .otherwise(F.lit(0).cast("bigint")).alias("definitions")))
