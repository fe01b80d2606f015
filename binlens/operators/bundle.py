"""Bundled applications: format detection, text segments, metadata, declaration chunks
and hints (X12-X16, P11, P15, A14, K7).

Chunking (X15) is a greedy scan in the original: a declaration line opens a new chunk when
at least 350 lines passed since the last break.  Here each block of 350 lines is a function from the
offset at which a break is allowed to that in the next block, and functions are composed by a prefix
scan of two levels (``greedy_breaks``).  Hints (X16) come from a scan over quotes in the same manner.  No
document and no chunk is collected into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binlens.functions import catalog as C
from binlens.functions import names as N
from binlens.session import cut_lineage

D = "bundle_id"
WS = r"[ \t\n\r\f\x0B]"  # Python's str.strip() whitespace for ASCII text
BLANKS = " \t\n\r\f\x0b"
STEP = int(C.CHUNK_TARGET_LINES * C.CHUNK_BREAK_FRACTION)  # 350
FAN = 256  # blocks, or groups of them, whose functions are composed in one row
HINT_BLOCK = 1024  # lines per block of the search for literals
LITERAL_MIN, LITERAL_MAX = 10, 80  # the lengths of C.SOURCE_LITERAL

# Printable in the sense of str.isprintable() (not in Unicode categories C* or Z*, but
# the ASCII space) plus newline, carriage return and tab.  One character class, so long
# runs do not recurse in the regex engine.
PRINTABLE_RUN = r"[ \n\r\t[\P{C}&&\P{Z}]]{%d,}" % (C.SEGMENT_MIN_LEN + 1)


# ---- X12 --------------------------------------------------------------------------

def bundle_format(strings: DataFrame, segments: DataFrame) -> DataFrame:
    """Bun when a segment's name contains __BUN, else the first format whose pattern occurs in
    the strings, else native (no bundled language)."""
    B = "binary_id"
    flags = strings.groupBy(B).agg(*[
        F.max(F.col("s").rlike(pat).cast("int")).alias(fmt) for fmt, _, pat in C.BUNDLE_FORMATS if pat])
    bun = segments.groupBy(B).agg(F.max((F.col("segment_name").contains(C.BUN_SEGMENT)).cast("int")).alias("bun"))
    ids = strings.select(B).unionByName(segments.select(B)).distinct()
    df = ids.join(bun, [B], "left").join(flags, [B], "left")
    fmt_expr = None
    lang_expr = None
    for fmt, lang, _ in C.BUNDLE_FORMATS:
        cond = F.coalesce(F.col(fmt), F.lit(0)) == 1
        fmt_expr = F.when(cond, fmt) if fmt_expr is None else fmt_expr.when(cond, fmt)
        lang_expr = F.when(cond, lang) if lang_expr is None else lang_expr.when(cond, lang)
    return df.select(B, fmt_expr.otherwise("native").alias("bundled_format"), lang_expr.alias("bundled_language"))


# ---- X13, P11, X14 ----------------------------------------------------------------

def text_segments(payloads: DataFrame, id_col: str = D, text_col: str = "text") -> DataFrame:
    """X13 + P11: maximal printable runs longer than 200 characters of each decoded
    payload, numbered in order, classed builtin/app."""
    segs = payloads.select(F.col(id_col).alias(D), F.posexplode(
        F.regexp_extract_all(text_col, F.lit(PRINTABLE_RUN), 0)).alias("seg_no", "segment"))
    builtin = N.contains_any("segment", C.BUILTIN_SEGMENT_MARKERS)
    return segs.select(D, "seg_no", "segment", F.length("segment").alias("n_chars"),
                       F.when(builtin, "builtin").otherwise("app").alias("seg_class"))


def _strip(c):
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


VERSION_RE = r"Version:" + WS + r"*([0-9]+\.[0-9]+\.[0-9]+)"
COPYRIGHT_RE = r"(?d)\(c\)" + WS + r"*(.+?)\."
APP_NAME_RE = r"//" + WS + r"*(\w[\w \t\n\r\f\x0B]+)" + WS + r"*is a"


def bundle_metadata(segments: DataFrame, first_segments: int | None = None) -> DataFrame:
    """Version, copyright holder and app name from the payload's app segments joined by
    newlines (together no longer than the payload, which is one row); character and segment
    totals per class.  ``first_segments`` reads only so many (the analysed pipeline uses 5)."""
    app = segments.where(F.col("seg_class") == "app")
    if first_segments is not None:
        w = Window.partitionBy(D).orderBy("seg_no")
        app = app.withColumn("r", F.row_number().over(w)).where(F.col("r") <= first_segments)
    head = (app.groupBy(D).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_no", "segment"))),
                                                      lambda x: x["segment"]), "\n").alias("head")))

    def grab(pat, strip=False):
        v = F.regexp_extract("head", pat, 1)
        v = _strip(v) if strip else v
        return F.when(F.col("head").rlike(pat), v)

    meta = head.select(D, grab(VERSION_RE).alias("app_version"), grab(COPYRIGHT_RE, True).alias("copyright"),
                       grab(APP_NAME_RE, True).alias("app_name"))
    totals = segments.groupBy(D).agg(
        F.sum(F.when(F.col("seg_class") == "app", F.col("n_chars")).otherwise(0)).cast("bigint").alias("app_chars"),
        F.sum(F.when(F.col("seg_class") == "builtin", F.col("n_chars")).otherwise(0)).cast("bigint").alias("builtin_chars"),
        F.sum((F.col("seg_class") == "app").cast("int")).cast("bigint").alias("app_segments"),
        F.sum((F.col("seg_class") == "builtin").cast("int")).cast("bigint").alias("builtin_segments"))
    return totals.join(meta, [D], "left")


# ---- X15: declaration chunks ---------------------------------------------------------

def line_blocks(lines: DataFrame) -> DataFrame:
    """The lines of each block of 350 as an array of their shapes, in order: offset in the block, characters, blanks at
    either end, whether a declaration starts there.  The only pass over the text; a null text is an empty line."""
    text = F.coalesce("text", F.lit(""))
    bare = F.ltrim(text, F.lit(BLANKS))
    i = F.col("line_no") - 1
    shape = F.struct((i % STEP).cast("int").alias("o"), F.length(text).alias("n"),
                     (F.length(text) - F.length(bare)).alias("lead"),
                     (F.length(text) - F.length(F.rtrim(text, F.lit(BLANKS)))).alias("trail"),
                     bare.rlike(C.CHUNK_BREAK_PATTERN).alias("declares"))
    return (lines.select(D, F.floor(i / STEP).alias("k"), shape.alias("shape"))
            .groupBy(D, "k").agg(F.array_sort(F.collect_list("shape")).alias("shapes")))


def _first_break(marks, x):
    """The first declaration at offset x or later in a block, as its offset plus one (0: none)."""
    return F.call_function("locate", F.lit("1"), marks, x + 1)


def _leave_block(marks, x):
    return F.greatest(_first_break(marks, x) - 1, F.lit(0))


def _leave_group(exits, x):
    return F.get(exits, x)


def _enter(part, state):
    """The offset with which a part is entered: that left by the part before, or 0 after a part without declarations."""
    return F.when(part["k"] == state["k"] + 1, state["x"]).otherwise(F.lit(0))


def _groups(parts: DataFrame, leave) -> DataFrame:
    """Up to ``FAN`` neighbouring parts as one: ``parts`` in order and ``f``, the exit offset for each entry offset."""
    first = F.col("g") * FAN
    start = F.struct((first - 1).alias("k"), F.sequence(F.lit(0), F.lit(STEP - 1)).alias("x"))

    def step(state, part):
        follows = part["k"] == state["k"] + 1
        return F.struct(part["k"].alias("k"), F.transform(
            state["x"], lambda x: leave(part["f"], F.when(follows, x).otherwise(F.lit(0)))).alias("x"))

    def close(state):  # the group's last parts hold no declaration: any offset is used up
        return F.when(state["k"] == first + FAN - 1, state["x"]).otherwise(F.array_repeat(F.lit(0), STEP))

    return (parts.groupBy(D, F.floor(F.col("k") / FAN).alias("g"))
            .agg(F.array_sort(F.collect_list(F.struct("k", "f"))).alias("parts"))
            .select(D, F.col("g").alias("k"), "parts", F.aggregate("parts", start, step, close).alias("f")))


def _entries(groups: DataFrame, leave) -> DataFrame:
    """Entry offset ``x`` and function of every part of groups whose own entry offset ``x`` is known."""
    start = F.struct((F.element_at("parts", 1)["k"] - 1).alias("k"),
                     F.when(F.element_at("parts", 1)["k"] == F.col("k") * FAN, F.col("x")).otherwise(F.lit(0)).alias("x"),
                     F.expr("array()").cast("array<int>").alias("seen"))

    def step(state, part):
        x = _enter(part, state)
        return F.struct(part["k"].alias("k"), leave(part["f"], x).alias("x"), F.concat(state["seen"], F.array(x)).alias("seen"))

    zipped = F.arrays_zip("parts", F.aggregate("parts", start, step, lambda s: s["seen"]).alias("x"))
    return (groups.select(D, F.explode(zipped).alias("z"))
            .select(D, F.col("z.parts.k").alias("k"), F.col("z.parts.f").alias("f"), F.col("z.x").alias("x")))


def greedy_breaks(blocks: DataFrame) -> DataFrame:
    """Breaks of the greedy scan, as (block, offset ``cut``); the one before line 0 is left out.

    A break allows the next one 350 lines on, that is from the same offset of the next block.  So a block holds at most one
    break and is a function: entered with the smallest allowed offset x, it breaks at its first declaration c >= x and
    is left with c; without such a declaration it is left with 0.  Functions of ``FAN`` neighbours are composed into
    one, and those of ``FAN`` such groups again (prefix scan); offsets then go back down from document to groups to
    blocks.  A part is 350 numbers, however many lines it covers; the topmost level has one part per 23
    million lines of a document."""
    # the first block follows the break before line 0, so nothing in it can break
    offsets = F.transform(F.filter("shapes", lambda s: s["declares"]), lambda s: s["o"])
    marks = F.array_join(F.transform("offsets", lambda o, j: F.lpad(
        F.lit("1"), o - F.coalesce(F.get("offsets", j - 1), F.lit(-1)), F.lit("0"))), "")
    declaring = (blocks.where(F.col("k") > 0).select(D, "k", offsets.alias("offsets")).where(F.size("offsets") > 0)
                 .select(D, "k", marks.alias("f")))
    low = cut_lineage(_groups(declaring, _leave_block))
    high = _groups(low.select(D, "k", "f"), _leave_group)
    top = (high.groupBy(D).agg(F.array_sort(F.collect_list(F.struct("k", "f"))).alias("parts"))
           .select(D, F.lit(0).cast("bigint").alias("k"), "parts", F.lit(0).alias("x")))
    for level in (high, low):
        top = _entries(top, _leave_group).select(D, "k", "x").join(level.select(D, "k", "parts"), [D, "k"])
    return (_entries(top, _leave_block).select(D, "k", (_first_break(F.col("f"), F.col("x")) - 1).alias("cut"))
            .where(F.col("cut") >= 0))


def _chars(shapes):
    return F.aggregate(shapes, F.lit(0).cast("bigint"), lambda a, s: a + s["n"] + 1)


def chunk_pieces(blocks: DataFrame) -> DataFrame:
    """Blocks cut at their breaks, with the chunk's index ``idx``: first line, lines, characters, and ``text_from`` /
    ``text_to``, where the piece's first and last character that is not blank stand in the document (null: all blank)."""
    halves = F.array(F.struct(F.lit(0).alias("opens"), F.filter("shapes", lambda s: s["o"] < F.col("cut")).alias("shapes")),
                     F.struct(F.lit(1).alias("opens"), F.filter("shapes", lambda s: s["o"] >= F.col("cut")).alias("shapes")))
    whole = F.array(F.struct(F.lit(0).alias("opens"), F.col("shapes").alias("shapes")))
    pieces = (blocks.join(greedy_breaks(blocks), [D, "k"], "left")
              .select(D, "k", F.explode(F.when(F.col("cut").isNull(), whole).otherwise(halves)).alias("p"))
              .select(D, "k", "p.opens", "p.shapes").where(F.size("shapes") > 0)
              .withColumn("full", F.filter("shapes", lambda s: s["lead"] < s["n"])))
    first, last = F.get("full", F.lit(0)), F.element_at("full", -1)
    sized = pieces.select(
        D, "k", "opens", (F.col("k") * STEP + F.get("shapes", F.lit(0))["o"]).alias("start"),
        F.size("shapes").cast("bigint").alias("n"), _chars("shapes").alias("chars"),
        F.when(F.size("full") > 0, _chars(F.filter("shapes", lambda s: s["o"] < first["o"])) + first["lead"]).alias("before"),
        F.when(F.size("full") > 0, _chars(F.filter("shapes", lambda s: s["o"] > last["o"])) + last["trail"] + 1).alias("after"))
    w = Window.partitionBy(D).orderBy("k", "opens")
    at = F.sum("chars").over(w) - F.col("chars")
    return sized.select(D, F.sum("opens").over(w).cast("int").alias("idx"), "start", "n",
                        (at + F.col("before")).alias("text_from"), (at + F.col("chars") - F.col("after")).alias("text_to"))


def declaration_chunks(lines: DataFrame) -> DataFrame:
    """X15 + P15: chunks with at least 100 stripped characters, indexes as in the scan.

    The text is read once; chunks follow from the shapes of the lines (``line_blocks``, written once)."""
    pieces = chunk_pieces(cut_lineage(line_blocks(lines)))
    chunks = (pieces.groupBy(D, "idx").agg(F.min("start").alias("start"), F.sum("n").alias("lines"),
                                           (F.max("text_to") - F.min("text_from")).alias("chars"))
              .where(F.col("chars") >= C.CHUNK_MIN_CHARS).withColumn("end", F.col("start") + F.col("lines")))
    return chunks.select(D, "idx", N.chunk_file_name("idx", "start", "end").alias("file"),
                         (F.col("start") + 1).cast("int").alias("start_line"), F.col("end").cast("int").alias("end_line"),
                         F.col("lines").cast("int").alias("lines"), F.col("chars").cast("int").alias("chars"))


def assign_chunks(rows: DataFrame, chunks: DataFrame, block: int = STEP) -> DataFrame:
    """Rows with a 0-based line ``i`` get the chunk that holds it, by an equi-join on the blocks of lines plus the
    range test.  Rows may carry their block ``k`` (a line may be given to a neighbouring block, too)."""
    if "k" not in rows.columns:
        rows = rows.withColumn("k", F.floor(F.col("i") / block))
    ranges = chunks.select(D, "idx", (F.col("start_line") - 1).alias("start"), F.col("end_line").alias("end"))
    spread = ranges.withColumn("k", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
    return (rows.join(spread, [D, "k"]).where((F.col("i") >= F.col("start")) & (F.col("i") < F.col("end")))
            .drop("start", "end"))


# ---- X16 / K7 --------------------------------------------------------------------------

def _numbered(lines: DataFrame) -> DataFrame:
    return lines.select(D, (F.col("line_no") - 1).alias("i"), F.coalesce("text", F.lit("")).alias("text"))


def chunk_document_lines(lines: DataFrame, chunks: DataFrame, source: str = "app_beautified.js") -> DataFrame:
    """The lines of each kept chunk's document under its header line, numbered by ``pos`` from 0 (the header).

    No document is one row, so a chunk may be of any length."""
    head = chunks.select(D, "idx", "file", F.lit(0).cast("bigint").alias("pos"), F.concat(
        F.lit("// Chunk "), F.col("idx").cast("string"), F.lit(": lines "), F.col("start_line").cast("string"), F.lit("-"),
        F.col("end_line").cast("string"), F.lit(f" of {source}")).alias("text"))
    body = (assign_chunks(_numbered(lines), chunks).join(chunks.select(D, "idx", "file", "start_line"), [D, "idx"])
            .select(D, "idx", "file", (F.col("i") - F.col("start_line") + 2).cast("bigint").alias("pos"), "text"))
    return head.unionByName(body)


def chunk_documents(lines: DataFrame, chunks: DataFrame) -> DataFrame:
    """Text of each kept chunk in one row, for chunks that fit one; ``chunk_document_lines`` has no such bound."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("i", "text"))), lambda x: x["text"])
    return assign_chunks(_numbered(lines), chunks).groupBy(D, "idx").agg(F.array_join(parts, "\n").alias("content"))


HINT_KINDS = {
    "hint_errors": lambda x: N.contains_any(F.lower(x), C.HINT_ERROR_WORDS),
    "hint_urls": lambda x: (F.instr(x, "/") > 0) & N.contains_any(x, C.HINT_URL_WORDS),
    "hint_keywords": lambda x: N.contains_any(F.lower(x), C.HINT_KEYWORDS),
}


def _first_hints(text):
    """The first five literals of each kind in one line's text."""
    lits = F.regexp_extract_all(text, F.lit(C.SOURCE_LITERAL), 1)
    return F.struct(*[F.slice(F.filter(lits, kind), 1, C.HINT_LIMIT).alias(name) for name, kind in HINT_KINDS.items()])


def _fits(n):
    return n.between(LITERAL_MIN, LITERAL_MAX)


def quoted_lines(lines: DataFrame, chunks: DataFrame) -> DataFrame:
    """Lines of kept chunks that hold a quote, each as a function of one bit: is its first quote taken, because a literal
    that began on an earlier line ends there?

    The text between two neighbouring quotes is a literal iff its length fits and the text before it is none.  So within
    a run of fitting texts every second one is a literal and anything unfitting starts anew.  Output:
    ``left_0`` / ``left_1`` (is the last quote taken, by that bit), ``hints_0`` / ``hints_1``, ``joins`` (the text from
    the quote before, on line ``opened``, to this line's first fits)."""
    k = F.floor(F.col("i") / HINT_BLOCK)
    segs = F.split("text", '"', -1)
    gaps = F.slice("segs", 2, F.greatest(F.size("segs") - 2, F.lit(0)))
    rows = (_numbered(lines).withColumn("segs", segs).withColumn("quotes", F.size("segs") - 1)
            # a line without quotes matters only where a literal may run through it
            .where((F.col("quotes") > 0) | (F.length("text") <= LITERAL_MAX))
            .withColumn("gaps", F.transform(gaps, lambda g: _fits(F.length(g))))
            # fitting texts at the end of the line
            .withColumn("run", F.size("gaps") - F.coalesce(F.array_max(F.transform(
                "gaps", lambda ok, j: F.when(ok, F.lit(0)).otherwise(j + 1))), F.lit(0))))
    odd = F.col("run") % 2 == 1
    rows = rows.select(
        D, "i", "quotes", F.length("text").alias("n"), F.length(F.get("segs", F.lit(0))).alias("head"),
        F.length(F.element_at("segs", -1)).alias("tail"), odd.alias("left_0"),
        F.when(F.col("run") == F.size("gaps"), ~odd).otherwise(odd).alias("left_1"),
        F.when(F.col("quotes") > 1, _first_hints(F.col("text"))).alias("hints_0"),
        F.when(F.col("quotes") > 2, _first_hints(F.expr("substring(text, instr(text, '\"') + 1)"))).alias("hints_1"),
        # each line break counts, so a literal spans at most LITERAL_MAX lines of the block before
        F.explode(F.when(F.col("i") % HINT_BLOCK >= HINT_BLOCK - LITERAL_MAX, F.array(k, k + 1)).otherwise(F.array(k))).alias("k"))
    w = Window.partitionBy(D, "k", "idx").orderBy("i")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = (assign_chunks(rows, chunks, HINT_BLOCK)
            .withColumn("row", F.row_number().over(w)).withColumn("sum", F.sum(F.col("n") + 1).over(w)))
    prev = F.last(F.when(F.col("quotes") > 0, F.struct("i", "row", "sum", "tail")), ignorenulls=True).over(before)
    rows = rows.withColumn("prev", prev).where((F.col("quotes") > 0) & (F.floor(F.col("i") / HINT_BLOCK) == F.col("k")))
    length = F.col("prev.tail") + 1 + F.col("sum") - F.col("n") - 1 - F.col("prev.sum") + F.col("head")
    whole = F.col("i") - F.col("prev.i") == F.col("row") - F.col("prev.row")
    return rows.select(D, "k", "idx", "i", "left_0", "left_1", "hints_0", "hints_1", F.col("prev.i").alias("opened"),
                       F.coalesce(whole & _fits(length), F.lit(False)).alias("joins"))


def _state(entry, fixed, flips):
    """A bit after some lines: that of the last line that fixes it, or else the entry bit, turned by every flip since."""
    return F.when(fixed.isNull(), (entry + flips) % 2).otherwise((fixed["bit"] + flips - fixed["flips"]) % 2)


def taken_quotes(quoted: DataFrame) -> DataFrame:
    """The bit ``taken`` of each quoted line: a literal from an earlier line ends at its first quote.

    Each line fixes the bit that it hands on, keeps it or flips it; a block of lines does so in sum.  The bits at the
    blocks' borders follow from one row per block, those within a block from the lines before."""
    # the bit handed on, by the bit of the quote before
    h0 = F.when(F.col("joins"), F.col("left_1")).otherwise(F.col("left_0")).cast("int")
    h1 = F.col("left_0").cast("int")
    w = Window.partitionBy(D, "k").orderBy("i")
    rows = (quoted.withColumn("flip", F.when(h0 > h1, 1).otherwise(0))
            .withColumn("flips", F.sum("flip").over(w))
            .withColumn("fixed", F.when(h0 == h1, F.struct(h0.alias("bit"), F.col("flips").alias("flips")))))
    blocks = rows.groupBy(D, "k").agg(F.max_by("fixed", F.when(F.col("fixed").isNotNull(), F.col("i"))).alias("fixed"),
                                      F.max("flips").alias("flips"))
    over = Window.partitionBy(D).orderBy("k")
    done = over.rowsBetween(Window.unboundedPreceding, -1)
    blocks = (blocks.withColumn("total", F.sum("flips").over(over)).withColumn("earlier", F.col("total") - F.col("flips"))
              .withColumn("known", F.last(F.when(F.col("fixed").isNotNull(), F.struct(
                  F.col("fixed.bit").alias("bit"), (F.col("earlier") + F.col("fixed.flips")).alias("flips"))),
                  ignorenulls=True).over(done))
              .select(D, "k", _state(F.lit(0), F.col("known"), F.col("earlier")).alias("entry")))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("known", F.last("fixed", ignorenulls=True).over(before)).join(blocks, [D, "k"])
    handed = _state(F.col("entry"), F.col("known"), F.col("flips") - F.col("flip"))
    return rows.withColumn("taken", F.col("joins") & (handed == 0))


def chunk_hints(lines: DataFrame, chunks: DataFrame) -> DataFrame:
    """X16 + K7: the first five error / url / keyword literals of each kept chunk, as arrays.

    Literals are those of the chunk's whole text and may span lines.  No chunk is put together: which quotes begin a
    literal follows by a scan over lines and blocks (``taken_quotes``), a line sends at most five literals of a kind on, and
    only the pieces of literals that span lines are joined."""
    taken = taken_quotes(cut_lineage(quoted_lines(lines, chunks)))
    within = [taken.select(D, "idx", "i", F.lit(name).alias("kind"), F.posexplode(
        F.when(F.col("taken"), F.col(f"hints_1.{name}")).otherwise(F.col(f"hints_0.{name}"))).alias("pos", "lit"))
        for name in HINT_KINDS]
    spans = (taken.where("taken").select(D, "idx", "opened", F.col("i").alias("closed"),
                                         F.explode(F.sequence("opened", "i")).alias("i")))
    piece = (F.when(F.col("i") == F.col("opened"), F.substring_index("text", '"', -1))
             .when(F.col("i") == F.col("closed"), F.substring_index("text", '"', 1)).otherwise(F.col("text")))
    across = (_numbered(lines).join(spans, [D, "i"]).groupBy(D, "idx", "closed")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", piece.alias("piece")))),
                                            lambda p: p["piece"]), "\n").alias("lit")))
    found = within[0]
    for part in within[1:]:
        found = found.unionByName(part)
    for name, kind in HINT_KINDS.items():
        found = found.unionByName(across.where(kind(F.col("lit"))).select(
            D, "idx", F.col("closed").alias("i"), F.lit(name).alias("kind"), F.lit(-1).alias("pos"), "lit"))
    w = Window.partitionBy(D, "idx", "kind").orderBy("i", "pos")
    firsts = found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= C.HINT_LIMIT)
    arrays = firsts.groupBy(D, "idx").agg(*[F.transform(F.array_sort(F.collect_list(
        F.when(F.col("kind") == name, F.struct("r", "lit")))), lambda x: x["lit"]).alias(name) for name in HINT_KINDS])
    return chunks.select(D, "idx").join(arrays, [D, "idx"], "left").select(D, "idx", *[
        F.coalesce(name, F.expr("array()").cast("array<string>")).alias(name) for name in HINT_KINDS])


def chunk_index_summary(lines: DataFrame, chunks: DataFrame) -> DataFrame:
    """Total lines, kept chunks, floor of the average chunk length."""
    total = lines.groupBy(D).agg(F.count(F.lit(1)).alias("total_lines"))
    n = chunks.groupBy(D).agg(F.count(F.lit(1)).alias("chunks"))
    return (total.join(n, [D], "left").withColumn("chunks", F.coalesce("chunks", F.lit(0)))
            .withColumn("avg_lines", F.expr("total_lines div greatest(chunks, 1)")))
