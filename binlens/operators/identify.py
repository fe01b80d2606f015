"""Which software a binary is.

Each detector is one aggregate per ``binary_id`` over all of the binary's strings or symbols;
nothing is ranked or cut.  Catalogs (markers, indicators) are literal arrays tested inside the
scan.  The detectors are independent and joined once per binary in ``identity``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binlens.functions import catalog as C
from binlens.functions import names as N

B = "binary_id"


def first_n(df: DataFrame, n: int, order: str = "ord") -> DataFrame:
    """The first ``n`` rows per binary by ``order`` (re-ranked densely).  The cut is its
    feature; no detector uses it.

    ``row_number() <= n`` is planned with a group limit before the shuffle, so each task
    forwards at most ``n`` rows per binary.
    """
    w = Window.partitionBy(B).orderBy(order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def _py_strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _py_list_repr(arr: Column) -> Column:
    """Python's repr of a list of plain strings: ['a', 'b']."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
                    F.lit("]"))


# ---- X6 / K1: repository URLs ------------------------------------------------------

def repo_mentions(strings: DataFrame) -> DataFrame:
    """Every owner/repo match, in visiting order (ord, pattern, match), repo with
    trailing '.', 'g', 'i', 't' stripped (Q1), minus the ignore list."""
    parts = []
    for i, pat in enumerate(C.GITHUB_URL_PATTERNS):
        m = F.arrays_zip(F.regexp_extract_all("s", F.lit(pat), 1).alias("owner"),
                         F.regexp_extract_all("s", F.lit(pat), 2).alias("repo"))
        parts.append(strings.where(F.col("s").contains("github"))
                     .select(B, "ord", F.lit(i).alias("pat_no"), F.posexplode(m).alias("m_pos", "m")))
    df = parts[0].unionByName(parts[1])
    df = df.select(B, "ord", "pat_no", "m_pos",
                   F.concat(F.col("m.owner"), F.lit("/"), F.expr("TRIM(TRAILING '.git' FROM m.repo)")).alias("repo"))
    return df.where(~F.col("repo").isin(C.IGNORE_REPOS))


def repo_counts(mentions: DataFrame) -> DataFrame:
    return (mentions.groupBy(B, "repo")
            .agg(F.count(F.lit(1)).alias("n_refs"),
                 F.min(F.struct("ord", "pat_no", "m_pos")).alias("first_seen")))


def top_repo(counts: DataFrame) -> DataFrame:
    """K1: the most referenced repo; ties go to the first one encountered."""
    best = (counts.groupBy(B)
            .agg(F.min_by(F.struct("repo", "n_refs"), F.struct((-F.col("n_refs")).alias("k"), F.col("first_seen")))
                 .alias("t")))
    return best.select(B, F.col("t.repo").alias("repo"), F.col("t.n_refs").alias("n_refs"),
                       F.concat(F.lit("https://github.com/"), F.col("t.repo"), F.lit(".git")).alias("repo_url"),
                       F.lower(F.element_at(F.split(F.col("t.repo"), "/"), 2)).alias("name"),
                       F.format_string(C.REPO_EVIDENCE, F.col("t.repo"), F.col("t.n_refs"))
                       .alias("evidence"))


# ---- X8: signature markers ----------------------------------------------------------

def signature_markers(strings: DataFrame, software: DataFrame, catalog=C.KNOWN_SOFTWARE) -> DataFrame:
    """Per binary and catalog software, the distinct markers present; matched when
    at least ``min_markers``.  Every string is tested against the catalog's markers in the
    scan; only hits leave it."""
    markers = F.array(*[F.struct(F.lit(i).alias("sw_rank"), F.lit(name).alias("sw_name"), F.lit(j).alias("marker_rank"),
                                 F.lit(m).alias("marker"))
                        for i, (name, _, found, _, _) in enumerate(catalog) for j, m in enumerate(found)])
    hits = (strings.select(B, F.explode(F.filter(markers, lambda m: F.col("s").contains(m["marker"]))).alias("h"))
            .select(B, "h.*").distinct())
    per = (hits.groupBy(B, "sw_rank", "sw_name")
           .agg(F.count(F.lit(1)).alias("n_markers"),
                F.array_sort(F.collect_list(F.struct("marker_rank", "marker"))).alias("ms")))
    per = per.join(software.select("sw_rank", "min_markers", "sw_repo_url", "sw_source_dir_hint"), ["sw_rank"])
    found = F.transform("ms", lambda x: x["marker"])
    return (per.where(F.col("n_markers") >= F.col("min_markers"))
            .select(B, "sw_rank", "sw_name", "n_markers", "sw_repo_url", "sw_source_dir_hint",
                    F.array_join(found, ",").alias("markers"),
                    F.format_string(C.SIGNATURE_EVIDENCE, F.col("sw_name"), F.col("n_markers"),
                                    _py_list_repr(found)).alias("evidence")))


def signature_winner(sig: DataFrame) -> DataFrame:
    """The first matched software in catalog order."""
    return (sig.groupBy(B).agg(F.min_by(F.struct("sw_name", "sw_repo_url", "sw_source_dir_hint", "evidence"),
                                        F.col("sw_rank")).alias("w"))
            .select(B, "w.*"))


# ---- X7 / K8: version strings -------------------------------------------------------

def version_mentions(strings: DataFrame) -> DataFrame:
    """Per string and per pattern, the first match."""
    parts = []
    for i, (pat, kind) in enumerate(C.VERSION_PATTERNS_LINEAR):
        named = kind == "named"
        parts.append(strings.where(F.col("s").contains("Version:" if not named else ".") & F.col("s").rlike(pat)).select(
            B, "ord", F.lit(i).alias("pat_no"), F.lit(kind).alias("kind"),
            (F.lower(F.regexp_extract("s", pat, 1)) if named else F.lit(None).cast("string")).alias("name_candidate"),
            F.regexp_extract("s", pat, 2 if named else 1).alias("version"), "s"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def first_version(mentions: DataFrame, software: DataFrame) -> DataFrame:
    """K8: the earliest named hit on a catalog name stops the scan and sets name and
    version; the earliest bare 'Version:' hit before it (or anywhere, with no stop) sets
    the version and is kept as evidence."""
    seq = F.struct("ord", "pat_no")
    cat = software.select(F.col("sw_name").alias("name_candidate"))
    stop = (mentions.where(F.col("kind") == "named").join(cat, ["name_candidate"], "left_semi")
            .groupBy(B).agg(F.min_by(F.struct("name_candidate", "version"), seq).alias("h"), F.min(seq).alias("stop_seq"))
            .select(B, F.col("h.name_candidate").alias("stop_name"), F.col("h.version").alias("stop_version"), "stop_seq"))
    bare = (mentions.where(F.col("kind") == "version_only").join(stop, [B], "left")
            .where(F.col("stop_seq").isNull() | (seq < F.col("stop_seq")))
            .groupBy(B).agg(F.min_by(F.struct("version", "s"), seq).alias("h"))
            .select(B, F.col("h.version").alias("bare_version"),
                    F.concat(F.lit(C.VERSION_EVIDENCE), _py_strip(F.col("h.s"))).alias("bare_evidence")))
    return (stop.join(bare, [B], "full")
            .select(B, "stop_name", "stop_version", "bare_version", "bare_evidence",
                    F.when(F.col("stop_name").isNotNull(),
                           F.concat(F.lit(C.VERSION_EVIDENCE), F.col("stop_name"), F.lit(" "), F.col("stop_version")))
                    .alias("stop_evidence")))


# ---- X9: build paths ----------------------------------------------------------------

def src_paths(text: Column) -> Column:
    """All matches of the second build-path pattern, in linear time.

    Matches lie within runs of path characters.  From a run's first ``src/`` the pattern takes as much as ends
    with a dot and word characters; behind that no such dot is left, so a run has one match at most."""
    def match(run: Column) -> Column:
        rest = F.substring(run, F.instr(run, "src/") + 4, F.length(run))
        return F.when((F.instr(run, "src/") > 0) & rest.rlike(r"[\w/.+-]\.\w"), F.concat(F.lit("src/"), F.regexp_extract(rest, r"^([\w/.+-]+\.\w+)", 1)))

    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"([\w/.+-]++)"), 1), match), lambda x: x.isNotNull())


def build_paths(strings: DataFrame) -> DataFrame:
    """Distinct path-like strings per binary with the extension of their last part."""
    users, _, nested = (F.regexp_extract_all("s", F.lit(p), 1) for p in C.BUILD_PATH_PATTERNS_LINEAR)
    found = F.array_distinct(F.concat(users, src_paths(F.col("s")), nested))
    paths = strings.where(F.col("s").contains("/")).select(B, F.explode(found).alias("path")).distinct()
    last = F.regexp_extract(F.regexp_replace("path", r"(/\.?)+$", ""), r"([^/]*)$", 1)
    return paths.withColumn("ext", F.regexp_extract(last, r"^.+(\.[^.]+)$", 1))


def build_path_summary(paths: DataFrame) -> DataFrame:
    """Per binary: number of paths and of extensions.  The histogram of a binary may be of any
    size; it is returned as rows (``build_path_extensions``), not inside the evidence text."""
    hist = build_path_extensions(paths).groupBy(B).agg(F.count(F.lit(1)).alias("n_ext"))
    n = paths.groupBy(B).agg(F.count(F.lit(1)).alias("n_paths"))
    return (n.join(hist, [B], "left")
            .select(B, "n_paths", F.format_string(C.BUILD_PATH_EVIDENCE, F.col("n_paths"),
                                                  F.coalesce("n_ext", F.lit(0))).alias("evidence")))


def build_path_extensions(paths: DataFrame) -> DataFrame:
    return paths.where(F.length("ext") > 0).groupBy(B, "ext").agg(F.count(F.lit(1)).alias("n_paths"))


# ---- X10: symbol families -----------------------------------------------------------

def symbol_families(symbols: DataFrame) -> DataFrame:
    """Distinct symbols by prefix family; node count kept (Q4)."""
    s = symbols.select(B, "symbol").distinct()
    agg = s.groupBy(B).agg(
        F.sum(F.col("symbol").startswith(C.NAPI_PREFIX).cast("int")).cast("bigint").alias("napi_count"),
        F.sum(F.col("symbol").startswith(C.UV_PREFIX).cast("int")).cast("bigint").alias("uv_count"),
        F.sum(F.lower("symbol").contains("node").cast("int")).cast("bigint").alias("node_count"))
    return agg.select(
        "*",
        F.when(F.col("napi_count") > C.NAPI_MIN,
               F.format_string(C.NAPI_EVIDENCE, F.col("napi_count"))).alias("napi_evidence"),
        F.when(F.col("uv_count") > C.UV_MIN, F.format_string(C.UV_EVIDENCE, F.col("uv_count"))).alias("uv_evidence"))


# ---- X11: languages -----------------------------------------------------------------

def binary_languages(strings: DataFrame, indicators=C.LANGUAGE_INDICATORS, c_indicators=C.C_INDICATORS) -> DataFrame:
    """X11: languages with any indicator present, sorted; 'c' only when none is.  One aggregate
    with a flag per language."""
    def any_of(words):
        return F.max(N.contains_any("s", words))

    names = sorted(lang for lang, _ in indicators)
    flags = strings.groupBy(B).agg(*[any_of(dict(indicators)[lang]).alias(lang) for lang in names], any_of(c_indicators).alias("c"))
    found = F.array_compact(F.array(*[F.when(F.col(lang), F.lit(lang)) for lang in names]))
    return (flags.select(B, F.when(F.size(found) > 0, found).when(F.col("c"), F.array(F.lit("c"))).alias("languages"))
            .where(F.col("languages").isNotNull()))


# ---- P10, P14, J13, J15, A15 ---------------------------------------------------------

def confidence_level(name: Column, version: Column, repo: Column, n_evidence: Column) -> Column:
    """P10."""
    return (F.when(name.isNotNull() & version.isNotNull() & repo.isNotNull() & (n_evidence >= 3), "high")
            .when(name.isNotNull() & repo.isNotNull() & (n_evidence >= 2), "medium")
            .when(name.isNotNull() & (n_evidence >= 1), "low")
            .otherwise("none"))


def tag_candidates(identity: DataFrame) -> DataFrame:
    """The tag spellings tried for a known name and version, in order."""
    cands = [F.lit(f).cast("string") for f in C.TAG_FORMATS]
    exprs = [F.replace(F.replace(c, F.lit("{version}"), F.col("version")), F.lit("{name}"), F.col("name"))
             for c in cands]
    return (identity.where(F.col("name").isNotNull() & F.col("version").isNotNull())
            .select(B, "name", "version", "repo_url", F.posexplode(F.array(*exprs)).alias("cand_pos", "tag")))


def resolve_tag(identity: DataFrame, remote_tags: DataFrame) -> DataFrame:
    """The first candidate the repository lists (peeled suffix stripped), else the
    first candidate; no tag without name and version."""
    tags = (remote_tags.select("repo_url", F.expr("TRIM(TRAILING '^{}' FROM tag)").alias("tag"))
            .distinct().withColumn("listed", F.lit(True)))
    c = tag_candidates(identity).join(tags, ["repo_url", "tag"], "left")
    return (c.groupBy(B).agg(
        F.min_by("tag", F.struct(F.coalesce(F.col("listed"), F.lit(False)).__invert__().alias("unlisted"),
                                 F.col("cand_pos"))).alias("tag")))


def identity(strings: DataFrame, symbols: DataFrame, software: DataFrame,
             remote_tags: DataFrame | None = None) -> DataFrame:
    """A15 (+ J15, P10, J13): the five detectors in order, first non-null wins except that
    a catalog version hit overwrites name and version; evidence in detector order."""
    ids = strings.select(B).unionByName(symbols.select(B)).distinct()
    url = top_repo(repo_counts(repo_mentions(strings))).select(
        B, F.col("repo_url").alias("url_repo"), F.col("name").alias("url_name"), F.col("evidence").alias("url_ev"))
    sig = signature_winner(signature_markers(strings, software)).select(
        B, F.col("sw_name").alias("sig_name"), F.col("sw_repo_url").alias("sig_repo"),
        F.col("sw_source_dir_hint").alias("sig_hint"), F.col("evidence").alias("sig_ev"))
    ver = first_version(version_mentions(strings), software)
    paths = build_path_summary(build_paths(strings)).select(B, F.col("evidence").alias("path_ev"))
    sym = symbol_families(symbols).select(B, "napi_evidence", "uv_evidence", "node_count")
    langs = binary_languages(strings)
    df = (ids.join(url, [B], "left").join(sig, [B], "left").join(ver, [B], "left")
          .join(paths, [B], "left").join(sym, [B], "left").join(langs, [B], "left"))
    name = F.coalesce("stop_name", "url_name", "sig_name")
    version = F.coalesce("stop_version", "bare_version")
    repo = F.coalesce("url_repo", "sig_repo")
    evidence = F.array_compact(F.array("url_ev", "sig_ev", "bare_evidence", "stop_evidence", "path_ev",
                                       "napi_evidence", "uv_evidence"))
    df = df.select(B, name.alias("name"), version.alias("version"), repo.alias("repo_url"),
                   F.col("sig_hint").alias("source_dir_hint"),
                   F.coalesce("languages", F.array().cast("array<string>")).alias("languages"),
                   evidence.alias("evidence_list"), F.coalesce("node_count", F.lit(0).cast("bigint")).alias("node_count"))
    # Fill repo and hint from the catalog when the name is a catalog name
    cat = software.select(F.col("sw_name").alias("name"), "sw_repo_url", "sw_source_dir_hint")
    df = (df.join(cat, ["name"], "left")
          .withColumn("repo_url", F.coalesce("repo_url", "sw_repo_url"))
          .withColumn("source_dir_hint", F.coalesce("source_dir_hint", "sw_source_dir_hint"))
          .drop("sw_repo_url", "sw_source_dir_hint"))
    df = df.withColumn("n_evidence", F.size("evidence_list").cast("bigint"))
    df = df.withColumn("confidence", confidence_level(F.col("name"), F.col("version"), F.col("repo_url"),
                                                      F.col("n_evidence")))
    if remote_tags is not None:
        df = df.join(resolve_tag(df, remote_tags), [B], "left")
    else:
        df = df.withColumn("tag", F.lit(None).cast("string"))
    return df.select(B, "name", "version", "repo_url", "tag", "languages", "confidence",
                     F.col("evidence_list").alias("evidence"), "n_evidence", "source_dir_hint", "node_count")
