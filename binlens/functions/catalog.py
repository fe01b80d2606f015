"""Fixed values the results depend on, stated as data.

These lists must equal the ones the analysed pipeline uses, so they are written out
plainly and in their natural order.  Each becomes a small DataFrame (a catalog of a
few dozen rows, so it is broadcast by size) or a literal expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---- fixed values: known software catalog (order matters: first match wins) ----
KNOWN_SOFTWARE = [
    # (name, repo_url, string_markers, min_markers, source_dir_hint)
    ("bun", "https://github.com/oven-sh/bun.git",
     ["Bun.serve", "bun create", "bun install", "BUN_INSTALL", "bunfig.toml", "bun.lockb"], 2, "src/"),
    ("node", "https://github.com/nodejs/node.git",
     ["process.versions.node", "NODE_VERSION", "node::Environment", "node_modules"], 2, "src/"),
    ("deno", "https://github.com/denoland/deno.git",
     ["deno_core", "Deno.serve", "DENO_DIR", "deno.json", "deno.lock"], 2, "cli/"),
    ("redis", "https://github.com/redis/redis.git",
     ["redis_version", "REDIS_PORT", "appendonly", "redis-server", "redis-cli"], 2, "src/"),
    ("nginx", "https://github.com/nginx/nginx.git",
     ["nginx/", "ngx_http_", "nginx.conf", "worker_processes", "ngx_event_"], 2, "src/"),
    ("sqlite", "https://github.com/sqlite/sqlite.git",
     ["sqlite3_open", "SQLITE_OK", "sqlite_master", "CREATE TABLE", "sqlite3_prepare"], 3, "src/"),
    ("curl", "https://github.com/curl/curl.git",
     ["curl_easy_", "CURLOPT_", "libcurl", "curl_global_init"], 2, "lib/"),
    ("ffmpeg", "https://github.com/FFmpeg/FFmpeg.git",
     ["avcodec_", "avformat_", "libavutil", "ffmpeg version", "AVCodecContext"], 2, "libavcodec/"),
]

# ---- fixed values: repositories never reported ----
IGNORE_REPOS = ["nicbarker/clay", "nicbarker/clay.git"]

# ---- fixed values: language indicators (checked in this language order) ----
LANGUAGE_INDICATORS = [
    ("zig", [".zig", "zig-linux", "zig-macos", "ZIG_PROGRESS"]),
    ("cpp", ["__cxa_throw", "std::__1", "libc++", "__cxxabiv1"]),
    ("rust", ["_cargo_registry", "rust_begin_unwind", ".rs:"]),
    ("go", ["runtime.gopanic", "go.buildid"]),
    ("swift", ["Swift.", "swift_demangle"]),
]
# used only when no language above is indicated
C_INDICATORS = [".c:", "printf", "fprintf"]

# ---- fixed values: bundled-application formats, in detection order ----
# (format, language, regex over the binary's strings); bun is found by segment name.
BUNDLE_FORMATS = [
    ("bun", "javascript", None),
    ("node_sea", "javascript", r"NODE_SEA_BLOB|NODE_SEA_FUSE_fce680ab2cc467b6e072b8b5df1996b2"),
    ("electron", "javascript", r"electron\.asar|ELECTRON_RUN_AS_NODE"),
    ("pyinstaller", "python", r"_MEIPASS|pyiboot|PyInstaller"),
    ("pkg", "javascript", r"pkg/prelude|pkg\.js\.snapshot"),
]
BUN_SEGMENT = "__BUN"

# ---- fixed values: source-tree path fragments skipped by the indexes ----
EXCLUDED_FRAGMENTS = ["vendor/", "node_modules/", "third_party/", "deps/", "external/", "test/", "bench/"]
# the literal index skips the same fragments except bench/
EXCLUDED_FRAGMENTS_LITERALS = ["vendor/", "node_modules/", "third_party/", "deps/", "external/", "test/"]

# ---- fixed values: extensions of the definition index, in scan order, with language ----
DEFINITION_EXTENSIONS = [
    (".zig", "zig"), (".cpp", "cpp"), (".c", "c"), (".h", "c"),
    (".hpp", "cpp"), (".rs", "rust"), (".go", "go"), (".swift", "swift"),
]
# extensions of the literal index, in scan order
LITERAL_EXTENSIONS = [".zig", ".cpp", ".c", ".h", ".rs", ".go", ".swift"]

# ---- fixed values: definition patterns per extension (group 1 = name) ----
# C-family patterns must match at the start of the line; the others anywhere in it.
DEFINITION_PATTERNS = {
    ".zig": r"(?:pub\s+)?(?:export\s+)?fn\s+(\w+)\s*\(",
    ".cpp": r"^[a-zA-Z_][\w:*&<> ]*\s+(\w+)\s*\(",
    ".c": r"^[a-zA-Z_][\w:*& ]*\s+(\w+)\s*\(",
    ".h": r"^[a-zA-Z_][\w:*& ]*\s+(\w+)\s*\(",
    ".hpp": r"^[a-zA-Z_][\w:*&<> ]*\s+(\w+)\s*\(",
    ".rs": r"(?:pub\s+)?fn\s+(\w+)\s*[<(]",
    ".go": r"^func\s+(?:\(\w+\s+\*?\w+\)\s+)?(\w+)\s*\(",
    ".swift": r"(?:public\s+)?func\s+(\w+)\s*[<(]",
}
# names a definition pattern may capture but that are not definitions
NOT_DEFINITION_NAMES = ["if", "for", "while", "return", "switch"]

# ---- fixed values: the "function at line" patterns (zig, and everything else) ----
ENCLOSING_PATTERN_ZIG = r"(?:pub\s+)?(?:export\s+)?fn\s+(\w+)\s*\("
ENCLOSING_PATTERN_OTHER = r"^[a-zA-Z_][\w:*&<> ]*\s+(\w+)\s*\("

# ---- fixed values: text patterns ----
FUNCTION_LITERAL = r'"([^"]{6,})"'
PATH_LINE_REF = r"([\w./+-]+\.\w{1,4}:\d+)"
PATH_LINE_ANCHORED = r"^([\w./+-]+\.\w{1,4}):(\d+)"
SOURCE_LITERAL = r'"([^"]{10,80})"'
CALL_SITE = r"(\w+)\s*\("

GITHUB_URL_PATTERNS = [
    r"github\.com/([a-zA-Z0-9_-]+)/([a-zA-Z0-9_.-]+)",
    r"raw\.githubusercontent\.com/([a-zA-Z0-9_-]+)/([a-zA-Z0-9_.-]+)",
]
# (pattern, kind): kind "named" has groups (name, version), "version_only" has (version)
VERSION_PATTERNS = [
    (r"(?:^|\s)(\w+)[/ ]v?(\d+\.\d+\.\d+)(?:\s|$)", "named"),
    (r"(\w+)-v?(\d+\.\d+\.\d+)", "named"),
    (r"Version:\s*v?(\d+\.\d+\.\d+)", "version_only"),
]
BUILD_PATH_PATTERNS = [
    r"(/[Uu]sers/\w+/[\w/.+-]+)",
    r"(src/[\w/.+-]+\.\w+)",
    r"(\w+/src/[\w/.+-]+)",
]

# The same matches in linear time for Java's engine: a run of word or path characters is
# entered at its start only (or where the match before ended) and never given back.
CALL_SITE_LINEAR = r"(?<!\w)(\w++)\s*+\("
# the two halves of a call with line breaks between them
TRAILING_WORD = r"(?<!\w)(\w++)\s*+\z"
CALL_OPENING = r"^\s*+\("
PATH_LINE_REF_LINEAR = r"(?:\G|(?<![\w./+-]))([\w./+-]++(?<=[\w./+-]\.\w{1,4}):\d+)"
VERSION_PATTERNS_LINEAR = [
    VERSION_PATTERNS[0],
    (r"(?<!\w)(\w++)-v?(\d+\.\d+\.\d+)", "named"),
    VERSION_PATTERNS[2],
]
BUILD_PATH_PATTERNS_LINEAR = [
    BUILD_PATH_PATTERNS[0],
    BUILD_PATH_PATTERNS[1],
    r"(?<!\w)(\w++/src/[\w/.+-]+)",
]

# ---- fixed values: first-N sizes of the ordered string / symbol lists (P13 only) ----
FIRST_N_STRINGS = 100_000
FIRST_N_SYMBOLS = 5_000
# ---- fixed values: symbol families ----
NAPI_PREFIX, NAPI_MIN = "_napi_", 50
UV_PREFIX, UV_MIN = "_uv_", 20

# ---- fixed values: evidence texts ----
REPO_EVIDENCE = "GitHub URL found: %s (%d refs)"
SIGNATURE_EVIDENCE = "Signature match: %s (%d markers: %s)"
VERSION_EVIDENCE = "Version string: "
BUILD_PATH_EVIDENCE = "Build paths found: %d paths, %d extensions"
NAPI_EVIDENCE = "N-API symbols: %d (Node.js compatible runtime)"
UV_EVIDENCE = "libuv symbols: %d"

# ---- fixed values: git tag spellings tried for a version, in order ({name}, {version})
TAG_FORMATS = ["v{version}", "{name}-v{version}", "{name}-{version}", "{version}", "release-{version}"]

# ---- fixed values: function categories (first rule that holds) ----
# (subcategory, name prefixes)
CATEGORY_RULES = [
    ("thunks", ["thunk_"]),
    ("system", ["__"]),
    ("cpp_mangled", ["_ZN", "_ZL", "_ZTV"]),
    ("switch_cases", ["caseD_", "switchD_"]),
]
LIBC_STYLE_MAX_LEN = 30

# ---- fixed values: categories of the composition document, with their descriptions ----
CATEGORY_DESCRIPTIONS = {
    "framework": "Mapped to framework source (already known)",
    "framework_propagated": "Called only by framework (likely inlined/optimized framework code)",
    "compiler_system": None,
    "unknown": "Unclassified — to be triaged by agent into third-party vs custom",
}
AUTO_NAME_PREFIXES = ["FUN_", "thunk_"]

# ---- fixed values: per-function corpus formats (header line, combined-file header) ----
CORPUS_DOC_HEADER = "// %s @ %s\n"  # name, address
CORPUS_COMBINED_HEADER = "// Ghidra decompilation of: %s\n// Functions: %d\n"  # target name, count

# ---- fixed values: bundle chunking ----
CHUNK_TARGET_LINES = 500
CHUNK_BREAK_FRACTION = 0.7  # a break needs >= 0.7 * 500 = 350 lines since the last one
CHUNK_MIN_CHARS = 100
CHUNK_BREAK_PATTERN = r"^(function |class |var |const |let |async function |export |\(function\()"
HINT_ERROR_WORDS = ["error", "fail", "invalid"]
HINT_URL_WORDS = ["http", "api", "oauth"]
HINT_KEYWORDS = ["config", "init", "handler", "route", "service", "model", "auth", "server", "client"]
HINT_LIMIT = 5
BUILTIN_SEGMENT_MARKERS = ["@getInternalField", "@createInternalModuleById"]
SEGMENT_MIN_LEN = 200  # runs strictly longer than this are kept

# ---- fixed values: produced-source checks ----
PRODUCED_EXTENSIONS = [".cpp", ".c", ".zig", ".rs", ".h", ".js", ".ts"]
C_DEFINITION_LINE = r"^(static\s+)?(const\s+)?(unsigned\s+)?(struct\s+)?[a-zA-Z_]\w*[\w *]+\w+\s*\([^;]*\)\s*\{?$"
# the same line in two parts that each take linear time: up to the first '(', and from there on
C_DEFINITION_HEAD = r"^(static\s+)?(const\s+)?(unsigned\s+)?(struct\s+)?[a-zA-Z_][\w *]+\w\s*$"
C_DEFINITION_REST = r"^\([^;]*\)\s*\{?$"
ZIG_DEFINITION_LINE = r"^\s*(pub\s+)?(export\s+)?fn\s+"
JS_DEFINITION_LINE = r"^\s*(export\s+)?(async\s+)?function\s+|^\s*(const|let|var)\s+\w+\s*=\s*(async\s+)?\("
GATE_MIN_LOC = 500
GATE_MIN_DEFINITIONS = 10
# ---- fixed values: gate messages ----
GATE_A_MESSAGE = "No source files found in output/src/."
GATE_B_MESSAGE = "QUALITY: Only %d lines of code across %d files. Minimum 500 LOC required."
GATE_C_MESSAGE = "QUALITY: Only %d function definitions found."
# ---- fixed values: run logs, composition, clusters ----
RATE_LIMIT_PATTERN = r"(?i)rate.limit|429|too many requests|overloaded"
COMPLETION_MARKER = "<promise>CYCLE_DONE</promise>"
LOG_TAIL_LINES = 30
FRAMEWORK_MODE_SHARE = 0.1
TOP_CLUSTERS = 30
CLUSTER_PREFIX_LEN = 6


def software_catalog(spark: SparkSession) -> DataFrame:
    rows = [(i, n, url, hint, m) for i, (n, url, _, m, hint) in enumerate(KNOWN_SOFTWARE)]
    schema = "sw_rank INT, sw_name STRING, sw_repo_url STRING, sw_source_dir_hint STRING, min_markers INT"
    return spark.createDataFrame(rows, schema)
