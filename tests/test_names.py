from pyspark.sql import functions as F

from binlens.functions import names as N


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first()["r"]


def test_auto_name_and_clean(spark):
    assert one(spark, N.is_auto_name, "FUN_001") is True
    assert one(spark, N.is_auto_name, "thunk_FUN_1") is True
    assert one(spark, N.is_auto_name, "_main") is False
    assert one(spark, N.clean_name, "___init") == "init"   # all leading underscores


def test_address_keys(spark):
    assert one(spark, N.addr_cluster_key, "1032be000") == "1032be"
    assert one(spark, N.addr_cluster_key, "1032b") == "1032b"
    assert one(spark, N.addr_dir_key, "100004000") == "100004"
    assert one(spark, N.addr_dir_key, "abc") == "misc"


def test_safe_name_and_tail(spark):
    assert one(spark, N.safe_name, "operator<<") == "operator__"
    assert one(spark, N.symbol_tail, "ns::Foo::bar(int)") == "bar"
    # Q23: a qualified parameter type is cut at the last '::'
    assert one(spark, N.symbol_tail, "foo(ns::Type)") == "Type)"


def test_path_helpers(spark):
    assert one(spark, N.path_ext, "src/a.b/c.cpp") == ".cpp"
    assert one(spark, N.path_ext, "src/.hidden") == ""
    # Q6: exclusion is a substring test, so latest/ is dropped by test/
    assert one(spark, N.is_excluded_path, "latest/x.c") is True
    assert one(spark, lambda c: N.language_of_ext(c, with_hpp=False), ".hpp") == "unknown"
    assert one(spark, N.language_of_ext, ".hpp") == "cpp"


def test_chunk_file_name(spark):
    df = spark.createDataFrame([(3, 700, 1050)], "i int, s int, e int")
    assert df.select(N.chunk_file_name("i", "s", "e")).first()[0] == "chunk_003_L701-L1050.js"
