from pyspark.sql import functions as F

from rostrum.functions import text as tx
from rostrum.operators import tfidf


def _one(spark, expr, value, schema="t string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("x")).first()["x"]


def test_tokenize_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "123 4.5 ,,, !!"), (4, "a b c"), (5, "The cat_9 sat; x2y the"), (6, "ΣΟΦΟΣ λόγος")]
    df = spark.createDataFrame(rows, "id long, merged_speech string")
    got = {r["id"]: r["tokens"] for r in tfidf.tokenize(df, stopwords=["the"], drop_null=False).collect()}
    assert got[1] == [] and got[2] == [] and got[3] == [] and got[4] == []
    # digits and underscore removed inside tokens, stopwords compared lower-cased
    assert got[5] == ["cat", "sat", "xy"]
    # Greek final sigma lower-cases to 'ς' in Spark, as in Python
    assert got[6] == ["σοφος", "λόγος"]
    assert tfidf.tokenize(df, drop_null=True).count() == 5


def test_stems_and_one_char(spark):
    df = spark.createDataFrame([(1, "Is was for them")], "id long, merged_speech string")
    tok = tfidf.tokenize(df, stems={"is": "be", "was": "be", "for": "f"}).first()["tokens"]
    assert tok == ["be", "be", "f", "them"]
    post = {r["term"]: r["tf"] for r in tfidf.postings(tfidf.tokenize(df, stems={"is": "be", "was": "be", "for": "f"})).collect()}
    assert post == {"be": 2, "them": 1}  # 1-char stems leave the TF-IDF path


def test_term_counts_match_python(spark):
    text = "b a c a b a dd dd e"
    df = spark.createDataFrame([(1, text)], "id long, merged_speech string")
    post = {r["term"]: r["tf"] for r in tfidf.postings(tfidf.tokenize(df)).collect()}
    assert post == {"dd": 2}
    df2 = spark.createDataFrame([(1, "bb aa cc aa bb aa")], "id long, merged_speech string")
    post2 = {r["term"]: r["tf"] for r in tfidf.postings(tfidf.tokenize(df2)).collect()}
    assert post2 == {"aa": 3, "bb": 2, "cc": 1}


def test_excerpt_and_prefix(spark):
    assert _one(spark, tx.excerpt("t", 20), "short") == "short"
    assert _one(spark, tx.excerpt("t", 20), "abcdefghijklmnopqrs \n tail") == "abcdefghijklmnopqrs..."
    assert _one(spark, tx.excerpt("t", 5), "  ab cdef") == "ab..."
    assert _one(spark, tx.report_prefix("t", 3), "abcdef") == "abc..."
    assert _one(spark, tx.or_unknown("t"), None) == "Unknown"


def test_text_pieces(spark):
    t = "x" * 25
    assert _one(spark, tx.text_pieces("t", 10, 20), t) == ["x" * 10, "x" * 10, "x" * 5]
    assert _one(spark, tx.text_pieces("t", 10, 30), t) == [t]


def test_years(spark):
    assert _one(spark, tx.lenient_year("t"), "unknown") is None
    assert _one(spark, tx.lenient_year("t"), "2001-02-03") == 2001
    assert _one(spark, tx.sitting_year("t"), "1999-05-03") == 1999


def test_dictionary_stems_of_any_size_keep_order_and_empty_documents(spark):
    rows = [(1, "The cat SAT on w7 the cat"), (2, ""), (3, None), (4, "x y"), (5, "gone walking gone")]
    df = spark.createDataFrame(rows, "id long, merged_speech string").selectExpr("*", "id * 10 AS tag")
    entries = [(f"tok{chr(97 + i % 26)}{'q' * (i // 26)}", "s") for i in range(5000)]
    entries += [("cat", "feline"), ("cat", "zzz"), ("sat", "sit"), ("gone", "")]
    stems = spark.createDataFrame(entries, "token string, stem string")
    tok = tfidf.tokenize(df, stopwords=["the"], stems=stems, drop_null=False, carry=["tag"])
    got = {r["id"]: (r["tag"], r["tokens"]) for r in tok.collect()}
    assert got == {1: (10, ["feline", "sit", "on", "feline"]), 2: (20, []), 3: (30, []), 4: (40, []),
                   5: (50, ["walking"])}
    cut = tfidf.tokenize(df, stopwords=["the"], stems=stems, suffix_rule="ing$")
    assert {r["id"]: r["tokens"] for r in cut.collect()}[5] == ["walk"]


def test_dictionary_join_equals_literal_map(spark):
    df = spark.createDataFrame([(1, "Is was for them is"), (2, "them and was")], "id long, merged_speech string")
    pairs = {"is": "be", "was": "be", "for": "f"}
    table = spark.createDataFrame(list(pairs.items()), "token string, stem string")
    by_join = {r["id"]: r["tokens"] for r in tfidf.tokenize(df, stems=table).collect()}
    by_map = {r["id"]: r["tokens"] for r in tfidf.tokenize(df, stems=pairs).collect()}
    assert by_join == by_map


def test_large_literal_map_is_accepted(spark):
    df = spark.createDataFrame([(1, "aa bb")], "id long, merged_speech string")
    stems = {f"k{i}x": "s" for i in range(600)} | {"aa": "zz"}
    assert tfidf.tokenize(df, stems=stems).first()["tokens"] == ["zz", "bb"]
