import random

from rostrum.operators import lexicon as lx
from rostrum.operators import sentiment as st
from rostrum.sources import fixtures as fx


def test_clean_and_expand(spark):
    rows = [(1, "Καλός -ή -ό", "POS", "POS", "POS", "POS"), (2, "ab", "NEG", "", "", ""),
            (3, "x,ab", "POS", "POS", "N/A", "N/A"), (4, "ab", "NEG", "NEG", "NEG", "NEG")]
    df = spark.createDataFrame(rows, fx.LEXICON_SCHEMA)
    cleaned = {r["pos"]: r["cleaned"] for r in lx.clean_terms(df).collect()}
    assert cleaned[1] == "καλός,καλή"  # only the second component's first ending is used
    forms = {r["form"]: r for r in lx.average_polarity(lx.expand_forms(lx.clean_terms(df))).collect()}
    # 'ab' keeps its first position but the comma list's values win
    assert forms["ab"]["grp"] == 0 and forms["ab"]["fpos"] == 2 and forms["ab"]["polarity"] == 0.5
    assert forms["x"]["grp"] == 1 and forms["καλή"]["polarity"] == 1.0


def test_half_average_in_entry_order(spark):
    rows = [(1, "aa", "POS", "POS", "POS", "POS"), (2, "bb", "NEG", "NEG", "NEG", "NEG"), (3, "cc", "POS", "POS", "N/A", "N/A")]
    df = spark.createDataFrame(rows, fx.LEXICON_SCHEMA)
    lex = {r["stem"]: r["polarity"] for r in lx.prepare(df, stems={"aa": "s", "bb": "s", "cc": "s"}).collect()}
    assert lex == {"s": ((1.0 + -1.0) / 2 + 0.5) / 2}


def test_speech_polarity_zero_without_hits(spark):
    toks = spark.createDataFrame([(1, "P", 2000, "good", 2), (1, "P", 2000, "x", 1), (2, "P", 2000, None, None), (3, "P", 2000, "bad", 1)],
                                 "id long, standard_party string, year int, term string, tf long")
    lex = spark.createDataFrame([("good", 1.0), ("bad", -0.5)], "stem string, polarity double")
    got = {r["id"]: r["polarity"] for r in st.speech_polarity(toks, lex).collect()}
    assert got == {1: 1.0, 2: 0.0, 3: -0.5}
    words = st.top_polar_words(toks, lex, stopwords=["bad"]).collect()
    assert [(r["word"], r["frequency"], r["polarity"]) for r in words] == [("good", 2, "positive")]


def test_merge_stems_in_segments(spark):
    """The half-average of many colliding forms, however they are cut, is the fold in entry order."""
    rng = random.Random(3)
    rows = [(s, g, p, i, rng.choice([-1.0, -0.25, 0.0, 0.5, 1.0]))
            for s, n in (("hot", 300), ("two", 2), ("one", 1)) for g in (0, 1) for p in range(n) for i in range(1 + (p % 7 == 0))]
    rows.append(("", 0, 0, 0, 1.0))
    want = {}
    for stem, _, _, _, x in sorted(rows):
        if stem:
            want[stem] = (want[stem] + x) / 2 if stem in want else x
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "stem string, grp int, fpos long, idx int, polarity double")
    for segment in (1, 16, 4096):
        got = {r["stem"]: r["polarity"] for r in lx.merge_stems(df, segment).collect()}
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-12 for s in want)
    assert lx.merge_stems(df.limit(0)).count() == 0


def test_only_lexicon_words_are_stemmed(spark):
    """Polarity and counts are those of all stems; lexicon terms that the dictionary lacks are their own stems."""
    speeches = spark.createDataFrame(
        [(1, "en", "2001-02-03", "Goods good worse zz plain"), (2, "en", "2001-02-03", None), (3, "de", "2002-01-01", "plain words"), (4, "de", "2002-01-01", "zz zz worse")],
        "id long, political_party string, sitting_date string, merged_speech string")
    stems = spark.createDataFrame([("goods", "good"), ("good", "good"), ("worse", "bad"), ("plain", "plain"), ("bad", "x")], "token string, stem string")
    lex = spark.createDataFrame([("good", 1.0), ("bad", -0.5), ("zz", 0.25)], "stem string, polarity double")
    out = []
    for lexicon in (None, lex):
        toks = st.party_speech_terms(speeches, {"en": "A", "de": "B"}, ["A", "B"], (), stems, lexicon)
        words = {tuple(r) for r in st.top_polar_words(toks, lex).collect()}
        out.append(({r["id"]: r["polarity"] for r in st.speech_polarity(toks, lex).collect()}, words))
    assert out[0] == out[1] and out[1][0] == {1: 1.75 / 4, 2: 0.0, 3: 0.0, 4: 0.0}
    assert {r["term"] for r in toks.collect()} == {None, "good", "bad", "zz"}


def test_lexicon_words_are_the_first_two_of_a_text(spark, tmp_path):
    texts = ["Ab cd ef", "  12,", None, "", "one", "é1ü x", "..a..b..c", "x" * 9000 + " y"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r["pos"] - 1: r["term"] for r in fx.lexicon_rows(spark, str(tmp_path)).collect()}
    assert got == {0: "Ab", 4: "one", 5: "é -ü -ly", 6: "a,b", 7: "y"}
