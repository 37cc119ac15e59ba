import os
import tempfile

import pytest

from rostrum.operators import keywords as kw
from rostrum.operators import lexicon as lx
from rostrum.sources import io


def test_read_lexicon_tsv(spark):
    d = tempfile.mkdtemp(prefix="rostrum-")
    path = os.path.join(d, "lex.tsv")
    header = ["Term"] + [f"c{i}" for i in range(1, 13)]
    rows = [["καλός -ή -ό"] + ["x"] * 8 + ["POS", "POS", "NEG", ""], ["κακός"] + ["x"] * 8 + ["NEG", "NEG", "NEG", "N/A"]]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\t".join(header) + "\n")
        for r in rows:
            f.write("\t".join(r) + "\n")
    df = lx.read_lexicon(spark, path)
    got = {r["term"]: (r["polarity1"], r["polarity2"], r["polarity3"], r["polarity4"]) for r in df.collect()}
    assert got["κακός"] == ("NEG", "NEG", "NEG", "N/A")
    assert got["καλός -ή -ό"][:3] == ("POS", "POS", "NEG")
    forms = {r["form"]: r["polarity"] for r in lx.average_polarity(lx.expand_forms(lx.clean_terms(df))).collect()}
    assert forms == {"καλός": 0.25, "καλή": 0.25, "κακός": -0.75}


def test_csv_round_trip_and_bom(spark):
    d = tempfile.mkdtemp(prefix="rostrum-")
    df = spark.createDataFrame([("P", "w", 3, "positive")], "party string, word string, frequency long, polarity string")
    io.write_csv(df, os.path.join(d, "top_positive_words_by_party"))
    back = io.polarity_data(spark, d, "positive")
    assert back.columns == ["party", "word", "frequency", "polarity"]
    assert back.first()["word"] == "w"
    with open(os.path.join(d, "bom.csv"), "w", encoding="utf-8-sig") as f:
        f.write("party,word\nP,w\n")
    assert io.read_result_csv(spark, os.path.join(d, "bom.csv")).columns == ["party", "word"]
    with pytest.raises(KeyError):
        io.polarity_data(spark, d, "neutral")


def test_parquet_round_trip_union_and_report(spark):
    d = tempfile.mkdtemp(prefix="rostrum-")
    a = spark.createDataFrame([(1, "x")], "id long, t string")
    b = spark.createDataFrame([(2, "y", 5)], "id long, t string, extra int")
    io.save(a, os.path.join(d, "a"))
    io.save(b, os.path.join(d, "b"))
    u = io.union_chunks(spark, [os.path.join(d, "a"), os.path.join(d, "b")])
    assert sorted(r["id"] for r in u.collect()) == [1, 2]
    post = spark.createDataFrame([(1, "b", 1.0), (2, "a", 2.0)], "id long, term string, weight double")
    io.save_postings(post, os.path.join(d, "post"), partitions=2)
    assert io.load(spark, os.path.join(d, "post")).filter("term = 'a'").count() == 1
    lines = spark.createDataFrame([(1, 0, "Cluster 1:"), (1, 1, "  Speech ID: 9"), (1, 2, "  Member Name: m ")],
                                  "cluster int, line_no int, line string")
    io.write_report(lines, os.path.join(d, "rep"), "cluster")
    back = io.filter_report_lines(io.read_report(spark, os.path.join(d, "rep")))
    assert sorted(r["line"] for r in back.collect()) == ["Cluster 1:", "Member Name: m"]


def test_corrupt_and_empty_chunks_are_skipped_and_listed(spark, tmp_path):
    a = spark.createDataFrame([(1, "x")], "id long, t string")
    b = spark.createDataFrame([(5, 2)], "extra int, id long")
    for name, df in (("a", a), ("b", b)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not parquet at all")
    paths = [str(tmp_path / n) for n in ("a", "b", "bad")]
    got = {r["id"]: (r["t"], r["extra"]) for r in io.union_chunks(spark, paths).collect()}
    assert got == {1: ("x", None), 2: (None, 5)}
    skipped = [r["path"] for r in io.skipped_chunks(spark, paths).collect()]
    assert skipped == [str(bad / "part-0.parquet")]
    assert io.union_chunks(spark, []).count() == 0


def test_position_order(spark):
    ids = spark.createDataFrame([(3, 0), (1, 1), (9, 2), (3, 3)], "id long, pos int")
    details = spark.createDataFrame([(1, "a"), (3, "c")], "id long, name string")
    got = [(r["pos"], r["id"], r["name"]) for r in kw.in_position_order(ids, details).collect()]
    assert got == [(0, 3, "c"), (1, 1, "a"), (3, 3, "c")]
