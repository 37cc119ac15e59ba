import zlib

import numpy as np
import pytest

from rostrum.llm import language_id, quality, toxicity
from rostrum.llm.queries import QUERIES
from tests.llm.conftest import HILL, SEA

SF = "/root/testdata/sf0.01"


def test_language_rules(odd, empty):
    got = {(r["doc_id"], r["lang_pred"]) for r in language_id.identify(odd).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (6, "und"), (14, "und")} <= got
    assert language_id.identify(odd).count() == odd.count()
    assert language_id.identify(empty).count() == 0
    kept = language_id.keep_identified(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 7, 8, 9, 10, None, 11, 12, 13}


def test_stage_keeps_what_the_operator_identifies(spark):
    rows = [(i, f"{SEA} {i}", "en") for i in range(30)] + [(100 + i, f"xqz zzkq qqxz kzq{i} zxzx", "und") for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = {r["doc_id"] for r in language_id.identify(frame).collect() if r["lang_pred"] != "und"}
    assert known == set(range(30)) == {r["doc_id"] for r in language_id.keep_identified(frame).collect()}


def test_kernel_equals_shared_ngrams():
    a, b = language_id.ngram_buckets(SEA), language_id.ngram_buckets(HILL)
    m = language_id.Model(["one"], np.zeros((language_id.BUCKETS, 2), np.float32), np.zeros(1))
    m.weights[:, 1] = 1
    m.weights[np.unique(b), 0] = 1 / np.sqrt(len(set(b)))
    exact = len(set(a) & set(b)) / np.sqrt(len(set(a)) * len(set(b)))
    assert m.scores([a])[0, 0] == pytest.approx(exact, rel=1e-5)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op9_language_id"](spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97


def test_sample_of_many_languages(spark):
    """Dirty tags do not push out frequent languages; the sample is the rows of smallest hash."""
    rows = [(i, f"{SEA} {i}", "en") for i in range(400)] + [(1000 + i, f"{HILL} {i}", "de") for i in range(300)]
    rows += [(5000 + i, f"qx{i} zk", f"tag{i:04d}") for i in range(3000)] + [(9000, "12 34", "num"), (9001, None, "none")]
    rows += [(7, "the same row", "en")] * 500
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    got = language_id.sample_rows(frame, 400).collect()
    by = {}
    for r in got:
        by.setdefault(r["lang"], []).append(r["key"])
    assert len(by) == 50 and by.keys() - {"en", "de"} == {f"tag{i:04d}" for i in range(48)}
    keys = frame.selectExpr("lang", f"xxhash64({language_id.SEED}, doc_id, text) k").distinct().collect()
    for lang in ("en", "de"):
        assert sorted(by[lang]) == sorted(r["k"] for r in keys if r["lang"] == lang)[:8]
    model = language_id.fit(frame, 400)
    assert language_id._labels(model, [f"{SEA} 9", f"{HILL} 9"])[0] == ["en", "de"]


def test_landmarks_are_not_the_short_texts(spark):
    rows = [(i, " ".join([SEA] * (1 + i % 40)), "en") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted((r["key"], len(r["bits"])) for r in language_id.sample_rows(frame, 400).collect())
    length = {r["k"]: r["n"] for r in frame.selectExpr(f"xxhash64({language_id.SEED}, doc_id, text) k", "length(text) n").collect()}
    first = np.mean([length[k] for k, _ in got[:100]])
    assert abs(first / np.mean(list(length.values())) - 1) < 0.25


def test_toxicity_odd_rows(odd, empty, labels):
    got = toxicity.classify(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert by[3] == by[4] == by[5] == by[14] and len(by[1]) == 1
    assert toxicity.classify(empty, labels).count() == 0
    assert toxicity.classify(odd, labels.limit(0)).count() == odd.count()


def test_stage_drops_what_the_operator_flags(odd, labels, monkeypatch):
    model = toxicity.fit(odd, labels)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(odd, model).collect()}
    # the German cut below every score, the English one above, none for French
    model.thresholds = {"de": min(scores.values()) / 2, "en": 1.1}
    monkeypatch.setattr(toxicity, "fit", lambda *a: model)
    flagged = {r["doc_id"] for r in toxicity.score_documents(odd, model).collect() if r["flagged"]}
    assert {8, 9} <= flagged and not {1, 2, 10, 13} & flagged
    kept = [r["doc_id"] for r in toxicity.keep_clean(odd, labels).collect()]
    assert set(kept) == set(scores) - flagged
    bare = {r["doc_id"] for r in toxicity.keep_clean(odd, labels, 0.0).collect()}
    assert 1 in bare and not bare & {8, 12}


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """Each training document's own word has a trained row, whatever their number; parts are averaged."""
    monkeypatch.setattr(toxicity, "PART", 1500)
    rows = [(i, f"the boat own{i} sea" + (" idiot" if i % 50 == 0 else ""), "en") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    lab = spark.createDataFrame([(i, int(i % 50 == 0)) for i, *_ in rows], "doc_id long, toxic int")
    train = {r["doc_id"] for r in toxicity.training_rows(docs, lab).where("not apart").collect()}
    assert 4000 < len(train) < 5600 and not any(zlib.crc32(str(i).encode()) % 3 == 1 for i in train)
    model = toxicity.fit(docs, lab)
    assert all(model.table[toxicity.subwords(f"own{i}")[0]].any() for i in train)
    got = toxicity.score_documents(docs, model).join(lab, "doc_id").where("flagged <> (toxic = 1)").count()
    assert got == 0 and set(model.thresholds) == {"en"}


def test_toxicity_threshold_of_counted_scores():
    s = np.array([0.1, 0.2, 0.6, 0.9])
    assert toxicity._calibrated(s, np.array([0, 0, 1, 5]), np.array([7, 2, 0, 0])) == pytest.approx(0.4)
    assert toxicity._calibrated(s, np.zeros(4), np.ones(4)) == toxicity.THRESHOLD


def test_pooling_by_pieces_equals_whole(monkeypatch):
    rng = np.random.default_rng(0)
    m = toxicity.Model(np.zeros((2, 8), np.float32), [rng.normal(size=(w, 8, 8)).astype(np.float32) for w in toxicity.WIDTHS],
                       np.zeros(24, np.float32), rng.normal(size=24), 0.0)
    vectors = np.vstack([np.zeros((1, 8)), rng.normal(size=(50, 8))]).astype(np.float32)
    docs = [rng.integers(1, 51, n).astype(np.int32) for n in (0, 1, 2, 40, 333)]
    whole = m.pooled(docs, vectors)
    monkeypatch.setattr(toxicity, "PIECE", 16)
    assert np.allclose(m.pooled(docs, vectors), whole)
    for d, p in zip(docs, whole):
        e = vectors[np.concatenate([d if len(d) else [0], [0, 0]]).astype(int)]
        best = np.concatenate([max((sum(e[i + k] @ w[k] for k in range(len(w))) for i in range(len(e) - 2)), key=lambda v: v[f])[f : f + 1]
                               for w in m.filters for f in range(8)])
        assert np.allclose(np.maximum(best, 0), p, atol=1e-4)


def test_quality_odd_rows(odd, empty, labels):
    got = quality.classify(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (3, 4, 5)}) == 1
    assert quality.classify(empty, labels).count() == 0


def test_quality_held_out(spark):
    lab = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = QUERIES["op4_quality"](spark, SF).join(lab, "doc_id").where("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    good = [r["score"] for r in got if r["quality"] == 1]
    bad = [r["score"] for r in got if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
