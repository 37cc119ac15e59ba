import re
import zlib

import corpus_pipeline
from rostrum.llm import language_id, packing, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_pipeline_against_its_steps(spark):
    """run() equals the stages' decisions taken one document at a time."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    ids = [i for i, r in rows.items() if language_id.ngram_buckets(r["text"]) is not None]
    kept = docs.where(docs.doc_id.isin(ids))
    model = toxicity.fit(kept, spark.read.parquet(f"{SF}/labels.parquet"))
    words = toxicity.WordRows(model.table)
    score = dict(zip(ids, model.score(words.block([rows[i]["text"] for i in ids]), words.vectors)))
    ids = sorted(i for i in ids if score[i] < toxicity.THRESHOLD)
    prints = {i: simhash.fingerprint(rows[i]["text"]) for i in ids}
    group = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            low = min(group[b] for b in ids if (prints[a] ^ prints[b]).bit_count() <= 3)
            changed |= low != group[a]
            group[a] = low
    ids = [i for i in ids if group[i] == i]
    from tests.llm.test_sets import brute_targets

    words_of = {i: len(re.findall(r"[^\x20\x09-\x0D]+", rows[i]["text"])) for i in ids}
    sizes = {}
    for i in ids:
        sizes[rows[i]["source"]] = sizes.get(rows[i]["source"], 0) + words_of[i]
    targets = brute_targets(sizes)
    got = corpus_pipeline.run(spark, SF).collect()
    seen = {r["doc_id"] for r in got}
    assert seen <= set(ids)
    ends = got
    # a source that is taken once over at least keeps all its documents
    for s, n in sizes.items():
        if targets[s] >= n:
            assert {i for i in ids if rows[i]["source"] == s and words_of[i]} <= seen
    whole = packing.WordTokens(str(__import__("public_tokenizers").path("word_bpe_49k.json")))
    import numpy as np

    for r in ends:
        tokens = np.concatenate([whole.block([rows[r["doc_id"]]["text"]])[0], [1]]).astype("<u4")
        part = tokens[r["start"] : r["start"] + r["length"]]
        full = r["start"] + r["length"] == len(tokens) or r["length"] == packing.CAPACITY
        if full:
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
    # at most one document of a source is cut, in one copy
    cut = [r["doc_id"] for r in got if r["length"] < packing.CAPACITY and zlib.crc32(
        np.concatenate([whole.block([rows[r["doc_id"]]["text"]])[0], [1]]).astype("<u4")[r["start"] : r["start"] + r["length"]].tobytes()) != r["ids_crc32"]]
    assert len({rows[i]["source"] for i in cut}) == len(cut)


def test_stages_return_the_columns_of_documents(spark, odd):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "simhash_near_dedup", "mixing", "packing"]
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd.columns, name
