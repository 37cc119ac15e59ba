import gzip
import hashlib
import re
import zlib
from itertools import groupby

import numpy as np
import pytest

from rostrum.llm import embed_dedup, licenses, minhash, mixing, packing, simhash, warc
from rostrum.llm.common import scratch, tokenizer_path
from rostrum.llm.components import components
from rostrum.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_components(nodes, linked):
    low = dict(zip(nodes, nodes))
    while True:
        new = {a: min([low[a], *(low[b] for b in linked[a])]) for a in nodes}
        if new == low:
            return low
        low = new


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (300, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "src long, dst long")).collect()))
    assert got == {**{i: 0 for i in [*range(41), 100]}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


# op1


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_minhash_against_jaccard(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PER_BUCKET", 7)
    docs = sorted(((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True)
    got = {r["doc_id"]: r for r in QUERIES["op1_minhash"](spark, SF).collect()}
    assert len(got) == len(docs)
    for k, (i, t) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = shingles(t), shingles(edited), shingles(after)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(t)
        assert got[i]["near_edited"] == pytest.approx(len(a & b) / len(a | b), abs=0.16)
        assert got[i]["near_next"] == pytest.approx(len(a & c) / len(a | c), abs=0.16)


def test_minhash_odd_rows(odd, empty):
    got = minhash.fingerprint_documents(odd).collect()
    assert len(got) == odd.count() and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fp"] == by[2]["fp"] and by[3]["fp"] == by[4]["fp"] == by[5]["fp"] == []
    assert by[4]["near_next"] == by[5]["near_next"] == 1.0  # 4 -> 3 and 5 -> 4: no words
    assert minhash.fingerprint_documents(empty).count() == 0


# op3


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mix_of_rows_alike_but_for_their_source(spark):
    rows = [(i % 10, f"one two three {i % 10}", s, "en") for i in range(20) for s in ("a", "b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    want = {r["source"]: int(r["target"]) for r in mixing.source_targets(mixing.taken(docs).select("source", "size")).collect()}
    got, again = ([tuple(r) for r in mixing.mix(docs).collect()] for _ in range(2))
    words = dict.fromkeys(want, 0)
    for _, text, source, _ in got:
        words[source] += len(text.split())
    assert words == want and sorted(map(str, got)) == sorted(map(str, again))


def test_mixing(odd, empty):
    rows = mixing.taken(odd).collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = brute_targets(sizes)
    assert len(rows) == odd.count()
    for s in sizes:
        mine = [r for r in rows if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[s]) < 1 and all(0 <= r["taken"] <= 2 * r["size"] for r in mine)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.taken(odd).collect()))
    assert mixing.taken(empty).count() == 0 and mixing.mix(empty).count() == 0
    mixed = mixing.mix(odd)
    words = {}
    for r in mixed.collect():
        words[r["source"]] = words.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert mixed.columns == odd.columns
    assert words == {s: n for s in sizes if (n := sum(r["taken"] for r in rows if r["source"] == s))}


# op5


def test_warc_round_trip(spark):
    pages = [(1, "http://a.org/x", "same", 1), (2, "http://a.org/y z", "same", 1), (2, "http://a.org/y", "same", 1), (3, None, None, 1),
             (4, "", "", 1), (5, "http://b.org/é", "\r\n\r\nHTTP/1.1 WARC/1.1\r\n\r\n é", 1), (None, "http://c.org", "only", 1),
             (6, "u", "big " * 3_000_000, 1), (None, None, "same", 1)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, digest int")
    got = warc.archive_pages(frame, scratch(spark, "t")).collect()
    assert len(got) == len(pages)
    want = sorted((str(p[0]), len((p[2] or "").encode()), warc.sha1_base32((p[2] or "").encode())) for p in pages)
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"]) for r in got) == want
    same = sorted((r["record_type"], r["page_id"] or 0, r["refers_to"]) for r in got if r["payload_digest"] == warc.sha1_base32(b"same"))
    assert same == [("response", 2, None), ("revisit", 0, 2), ("revisit", 1, 2), ("revisit", 2, 2)]
    blank = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in got if r["payload_bytes"] == 0}
    assert blank == {4: ("response", None), 3: ("revisit", 4)}
    small = warc.archive_pages(frame.where("page_id < 5"), scratch(spark, "t"), min_bytes=5).collect()
    assert {r["record_type"] for r in small} == {"response"}
    assert warc.archive_pages(frame.limit(0), scratch(spark, "t")).count() == 0


def test_arc_versions_and_damage():
    for version in (1, 2):
        body = b"line\nwith 5 fields 20200101000000 x 3\n"
        data = warc.arc_opening(version, "f.arc") + warc.arc_record(version, "http://a", body, "f.arc", 9)
        cut = b"garbage here\n" + warc.arc_record(version, "http://b", b"z", "f.arc", 9)
        got = list(warc.parse_arc(data + cut + b"http://c 0.0.0.0 20200101000000 text/html 99\nshort"))
        assert [r.get("url") for r in got] == ["http://a", None, "http://b", None]
        assert got[0]["body"] == body and got[1]["damage"] == 13 and got[3]["damage"] > 0


def packed_records(version):
    """An ARC file whose records are gzip members of their own, and the records."""
    bodies = [b"", b"a\nb " * 400_000, b"\x1f\x8b\x08 no \xff\x00 member", b"http://x 0.0.0.0 20200101000000 text/html 3\nabc"]
    records = [warc.arc_record(version, f"http://{i}", b, "f.arc", 9) for i, b in enumerate(bodies)]
    return bodies, [gzip.compress(x) for x in (warc.arc_opening(version, "f.arc"), *records)]


@pytest.mark.parametrize("version", [1, 2])
def test_arc_of_gzip_members(version, monkeypatch):
    bodies, members = packed_records(version)
    got = list(warc.parse_arc(b"".join(members)))
    assert [r["body"] for r in got] == bodies and len({r["offset"] for r in got}) == 4
    plain = b"".join(map(gzip.decompress, members))
    for part in (7, 1 << 20):  # whatever the parts are, and packed or not, the records and offsets are the same
        monkeypatch.setattr(warc, "_PART", part)
        assert list(warc.parse_arc(gzip.compress(plain))) == list(warc.parse_arc(b"".join(members))) == got
        if part > 7:
            assert list(warc.parse_arc(plain)) == got
    # a cut last member, a damaged one in the middle, zeros and other bytes between members
    cut = list(warc.parse_arc(b"".join(members)[:-5]))
    assert [r["body"] for r in cut if "body" in r] == bodies[:3] or [r["body"] for r in cut if "body" in r] == bodies
    assert any("damage" in r for r in cut)
    torn = members[2][:500] + b"\xff" * 40 + members[2][540:]
    got = list(warc.parse_arc(b"".join([*members[:2], torn, *members[3:]])))
    sound = [r["body"] for r in got if "body" in r]
    assert sound[0] == bodies[0] and sound[-2:] == bodies[2:] and sum(r.get("damage", 0) for r in got) >= len(torn)
    got = list(warc.parse_arc(b"".join([members[0], bytes(100), members[1], b"junk", *members[2:]])))
    assert [r["body"] for r in got if "body" in r] == bodies and [r["damage"] for r in got if "damage" in r] == [4]


def test_convert_reports_damage(spark, tmp_path):
    bodies, members = packed_records(1)
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "a.arc.gz").write_bytes(b"".join(members)[:-5])
    (tmp_path / "arc" / "b.arc").write_bytes(b"".join(map(gzip.decompress, members)) + b"garbage\n")
    damage = warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc")).collect()
    assert sorted(r["file"] for r in damage if r["bytes"] == 8) == ["b.arc"] and any(r["file"] == "a.arc.gz" for r in damage)
    kept = [r["body"] for r in warc.parse_arc(b"".join(members)[:-5]) if "body" in r]
    got = warc.read_warc(spark, str(tmp_path / "warc")).collect()
    assert sorted(r["payload_digest"] for r in got) == sorted(map(warc.sha1_base32, kept + bodies))


# op6


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 16)
    monkeypatch.setattr(embed_dedup, "LEAF", 4)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 16))
    rows = [(i, (base[i % 12] + rng.normal(size=16) * 0.25).tolist(), i % 3) for i in range(150)]
    rows += [(150 + i, rows[0][1], 0) for i in range(30)]
    odd = [(500, None, 1), (501, [], 1), (502, [0.0] * 16, 1), (503, [float("nan")] * 16, 1), (504, [None] * 16, 1), (505, rows[0][1], None),
           (None, rows[0][1], 0), (506, [1.0, 2.0], 0), (507, [1.0, 2.0], 0), (0, rows[0][1], 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<float>, label int, node string")
    got = embed_dedup.near_duplicates(frame).collect()
    assert len(got) == len(rows) + len(odd)
    full = [(i, np.array(v, np.float32).astype(float), k) for i, v, k in rows + odd[7:]]
    links, counts = {i: set() for i, _, _ in full}, {}
    for a, (i, v, k) in enumerate(full):
        n = 0
        for b, (j, w, m) in enumerate(full):
            if a != b and k == m and len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= 0.93:
                n += 1
                links[i].add(j)
        counts[i] = n
    want = brute_components(list(links), links)
    for r in got:
        if r["vec_id"] in links:
            assert (r["n_links"], r["component_id"]) == (counts[r["vec_id"]], want[r["vec_id"]])
            assert r["kept"] == (r["vec_id"] == r["component_id"])
        else:
            assert (r["n_links"], r["component_id"]) == (0, r["vec_id"])
    assert embed_dedup.near_duplicates(frame.limit(0)).count() == 0


# op7


def test_packing_places_every_piece(odd, empty, monkeypatch):
    rows = packing.pack_documents(odd, tokenizer_path(), group=4).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    total = sum(len(t.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert sum(r["length"] for r in rows) == total and max(r["length"] for r in rows) <= 4096
    for _, part in groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        end = 0
        for r in part:
            assert r["offset"] == end
            end += r["length"]
        assert end <= 4096
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_packing_rows_are_the_tokenizers(spark):
    """Every row of the query against the tokeniser itself."""
    from tokenizers import Tokenizer

    t, want = Tokenizer.from_file(tokenizer_path()), []
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k : k + 4096], "<u4")
            want.append((r["doc_id"], k // 4096, k, len(part), zlib.crc32(part.tobytes())))
    got = QUERIES["op7_packing"](spark, "/root/testdata/sf0.001").select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_word_tokens_equal_the_tokenizer():
    w = packing.WordTokens(tokenizer_path(), most=3)
    texts = ["a b  c", "x\x1cy z", "<|endoftext|>abc don't", "é ́a", "I'LL it's 'S ''s", "", None, " ", "½x²7 ÀÉ\x85b\xa0c", "ΑΣ ς"]
    for _ in range(2):
        assert [x.tolist() for x in w.block(texts)] == [e.ids for e in w.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_bin_completion_is_optimal_on_small_cases():
    from functools import lru_cache

    rng = np.random.default_rng(1)
    for _ in range(40):
        sizes = sorted(rng.integers(8, 60, 9).tolist(), reverse=True)

        @lru_cache(None)
        def least(i, free):
            if i == len(sizes):
                return len(free)
            opts = {tuple(sorted((*free[:k], f - sizes[i], *free[k + 1 :]))) for k, f in enumerate(free) if f >= sizes[i]}
            return min(least(i + 1, o) for o in [*opts, tuple(sorted((*free, 100 - sizes[i])))])

        placed = packing.pack(sizes, 100)
        assert len({b for b, _ in placed}) == least(0, ())


def test_bin_completion_tries_every_undominated_filling():
    for sizes, capacity in (([41, 40, 30, 29, 28, 27], 100), ([1679, 1638, 1229, 1188, 1147, 1106], 4096)):
        placed = packing.pack(sizes, capacity)
        assert len({b for b, _ in placed}) == 2
    # 36 and 34 fill 70 as well as 35 and 35 do, and only the second leaves the rest whole
    left = {30: 1, 34: 1, 35: 2, 36: 1}
    got = [f for f in packing._fillings(left, 30, sum(1 << s for s in left), 70, 0) if f]
    assert sorted(got) == [(35, 35), (36, 34)]
    # a thousand equal pieces are one filling, deeper than one round of the enumeration
    got = [f for f in packing._fillings({3000: 1, 1: 1096}, 3000, 1 << 3000 | 2, 1096, 0) if f]
    assert got == [(1,) * 1096]


# op8


def test_simhash_brute(spark, odd, empty, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    texts = [(r["doc_id"], r["text"]) for r in docs]
    texts += [(10_000 + i, t + " zz" * (i % 4)) for i, t in texts[:60]] + [(20_000, None), (20_001, ""), (20_001, "")]
    frame = spark.createDataFrame([(*x, "x") for x in texts], "doc_id long, text string, fp string")
    for block in (2, 8192):
        monkeypatch.setattr(simhash, "BLOCK", block)
        for parts in (2, 4):
            classes = simhash.fingerprints(frame).groupBy("fp").count()
            found = components(simhash.links(classes, partitions=parts, block=block)).collect()
            fps = np.array([r["fp"] for r in classes.collect()], np.int64)
            near = {int(a): {int(b) for b in fps[np.bitwise_count(a ^ fps) <= 3]} for a in fps}
            want = {a: c for a, c in brute_components(list(near), near).items() if len(near[a]) > 1}
            assert dict(map(tuple, found)) == want
    got = simhash.near_duplicates(odd).collect()
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert len(got) == odd.count() and by[2] == 1 and by[3] == by[4] == by[5] == by[14] == 3 and by[9] == 8
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted({v for v in by.values() if v})
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


def test_keep_first_keeps_a_document_of_every_group(spark):
    sea, hill, iron = ("the boat went over the sea and back home", "der hund lief ueber den berg ins tal", "iron and coal were sold on the market")
    docs = [(None, "no id and a text of its own"), (None, "another one without any id"), (None, "another one without any id"), (None, sea),
            (1, sea), (7, hill), (7, iron), (8, iron), (9, hill), (9, hill)]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, fp string")
    kept = sorted((str(r["doc_id"]), r["text"]) for r in simhash.keep_first(frame).collect())
    assert kept == sorted([("None", docs[0][1]), ("None", docs[1][1]), ("1", sea), ("7", hill), ("7", iron)])


# op10


def test_licences(spark, empty):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    files = [(1, "a/LICENSE", gpl), (2, "a/b/c/x.py", "# code\nprint(1)"), (3, "a/b/COPYING.txt", "Released under the MIT License."),
             (4, "a/b/c/y.py", "# Licensed under the Apache License,\n# Version 2.0.\nx = 1"), (5, "z/q.py", "the of and to in"), (6, None, gpl),
             (7, "top.py", None), (8, "a/d/e.py", ""), (9, "a/LICENSE", gpl), (9, "a/LICENSE", gpl)] + [(100 + i, f"w/{i}", "other words here %d" % i) for i in range(50)]
    frame = spark.createDataFrame([(*f, "x") for f in files], "doc_id long, path string, text string, directory string")
    from pyspark.sql import functions as F

    got = {r["doc_id"]: (r["licences"], r["origin"], r["from_directory"]) for r in licenses.scan(licenses.named_files(frame, F.col("path"))).collect()}
    assert got[1] == (["GPL-3.0"], "own", "a") == got[9] and got[6] == (["GPL-3.0"], "own", None)
    assert got[2] == (["MIT"], "inherited", "a/b") and got[4] == (["Apache-2.0"], "own", "a/b/c") and got[8] == (["GPL-3.0"], "inherited", "a")
    assert got[5] == got[7] == got[100] == ([], "none", None)
    assert licenses.scan(licenses.named_files(empty, F.lit("a"))).count() == 0


def test_licences_weigh_every_word_by_its_frequency(spark, monkeypatch):
    import math
    from collections import Counter

    from pyspark.sql import functions as F

    lines = ["Code licensed under the MIT License with data files", "Qwertz licensed under the MIT License with zebra notes",
             "Some Licensed under the Apache License, Version 2.0. text"]
    lines += ["the code and some data files with text"] * 300 + [f"zebra{i} of the plain notes {i} and code" for i in range(700)]
    bags = [Counter(licenses.words(x)) for x in lines]
    df = Counter(w for b in bags for w in b)

    def vector(bag):
        v = {w: c * (math.log((1 + len(bags)) / (1 + df[w])) + 1) for w, c in bag.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    marks = [(name, vector(Counter(licenses.words(t)))) for name, t in licenses.TEMPLATES]
    want = []
    for v in map(vector, bags):
        score, name = max((sum(x * t.get(w, 0) for w, x in v.items()), name) for name, t in marks)
        want.append(([name], pytest.approx(score)) if score >= 0.6 else ([], 0))
    assert want[0][0] == ["MIT"] and want[2][0] == ["Apache-2.0"]
    frame = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    files = licenses.named_files(frame, F.lit("a.txt"))
    for frequent in (3, 20_000):
        monkeypatch.setattr(licenses, "FREQUENT", frequent)
        got = {r["doc_id"]: (r["own"], r["score"]) for r in licenses.own_licences(files).collect()}
        assert [got[i] for i in range(len(lines))] == want
