"""One-permutation MinHash fingerprints, with DataFrame functions only.

A text's words (runs of anything but ASCII white space, lower-cased) give
shingles of five words; a shorter text is one shingle.  Each shingle is hashed
once; the top bits of the hash name one of ``BINS`` bins and each bin keeps its
smallest hash.  Empty bins are filled by optimal densification (Shrivastava
2017): an empty bin i tries the bins (t - a_i) * s_i (mod BINS, a_i and odd s_i
hashed from i) for t = 0, 1, 2, ... and copies the first that is not empty, so
two texts fill it alike with the probability of their likeness.  Of each bin's
hash the lowest ``LOW`` bits are stored, packed into longs.  The share of equal
bins overestimates the likeness by chance matches of the low bits; likeness()
corrects for them (Li and Koenig 2010).

Everything is an expression inside a text's own row.  Null texts count as
empty; a text without words has no bin (an empty fingerprint), likeness 1 to
another such text and 0 to all others.  Equal texts have equal fingerprints."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
BINS_LOG2 = 8
BINS = 1 << BINS_LOG2
LOW = 8
SEED = 71
#: Attempts of an empty bin that are looked up one by one; the rest is found at once.
LOOKED_UP = 6
_PER_LONG = 64 // LOW
_MASK = (1 << LOW) - 1
_SPACE = " \t\n\x0b\x0c\r"
_SIGN = -(1 << 63)

#: Documents that one window of next_rows() is meant to hold, and knots of its id quantiles.
PER_BUCKET = 4096
KNOTS = 256
MOST_SLICES = 256


def _hashes(text: Column) -> Column:
    bare = F.btrim(F.lower(text), F.lit(_SPACE))
    words = F.when(F.length(bare) > 0, F.split(bare, rf"[{_SPACE}]+")).otherwise(F.array().cast("array<string>"))
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(h: Column) -> Column:
    """Shingle hashes, sign-flipped so that signed order is unsigned order, sorted."""
    joined = F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, SHINGLE))))
    whole = F.slice(joined, 1, F.greatest(F.size(h) - (SHINGLE - 1), F.least(F.size(h), F.lit(1))))
    return F.sort_array(F.transform(whole, lambda x: x.bitwiseXOR(F.lit(_SIGN))))


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x.bitwiseXOR(F.lit(_SIGN)), 64 - BINS_LOG2)


def _firsts(s: Column) -> Column:
    """For each bin with a hash: bin << LOW | lowest bits of its smallest hash."""
    kept = F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1))))
    return F.transform(kept, lambda x: F.shiftleft(_bin(x), LOW).bitwiseOR(x.bitwiseAND(F.lit(_MASK))))


def _attempts() -> tuple[list[list[int]], list[int], list[int]]:
    """For each bin i, from a hash of i: the bins of its first attempts, and the
    a and b for which bin j is attempt (j * b + a) mod BINS."""
    looked, shift, back = [[] for _ in range(LOOKED_UP)], [], []
    for i in range(BINS):
        h = int.from_bytes(hashlib.sha256(f"{SEED}:{i}".encode()).digest()[:8], "big")
        a, step = h % BINS, (h >> 32) % BINS | 1
        shift.append(a)
        back.append(pow(step, -1, BINS))
        for t in range(LOOKED_UP):
            looked[t].append((t - a) * step % BINS)
    return looked, shift, back


def _dense(firsts: Column) -> Column:
    """An entry for every bin, in order: bin << (LOW + 1) | low bits, with the
    bit 1 << LOW in an empty one."""
    taken = F.transform(firsts, lambda e: F.shiftrightunsigned(e, LOW))
    empty = F.array_except(F.sequence(F.lit(0).cast("long"), F.lit(BINS - 1).cast("long")), taken)
    marks = F.transform(empty, lambda i: F.shiftleft(i, LOW + 1).bitwiseOR(F.lit(1 << LOW)))
    there = F.transform(firsts, lambda e: e + F.shiftleft(F.shiftrightunsigned(e, LOW), LOW))
    return F.sort_array(F.concat(there, marks))


def _filled(firsts: Column, dense: Column) -> Column:
    """The low bits of every bin.  An empty one looks up its first attempts;
    where all of them are empty, the attempt of every bin that has a hash is
    computed and the least wins."""
    looked, shift, back = _attempts()

    def constant(values):
        return F.array(*map(F.lit, values))

    looked, shift, back = [constant(v) for v in looked], constant(shift), constant(back)
    empty = F.lit(1 << LOW)

    def entry(e):
        i = F.shiftrightunsigned(e, LOW + 1).cast("int")

        def attempt(f):
            t = (F.shiftrightunsigned(f, LOW) * F.get(back, i) + F.get(shift, i)).bitwiseAND(F.lit(BINS - 1))
            return F.shiftleft(t, LOW).bitwiseOR(f.bitwiseAND(F.lit(_MASK)))

        out = F.when(e.bitwiseAND(empty) == 0, e)
        for table in looked:
            found = F.get(dense, F.get(table, i))
            out = out.when(found.bitwiseAND(empty) == 0, found)
        return out.otherwise(F.array_min(F.transform(firsts, attempt)))

    return F.when(F.size(firsts) > 0, F.transform(dense, entry)).otherwise(F.array().cast("array<bigint>"))


def _packed(entries: Column) -> Column:
    def word(w):
        out = F.lit(0).cast("long")
        for k in range(_PER_LONG):
            out = F.shiftleft(out, LOW).bitwiseOR(F.get(entries, w * _PER_LONG + k).bitwiseAND(F.lit(_MASK)))
        return out

    return F.when(F.size(entries) > 0, F.transform(F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)), word)) \
        .otherwise(F.array().cast("array<bigint>"))


def with_fingerprint(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Add the packed fingerprint of a text column, an array of longs.  Each
    step is a projection of its own, so that none is evaluated twice."""
    rest = [c for c in rows.columns if c != out]
    step = rows.select(*rest, _hashes(F.col(text)).alias("_h"))
    step = step.select(*rest, _shingles(F.col("_h")).alias("_s"))
    step = step.select(*rest, _firsts(F.col("_s")).alias("_f"))
    step = step.select(*rest, "_f", _dense(F.col("_f")).alias("_d"))
    step = step.select(*rest, _filled(F.col("_f"), F.col("_d")).alias("_e"))
    return step.select(*rest, _packed(F.col("_e")).alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two fingerprints, 0 to 1."""
    def equal_bytes(x):  # the lowest bit of a byte gathers the byte's others
        for k in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, k))
        return F.lit(_PER_LONG) - F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))

    same = F.aggregate(F.zip_with(a, b, lambda x, y: equal_bytes(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda s, n: s + n)
    chance = 1.0 / (1 << LOW)
    share = (same / F.lit(float(BINS)) - chance) / (1 - chance)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0) \
        .otherwise(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)))


def digits(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def next_rows(rows: DataFrame, ids: DataFrame, key: str, tie: Column, carry: dict[str, str]) -> DataFrame:
    """Add for each (new column, column) of ``carry`` the column's value in the
    next row by descending key (nulls last, ties by ``tie``); the last row's
    next is the first.  ``ids`` is a frame with the key column that is cheap to
    read, for the key's quantiles.

    The keys are cut at quantiles and evenly between them into windows of about
    ``PER_BUCKET`` rows; the rows with the largest key of each window also stand
    at the end of the window before it, so every window is one task's and rows
    move once.  The table of largest keys has a row for each window, at most
    KNOTS * MOST_SLICES."""
    n = ids.count()
    knots = ids.agg(F.percentile_approx(key, [i / KNOTS for i in range(1, KNOTS)], 10 * KNOTS)).first()[0] or []
    lows = F.array(*[F.lit(k) for k in sorted(set(knots))]) if knots else F.array().cast("array<bigint>")
    slices = min(MOST_SLICES, -(-max(1, n) // (KNOTS * PER_BUCKET)))
    at = F.size(F.filter(lows, lambda k: k <= F.col(key)))
    lo, hi = F.get(lows, at - 1).cast("double"), F.get(lows, at).cast("double")
    inside = F.when(hi > lo, F.floor((F.col(key) - lo) / (hi - lo) * slices)).otherwise(0)
    bucket = F.when(F.col(key).isNull(), -1).otherwise(at * slices + F.least(F.greatest(inside, F.lit(0)), F.lit(slices - 1)))
    bucket = bucket.cast("long")
    heads = ids.groupBy(bucket.alias("b")).agg(F.max(key).alias("head")).orderBy(F.col("b").desc()).collect()
    if not heads:
        return rows.select("*", *(F.col(c).alias(k) for k, c in carry.items()))
    before = [heads[-1], *heads[:-1]]  # the window that comes before each one, from the largest keys down
    spark = rows.sparkSession
    table = spark.createDataFrame([(h["b"], h["head"], p["b"]) for h, p in zip(heads, before)],
                                  f"_b long, _head {rows.schema[key].dataType.simpleString()}, _to long")
    placed = rows.withColumn("_bucket", bucket).join(F.broadcast(table), F.col("_bucket") == F.col("_b"))
    copies = F.array(F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("extra")),
                     F.when(F.col(key).eqNullSafe(F.col("_head")), F.struct(F.col("_to").alias("b"), F.lit(1).alias("extra"))))
    placed = placed.select(*rows.columns, F.explode(F.filter(copies, lambda c: c.isNotNull())).alias("_c"))
    placed = placed.select(*rows.columns, F.col("_c.b").alias("_b"), F.col("_c.extra").alias("_extra"))
    w = Window.partitionBy("_b").orderBy("_extra", F.col(key).desc_nulls_last(), tie)
    out = placed.select("*", *(F.lead(c).over(w).alias(k) for k, c in carry.items()))
    return out.where("_extra = 0").drop("_b", "_extra")


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next):
    fingerprints of every text and of its edited text, whose last
    floor(n_chars / 2) characters are the first as many (or all) of the next
    document's, by descending doc_id."""
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_fingerprint(docs, "text", "fp")
    rows = next_rows(rows, documents.select("doc_id"), "doc_id", F.col("text"), {"_next": "text", "next_fp": "fp"})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("_next"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "fp", "next_fp", edited.alias("edited"))
    rows = with_fingerprint(rows, "edited", "edited_fp")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fp", "edited_fp",
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
