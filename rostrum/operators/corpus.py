"""Corpus-level row operators: consolidation (D1), scans (A1-A4), null text
handling (B1, B2), dictionary stemming by join (C3), party
standardisation (B9, B10, D20)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CONSOLIDATION_KEYS = [
    "member_name", "parliamentary_period", "parliamentary_session", "parliamentary_sitting",
    "sitting_date", "political_party",
]


def merge_speeches(speeches: DataFrame, keys: Iterable[str] = CONSOLIDATION_KEYS, order_col: str = "id",
                   text_col: str = "speech") -> DataFrame:
    """One row per member and sitting, its turns' texts joined by a space
    in ``order_col`` order; the new id is the smallest turn id.  A group is
    one member's turns in one sitting, so its size is bounded by the sitting
    transcript; partial aggregation runs map-side."""
    keys = list(keys)
    agg = speeches.groupBy(*keys).agg(
        F.min(order_col).alias("id"),
        F.count("*").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct(order_col, text_col))).alias("_parts"),
    )
    return agg.select(
        "id", *keys, "n_turns", F.array_join(F.transform("_parts", lambda p: p[text_col]), " ").alias("merged_speech")
    )


def scan_speeches(speeches: DataFrame) -> DataFrame:
    """A1: the pruned columns of the sentiment path (Parquet reads only these)."""
    return speeches.select("id", "sitting_date", "political_party", "merged_speech")


def with_position(df: DataFrame, *order) -> DataFrame:
    """Add ``pos``, the row's number (from 1) in the order, without a one-task
    window: rows are range-partitioned and sorted, the layout is written once
    (``checkpoint``), and a row's number is its place in its partition plus the
    rows of the partitions before (a table with a row for each partition)."""
    place = F.monotonically_increasing_id()  # partition number << 33 | place in it
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place).checkpoint()
    part = F.shiftright("_place", 33)
    sizes = laid.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    out = laid.join(offsets, part == F.col("_part"))
    inside = F.col("_place") - F.shiftleft("_part", 33)
    return out.select(*df.columns, (F.col("_before") + inside + 1).alias("pos"))


def member_documents(speeches: DataFrame, order: Iterable[str] = ("sitting_date", "id"), member_col: str = "member_name",
                     text_col: str = "merged_speech", sep: str = " ", piece: int = 2_000_000,
                     threshold: int = 4_000_000) -> DataFrame:
    """D2 + B8: (member, piece_no, text): every member's speeches as one text,
    joined by ``sep`` in the order of the columns ``order`` (nulls first; rows
    that tie in all of them in any order), cut into ``piece``-sized parts where it
    is longer than ``threshold`` characters.  Null texts and null members
    are left out; an empty text still takes a separator.

    No group holds a member's text: rows are range-partitioned by (member,
    order) and that layout is written once; a row's place in its member's text
    is the sum of the lengths before it in its partition plus those of the
    partitions before (a table with a row for each partition and member in
    it).  A speech is cut where pieces begin, and a group is one piece: at most
    ``threshold`` characters."""
    order = list(order)
    src = speeches.dropna(subset=[member_col, text_col]).select(
        F.col(member_col).alias("_member"), F.struct(*order).alias("_order"), F.col(text_col).alias("_text"))
    src = src.withColumn("_len", F.length("_text") + len(sep))  # a text with the separator before it
    laid = src.repartitionByRange("_member", "_order").withColumn("_part", F.spark_partition_id()).checkpoint()
    sizes = laid.groupBy("_part", "_member").agg(F.sum("_len").alias("_size"))
    whole = Window.partitionBy("_member")
    before = F.sum("_size").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col("_part").alias("_p"), F.col("_member").alias("_m"), F.coalesce(before, F.lit(0)).alias("_before"),
                         (F.sum("_size").over(whole) - len(sep)).alias("_total"))
    inside = Window.partitionBy("_part", "_member").orderBy("_order", F.length("_text")).rowsBetween(Window.unboundedPreceding, -1)
    rows = laid.withColumn("_inside", F.coalesce(F.sum("_len").over(inside), F.lit(0)))
    rows = rows.join(sizes, (F.col("_part") == F.col("_p")) & (F.col("_member") == F.col("_m")))
    at = F.col("_before") + F.col("_inside")  # of the separator, if the member's text had one at its start too
    size = F.when(F.col("_total") > threshold, piece).otherwise(threshold)
    rows = rows.select(
        F.col("_member").alias("member"), size.cast("long").alias("_piece"), F.greatest(at - len(sep), F.lit(0)).alias("_start"),
        F.when(at > 0, F.concat(F.lit(sep), "_text")).otherwise(F.col("_text")).alias("_text"))
    first, last = F.expr("_start div _piece"), F.expr("greatest(_start, _start + length(_text) - 1) div _piece")
    cut = rows.select("*", F.explode(F.sequence(first, last)).alias("piece_no"))
    begin = F.greatest(F.col("piece_no") * F.col("_piece"), F.col("_start"))
    end = F.least((F.col("piece_no") + 1) * F.col("_piece"), F.col("_start") + F.length("_text"))
    part = F.substring(F.col("_text"), (begin - F.col("_start") + 1).cast("int"), (end - begin).cast("int"))
    cut = cut.select("member", F.col("piece_no").cast("int").alias("piece_no"), begin.alias("_begin"), part.alias("_part"))
    pieces = cut.groupBy("member", "piece_no").agg(
        F.sort_array(F.collect_list(F.when(F.length("_part") > 0, F.struct("_begin", "_part")))).alias("_parts"))
    return pieces.select("member", "piece_no", F.array_join(F.col("_parts._part"), "").alias("text"))


def scan_by_date(speeches: DataFrame) -> DataFrame:
    """A2: (id, sitting_date, text, pos) with the row's number in sitting-date
    order (id breaks ties)."""
    return with_position(speeches.select("id", "sitting_date", "merged_speech"), "sitting_date", "id")


def count_rows(df: DataFrame) -> DataFrame:
    """A3: row count as a one-row DataFrame."""
    return df.agg(F.count("*").alias("n"))


def fetch_by_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """A4: rows whose id is in ``ids`` — a semi join without hint, so the planner
    goes by the real size of the id side."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def drop_null_text(df: DataFrame, text_col: str = "merged_speech") -> DataFrame:
    """B1."""
    return df.dropna(subset=[text_col])


def null_text_to_empty(df: DataFrame, text_col: str = "merged_speech") -> DataFrame:
    """B2."""
    return df.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))


def stem_rows(rows: DataFrame, stems: DataFrame, token_col: str = "token") -> DataFrame:
    """C3 for large stem dictionaries: exploded token rows joined with a
    (token, stem) table on the lower-cased token; unknown tokens keep their
    lower-cased form; empty stems are dropped."""
    low = rows.withColumn("_low", F.lower(token_col))
    st = stems.select(F.col("token").alias("_low"), "stem")
    out = low.join(st, "_low", "left").withColumn("stem", F.coalesce("stem", "_low")).drop("_low")
    return out.filter(F.length("stem") > 0)


def stem_arrays(df: DataFrame, stems: DataFrame, key: Iterable[str] = ("id",), tokens_col: str = "tokens",
                suffix_rule: str | None = None) -> DataFrame:
    """C3 over token arrays with a (token, stem) table of any size: every token
    lower-cased and replaced by its stem, in order; tokens the table lacks take
    the suffix rule or stay; empty stems go.  ``key`` identifies a row, all
    other columns are kept; a null array counts as empty; of several stems of
    a token the smallest is used.

    Tokens travel with their place; the join carries no hint (the planner
    broadcasts a small table, AQE splits frequent tokens otherwise), and the
    rows come together again by key, the partitioning that per-document
    weights need anyway: a group is one row's tokens."""
    key = list(key)
    rest = [c for c in df.columns if c not in (*key, tokens_col)]
    flat = df.select(*key, *rest, F.posexplode_outer(tokens_col).alias("_at", "_token"))
    flat = flat.select(*key, *rest, "_at", F.lower("_token").alias("_low"))
    st = stems.groupBy(F.col("token").alias("_low")).agg(F.min("stem").alias("_stem"))
    other = F.regexp_replace("_low", F.lit(suffix_rule), F.lit("")) if suffix_rule else F.col("_low")
    hit = flat.join(st, "_low", "left").withColumn("_stem", F.coalesce("_stem", other))
    used = F.when(F.length("_stem") > 0, F.struct("_at", "_stem"))  # nulls are not collected
    back = hit.groupBy(*key).agg(*[F.first(c).alias(c) for c in rest],
                                 F.sort_array(F.collect_list(used)).alias("_placed"))
    return back.withColumn(tokens_col, F.col("_placed._stem")).select(*df.columns)


def standardize_party(df: DataFrame, mapping: Mapping[str, str] | DataFrame, party_col: str = "political_party",
                      out_col: str = "standard_party", default: str = "Other") -> DataFrame:
    """Canonical party by exact match of the lower-cased name; unknown or
    null -> ``default``.  A dict becomes a literal map (small), a DataFrame
    (raw, canonical) is joined without hint."""
    low = F.lower(F.col(party_col))
    if isinstance(mapping, DataFrame):
        m = mapping.select(F.col("raw").alias("_raw"), F.col("canonical").alias("_canon"))
        j = df.withColumn("_raw", low).join(m, "_raw", "left")
        return j.withColumn(out_col, F.coalesce("_canon", F.lit(default))).drop("_raw", "_canon")
    lit_map = F.create_map(*[F.lit(x) for kv in sorted(mapping.items()) for x in kv])
    return df.withColumn(out_col, F.coalesce(F.try_element_at(lit_map, low), F.lit(default)))


def selected_parties(df: DataFrame, parties: Iterable[str], col: str = "standard_party") -> DataFrame:
    """B10."""
    return df.filter(F.col(col).isin(list(parties)))


def party_distribution(df: DataFrame, col: str = "standard_party") -> DataFrame:
    """Value counts, most frequent first."""
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(col))


def distinct_parties(df: DataFrame, col: str = "standard_party") -> DataFrame:
    """The distinct non-null values."""
    return df.select(col).dropna().distinct()
