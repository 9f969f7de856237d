"""Operator 10: benchmark decontamination, DataFrame functions only.

Test items and documents are cut into normalised words.  The distinct windows
of the items (``WIDTH`` consecutive words; a shorter item is one window)
make a hash set.  Each document hashes its own windows in place; those whose hash
may be in the set leave the row as (position, window) and are verified word
by word in a join with the items' windows.  Up to ``BROADCAST_WINDOWS``
windows (counted first) the set is broadcast, as a bit table that screens
hashes and as the join's build side; beyond that every window of a document
goes to a shuffled join with the same verification.

Cases: null text has no words; a document shorter than a window can only hold
short items; words inside several occurrences count once; repeated items and
items with equal text count by distinct item_id; an item with null item_id
still marks words but isn't counted; repeated documents are judged one by one;
empty tables give no hits or no rows; further columns are ignored by
``find`` and kept by ``remove``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .written import written

WIDTH = 10
#: windows of test items up to which their hash set is broadcast (about 100 bytes each)
BROADCAST_WINDOWS = 1_000_000
#: bits of the screening table for each window, and its least and largest size
BITS_PER_WINDOW, MIN_BITS, MAX_BITS = 64, 1 << 16, 1 << 24
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: the same in a text that isn't lower-cased
RAW_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RAW_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z only; ``lower`` does just that where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def windows_of(items: DataFrame, width: int) -> DataFrame:
    """Distinct (item_id, win, len, h) of rows (item_id, text)."""
    w = items.select("item_id", words(F.col("text")).alias("w")).withColumn("n", F.size("w")).filter("n > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("n") - width + 1))
    return (w.withColumn("i", F.explode(starts)).select("item_id", F.slice("w", F.col("i"), F.lit(width)).alias("win")).distinct()
            .select("item_id", "win", F.size("win").alias("len"), F.xxhash64("win").alias("h")))


def find(docs: DataFrame, items: DataFrame, width: int = WIDTH, broadcast_windows: int = BROADCAST_WINDOWS,
         keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, hit (sorted distinct word positions from 1, inside an
    occurring window) and items (sorted distinct item_ids) for every row of
    ``docs``; ``keep`` names further columns to carry."""
    wins = windows_of(items, width)
    size = wins.agg(F.count("*").alias("n"), F.collect_set("len").alias("lens")).first()  # at most ``width`` lengths
    small = size.n <= broadcast_windows
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (size.n * BITS_PER_WINDOW).bit_length()))

    def spot(w: str, i: Column, n: Column) -> Column:
        """Place in the bit table of the window of n words from position i."""
        return F.pmod(F.xxhash64(n, F.get(w, i - 1), F.get(w, i - 1 + F.floor((n - 1) / 2).cast("int")), F.get(w, i + n - 2)), F.lit(bits))

    def one_bit(b: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(b, F.lit(64)).cast("int"))
    if small:
        # the bit table, 64 bits a word, is evaluated once as a scalar subquery
        b = spot("win", F.lit(1), F.col("len"))
        on = (wins.select(F.shiftright(b, 6).alias("k"), one_bit(b).alias("m"))
              .groupBy("k").agg(F.bit_or("m").alias("m")))
        table = (docs.sparkSession.range(bits // 64).select(F.col("id").alias("k")).join(F.broadcast(on), "k", "left")
                 .agg(F.array_sort(F.collect_list(F.struct("k", F.coalesce("m", F.lit(0)).alias("m")))).alias("t"))
                 .select(F.col("t.m").alias("t"))).scalar()

    def spots(n: int) -> Column:
        """Positions at which a window of n words may match, with the window."""
        def cut(i):
            return F.slice("w", i, F.lit(n))

        def screened(i):
            # exists() over one value names the place, so that it is hashed once
            return F.exists(F.array(spot("w", i, F.lit(n))), lambda b: F.getbit(F.get("t", F.shiftright(b, 6).cast("int")), F.pmod(b, F.lit(64)).cast("int")) == 1)
        every = F.sequence(F.lit(1), F.col("n_words") - (n - 1))
        maybe = F.filter(every, screened) if small else every
        found = F.transform(maybe, lambda i: F.struct(i.alias("pos"), F.lit(n).alias("len"), cut(i).alias("win")))
        none = F.filter(F.transform(F.array(F.lit(1)), lambda i: F.struct(i.alias("pos"), F.lit(n).alias("len"), cut(i).alias("win"))), lambda _: F.lit(False))
        return F.when(F.col("n_words") >= n, found).otherwise(none)
    rows = (docs.select("doc_id", "text", *keep)
            .select(F.monotonically_increasing_id().alias("row"), "doc_id", *keep, words(F.col("text")).alias("w"))
            .withColumn("n_words", F.size("w")))
    if small:
        rows = rows.withColumn("t", table)
    lens = sorted(size.lens)
    if not lens:
        return rows.select("doc_id", *keep, "n_words", F.array().cast("array<int>").alias("hit"), F.array().cast(f"array<{items.schema['item_id'].dataType.simpleString()}>").alias("items"))
    cand = (rows.select("row", "doc_id", *keep, "n_words", F.explode_outer(F.concat(*(spots(n) for n in lens))).alias("c"))
            .select("row", "doc_id", *keep, "n_words", "c.pos", "c.len", "c.win")
            .withColumn("h", F.xxhash64("win")))
    side = wins.select("item_id", F.col("win").alias("item_win"), F.col("len").alias("item_len"), "h", F.lit(True).alias("same"))
    met = cand.join(F.broadcast(side) if small else side, (cand.h == side.h) & (cand.len == side.item_len) & (cand.win == side.item_win), "left")
    span = F.when(F.col("same"), F.struct("pos", "len"))
    return (met.groupBy("row", "doc_id", *keep, "n_words")
            .agg(F.collect_set(span).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items"))
            .select("doc_id", *keep, "n_words",
                    F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["len"] - 1))))).alias("hit"),
                    "items"))


def report(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: how many of its words are hit, by which items."""
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return find(docs, items, width).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size("hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"))


def remove(docs: DataFrame, items: DataFrame, width: int = WIDTH, spans: bool = False) -> DataFrame:
    """``docs`` without its contaminated rows; with ``spans`` all rows, their
    hit words (and the separators after them) cut from the text.  Columns stay.

    What is hit depends on the text alone, so the hits are found for keys of 128
    bits of hash of the text and joined back; texts are shuffled only if the
    contaminated keys are too many to be broadcast."""
    keys = [F.xxhash64(F.coalesce("text", F.lit(""))).alias("__h"), F.xxhash64(F.lit("text"), F.coalesce("text", F.lit(""))).alias("__g")]
    found = find(docs.select("doc_id", "text", *keys), items, width, keep=("__h", "__g")).filter(F.size("hit") > 0)
    hits = written(found.groupBy("__h", "__g").agg(F.first("hit").alias("__hit")), "contaminated")
    keyed = docs.select("*", *keys)
    if not spans:
        return keyed.join(hits, ["__h", "__g"], "left_anti").select(*docs.columns)
    raw = F.array_remove(F.split("text", RAW_SEPARATORS), "")
    gaps = F.split("text", RAW_WORDS)  # one more than the words: before, between, after
    kept = F.transform(raw, lambda w, i: F.when(F.array_contains("__hit", i + 1), F.lit("")).otherwise(F.concat(w, F.get(gaps, i + 1))))
    cut = F.when(F.col("__hit").isNotNull(), F.concat(F.get(gaps, F.lit(0)), F.array_join(kept, ""))).otherwise(F.col("text"))
    return keyed.join(hits, ["__h", "__g"], "left").select(*((cut if c == "text" else F.col(c)).alias(c) for c in docs.columns))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
     FROM documents),
b AS (SELECT item_id,
       regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
     FROM benchmark),
bw AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(win) AS k FROM bw),
dw AS (SELECT r, i, k, list_slice(w, i, i + k - 1) AS win
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lens)),
m AS (SELECT r, i, k, item_id FROM dw JOIN bw USING (win)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM m) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
