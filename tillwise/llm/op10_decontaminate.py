"""Benchmark decontamination: prefix-filtered containment join of documents with benchmark windows.

A window is ``window`` consecutive words of a benchmark item, or the whole of a shorter item.  As a
set of word shingles a window lies in a document only if *all* its shingles do, so the prefix that a
containment join has to probe is one shingle: the rarest, by its number of occurrences over all
documents.  A document position holding that shingle fixes where the window must start (positional
bound) and the start must leave room for the whole window (length bound); what passes is verified
word by word against the document, so hash collisions cannot add a hit.

Only DataFrame functions run.  Documents are read twice: once to meet the benchmark's shingles, once
to be verified and reported.  What meets is small next to the text; no pair of documents is formed.

Defined results: a null or empty text has no words (n_words 0, no hits, not contaminated); null or
repeated ids keep their rows; an item without words has no window; repeated items are all counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.common import broadcast_if_small, lower_ascii, materialize, table

NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NON_WORD), lambda w: w != "")


def _shingles(words: Column, k: int) -> Column:
    """Hash of every run of k words, in order; empty if there are fewer words."""
    first = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k))
    parts = lambda i: [F.get(words, i + j) for j in range(k)]
    return F.coalesce(F.transform(first, lambda i: F.xxhash64(F.lit(k), *parts(i))),
                      F.array().cast("array<long>"))


def _windows(bench: DataFrame, window: int) -> DataFrame:
    """(wid, words, item_id) for each window of each item."""
    items = bench.select("item_id", words_of(F.col("text")).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    cut = items.select("item_id", F.explode(F.transform(
        starts, lambda s: F.slice(F.col("all"), s, window))).alias("words"))
    return cut.select(F.sha2(F.array_join("words", " "), 256).alias("wid"), "words", "item_id").distinct()


def find_contamination(docs: DataFrame, bench: DataFrame, window: int = 13, shingle: int = 3) -> DataFrame:
    """Every row of ``docs`` with its hits against ``bench``.

    Returns (row: struct of all columns of docs, n_words, n_hit, items: array of item ids as
    strings, sorted).  ``docs`` needs a text column; all others are carried inside ``row``, so their
    names cannot clash.
    """
    windows = materialize(_windows(bench, window), "decon-windows")
    texts = materialize(windows.groupBy("wid").agg(F.first("words").alias("words")), "decon-texts")
    sizes = [r[0] for r in texts.select(F.least(F.size("words"), F.lit(shingle)).alias("k")).distinct().collect()]

    # The benchmark's shingles: per window, each shingle hash with its offset.
    by_size = [texts.where(F.least(F.size("words"), F.lit(shingle)) == k).select(
        "wid", F.posexplode(_shingles(F.col("words"), k)).alias("at", "h")) for k in sorted(sizes)]
    base = docs.select(F.struct("*").alias("row"), F.col("text").alias("t"))
    keyed = base.withColumn("k", F.xxhash64("row"))
    if not by_size:
        return keyed.select("row", F.size(words_of(F.col("t"))).cast("long").alias("n_words"),
                            F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    grams = by_size[0]
    for more in by_size[1:]:
        grams = grams.union(more)
    grams = materialize(grams, "decon-grams")
    known = materialize(grams.select("h").distinct(), "decon-known")

    # Pass 1: where documents hold any of these shingles.
    split = keyed.select("k", words_of(F.col("t")).alias("w"))
    arrays = [_shingles(F.col("w"), k) for k in sorted(sizes)]
    found = None
    for hashes in arrays:
        one = split.select("k", F.posexplode(hashes).alias("pos", "h"))
        found = one if found is None else found.union(one)
    met = materialize(found.join(broadcast_if_small(known), "h"), "decon-met")

    # Rarity over all documents (0 if unseen), then the one necessary prefix shingle of each window.
    counts = met.groupBy("h").agg(F.count("*").alias("n"))
    rarest = (grams.join(counts, "h", "left").groupBy("wid")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "h")).alias("r"))
              .select("wid", "r.at", "r.h").where("r.n > 0"))
    probe = materialize(rarest.join(texts, "wid"), "decon-probe")
    starts = (met.join(broadcast_if_small(probe, 200_000), "h").where("pos >= at")
              .select("k", F.struct((F.col("pos") - F.col("at")).alias("start"), "wid", "words").alias("c")))
    per_doc = starts.groupBy("k").agg(F.collect_set("c").alias("cands"))

    # Pass 2: verify on the document's own words; length bound first.
    w = F.col("w")
    real = F.filter("cands", lambda c: (c["start"] + F.size(c["words"]) <= F.size(w))
                    & (F.slice(w, c["start"] + 1, F.size(c["words"])) == c["words"]))
    spans = F.array_sort(F.transform(real, lambda c: F.struct(
        c["start"].alias("s"), (c["start"] + F.size(c["words"])).alias("e"))))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(F.col("spans"), zero, lambda acc, x: F.struct(
        (acc["n"] + F.greatest(x["e"] - F.greatest(x["s"], acc["end"]), F.lit(0))).alias("n"),
        F.greatest(acc["end"], x["e"]).alias("end")), lambda acc: acc["n"])
    checked = (keyed.join(per_doc, "k", "left")
               .select("k", "row", "cands", words_of(F.col("t")).alias("w"))
               .select("k", "row", F.size("w").cast("long").alias("n_words"),
                       F.when(F.col("cands").isNotNull(), spans).alias("spans"),
                       F.when(F.col("cands").isNotNull(),
                              F.array_distinct(F.transform(real, lambda c: c["wid"]))).alias("wids"))
               .select("k", "row", "n_words", "wids",
                       F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit")))
    checked = materialize(checked, "decon-checked")

    names = (checked.where("n_hit > 0").select("k", F.explode("wids").alias("wid")).distinct()
             .join(windows.select("wid", F.col("item_id").cast("string").alias("item")), "wid")
             .groupBy("k").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return (checked.join(names, "k", "left")
            .select("row", "n_words", "n_hit",
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bench = table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = find_contamination(docs, bench)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
      lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
      lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, len(win) AS n, array_to_string(win, ' ') AS win FROM (
      SELECT item_id, unnest([w[s:s+12] for s in range(1, greatest(len(w) - 12, 1) + 1)]) AS win
      FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, s, array_to_string(w[s:s+n-1], ' ') AS win FROM (
      SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens)),
hits AS (SELECT doc_id, s, dw.n AS n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
      SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
      SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
