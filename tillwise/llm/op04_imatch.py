"""Document fingerprints (I-Match) with randomised lexicon subsets, in DataFrame functions only.

The lexicon holds the terms whose document frequency lies in a band of inverse document frequency
(``N / min_share`` to ``N / max_share`` documents hold the term).  A term in that band is held by at
least one document in ``max_idf`` of them, so the lexicon has at most ``max_idf`` times the mean
number of distinct terms per document, however many documents there are; its size is counted before
it is broadcast.  Each of the ``SUBSETS`` keeps a pseudorandom share of the lexicon, from a half to
1/512: dense subsets agree on near copies only, sparse ones also on texts that share a part.  The
fingerprint is, per subset, the hash of the document's distinct terms in it, sorted and joined; a
subset without a term of the document is empty (``-``).  A text without any lexicon term has the hash
of the whole text in front instead.  The likeness of two fingerprints is the share of equal parts
among those that are not empty in both.

The next document is found in id ranges: each range is sorted and looks one row ahead, and its last
row sees the first row of the range below, which is sent there as well.  Texts are shuffled once; the
terms of a document are gathered where its range already is.

Defined results: null text is empty; equal texts have equal fingerprints; null ids come last in
descending order, repeated ids are ordered by the hash of their text; a single document is its own
next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import broadcast_if_small, bucket_of, id_bounds, materialize, table
from tillwise.llm.op10_decontaminate import words_of

# Denominator of the share of the lexicon that each subset keeps.
SUBSETS = [2] * 4 + [8] * 4 + [32] * 8 + [128] * 8 + [512] * 8
MIN_IDF, MAX_IDF = 8, 1000  # the band: N / df between these
ROWS_PER_RANGE = 1_000
MAX_RANGES = 4096


def with_next(df: DataFrame, value: str, bounds: list[int]) -> DataFrame:
    """Add ``range``, ``place`` (in the range) and ``next``: ``value`` of the row with the next smaller
    (doc_id, tie); after the smallest comes the largest.  ``df`` has doc_id, tie and ``value``."""
    rows = df.withColumn("range", bucket_of(F.col("doc_id"), bounds))
    # The first row of each range (in descending order) also ends the next range above it; at most
    # one row per range, so this side is bounded by the number of ranges.
    tops = rows.groupBy("range").agg(F.max(F.struct("doc_id", "tie")).alias("top"))
    above = F.lead("range").over(Window.orderBy("range"))
    lowest = F.min("range").over(Window.partitionBy())
    ends = tops.select(F.coalesce(above, lowest).alias("to"), F.col("top.doc_id").alias("top_id"),
                       F.col("top.tie").alias("top_tie"))
    sent = (rows.join(F.broadcast(ends), rows["doc_id"].eqNullSafe(F.col("top_id")) & (rows["tie"] == F.col("top_tie")))
            .select(*[F.col("to").alias("range") if c == "range" else rows[c] for c in rows.columns],
                    F.lit(1).alias("end")).dropDuplicates(["range"]))
    order = Window.partitionBy("range").orderBy("end", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    return (rows.withColumn("end", F.lit(0)).unionByName(sent)
            .withColumn("next", F.lead(value).over(order)).withColumn("place", F.row_number().over(order))
            .where("end = 0").drop("end"))


def lexicon(docs: DataFrame, min_idf: int = MIN_IDF, max_idf: int = MAX_IDF) -> DataFrame:
    """(term, subsets) for the terms in the band; bit i of ``subsets`` is set if subset i keeps it."""
    total = docs.count()
    df = (docs.select(F.explode(F.array_distinct(words_of(F.col("text")))).alias("term"))
          .groupBy("term").agg(F.count("*").alias("df")))
    band = df.where((F.col("df") * min_idf <= total) & (F.col("df") * max_idf >= total))
    bits = F.lit(0).cast("long")
    for i, share in enumerate(SUBSETS):
        bits = bits + F.when(_draw(F.col("term"), i) % share == 0, F.lit(1 << i).cast("long")).otherwise(0)
    return band.select("term", bits.alias("subsets"))


def _draw(term: Column, subset: int) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{subset}:"), term)), 1, 8), 16, 10).cast("long")


# Subsets are looked up in layers: each holds the terms that some subset of it or a sparser one keeps.
LAYERS = [(0, 8), (8, 16), (16, len(SUBSETS))]


def _bits(low: int, high: int) -> Column:
    return F.lit((1 << high) - (1 << low)).cast("long")


def layered(df: DataFrame, terms: str) -> DataFrame:
    """Add the layers of the column ``terms`` as columns ``terms_1``, ``terms_2``."""
    for n, (low, _) in enumerate(LAYERS[1:], 1):
        above = terms if n == 1 else f"{terms}_{n - 1}"
        df = df.withColumn(f"{terms}_{n}", F.filter(above, lambda t: t["subsets"].bitwiseAND(_bits(low, len(SUBSETS))) != 0))
    return df


def fingerprint(terms: str, whole: Column) -> Column:
    """From the sorted lexicon terms (structs of term, subsets) of a text, with their layers, and the
    hash of all of it."""
    def joined(layer: str, i: int) -> Column:
        kept = F.filter(layer, lambda t: t["subsets"].bitwiseAND(F.lit(1 << i).cast("long")) != 0)
        return F.array_join(F.transform(kept, lambda t: t["term"]), " ")

    names = [terms] + [f"{terms}_{n}" for n in range(1, len(LAYERS))]
    subsets = F.array(*[joined(name, i) for name, (low, high) in zip(names, LAYERS) for i in range(low, high)])
    parts = F.array_join(F.transform(subsets, lambda x: F.when(x == "", "-").otherwise(F.substring(F.md5(x), 1, 8))), ".")
    alone = F.concat(F.substring(whole, 1, 8), F.lit(".-" * (len(SUBSETS) - 1)))
    return F.when(F.size(terms) == 0, alone).otherwise(parts)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts among those not empty in both, from 0 to 1."""
    pairs = F.arrays_zip(F.split(a, "\\.").alias("x"), F.split(b, "\\.").alias("y"))
    some = F.size(F.filter(pairs, lambda p: (p["x"] != "-") | (p["y"] != "-")))
    same = F.size(F.filter(pairs, lambda p: (p["x"] != "-") & (p["x"] == p["y"])))
    return F.when(some == 0, F.lit(1.0)).otherwise(same / some)


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the first as many of the following text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprint_documents(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each
    row of ``docs`` (doc_id, text); ``terms`` is a materialised :func:`lexicon`."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("tie", F.xxhash64("text"))
    ranges = int(min(MAX_RANGES, max(1, -(-docs.count() // ROWS_PER_RANGE))))
    bounds = id_bounds(docs, "doc_id", ranges)
    rows = with_next(docs, "text", bounds).withColumn("edit", edited(F.col("text"), F.col("next")))
    about = F.struct("doc_id", "tie", F.char_length("text").cast("long").alias("n_chars"),
                     F.md5("text").alias("whole"), F.md5("edit").alias("edit_whole"),
                     F.sha2("edit", 256).alias("edited_sha256"))
    # One row for the document itself, then one per distinct term of either text.
    kind = "struct<of:int,term:string,about:struct<doc_id:bigint,tie:bigint,n_chars:bigint,whole:string,edit_whole:string,edited_sha256:string>>"
    each = lambda text, n: F.transform(F.array_distinct(words_of(F.col(text))), lambda t: F.struct(
        F.lit(n).alias("of"), t.alias("term"), F.lit(None).alias("about")).cast(kind))
    own = F.array(F.struct(F.lit(0).alias("of"), F.lit(None).alias("term"), about.alias("about")).cast(kind))
    met = (rows.select("range", "place", F.explode(F.concat(own, each("text", 0), each("edit", 1))).alias("x"))
           .select("range", "place", "x.of", "x.term", "x.about")
           .join(broadcast_if_small(terms), "term", "left").where("about IS NOT NULL OR subsets IS NOT NULL"))
    found = (met.groupBy("range", "place").agg(F.max("about").alias("a"), F.array_sort(F.collect_list(
        F.when(F.col("subsets").isNotNull(), F.struct("term", "subsets", "of")))).alias("terms")))
    of = lambda n: F.filter("terms", lambda t: t["of"] == n)
    found = layered(layered(found.select("a", of(0).alias("t0"), of(1).alias("t1")), "t0"), "t1")
    done = found.select("a.doc_id", "a.tie", "a.n_chars", "a.edited_sha256",
                        fingerprint("t0", F.col("a.whole")).alias("fingerprint"),
                        fingerprint("t1", F.col("a.edit_whole")).alias("edited_fingerprint"))
    done = materialize(done, "imatch")
    return with_next(done, "fingerprint", bounds).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"))


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprint_documents(docs, materialize(lexicon(docs), "imatch-lexicon"))


def _sql() -> str:
    shares = ", ".join(f"({i}, {s})" for i, s in enumerate(SUBSETS))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS nxt FROM d),
e AS (SELECT doc_id, text, left(text, CAST(length(text) - length(text) // 2 AS BIGINT)) || left(nxt, CAST(length(text) // 2 AS BIGINT)) AS edit FROM n),
t AS (SELECT doc_id, 0 AS side, text AS body FROM e UNION ALL SELECT doc_id, 1, edit FROM e),
w AS (SELECT DISTINCT doc_id, side, unnest(list_filter(string_split_regex(translate(body,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term FROM t),
l AS (SELECT term FROM w WHERE side = 0 GROUP BY term
      HAVING count(*) * {MIN_IDF} <= (SELECT count(*) FROM d) AND count(*) * {MAX_IDF} >= (SELECT count(*) FROM d)),
s(i, share) AS (VALUES {shares}),
m AS (SELECT i, term FROM l, s WHERE CAST('0x' || substr(md5(i || ':' || term), 1, 8) AS BIGINT) % share = 0),
p AS (SELECT doc_id, side, i, substr(md5(string_agg(term, ' ' ORDER BY term)), 1, 8) AS part
      FROM w JOIN m USING (term) GROUP BY ALL),
has AS (SELECT DISTINCT doc_id, side FROM w JOIN l USING (term)),
f AS (SELECT t.doc_id, t.side, CASE WHEN any_value(has.doc_id) IS NULL
          THEN substr(md5(any_value(body)), 1, 8) || repeat('.-', {len(SUBSETS) - 1})
          ELSE string_agg(coalesce(part, '-'), '.' ORDER BY s.i) END AS fp
      FROM t CROSS JOIN s LEFT JOIN p ON p.doc_id = t.doc_id AND p.side = t.side AND p.i = s.i
      LEFT JOIN has ON has.doc_id = t.doc_id AND has.side = t.side GROUP BY t.doc_id, t.side),
g AS (SELECT e.doc_id, length(text) AS n_chars, sha256(edit) AS edited_sha256, a.fp AS fingerprint, b.fp AS edited_fingerprint,
      coalesce(lead(a.fp) OVER (ORDER BY e.doc_id DESC), first_value(a.fp) OVER (ORDER BY e.doc_id DESC)) AS nfp
      FROM e JOIN f a ON a.doc_id = e.doc_id AND a.side = 0 JOIN f b ON b.doc_id = e.doc_id AND b.side = 1),
z AS (SELECT *, list_zip(string_split(fingerprint, '.'), string_split(edited_fingerprint, '.')) AS u,
      list_zip(string_split(fingerprint, '.'), string_split(nfp, '.')) AS v FROM g)
SELECT doc_id, CAST(n_chars AS BIGINT) AS n_chars, edited_sha256, fingerprint, edited_fingerprint,
  coalesce(len(list_filter(u, lambda x: x[1] <> '-' AND x[1] = x[2])) / nullif(len(list_filter(u, lambda x: x[1] <> '-' OR x[2] <> '-')), 0), 1.0) AS near_edited,
  coalesce(len(list_filter(v, lambda x: x[1] <> '-' AND x[1] = x[2])) / nullif(len(list_filter(v, lambda x: x[1] <> '-' OR x[2] <> '-')), 0), 1.0) AS near_next
FROM z
"""


SQL = _sql()
