"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short, documents may be very long, so a MinHash sketch of a whole document says nothing about
containment. The index is therefore asymmetric: each item is represented by its bottom-k MinHash sketch (the shingles that
give its k smallest hash values), and the search looks for those values among the hashes of all windows of a
document. Items are partitioned by size, in powers of two; a partition's largest size u sets its k: at containment t
at most u - ceil(t*u) shingles of an item can be missing, so with one value more at least one is found in every
document that contains the item. The recall of the search is therefore 1 by construction, which sketches of document
windows would not reach. Pairs found so are verified by exact containment on the shingles' own words.

Plan: two narrow passes over the documents. The first explodes the distinct hashes of each document's windows, looks them
up in the probe table and leaves distinct (document, item) pairs of ids, so a shingle that a document or the whole
corpus repeats costs one probe a document. The second takes those pairs to the texts and compares words, once a pair.
The query and ``drop_contaminated`` shuffle ids only, as long as the index has no more than ``max_probes`` probes, its
texts no more than ``max_item_bytes``, and there are no more than ``max_pairs`` pairs, which are all counted first;
beyond a bound that one join is a shuffle.

Words are lower-case runs of letters and digits, shingles are ``n`` = 5 of them. An item of fewer words has one
shingle, all its words, looked up among the documents' windows of that length. Defined results: null and empty texts
contain nothing; items without words match nothing; repeated rows give one pair, with the largest containment; null ids are
never in a pair of ``contained_items``; ``drop_contaminated`` decides by the text, so rows with null or repeated ids
go exactly if their own text contains an item; empty tables give none; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut, held, normal_words, text_of, window_texts, with_window_hashes

MAX_SIZE_CLASS = 40


def item_index(items: DataFrame, n: int, threshold: float) -> DataFrame:
    """items(item_id, text) -> item_id, width (words a shingle), grams (distinct shingles), size_class, probes (hashes)."""
    rows = items.filter(F.col("item_id").isNotNull()).select("item_id", held(normal_words(text_of())).alias("words"))
    rows = rows.filter(F.size("words") > 0).withColumn("width", F.least(F.size("words"), F.lit(n)))
    whole = F.array(F.array_join("words", " "))
    rows = rows.withColumn("grams", held(F.when(F.col("width") < n, whole).otherwise(F.array_distinct(window_texts(F.col("words"), n)))))
    hashes = F.array().cast("array<bigint>")
    for width in range(1, n + 1):
        rows = with_window_hashes(rows, "words", width, f"hashes{width}")
        hashes = F.when(F.col("width") == width, F.col(f"hashes{width}")).otherwise(hashes)
    rows = rows.withColumn("hashes", F.array_sort(F.array_distinct(hashes)))
    rows = rows.withColumn("size_class", F.ceil(F.log2(F.size("grams"))).cast("int"))
    # the largest size u of the class needs u - ceil(t*u) + 1 probes
    need = [max(1, (1 << c) - math.ceil(threshold * (1 << c) - 1e-9) + 1) for c in range(MAX_SIZE_CLASS)]
    k = F.get(F.array(*[F.lit(x) for x in need]), F.col("size_class"))
    probes = F.slice("hashes", F.lit(1), F.least(k, F.size("hashes")).cast("int"))
    return rows.select("item_id", "width", "grams", "size_class", probes.alias("probes"))


def contained_items(
    docs: DataFrame, items: DataFrame, n: int = 5, threshold: float = 0.8, max_probes: int = 1_000_000, max_item_bytes: int = 64_000_000, max_pairs: int = 2_000_000
) -> DataFrame:
    """docs(doc_id, text), items(item_id, text) -> doc_id, item_id, n_shared, n_item, containment."""
    index = Cut(item_index(items, n, threshold)).df
    size = index.agg(F.sum(F.size("probes").cast("long")).alias("p"), F.sum(F.octet_length(F.array_join("grams", "")).cast("long")).alias("b")).first()
    widths = [r["width"] for r in index.select("width").distinct().collect()] or [n]  # n of them at most
    probes = index.select("item_id", F.explode("probes").alias("h"))
    grams = index.select("item_id", "grams", "width")
    if (size["p"] or 0) <= max_probes:
        probes = F.broadcast(probes)
    if (size["b"] or 0) <= max_item_bytes:
        grams = F.broadcast(grams)
    named = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", text_of().alias("text"))
    words = held(normal_words(F.col("text"))).alias("words")
    hashed = named.select("doc_id", words)
    for width in widths:
        hashed = with_window_hashes(hashed, "words", width, f"hashes{width}")
    hashes = held(F.array_distinct(F.concat(*[F.col(f"hashes{width}") for width in widths])))
    pairs = Cut(hashed.select("doc_id", F.explode(hashes).alias("h")).join(probes, "h").select("doc_id", "item_id").distinct()).df
    if pairs.count() <= max_pairs:
        pairs = F.broadcast(pairs)
    hits = named.join(pairs, "doc_id").select("doc_id", "item_id", words).join(grams, "item_id")
    own = F.array().cast("array<string>")
    for width in widths:
        own = F.when(F.col("width") == width, window_texts(F.col("words"), width)).otherwise(own)
    shared = hits.withColumn("own", own).withColumn("shared", held(F.size(F.array_intersect("grams", "own")).cast("long"))).withColumn("n_item", F.size("grams").cast("long"))
    return (
        shared.filter(F.col("shared") >= F.ceil(F.col("n_item") * threshold - F.lit(1e-9)))
        .groupBy("doc_id", "item_id")
        .agg(F.max("shared").alias("n_shared"), F.max("n_item").alias("n_item"))
        .withColumn("containment", F.col("n_shared") / F.col("n_item"))
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, max_pairs: int = 2_000_000, **options) -> DataFrame:
    """The rows of docs whose text contains no item, with all their columns. Texts are known by their digests; those to
    drop are broadcast below ``max_pairs``."""
    digest = F.md5(text_of())
    keyed = docs.select(digest.alias("doc_id"), "text")
    found = Cut(contained_items(keyed, items, max_pairs=max_pairs, **options).select(F.col("doc_id").alias("__leak")).distinct()).df
    leaks = F.broadcast(found) if found.count() <= max_pairs else found
    return docs.join(leaks, F.md5(text_of(docs["text"])) == found["__leak"], "left_anti")


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contained_items(documents.select("doc_id", "text"), benchmark)


ORACLE = """
WITH d AS (SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS w FROM documents),
b AS (SELECT item_id, string_split(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ') AS w FROM benchmark),
bw AS (SELECT item_id, w, least(len(w), 5) AS k FROM b WHERE w[1] <> ''),
ks AS (SELECT DISTINCT k FROM bw),
ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d JOIN ks ON len(w) >= k)),
bs AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bw)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (k, g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, CAST(n_shared AS DOUBLE) / n_item AS containment
FROM s JOIN n USING (item_id) WHERE n_shared >= ceil(0.8 * n_item - 1e-9)
"""
