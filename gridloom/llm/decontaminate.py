"""Benchmark decontamination: size-partitioned MinHash containment search, verified on the shingles themselves.

Items are put into classes by the power of two of their number of distinct shingles. An item is
represented by the smallest hashes of its shingles, a bottom-m MinHash sketch; m is fixed by the
class so that an item of which at least the threshold is contained in a document shares at
least one sketch hash with it. A document that holds `n - f` of `n` shingles misses `f` at most, so
it holds `m - f` or more of the sketch: the search loses nothing. Only items have size classes;
a document that is too small to hold an item may be a candidate and falls to the verification.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import written

WORDS = 5
THRESHOLD = 0.8
BREAK = r"[^\p{L}\p{M}\p{N}]+"


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits."""
    return F.array_remove(F.split(F.lower(text), BREAK), "")


def _needed(n: Column, threshold: float) -> Column:
    """The fewest shingles that make the threshold of `n`."""
    return F.ceil(n * F.lit(threshold) - 1e-9).cast("long")


def _size_class(n: Column) -> Column:
    return F.floor(F.log2(F.greatest(n, F.lit(1)) + 0.5)).cast("int")


def _shingles(rows: DataFrame, width: int, keep: list[str]) -> DataFrame:
    """`keep` and the columns word_0 .. of every run of `width` words of the column `words`."""
    runs = rows.select(*keep, "words", F.posexplode("words").alias("at", "first")).where(F.col("at") <= F.size("words") - width)
    return runs.select(*keep, *(F.get("words", F.col("at") + i).alias(f"word_{i}") for i in range(width)))


def _hashed(rows: DataFrame, width: int, keep: list[str]) -> DataFrame:
    return _shingles(rows, width, keep).select(*keep, F.xxhash64(F.lit(width), *(f"word_{i}" for i in range(width))).alias("hash"))


def _spelled(rows: DataFrame, width: int, keep: list[str]) -> DataFrame:
    return _shingles(rows, width, keep).select(*keep, F.concat_ws(" ", *(f"word_{i}" for i in range(width))).alias("shingle"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Pairs (key, item_key, n_shingles, n_shared) of documents that hold `threshold` or more of an item's shingles.

    Shingles are runs of `words` lower-cased words, each counted once; an item of fewer words is one
    shingle of all its words, an item without words never matches. Rows that share a key, null
    included, are one document or item. Null and empty texts hold nothing; empty tables give no
    rows. Columns other than key and text are not looked at.
    """
    item_words = items.select(F.col(item_key).alias("item"), words_of(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    item_words = item_words.withColumn("width", F.least(F.size("words"), F.lit(words)))
    widths = [row[0] for row in item_words.select("width").distinct().collect()]  # `words` numbers at most
    doc_words = docs.select(F.col(key).alias("doc"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    out = docs.sparkSession.createDataFrame([], f"doc {docs.schema[key].dataType.simpleString()}, item {items.schema[item_key].dataType.simpleString()}, n_shingles long, n_shared long")
    if widths:
        by_width = [(w, item_words.where(F.col("width") == w)) for w in sorted(widths)]
        # written, so that their size is known before documents are read: small ones need no shuffle of the documents
        spelled = written(_union([_spelled(rows, w, ["item", "width"]) for w, rows in by_width]).distinct(), "item-shingles")
        sketches = written(_sketches(_union([_hashed(rows, w, ["item"]) for w, rows in by_width]).distinct(), threshold), "sketches")
        candidates = written(_candidates(doc_words, sketches, sorted(widths), threshold), "leak-candidates")
        sizes = spelled.groupBy(F.col("item").alias("sized")).agg(F.count(F.lit(1)).alias("n_shingles"))
        lists = spelled.groupBy("item", "width").agg(F.collect_list("shingle").alias("shingles"))
        lists = written(lists.join(sizes, F.col("item").eqNullSafe(F.col("sized"))).drop("sized"), "item-lists")
        out = _verified(doc_words, candidates, lists, sorted(widths), threshold)
    return out.select(F.col("doc").alias(key), F.col("item").alias(item_key), "n_shingles", "n_shared")


def _verified(doc_words: DataFrame, candidates: DataFrame, lists: DataFrame, widths: list[int], threshold: float) -> DataFrame:
    """(doc, item, n_shingles, n_shared) of the candidates that hold enough of the item's shingles.

    A document's row meets the lists of its candidates and is compared inside the row, so no shingle, however common, brings
    rows together. What several rows with one key hold is one set.
    """
    pairs = candidates.join(lists.withColumnRenamed("item", "named"), F.col("item").eqNullSafe(F.col("named"))).drop("named").withColumnRenamed("doc", "asked")
    found = []
    for width in widths:
        own = F.transform(F.sequence(F.lit(1), F.size("words") - width + 1), lambda at: F.array_join(F.slice("words", at, width), " "))
        rows = doc_words.where(F.size("words") >= width).join(candidates.select(F.col("doc").alias("asked")).distinct(), F.col("doc").eqNullSafe(F.col("asked")), "left_semi")
        rows = rows.select("doc", own.alias("own")).join(pairs.where(F.col("width") == width), F.col("doc").eqNullSafe(F.col("asked")))
        found.append(rows.select("doc", "item", "n_shingles", F.explode(F.array_intersect("shingles", "own")).alias("shingle")))
    shared = _union(found).distinct().groupBy("doc", "item", "n_shingles").agg(F.count(F.lit(1)).alias("n_shared"))
    return shared.where(F.col("n_shared") >= _needed(F.col("n_shingles"), threshold))


def clean_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **how: object) -> DataFrame:
    """The rows of `docs` that hold none of the items, with all of their columns.

    Rows without a key are judged together, as `contained_items` does.
    """
    found = written(contained_items(docs, items, key, text, **how).select(F.col(key).alias("__leaked")).distinct(), "leaked")
    return docs.join(found, docs[key].eqNullSafe(F.col("__leaked")), "left_anti")


def _sketches(hashes: DataFrame, threshold: float) -> DataFrame:
    """Per item the rows (item, hash, n, needed_hits) of its bottom-m sketch."""
    sized = hashes.join(hashes.groupBy("item").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("item", "sized"), F.col("item").eqNullSafe(F.col("sized"))).drop("sized")
    most = F.pow(F.lit(2), _size_class(F.col("n")) + 1).cast("long") - 1
    sized = sized.withColumn("m", F.least(F.col("n"), most - _needed(most, threshold) + 1))
    order = F.row_number().over(Window.partitionBy("item").orderBy("hash"))
    hits = F.greatest(F.lit(1), F.col("m") - (F.col("n") - _needed(F.col("n"), threshold)))
    return sized.withColumn("at", order).where(F.col("at") <= F.col("m")).select("item", "hash", "n", hits.alias("hits"))


def _candidates(doc_words: DataFrame, sketches: DataFrame, widths: list[int], threshold: float) -> DataFrame:
    limit = sketches.agg(F.max("hash")).first()[0]
    below = _union([_hashed(doc_words, w, ["doc"]) for w in widths]).where(F.col("hash") <= F.lit(limit))
    met = below.join(sketches, "hash").select("doc", "item", "hash", "hits").distinct()
    return met.groupBy("doc", "item").agg(F.count(F.lit(1)).alias("met"), F.max("hits").alias("hits")).where(F.col("met") >= F.col("hits")).select("doc", "item")
