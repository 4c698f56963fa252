"""Benchmark decontamination by spaced-seed hashing, in column functions only.

A seed is a hash of the tokens that a fixed mask selects; the other positions may differ. Seeds of every document
position meet the seeds of the benchmark in a hash join; documents with hits are read again and windows of the tokens
aligned by a hit are compared. ``MASKS`` hit every window of 13 tokens in which any 2 differ, ``SHORT_MASKS`` every whole
item of 9 to 12 tokens in which any 2 differ (enumerating tests hold both to it), so within the definition nothing is
missed. Items of fewer than 9 tokens are outside the definition: they are skipped, exact copies of them too. Documents
get seeds of the short masks only where the benchmark has an item for them. The benchmark is broadcast in blocks of at
most ``BLOCK_TOKENS`` tokens, whatever its size; documents are never paired with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASKS = ("1101111", "110100111")
SHORT_MASKS = ("11101", "100111")
WINDOW, DIFFERENT = 13, 2
MIN_TOKENS = 9
BLOCK_TOKENS = 250_000


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null for a null text."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def seeds(rows: DataFrame, keep: str, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """(keep, seed, pos) of rows (keep, words): one row per position and mask that fits there."""
    n = F.size("words")

    def of(mask: str) -> Column:
        at = lambda i: F.xxhash64(F.lit(mask), *(F.get("words", i + o) for o, bit in enumerate(mask) if bit == "1"))
        return F.when(n >= len(mask), F.transform(F.sequence(F.lit(0), n - len(mask)), at)).otherwise(
            F.array().cast("array<bigint>"))

    # only hashes leave this projection: exploding beside the words would copy them for every position
    lists = rows.select(keep, *(of(m).alias(f"s{k}") for k, m in enumerate(masks)))
    places = F.concat(*(F.transform(
        F.col(f"s{k}"), lambda seed, i: F.struct(seed.alias("seed"), i.alias("pos"))) for k in range(len(masks))))
    return lists.select(keep, F.explode(places).alias("p")).select(keep, "p.seed", "p.pos")


def _alike(words: Column, item: Column, shift: Column) -> Column:
    """Whether a window of the item agrees with the document, shifted by ``shift``, in all but DIFFERENT places."""
    size = F.size(item)
    win = F.least(F.lit(WINDOW), size)
    same = F.transform(item, lambda token, i: F.coalesce((F.get(words, shift + i) == token).cast("int"), F.lit(0)))
    return F.exists(F.sequence(F.lit(0), size - win), lambda start: F.aggregate(
        F.slice(same, start + 1, win), F.lit(0), lambda a, b: a + b) >= win - DIFFERENT)


def contaminated(docs: DataFrame, benchmark: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, item_id), distinct: documents that hold 13 aligned tokens of an item (all of a shorter one), 2 of them
    different at most.

    Items of fewer than 9 tokens are no evidence: they are skipped and match nothing, not even exact copies. Null texts and rows with null ids have no tokens or
    no name and take part in nothing. Repeated rows count once. Extra columns are ignored.
    """
    items = benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), tokens(F.col("text")).alias("words")).where(
        F.size("words") >= MIN_TOKENS)
    total, least = items.agg(F.sum(F.size("words")), F.min(F.size("words"))).first()
    blocks = max(1, -(-int(total or 0) // block_tokens))
    any_short = least is not None and least < WINDOW
    named = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    all_seeds = seeds(named.select("doc_id", tokens(F.col("text")).alias("words")), "doc_id",
                      MASKS + SHORT_MASKS if any_short else MASKS)
    hits = None
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        known = seeds(block.where(F.size("words") >= WINDOW), "item_id")
        if any_short:
            known = known.unionByName(seeds(block.where(F.size("words") < WINDOW), "item_id", SHORT_MASKS))
        known = known.withColumnRenamed("pos", "item_pos")
        found = all_seeds.join(F.broadcast(known), "seed").select(
            "doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift"))
        hits = found if hits is None else hits.unionByName(found)
    by_doc = hits.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "shift")).alias("hits"))
    placed = named.join(by_doc, "doc_id").select("doc_id", tokens(F.col("text")).alias("words"), F.explode("hits").alias("h"))
    return placed.select("doc_id", "words", "h.item_id", "h.shift").join(
        items.withColumnRenamed("words", "item"), "item_id").where(
        _alike(F.col("words"), F.col("item"), F.col("shift"))).select("doc_id", "item_id").distinct()


def marked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, items), a row per row of docs; items: the item ids in order, comma-joined.

    A row with null doc_id is never contaminated.
    """
    by_doc = contaminated(docs, benchmark).groupBy("doc_id").agg(
        F.count("*").alias("n_items"),
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list("item_id")), lambda i: i.cast("string"))).alias("items"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(by_doc, "doc_id", "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.lit("")).alias("items"))
