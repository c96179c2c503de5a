"""Benchmark decontamination: item-sized document windows, SimHash, multi-index Hamming blocks, exact check.

1. *Screen (lossless).* Items and documents are cut into word shingles (five words; an item of fewer
   words is one shingle). Shingles weigh by their rarity among items. A window of similarity >= t
   shares at least t of the item's weight, so it must hold one of the item's *anchors*: its rarest
   shingles up to just over (1 - t) of its weight. Where a text holds an anchor of an item, all its
   shingles of that item are found, and every item-sized window in which they sum to t of the item's
   weight is opened, whatever their order and place. A text shorter than the item is one window.
   No other window can pass.
2. *Fingerprint.* Every distinct window content and every item gets a 128-bit SimHash of its weighted
   words.
3. *Multi-index blocks.* Fingerprints are cut into ``BLOCKS`` blocks of 16 bits; of two within Hamming distance
   RADIUS, one block differs in at most RADIUS // BLOCKS bits (pigeonhole). Items are entered under every value
   so near to each of their blocks (697 values a block for three bits), so the equi-join on (length, block number,
   block) finds every pair within the radius, and of other pairs of one length about one in twelve. A pair
   counts at its first such block only.
4. *Exact check.* The pairs of step 3, and no others, are verified: weighted multiset similarity of shingles,
   sum w*min / sum w*max >= t.

The screen only leaves windows out. Windows of equal content (a passage that many documents share)
are fingerprinted and verified once. Everything is DataFrame code; no Python runs on executors. A window of similarity t
or more is lost only if its fingerprint is beyond the radius (see README for the recall measured against brute force).

Cases: null or empty documents and items never match; items and documents of fewer than five words
match as whole shingles; an item cut off at a document's start or end is met by the first or last
window that fits, and one that is longer than the document by the whole document; repeated
item rows count once, a null item_id is reported as null; null doc_ids are reported as null; repeated documents are each
reported once per (doc_id, text); extra columns are ignored (kept by ``remove_contaminated``); empty
tables give an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dugout.llm.common import small, staged, text_or_empty

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 31
BITS = 128
BLOCKS = 8
BLOCK_BITS = BITS // BLOCKS
NOT_WORD = r"[^\p{L}\p{N}]+"


def words_of(text: str | Column = "text") -> Column:
    """Lower-case words (letters and digits)."""
    return F.array_remove(F.split(F.lower(text_or_empty(text)), NOT_WORD), "")


def _gram(words: str, at: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(F.col(words), at + i) for i in range(k)])


def _starts(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1))


def item_shingles(items: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(item_id, n_words, k, pos, gram): every shingle of every item with at least one word."""
    items = items.select("item_id", words_of().alias("words")).withColumn("n_words", F.size("words")).where("n_words > 0")
    parts = []
    for size in range(1, k + 1):
        held = items.where(F.col("n_words") >= k if size == k else F.col("n_words") == size)
        parts.append(held.select("item_id", "n_words", "words", F.lit(size).alias("k"),
                                 F.explode(_starts(F.col("n_words") - (size - 1))).alias("pos"))
                     .select("item_id", "n_words", "k", "pos", _gram("words", F.col("pos"), size).alias("gram")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _weights(shingles: DataFrame) -> DataFrame:
    """(k, gram, weight): 1 + ln(items / items that hold it). A shingle of no item weighs as one of one item."""
    n = shingles.agg(F.count_distinct("item_id").alias("n_items"))
    return (shingles.groupBy("k", "gram").agg(F.count_distinct("item_id").alias("df")).crossJoin(F.broadcast(n))
            .select("k", "gram", (1 + F.log(F.col("n_items") / F.col("df"))).alias("weight")))


def _anchors(shingles: DataFrame, weights: DataFrame, t: float) -> DataFrame:
    """The rarest shingles of each item, up to just over (1 - t) of its weight. An item is a short text."""
    w = W.partitionBy("item_id").orderBy(F.desc("weight"), "gram", "pos")
    s = (shingles.join(weights, ["k", "gram"])
         .withColumn("above", F.sum("weight").over(w.rowsBetween(W.unboundedPreceding, -1)))
         .withColumn("total", F.sum("weight").over(W.partitionBy("item_id"))))
    return s.where(F.coalesce(F.col("above"), F.lit(0.0)) <= (1 - t) * F.col("total") + 1e-9)


def _candidates(docs: DataFrame, anchors: DataFrame, k_sizes: list[int]) -> DataFrame:
    """(doc_id, text_id, item_id): the documents that hold an anchor of an item."""
    docs = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("text_id"), words_of().alias("words"))
    found = []
    for k in k_sizes:
        side = small(staged(anchors.where(F.col("k") == k).select("gram", "item_id").distinct(), f"decon-anchors-{k}"))
        grams = (docs.withColumn("pos", F.explode(_starts(F.size("words") - (k - 1))))
                 .withColumn("gram", _gram("words", F.col("pos"), k)))
        found.append(grams.join(side, "gram").select("doc_id", "text_id", "item_id"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def _windows(docs: DataFrame, candidates: DataFrame, shingles: DataFrame, weights: DataFrame, k_sizes: list[int],
             t: float) -> DataFrame:
    """(text_id, item_id, start, n_words, length, window, content): the windows that hold t of a candidate item's weight.

    n_words is the item's length, length the window's (smaller where the text is shorter than the item).
    Each shingle of the item at pos of a text counts for the windows that start from pos - (n_words - k) to pos;
    these ranges are summed as steps up and down, so the work grows with the shingles met, not with the windows.
    """
    pairs = staged(candidates.select("text_id", "item_id").distinct(), "decon-pairs")
    wanted = small(staged(pairs.select(F.col("text_id").alias("_text")).distinct(), "decon-wanted"))
    texts = (docs.select(F.xxhash64(text_or_empty()).alias("text_id"), "text")
             .join(wanted, F.col("text_id") == F.col("_text"), "left_semi")
             .groupBy("text_id").agg(F.first("text").alias("text")).select("text_id", words_of().alias("words")))
    texts = staged(texts, "decon-texts")
    weighed = shingles.join(weights, ["k", "gram"])
    totals = weighed.groupBy("item_id").agg(F.sum("weight").alias("total"))
    of_items = staged(weighed.select("item_id", "n_words", "k", "gram", "weight").distinct().join(totals, "item_id"), "decon-grams")
    sought = pairs.join(small(of_items), "item_id")
    found = []
    for k in k_sizes:
        found.append(texts.select("text_id", "words", F.size("words").alias("size"), F.lit(k).alias("k"),
                                  F.explode(_starts(F.size("words") - (k - 1))).alias("pos"))
                     .select("text_id", "size", "k", "pos", _gram("words", F.col("pos"), k).alias("gram")))
    grams = found[0]
    for f in found[1:]:
        grams = grams.unionByName(f)
    last = F.greatest(F.col("size") - F.col("n_words"), F.lit(0))
    held = grams.join(sought, ["text_id", "k", "gram"]).select(
        "text_id", "item_id", "n_words", "total", "weight",
        F.greatest(F.col("pos") - (F.col("n_words") - F.col("k")), F.lit(0)).alias("lo"), F.least(F.col("pos"), last).alias("hi"))
    steps = (held.select("text_id", "item_id", "n_words", "total", F.explode(F.array(
                F.struct(F.col("lo").alias("at"), F.col("weight").alias("step")),
                F.struct((F.col("hi") + 1).alias("at"), (-F.col("weight")).alias("step")))).alias("s"))
             .groupBy("text_id", "item_id", "n_words", "total", F.col("s.at").alias("at")).agg(F.sum("s.step").alias("step")))
    order = W.partitionBy("text_id", "item_id").orderBy("at")
    opened = (steps.withColumn("shared", F.sum("step").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
              .withColumn("next", F.lead("at").over(order))
              .where(F.col("next").isNotNull() & (F.col("shared") >= (t - 1e-6) * F.col("total")))
              .select("text_id", "item_id", "n_words", F.explode(F.sequence("at", F.col("next") - 1)).alias("start")))
    out = (opened.join(texts, "text_id")
           .select("text_id", "item_id", "start", "n_words", F.expr("slice(words, start + 1, n_words)").alias("window")))
    return (out.withColumn("length", F.size("window"))
            .withColumn("content", F.md5(F.concat_ws(" ", "window").cast("binary"))))


def simhash(words: DataFrame, key: list[str], names: tuple[str, str] = ("print1", "print2")) -> DataFrame:
    """(key..., word, weight) -> (key..., two halves of the fingerprint): one sum per bit, aggregated map-side first."""
    h = words.withColumn("h0", F.xxhash64("word")).withColumn("h1", F.xxhash64(F.lit("half"), "word"))
    bits = h.groupBy(*key).agg(*[F.sum(F.expr(f"weight * (2 * (shiftright(h{b // 64}, {b % 64}) & 1) - 1)")).alias(f"b{b}")
                                 for b in range(BITS)])
    half = lambda at: " | ".join(f"CASE WHEN b{at + b} >= 0 THEN shiftleft(1L, {b}) ELSE 0L END" for b in range(64))
    return bits.select(*key, F.expr(half(0)).alias(names[0]), F.expr(half(64)).alias(names[1]))


def _block(one: str, two: str, n: int) -> str:
    """Block n of a fingerprint given by its halves."""
    per = BLOCKS // 2
    return f"(shiftrightunsigned({one if n < per else two}, {n % per * BLOCK_BITS}) & {(1 << BLOCK_BITS) - 1})"


def near_masks(flips: int) -> list[int]:
    """The block values of at most ``flips`` bits."""
    return [sum(1 << b for b in bits) for n in range(flips + 1) for bits in combinations(range(BLOCK_BITS), n)]


def hamming_join(left: DataFrame, right: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs of equal n_words within ``radius``: left has print1 and print2, right item_print1 and item_print2."""
    flips = radius // BLOCKS
    blocks = lambda one, two: F.expr("array(" + ", ".join(_block(one, two, n) for n in range(BLOCKS)) + ")")
    a = left.select("*", F.posexplode(blocks("print1", "print2")).alias("block_no", "block")).alias("a")
    masks = F.array(*[F.lit(m).cast("long") for m in near_masks(flips)])
    b = (right.select("*", F.posexplode(blocks("item_print1", "item_print2")).alias("block_no", "value"))
         .select("*", F.explode(masks).alias("mask")).withColumn("block", F.col("value").bitwiseXOR(F.col("mask"))).drop("value", "mask"))
    b = small(staged(b, "decon-blocks")).alias("b")
    one, two = "(a.print1 ^ b.item_print1)", "(a.print2 ^ b.item_print2)"
    first = F.expr("CASE " + " ".join(f"WHEN bit_count({_block(one, two, n)}) <= {flips} THEN {n}" for n in range(BLOCKS)) + " END")
    apart = F.expr(f"bit_count({one}) + bit_count({two})")
    on = ((F.col("a.n_words") == F.col("b.n_words")) & (F.col("a.block_no") == F.col("b.block_no"))
          & (F.col("a.block") == F.col("b.block")) & (apart <= radius) & (first == F.col("a.block_no")))
    keep = [F.col(f"a.{c}") for c in left.columns] + [F.col(f"b.{c}") for c in right.columns if c != "n_words"]
    return a.join(b, on).select(*keep, apart.cast("int").alias("hamming"))


def contaminated(docs: DataFrame, items: DataFrame, k: int = SHINGLE, t: float = SIMILARITY,
                 radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_id, item_id, start_word, n_words, hamming, similarity): a row for each document and
    item of which it holds a window of similarity >= t; the best window, the first of equals."""
    # inside, an item is its row's hash: item_ids may be null or stand for several texts; repeated rows count once
    names = staged(items.select("item_id", text_or_empty().alias("text")).distinct()
                   .withColumn("item", F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text")), "decon-names")
    items = names.select(F.col("item").alias("item_id"), "text")
    shingles = staged(item_shingles(items, k), "decon-items")
    sizes = sorted(r["k"] for r in shingles.select("k").distinct().collect())   # at most k values
    weights = staged(_weights(shingles), "decon-weights")
    n_items = shingles.agg(F.count_distinct("item_id")).first()[0]
    if not sizes:
        sizes = [k]
    anchors = _anchors(shingles, weights, t)
    candidates = staged(_candidates(docs, anchors, sizes), "decon-candidates")
    windows = staged(_windows(docs, candidates, shingles, weights, sizes, t), "decon-windows")
    contents = windows.groupBy("content", "n_words").agg(F.first("window").alias("window"))
    contents = staged(contents, "decon-contents")

    item_words = items.select("item_id", words_of().alias("words")).withColumn("n_words", F.size("words")).where("n_words > 0")
    exploded = item_words.select("item_id", "n_words", F.explode("words").alias("word"))
    rarity = small(staged(exploded.groupBy("word").agg(F.count_distinct("item_id").alias("df"))
                          .select("word", (1 + F.log(F.lit(float(max(n_items, 1))) / F.col("df"))).alias("rarity")), "decon-rarity"))
    unknown = 1 + F.log(F.lit(float(max(n_items, 1))))

    def weighed(rows: DataFrame) -> DataFrame:
        return rows.join(rarity, "word", "left").withColumn("weight", F.coalesce("rarity", unknown)).drop("rarity")

    item_prints = simhash(weighed(exploded), ["item_id", "n_words"], ("item_print1", "item_print2"))
    prints = simhash(weighed(contents.select("content", "n_words", F.explode("window").alias("word"))), ["content", "n_words"])
    near = staged(hamming_join(staged(prints, "decon-prints"), item_prints, radius).select("content", "n_words", "item_id", "hamming"), "decon-near")

    # exact weighted-shingle similarity of the candidate pairs
    size = F.least(F.col("n_words"), F.lit(k))
    grams = contents.select("content", "n_words", "window", size.alias("k"),
                            F.explode(_starts(F.size("window") - size + 1)).alias("pos"))
    gram = F.lit(None).cast("long")
    for s in range(k, 0, -1):
        gram = F.when(F.col("k") == s, _gram("window", F.col("pos"), s)).otherwise(gram)
    window = ["content", "n_words"]
    w_counts = grams.select(*window, "k", gram.alias("gram")).groupBy(*window, "k", "gram").agg(F.count("*").alias("n"))
    i_counts = shingles.groupBy("item_id", "k", "gram").agg(F.count("*").alias("n"))
    pairs = near.select(*window, "item_id")
    both = (pairs.join(w_counts, window).select(*window, "item_id", "k", "gram", F.col("n").alias("a"), F.lit(0).cast("long").alias("b"))
            .unionByName(pairs.join(i_counts, "item_id").select(*window, "item_id", "k", "gram", F.lit(0).cast("long").alias("a"), F.col("n").alias("b"))))
    shared = (both.groupBy(*window, "item_id", "k", "gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
              .join(small(weights), ["k", "gram"], "left").withColumn("weight", F.coalesce("weight", unknown)))
    exact = (shared.groupBy(*window, "item_id")
             .agg((F.sum(F.col("weight") * F.least("a", "b")) / F.sum(F.col("weight") * F.greatest("a", "b"))).alias("similarity"))
             .where(F.col("similarity") >= t - 1e-9))
    verified = (near.join(exact, [*window, "item_id"]).withColumnRenamed("item_id", "item")
                .join(names.select("item", "item_id"), "item").drop("item"))
    verified = small(staged(verified, "decon-verified"))
    best = F.max_by(F.struct("start", "length", "hamming", "similarity"), F.struct("similarity", -F.col("start"))).alias("best")
    found = (windows.select("text_id", "start", "length", *window).distinct().join(verified, window)
             .groupBy("text_id", "item_id").agg(best))
    found = small(staged(found, "decon-found"))
    return (candidates.select("doc_id", "text_id").distinct().join(found, "text_id")
            .select("doc_id", "text_id", "item_id", F.col("best.start").alias("start_word"), F.col("best.length").alias("n_words"),
                    F.col("best.hamming").alias("hamming"), F.col("best.similarity").alias("similarity")))


def remove_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item, all columns as they are."""
    bad = staged(contaminated(docs, items, **options).select(
        F.col("doc_id").alias("_doc"), F.col("text_id").alias("_text")).distinct(), "decon-flagged")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"))
    on = F.col("r.doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64(text_or_empty(F.col("r.text"))) == F.col("_text"))
    return rows.join(small(bad), on, "left_anti").select("r.*")
