"""Mixing sources to target weights.

Words are packed into blocks of fixed length per source. Each output shard draws how many of
its slots each source fills; the slots of a source walk through pseudorandom permutations of
its block numbers, one permutation per pass, and blocks are joined by their number. Only
per-source totals are gathered; everything else is spread by blocks and shards. All steps are
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lastmile.llm.shield import restored, shielded
from lastmile.operators.sizing import written

WEIGHTS = (5, 2, 1)
BUDGET = 1.5  # share of all words that the mix has
MOST_PASSES = 2  # a source gives each of its words at most so often
BLOCK_WORDS = 64
SHARD_SLOTS = 1024
SEED = 17
ROUNDS = 6
DOCS_PER_BUCKET = 1000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most_passes: int = MOST_PASSES,
) -> DataFrame:
    """(source, source_no, source_size, target) of sized documents (source, size).

    Sources are ordered by code point, null last, and take the weights in turn. Where a
    target would exceed ``most_passes`` times its source's size it stops there and the rest
    is shared again by weight: sources are filled in the order of limit to weight, so one
    running sum tells which of them stop. The window runs over sources, not over documents.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    by_ratio = everything.orderBy("_ratio", "source_no")
    return (
        totals.withColumn("source_no", F.row_number().over(by_name) - 1)
        .withColumn("_weight", weight)
        .withColumn("_limit", F.col("source_size") * float(most_passes))
        .withColumn("_ratio", F.col("_limit") / F.col("_weight"))
        .withColumn("_left", F.sum("source_size").over(everything) * F.lit(budget)
                    - F.sum("_limit").over(by_ratio) + F.col("_limit"))
        .withColumn("_share", F.sum("_weight").over(everything) - F.sum("_weight").over(by_ratio) + F.col("_weight"))
        # What each unit of weight would get if this source and all later ones were open.
        .withColumn("_unit", F.col("_left") / F.col("_share"))
        .withColumn("_open", F.min(F.when(F.col("_unit") <= F.col("_ratio"), F.struct("_ratio", "source_no", "_unit"))).over(everything))
        .withColumn(
            "target",
            F.when(
                F.col("_open").isNull() | (F.struct("_ratio", "source_no") < F.struct("_open._ratio", "_open.source_no")),
                F.col("_limit"),
            ).otherwise(F.least(F.col("_open._unit") * F.col("_weight"), F.col("_limit"))),
        )
        .select("source", "source_no", "source_size", "target")
    )


def placed(sized: DataFrame, docs_per_bucket: int = DOCS_PER_BUCKET) -> DataFrame:
    """Add ``start``: the words before the document in its source's stream.

    Documents are dealt into hashed buckets of about ``docs_per_bucket`` rows; sums run inside
    buckets and over bucket totals, so a source with a third of all rows is not one task.
    """
    counts = sized.groupBy("source_no").agg(F.ceil(F.count(F.lit(1)) / docs_per_bucket).cast("int").alias("_buckets"))
    dealt = sized.join(F.broadcast(counts), "source_no").withColumn(
        "_bucket", F.pmod(F.xxhash64("doc_id"), F.col("_buckets"))
    )
    buckets = dealt.groupBy("source_no", "_bucket").agg(F.sum("size").alias("_n"))
    across = Window.partitionBy("source_no").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("source_no", "_bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select("source_no", "_bucket", F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_first"))
    return (
        dealt.withColumn("_inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(starts, ["source_no", "_bucket"])
        .withColumn("start", F.col("_first") + F.col("_inside"))
        .drop("_buckets", "_bucket", "_first", "_inside")
    )


def permuted(df: DataFrame, position: str, size: str, key: Column, rounds: int = ROUNDS) -> DataFrame:
    """Replace ``position`` in [0, size) by its image under a pseudorandom permutation.

    Swap-or-not rounds: a position and its mirror image change places or do not, as a hash
    of the pair says. Each round maps [0, size) onto itself for any size.
    """
    for r in range(rounds):
        turn = F.pmod(F.xxhash64(key, F.lit(r)), F.col(size))
        df = df.withColumn("_mirror", F.pmod(turn - F.col(position), F.col(size)))
        swap = F.xxhash64(key, F.lit(r), F.greatest("_mirror", position)).bitwiseAND(F.lit(1).cast("long")) == 1
        df = df.withColumn(position, F.when(swap, F.col("_mirror")).otherwise(F.col(position)))
    # Without nulls no filter on the result is pushed through the rounds, each of which would
    # triple its expression.
    return df.drop("_mirror").withColumn(position, F.coalesce(position, F.lit(0).cast("long")))


def draws(
    targets: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED,
) -> DataFrame:
    """(shard, source_no, blocks, before, slots): how many slots of a shard a source fills.

    Counts have multinomial means in every shard; they are drawn systematically, from one
    hashed start per shard, which keeps the sum over shards close to the target.
    ``before`` counts the source's slots in earlier shards.
    """
    wanted = targets.where("source_size > 0").withColumn(
        "blocks", F.ceil(F.col("source_size") / block_words).cast("long")
    ).withColumn("_want", F.col("target") * F.col("blocks") / F.col("source_size"))
    run = Window.partitionBy(F.lit(0)).orderBy("source_no")
    ranked = wanted.withColumns({
        "_no": F.row_number().over(run) - 1, "_high": F.sum("_want").over(run),
    }).withColumn("_low", F.coalesce(F.lag("_high").over(run), F.lit(0.0)))
    sources, total = ranked.agg(F.count(F.lit(1)), F.max("_high")).first()
    per_shard = max(shard_slots, 4 * sources)
    shards = max(1, round((total or 0.0) / per_shard))
    # Shards x sources rows, of which there are at most a quarter of the slots.
    grid = targets.sparkSession.range(shards * sources).select(
        F.expr(f"id DIV {max(sources, 1)}").alias("shard"), (F.col("id") % max(sources, 1)).alias("_no")
    )
    chance = F.pmod(F.xxhash64("shard", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    upto = lambda edge: F.ceil(F.col(edge) / shards - chance).cast("long")
    earlier = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (
        grid.join(ranked, "_no")
        .withColumn("slots", upto("_high") - upto("_low"))
        .withColumn("before", F.coalesce(F.sum("slots").over(earlier), F.lit(0)))
        .where("slots > 0")
        .select("shard", "source_no", "blocks", "before", "slots")
    )


def slots(drawn: DataFrame, most_passes: int = MOST_PASSES, seed: int = SEED) -> DataFrame:
    """(shard, source_no, pass, block): the block in each slot; no block more than ``most_passes`` times."""
    numbered = (
        drawn.repartition("shard", "source_no")
        .select("shard", "source_no", "blocks", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("slots") - 1)).alias("_at"))
        .where(F.col("_at") < F.col("blocks") * most_passes)
        .withColumn("pass", F.expr("CAST(_at DIV blocks AS INT)"))
        .withColumn("block", F.col("_at") % F.col("blocks"))
    )
    key = F.xxhash64(F.lit(seed), "source_no", "pass")
    return permuted(numbered, "block", "blocks", key).select("shard", "source_no", "pass", "block")


def pieces(place: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents (source_no, start, size, ...) cut at block borders: ``block``, ``first``, ``words``."""
    words = F.lit(block_words)
    first = F.greatest(F.col("start"), F.col("block") * words)
    last = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * words)
    return (
        place.where("size > 0")
        .withColumn("block", F.explode(F.expr(f"sequence(start DIV {block_words}, (start + size - 1) DIV {block_words})")))
        .withColumn("first", first - F.col("start")).withColumn("words", last - first)
    )


def sized_documents(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with size, source_no and start; targets), without texts, both written once."""
    sized = written(docs.select("doc_id", "source", word_count(text).alias("size")))
    targets = written(source_targets(sized))
    numbered = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(
        "doc_id", sized["source"], "size", "source_no", "source_size", "target"
    )
    return written(placed(numbered)), targets


def mixed(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, source_size, target and ``taken`` words.

    Null texts have no words; null sources form one source, the last. Repeated rows are
    documents of their own. Tables without words have targets of zero and take nothing.
    Other columns are left out. The same rows give the same mix in every run.
    """
    place, targets = sized_documents(docs, text)
    times = slots(draws(targets)).groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = (
        pieces(place).join(times, ["source_no", "block"])
        .groupBy("source_no", "start", "doc_id").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    key = ["source_no", "start"]
    full = place.where("size > 0").alias("d").join(
        taken.alias("t"), [F.col(f"d.{k}") == F.col(f"t.{k}") for k in key], "left"
    ).select("d.doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    empty = place.where("size = 0").select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    return full.unionAll(empty)


def mixed_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The mix as documents: a row for each pass of a document that any of its words is in.

    A document that a pass takes whole keeps its text; otherwise the text is the taken words,
    with the white space behind each. ``n_chars`` is set to the new length where there is
    such a column. Documents without words are in no mix and go.
    """
    inner = shielded(docs, ("doc_id", "source", "n_chars", text))
    keyed = inner.withColumn("_row", F.xxhash64(*inner.columns))
    place, targets = sized_documents(keyed.withColumn("doc_id", F.struct("doc_id", "_row")), text)
    parts = (
        pieces(place).join(slots(draws(targets)), ["source_no", "block"])
        .groupBy("doc_id", "source_no", "start", "size", "pass")
        .agg(F.sum("words").alias("_words"), F.sort_array(F.collect_list(F.struct("first", "words"))).alias("_parts"))
        # Identical rows share their key; the number tells them apart.
        .withColumn("_copy", F.dense_rank().over(Window.partitionBy("doc_id").orderBy("source_no", "start")))
        .select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id._row").alias("_row"), "_copy", "size", "_words", "_parts")
    )
    numbered = keyed.withColumn(
        "_copy", F.row_number().over(Window.partitionBy("doc_id", "_row").orderBy("_row"))
    )
    tokens = F.regexp_extract_all(F.col(text), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.array_join(
        F.flatten(F.transform("_parts", lambda p: F.slice(F.col("_tokens"), p["first"].cast("int") + 1, p["words"].cast("int")))), ""
    )
    rows = (
        numbered.alias("d").join(
            parts.alias("p"),
            F.col("d.doc_id").eqNullSafe(F.col("p._id")) & (F.col("d._row") == F.col("p._row")) & (F.col("d._copy") == F.col("p._copy")),
        )
        .select(*[F.col(f"d.{c}").alias(c) for c in inner.columns], "size", "_words", "_parts")
        .withColumn("_tokens", F.when(F.col("_words") < F.col("size"), tokens))
        .withColumn(text, F.when(F.col("_words") < F.col("size"), cut).otherwise(F.col(text)))
    )
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return restored(rows, inner, docs)
