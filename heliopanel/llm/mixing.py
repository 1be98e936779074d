"""Temperature mixing of sources, realised as budgeted block permutations.  DataFrame functions only.

Source shares ``p`` are raised to an exponent ``a`` and normalised: ``w = p^a / sum p^a``.
The exponent is found by bisection on [0, 1]: the largest one whose entropy reaches the
target, raised if needed until no source is read more than ``max_repeats`` times.  A source
of ``t`` tokens then gets ``w * budget`` tokens, rounded: whole passes over its documents, and of one
more pass so many blocks, in an order permuted per pass, that the rest is met; the block in
which the rest ends is cut between documents.

A source's documents fall into blocks by a hash of their id, at most ``MAX_BLOCKS`` a
source, so the only windows are over one source's block totals and over the documents of
its one cut block.  What a document gets follows from its own row and its source's plan
row.

Nulls: null text has no tokens; null source is a source of its own (''); rows whose ids are
equal (or null) share a key, hence stand or fall together.  Sources without any token get
each document once.  An empty table gives an empty result.  Extra columns are carried by
``mix`` and ignored by ``schedule``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import write_table

WORD = "[^\\x20\\x09-\\x0D]+"
ENTROPY_SHARE = 0.99
MAX_REPEATS = 4.0
SEED = 17
BLOCK_TOKENS = 20_000
MAX_BLOCKS = 100_000
STEPS = 60
BROADCAST_SOURCES = 50_000
SALTS = 16


def n_tokens(text: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _doc_key(doc_id: F.Column) -> F.Column:
    return F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def _block(key: F.Column, blocks: F.Column) -> F.Column:
    return F.pmod(F.conv(F.substring(key, 25, 8), 16, 10).cast("long"), blocks)


def _block_key(epoch: F.Column, source: F.Column, block: F.Column) -> F.Column:
    parts = F.concat_ws(":", F.lit(str(SEED)), epoch.cast("string"), source, block.cast("string"))
    return F.md5(parts.cast("binary"))


def token_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens (words) of each document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("source"),
                       n_tokens().alias("n_tokens"))


def exponent(tokens: DataFrame, entropy_share: float = ENTROPY_SHARE, max_repeats: float = MAX_REPEATS,
             budget_share: float = 1.0) -> DataFrame:
    """One row: all sources with tokens (sorted), total, exponent and normaliser.

    ``tokens`` has one row per source; the array holds the sources, not the documents.
    """
    one = tokens.where("tokens > 0").agg(F.array_sort(F.collect_list(F.struct("source", "tokens"))).alias("all"))
    one = one.withColumn("total", F.aggregate("all", F.lit(0).cast("long"), lambda s, x: s + x["tokens"]))
    one = one.withColumn("p", F.transform("all", lambda x: x["tokens"].cast("double") / F.col("total")))

    def power_sum(a):
        return F.aggregate("p", F.lit(0.0), lambda s, p: s + F.pow(p, a))

    def entropy(a):
        z = power_sum(a)
        return F.log(z) - a * F.aggregate("p", F.lit(0.0), lambda s, p: s + F.pow(p, a) * F.log(p)) / z

    def repeats(a):     # the rarest source is read most often
        return F.lit(budget_share) * F.pow(F.array_min("p"), a - 1.0) / power_sum(a)

    def bisect(ok):
        """Narrow [lo, hi] of exponents: ``ok(mid)`` moves the lower end up."""
        start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

        def step(s, _):
            mid = (s["lo"] + s["hi"]) / 2
            good = ok(mid)
            return F.struct(F.when(good, mid).otherwise(s["lo"]).alias("lo"),
                            F.when(good, s["hi"]).otherwise(mid).alias("hi"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)

    target = F.lit(entropy_share) * F.log(F.size("p").cast("double"))
    one = one.withColumn("by_entropy", F.when(entropy(F.lit(1.0)) >= target, 1.0)
                         .otherwise(bisect(lambda a: entropy(a) >= target)["lo"]))
    one = one.withColumn("by_repeats", F.when(repeats(F.lit(0.0)) <= max_repeats, 0.0)
                         .otherwise(bisect(lambda a: repeats(a) > max_repeats)["hi"]))
    one = one.withColumn("exponent", F.greatest("by_entropy", "by_repeats"))
    return one.withColumn("z", power_sum(F.col("exponent"))).select("all", "total", "exponent", "z")


def plan(counts: DataFrame, entropy_share: float = ENTROPY_SHARE, max_repeats: float = MAX_REPEATS,
         budget_share: float = 1.0) -> DataFrame:
    """One row per source: weight, quota, whole passes, and where the last pass is cut."""
    counts = counts.withColumn("key", _doc_key(F.col("doc_id")))
    sources = counts.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    sized = sources.withColumn("blocks", F.least(F.lit(MAX_BLOCKS), F.greatest(
        F.lit(1), F.ceil(F.col("tokens") / F.lit(BLOCK_TOKENS)))).cast("long"))
    one = exponent(sources, entropy_share, max_repeats, budget_share)
    weights = one.select("exponent", "total", "z", F.explode("all").alias("s")).select(
        F.col("s.source").alias("_s"), "exponent",
        (F.pow(F.col("s.tokens").cast("double") / F.col("total"), F.col("exponent")) / F.col("z")).alias("weight"),
        (F.lit(float(budget_share)) * F.col("total")).alias("budget"))
    quotas = sized.join(weights, sized["source"] == weights["_s"], "left").drop("_s") \
        .withColumn("quota", F.when(F.col("tokens") == 0, 0.0).otherwise(
            F.floor(F.least(F.col("weight") * F.col("budget"), F.lit(float(max_repeats)) * F.col("tokens")) + 0.5))
            .cast("double")) \
        .withColumn("passes", F.when(F.col("tokens") == 0, F.lit(1)).otherwise(
            F.floor(F.col("quota") / F.col("tokens"))).cast("long")) \
        .withColumn("rest", F.when(F.col("tokens") == 0, 0.0).otherwise(
            F.col("quota") - F.col("passes") * F.col("tokens")))
    quotas = write_table(quotas, "mixing-quotas")

    few = small(quotas, BROADCAST_SOURCES)
    placed = salted(counts, few, quotas.select("source", "blocks", "passes", "rest"),
                    F.pmod(F.xxhash64("key"), F.lit(SALTS))) \
        .withColumn("block", _block(F.col("key"), F.col("blocks")))
    totals = placed.groupBy("source", "block").agg(F.sum("n_tokens").alias("in_block"), F.max("passes").alias("passes"),
                                                   F.max("rest").alias("rest")) \
        .withColumn("block_key", _block_key(F.col("passes"), F.col("source"), F.col("block")))
    upto = Window.partitionBy("source").orderBy("block_key", "block") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = totals.withColumn("before", F.sum("in_block").over(upto) - F.col("in_block")) \
        .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("in_block") >= F.col("rest"))) \
        .select("source", "block", "block_key", (F.col("rest") - F.col("before")).alias("left_over"))
    cut = write_table(cut, "mixing-cuts")       # at most one block per source

    inside = salted(placed.select("source", "key", "n_tokens", "block"), few,
                    cut.select("source", F.col("block").alias("cut_block"), "left_over"),
                    F.pmod(F.xxhash64("key"), F.lit(SALTS)), "inner").where("block = cut_block")
    order = Window.partitionBy("source", "block").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy("source", "block", "key")
    last = inside.withColumn("before", F.sum("n_tokens").over(order) - F.sum("n_tokens").over(same)) \
        .where(F.col("before") < F.col("left_over")).groupBy("source").agg(F.max("key").alias("cut_key"))
    return quotas.join(cut.select("source", F.col("block").alias("cut_block"), F.col("block_key").alias("cut_block_key")),
                       "source", "left").join(last, "source", "left")


def small(table: DataFrame, limit: int) -> bool:
    return table.count() <= limit


def salted(rows: DataFrame, few: bool, per_source: DataFrame, salt: F.Column, how: str = "left") -> DataFrame:
    """Join per-source values: broadcast if the sources are few, else on (source, salt), as one may be hot."""
    if few:
        return rows.join(F.broadcast(per_source), "source", how)
    copies = per_source.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return rows.withColumn("_salt", salt).join(copies, ["source", "_salt"], how).drop("_salt")


def _epochs(rows: DataFrame) -> DataFrame:
    """Add ``epoch``: one row per pass that takes the document."""
    block = _block(F.col("_key"), F.col("_plan.blocks"))
    rows = rows.withColumn("_block", block)
    mine = _block_key(F.col("_plan.passes"), F.col("_source"), F.col("_block"))
    cut_key, cut_block = F.col("_plan.cut_block_key"), F.col("_plan.cut_block")
    taken = (F.col("_plan.rest") > 0) & F.when(F.col("_block") == cut_block, F.col("_key") <= F.col("_plan.cut_key")) \
        .otherwise(F.struct(mine, F.col("_block")) < F.struct(cut_key, cut_block))
    copies = F.col("_plan.passes") + F.coalesce(taken, F.lit(False)).cast("long")
    return rows.withColumn("epoch", F.explode(F.when(copies > 0, F.sequence(F.lit(0).cast("long"), copies - 1))))


def _planned(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    few = small(chosen, BROADCAST_SOURCES)
    p = chosen.select(F.col("source").alias("_source"), F.struct(
        "blocks", "passes", "rest", "cut_block", "cut_block_key", "cut_key").alias("_plan"))
    if few:
        return rows.join(F.broadcast(p), "_source")
    p = p.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS))).join(p, ["_source", "_salt"])


def schedule(docs: DataFrame, entropy_share: float = ENTROPY_SHARE, max_repeats: float = MAX_REPEATS,
             budget_share: float = 1.0) -> DataFrame:
    """The training order: doc_id, source, n_tokens, epoch, block and the keys to sort an epoch by."""
    counts = write_table(token_counts(docs), "mixing-counts")
    chosen = write_table(plan(counts, entropy_share, max_repeats, budget_share), "mixing-plan")
    rows = counts.withColumn("_source", F.col("source")).withColumn("_key", _doc_key(F.col("doc_id")))
    out = _epochs(_planned(rows, chosen))
    return out.select("doc_id", "source", "n_tokens", "epoch", F.col("_block").alias("block"),
                      _block_key(F.col("epoch"), F.col("_source"), F.col("_block")).alias("block_key"),
                      F.col("_key").alias("doc_key"))


def mix(docs: DataFrame, entropy_share: float = ENTROPY_SHARE, max_repeats: float = MAX_REPEATS,
        budget_share: float = 1.0) -> DataFrame:
    """The documents themselves, each as often as the mixture reads it, with their own columns."""
    counts = write_table(token_counts(docs), "mixing-counts")
    chosen = write_table(plan(counts, entropy_share, max_repeats, budget_share), "mixing-plan")
    names = docs.columns
    plain = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"),
                        F.coalesce(docs["source"], F.lit("")).alias("_source"),
                        _doc_key(docs["doc_id"].cast("long")).alias("_key"))
    return _epochs(_planned(plain, chosen)).select("_row.*")
