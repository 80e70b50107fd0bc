"""Benchmark decontamination by SimHash of item-sized windows (DataFrame functions only).

Words are lower-case runs of letters and digits; shingles have five words (an item
of fewer words is one shingle).  For an item of n words the windows of a document
are its runs of n words (the whole document if it is shorter).

1. A window that reaches the similarity shares most of its shingles with items of
   its size, so windows are built only where enough positions hold a shingle of an
   item of that size; this loses none.
2. Windows with equal words are one.  Windows and items get a 64-bit SimHash of
   their shingles, repeats included.
3. Multi-index: fingerprints are cut into four blocks of 16 bits.  Two fingerprints
   within ``4 * r + 3`` bits agree in some block up to r bits, so looking up every
   block value within r of an item's block finds all of them.
4. Candidates within the radius are verified exactly: the sum of the smaller over
   the sum of the larger shingle counts must reach ``similarity``.

The shingles and block values of the items are broadcast only if counted to be at
most ``max_broadcast`` rows; beyond that the joins are ordinary shuffles.

Defined cases: null or empty texts and items without words match nothing.  Items
that repeat are each reported.  A null item_id is reported as null; a null doc_id
too.  Rows that repeat are each reported.  Very long texts are read whole.  Empty
tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inspecta.llm.base import free_name, stored

SHINGLE = 5
SIMILARITY = 0.8
BLOCK_RADIUS = 4            # fingerprints within 4 * 4 + 3 = 19 bits are found
BLOCKS = 4
MAX_BROADCAST = 2_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def row_key(id_: Column, text: Column) -> Column:
    return F.xxhash64(id_.cast("long"), F.coalesce(text.cast("string"), F.lit("")))


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows."""
    return F.broadcast(df) if df.count() <= max_rows else df


def _shingles(df: DataFrame, id_: str) -> DataFrame:
    """(id, shingle) per position of ``words`` with ``k`` words a shingle."""
    at = F.sequence(F.lit(1), F.size("words") - F.col("k") + 1)
    return (df.withColumn("at", F.explode(at))
            .select(id_, F.concat_ws(" ", F.slice("words", F.col("at"), F.col("k"))).alias("shingle")))


def simhash(shingles: DataFrame, id_: str) -> DataFrame:
    """(id, fp, m): a bit is 1 if set in over half of the m shingles' hashes."""
    hashed = shingles.select(id_, F.xxhash64("shingle").alias("h"))
    n = F.count(F.lit(1))
    bits = hashed.groupBy(id_).agg(n.alias("m"), *[F.sum(F.getbit("h", F.lit(b)).cast("int")).alias(f"b{b}") for b in range(64)])
    fp = F.lit(0).cast("long")
    for b in range(64):
        fp = fp.bitwiseOR(F.when(2 * F.col(f"b{b}") > F.col("m"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return bits.select(id_, fp.alias("fp"), "m")


def _block(fp: Column, b: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * b).bitwiseAND(F.lit(0xFFFF).cast("long")).cast("int")


def item_table(items: DataFrame, item_col: str, text_col: str, shingle: int) -> DataFrame:
    """(item, item_id, words, n, k); ``item`` names equal word sequences."""
    w = items.select(items[item_col].alias("item_id"), words(items[text_col]).alias("words"))
    return (w.where(F.size("words") > 0)
            .select(F.sha2(F.concat_ws(" ", "words"), 256).alias("item"), "item_id", "words",
                    F.size("words").alias("n"), F.least(F.size("words"), F.lit(shingle)).alias("k")))


def windows(docs: DataFrame, known: DataFrame, shingle: int, similarity: float,
            max_broadcast: int) -> DataFrame:
    """(key, doc_id, n, k, start, words): windows that may reach ``similarity``.

    ``docs``: key, doc_id, text.  ``known``: item, words, n, k."""
    by_size = (known.select("n", "k", "words").withColumn("at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("k") + 1)))
               .select("n", "k", F.xxhash64(F.slice("words", F.col("at"), F.col("k"))).alias("h")).distinct())
    sizes = [r.k for r in by_size.select("k").distinct().collect()]        # at most ``shingle`` numbers
    split = docs.select("key", words(F.col("text")).alias("words"))
    hits = None
    for k in sorted(sizes):
        at = F.when(F.size("words") >= k, F.sequence(F.lit(0), F.size("words") - k)).otherwise(F.array().cast("array<int>"))
        here = split.select("key", "words", F.explode(at).alias("pos"))
        h = F.xxhash64(F.array(*[F.get("words", F.col("pos") + i) for i in range(k)]))
        look = checked_broadcast(by_size.where(F.col("k") == k), max_broadcast)
        found = (here.select("key", "pos", h.alias("h")).join(look, "h").select("key", "n", "k", "pos"))
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = docs.select("key", F.lit(0).alias("n"), F.lit(0).alias("k"), F.lit(0).alias("pos")).where("false")
    places = (hits.distinct().groupBy("key", "n", "k").agg(F.array_sort(F.collect_list("pos")).alias("pos"))
              .where(F.size("pos") >= F.ceil(similarity / (1 + similarity) * (F.col("n") - F.col("k") + 2) - 1e-9)))
    places = stored(places, "windows")
    doc = docs.select("key", "doc_id", words(F.col("text")).alias("words"))
    both = places.join(doc, "key").withColumn("len", F.least("n", F.size("words")))
    # shingles of the window, and how many of them must be known
    both = (both.withColumn("mw", F.col("len") - F.col("k") + 1)
            .withColumn("need", F.greatest(F.lit(1), F.ceil(similarity / (1 + similarity) * (
                F.col("n") - F.col("k") + 1 + F.col("mw")) - 1e-9).cast("int")))
            .where(F.size("pos") >= F.col("need")))
    # with hit i the first in the window, starts lie after hit i - 1 and let hit i + need - 1 in
    runs = F.transform(F.sequence(F.lit(0), F.size("pos") - F.col("need")), lambda i: F.struct(
        F.greatest(F.lit(0), F.when(i > 0, F.get("pos", i - 1) + 1).otherwise(F.lit(0)),
                   F.get("pos", i + F.col("need") - 1) - F.col("mw") + 1).alias("lo"),
        F.least(F.get("pos", i), F.size("words") - F.col("len")).alias("hi")))
    return (both.withColumn("run", F.explode(runs)).where("run.lo <= run.hi")
            .withColumn("start", F.explode(F.sequence("run.lo", "run.hi")))
            .select("key", "doc_id", "n", "k", "start", F.slice("words", F.col("start") + 1, F.col("len")).alias("words")))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE,
               similarity: float = SIMILARITY, block_radius: int = BLOCK_RADIUS,
               max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, similarity and start
    (word number) of the best window, n_windows that match, key (``row_key``)."""
    named = item_table(items, item_col, item_text_col, shingle)
    known = stored(named.dropDuplicates(["item"]).drop("item_id"), "items")
    rows = docs.select(row_key(docs[id_col], docs[text_col]).alias("key"), docs[id_col].alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    found = windows(rows, known, shingle, similarity, max_broadcast)
    found = stored(found.withColumn("win", F.sha2(F.concat_ws(" ", F.col("n").cast("string"), F.concat_ws(" ", "words")), 256)), "windows")
    one = found.select("win", "n", "k", "words").dropDuplicates(["win"])
    win_shingles, item_shingles = _shingles(one, "win"), _shingles(known, "item")
    win_fp = simhash(win_shingles, "win").join(one.select("win", "n"), "win")
    item_fp = simhash(item_shingles, "item").withColumnsRenamed({"fp": "item_fp", "m": "item_m"}).join(known.select("item", "n"), "item")
    near = F.expr(f"filter(sequence(0, 65535), x -> bit_count(x) <= {block_radius})")
    probes = item_fp.select("item", "item_fp", "item_m", "n", F.explode(F.array(*[
        F.struct(F.lit(b).alias("b"), _block(F.col("item_fp"), b).alias("v")) for b in range(BLOCKS)])).alias("p"))
    probes = probes.select("item", "item_fp", "item_m", "n", "p.b", F.explode(F.transform(near, lambda x: x.bitwiseXOR(F.col("p.v")))).alias("v"))
    cuts = win_fp.select("win", "fp", "m", "n", F.explode(F.array(*[
        F.struct(F.lit(b).alias("b"), _block(F.col("fp"), b).alias("v")) for b in range(BLOCKS)])).alias("p")
    ).select("win", "fp", "m", "n", "p.b", "p.v")
    radius = BLOCKS * block_radius + BLOCKS - 1
    # thousands of probes an item: sorted, never broadcast, whatever the items' own size
    pairs = (cuts.join(probes.hint("merge"), ["n", "b", "v"])
             .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
             .select("win", "m", "item", "item_m").distinct())
    per_win = win_shingles.groupBy("win", "shingle").agg(F.count(F.lit(1)).alias("c"))
    per_item = item_shingles.groupBy("item", "shingle").agg(F.count(F.lit(1)).alias("item_c"))
    same = (pairs.join(per_win, "win").join(per_item, ["item", "shingle"])
            .groupBy("win", "item", "m", "item_m").agg(F.sum(F.least("c", "item_c")).alias("both"))
            .withColumn("similarity", F.col("both") / (F.col("m") + F.col("item_m") - F.col("both")))
            .where(F.col("similarity") >= similarity).select("win", "item", "similarity"))
    best = F.max(F.struct(F.col("similarity"), (-F.col("start")).alias("turned")))
    leaks = (found.select("key", "doc_id", "start", "win").join(same, "win")
             .groupBy("key", "doc_id", "item").agg(best.alias("best"), F.count(F.lit(1)).alias("n_windows")))
    return (leaks.join(named.select("item", "item_id"), "item")
            .select("doc_id", "item_id", "best.similarity", (-F.col("best.turned")).cast("long").alias("start"),
                    "n_windows", "key"))


def drop_leaked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns."""
    key = free_name(docs, "x_key")
    bad = find_leaks(docs, items, id_col, text_col, **settings).select(F.col("key").alias(key)).distinct()
    return (docs.withColumn(key, row_key(docs[id_col], docs[text_col]))
            .join(bad, key, "left_anti").drop(key))
