"""Delta dedupe and MERGE (upsert / delete) without a transactional table format.

Parquet tables reject MERGE INTO, so the three MERGE clauses are written as
joins:

  matched     + DELETED          -> row removed
  matched     + CREATED/UPDATED  -> row replaced by the delta record; columns
                                    the MERGE does not set keep main's value
  not matched + CREATED/UPDATED  -> row inserted (unset columns NULL)
  not matched + DELETED          -> nothing

Three physical forms give the same rows:

* ``broadcast`` (the delta's keys fit checked bounds of number and bytes): main is never
  shuffled.  Only the delta *keys* are broadcast; main rows whose key is in it are
  dropped map-side, and the small matched slice of main is joined to the
  delta records.
* ``bloom``: a Bloom filter of the keys is broadcast; only main rows that may match
  are shuffled into a full outer join, the rest passes map-side.
* ``shuffle``: one full outer join on the key (sort-merge), for deltas beyond any filter.

Rows with a NULL key never match (plain ``=``); in every form they are routed around
the joins, so that they cannot pile up in one shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from inspecta.operators import bloom
from inspecta.operators.bloom import KeyFilter
from inspecta.operators.enrich import enrich
from inspecta.schema import DELETED, MERGE_SET_COLUMNS, MODIFICATIONS

DEFAULT_MAX_BROADCAST_KEYS = 1_000_000
MAX_BROADCAST_BYTES = 256 << 20      # of the keys as text
ACTIONS = ("keep", "delete", "update", "insert", "ignore")


def valid_delta(df: DataFrame) -> DataFrame:
    """Keep records whose modification is CREATED, UPDATED or DELETED."""
    return df.where(F.col("modification").isin(*MODIFICATIONS))


def _dedupe_order(df: DataFrame, order: str) -> list:
    last = F.col("lastMotTestDate").desc_nulls_last()
    feed = [F.col("feed_date").desc_nulls_last()] if "feed_date" in df.columns else []
    lead = [last] + feed if order == "last_test" else feed + [last]
    if order not in ("last_test", "feed_date"):
        raise ValueError("order must be 'last_test' or 'feed_date'")
    # Deterministic tie-breakers: DELETED first, then a hash of the record.
    return lead + [(F.col("modification") == DELETED).desc_nulls_last(),
                   F.xxhash64(*[F.col(c) for c in df.columns]).desc()]


def dedupe_delta(df: DataFrame, key: str = "registration", order: str = "last_test") -> DataFrame:
    """One record per key: the newest by ``lastMotTestDate`` (NULLs last).

    ``row_number() = 1`` is planned as a WindowGroupLimit whose partial
    step runs before the shuffle, so a key that owns many records is cut to
    one row per map task first.  All NULL keys form one group, as in SQL.
    """
    w = Window.partitionBy(key).orderBy(*_dedupe_order(df, order))
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def prepare_delta(staged: DataFrame, as_of=None, key: str = "registration",
                  order: str = "last_test", on_bad: str = "error") -> DataFrame:
    """The MERGE source: valid modifications, deduped, enriched."""
    return enrich(dedupe_delta(valid_delta(staged), key, order), as_of, on_bad)


def _check_unique(delta: DataFrame, key: str) -> None:
    dup = delta.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").limit(1)
    if dup.count():
        raise ValueError(f"delta has more than one record for some {key}; dedupe it first")


def choose_strategy(delta: DataFrame, key: str, strategy: str, max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS,
                    max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> tuple[str, int]:
    """(form, number of keys) for a checkpointed delta: 'broadcast' if its keys are few
    and short enough, else 'bloom' as long as a filter of them is, else 'shuffle'.

    Keys and their bytes are counted by partial sums.  A broadcast that is asked for is
    checked too: beyond the bounds it is refused."""
    if strategy not in ("auto", "broadcast", "bloom", "shuffle"):
        raise ValueError("strategy must be 'auto', 'broadcast', 'bloom' or 'shuffle'")
    if strategy == "shuffle":
        return strategy, 0
    n, size = delta.select(F.count(key), F.coalesce(F.sum(_length(key)), F.lit(0))).first()
    fits = n <= max_broadcast_keys and size <= max_broadcast_bytes
    if strategy == "broadcast" and not fits:
        raise ValueError(f"{n} delta keys of {size} bytes exceed the broadcast bounds of {max_broadcast_keys} keys "
                         f"and {max_broadcast_bytes} bytes")
    if strategy == "auto":
        strategy = "broadcast" if fits else "bloom" if n * bloom.BITS_PER_KEY <= 8 * bloom.MAX_BYTES else "shuffle"
    return strategy, n


def _length(col: str) -> Column:
    return F.octet_length(F.col(col).cast("string"))


def _checkpointed(df: DataFrame) -> DataFrame:
    # Reliable checkpoint in the shared folder: the delta is read twice
    # (size check + merge) and its lineage (read, dedupe, enrich) is cut.
    from inspecta.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _outer(main: DataFrame, d: DataFrame, key: str, set_cols: list[str], mark: str) -> DataFrame:
    """Full outer join of rows that have keys: main's columns and the action."""
    j = main.alias("m").join(d.alias("d"), F.col(f"m.{key}") == F.col(f"d.{key}"), "full_outer")
    in_main, in_delta = F.col(f"m.{key}").isNotNull(), F.col(f"d.{key}").isNotNull()
    gone = F.col("d.modification") == DELETED
    action = (F.when(in_main & ~in_delta, "keep").when(in_main & gone, "delete").when(in_main, "update")
              .when(gone, "ignore").otherwise("insert"))
    return j.select(*[F.coalesce(F.col(f"m.{key}"), F.col(f"d.{key}")).alias(key) if c == key
                      else F.when(in_delta, F.col(f"d.{c}")).otherwise(F.col(f"m.{c}")).alias(c) if c in set_cols
                      else F.col(f"m.{c}").alias(c) for c in main.columns], action.alias(mark))


def _by_keys(main: DataFrame, d: DataFrame, key: str, set_cols: list[str], mark: str) -> DataFrame:
    """The same with the delta's keys broadcast; main isn't shuffled."""
    dkeys = F.broadcast(d.select(key))
    extra = [c for c in main.columns if c != key and c not in set_cols]
    hit = f"{mark}_hit"
    matched = main.join(dkeys, key, "left_semi").select(key, *extra, F.lit(True).alias(hit))
    gone = F.col("modification") == DELETED
    action = (F.when(F.col(hit) & gone, "delete").when(F.col(hit), "update")
              .when(gone, "ignore").otherwise("insert"))
    changed = d.join(matched, key, "left").withColumn(mark, action).select(*main.columns, mark)
    return main.join(dkeys, key, "left_anti").withColumn(mark, F.lit("keep")).unionByName(changed)


def merged_rows(main: DataFrame, delta: DataFrame, key: str, set_cols: list[str], form: str, n_keys: int = 0,
                mark: str = "_action", buckets: int | None = None, bits_per_key: float = bloom.BITS_PER_KEY,
                block_bits: int = bloom.BLOCK_BITS) -> DataFrame:
    """Rows of main after the merge and what was done to each, one of ``ACTIONS``; rows
    marked delete and ignore are no part of the result.  ``delta`` has ``key``, the
    columns that are set and ``modification``, and at most one row per key."""
    nulls = delta.where(F.col(key).isNull()).withColumn(
        mark, F.when(F.col("modification") == DELETED, "ignore").otherwise("insert"))
    nulls = nulls.select(*[c if c in delta.columns else F.lit(None).cast(main.schema[c].dataType).alias(c) for c in main.columns], mark)
    d = delta.where(F.col(key).isNotNull())
    if buckets:
        d = d.repartition(buckets, key)      # co-partitioned with the bucketed main
    if form == "broadcast":
        return _by_keys(main, d, key, set_cols, mark).unionByName(nulls)
    if form == "bloom":
        may = f"{mark}_may"
        tested = KeyFilter(d, key, n_keys, bits_per_key, block_bits=block_bits).test(main, key, may)
        rest, main = tested.where(~F.col(may)).drop(may), tested.where(may).drop(may)
    else:
        rest, main = main.where(F.col(key).isNull()), main.where(F.col(key).isNotNull())
    return (_outer(main, d, key, set_cols, mark)
            .unionByName(rest.withColumn(mark, F.lit("keep"))).unionByName(nulls))


def upsert(main: DataFrame, delta: DataFrame, key: str = "registration", strategy: str = "auto",
           max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS, duplicates: str = "dedupe",
           checkpoint: bool = True, buckets: int | None = None, report: Observation | None = None, **settings) -> DataFrame:
    """Apply an enriched delta to ``main``; returns the new main rows.

    A delta with two records for a key: ``duplicates='dedupe'`` keeps the one
    ``dedupe_delta`` would, ``'error'`` raises (what a MERGE does on duplicate
    matched source rows), ``'trust'`` skips the test for a delta that is known
    to be deduped.  Records with a NULL key are all inserted.  A column that
    the MERGE sets and main has must be in the delta.  With
    ``buckets=N`` and ``main`` read from a table bucketed by the key into N
    buckets (``write_bucketed``), the join form hash-partitions only the
    delta into the same N buckets: main is joined in place.

    ``report`` is filled with the rows per action when the result is written.  The
    counts are taken behind the last exchange, by the tasks that write, so a lost
    executor doesn't count rows twice.
    """
    missing = [c for c in MERGE_SET_COLUMNS if c in main.columns and c not in delta.columns]
    if missing:
        raise ValueError(f"the delta lacks columns that the merge sets: {missing}")
    delta = valid_delta(delta)   # other or NULL modifications never act (no-op on prepared deltas)
    if duplicates == "dedupe":
        named = dedupe_delta(delta.where(F.col(key).isNotNull()), key)
        delta = named.unionByName(delta.where(F.col(key).isNull()))
    elif duplicates not in ("error", "trust"):
        raise ValueError("duplicates must be 'dedupe', 'error' or 'trust'")
    if checkpoint:
        delta = _checkpointed(delta)
    if duplicates == "error":
        _check_unique(delta, key)
    form, n = ("shuffle", 0) if buckets else choose_strategy(delta, key, strategy, max_broadcast_keys)
    set_cols = [c for c in MERGE_SET_COLUMNS if c in main.columns]
    d = delta.select(key, *set_cols, *[c for c in ("modification",) if c not in set_cols])
    mark = "_action"
    while mark in main.columns:
        mark += "_"
    out = merged_rows(main, d, key, set_cols, form, n, mark, buckets, **settings)
    if report is not None:
        out = out.observe(report, *[F.count_if(F.col(mark) == a).alias(a) for a in ACTIONS])
    return out.where(~F.col(mark).isin("delete", "ignore")).drop(mark)


def matching(main: DataFrame, delta: DataFrame, key: str, strategy: str = "auto",
             max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS) -> DataFrame:
    """Main rows whose key is in the (checkpointed) delta; only these are ever shuffled."""
    form, n = choose_strategy(delta, key, strategy, max_broadcast_keys)
    keys = delta.where(F.col(key).isNotNull()).select(key)
    if form == "broadcast":
        return main.join(F.broadcast(keys), key, "left_semi")
    if form == "bloom":
        main = KeyFilter(keys, key, n).test(main, key, "_may").where("_may").drop("_may")
    return main.where(F.col(key).isNotNull()).join(keys, key, "left_semi")


def merge_actions(main: DataFrame, delta: DataFrame, key: str = "registration",
                  strategy: str = "auto", max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS) -> DataFrame:
    """(key, action) for every main row and every delta record.

    action is one of keep, delete, update, insert, ignore (unmatched delete).
    Only key columns move; main is not shuffled in the broadcast form.
    """
    # keys + action only, read twice (size check and join): checkpointed once
    dk = _checkpointed(valid_delta(delta).select(key, "modification"))
    form, n = choose_strategy(dk, key, strategy, max_broadcast_keys)
    return merged_rows(main.select(key), dk, key, [], form, n, "action")


def merge_report(main: DataFrame, delta: DataFrame, key: str = "registration", **kw) -> DataFrame:
    """Rows per merge action (the DML 'rows affected' report)."""
    return merge_actions(main, delta, key, **kw).groupBy("action").agg(F.count(F.lit(1)).alias("rows"))


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_KEYS,
                    max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df``, checkpointed so that counting and joining don't run its pipeline
    twice, with a broadcast hint when it has at most ``max_rows`` rows of
    ``max_bytes`` in all (as text)."""
    df = _checkpointed(df)
    size = sum((F.coalesce(_length(c), F.lit(0)) for c in df.columns), F.lit(0))
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and total <= max_bytes else df


def new_vehicles(main: DataFrame, delta: DataFrame, key: str = "registration",
                 max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS) -> DataFrame:
    """Delta records that would be inserted (not matched, not DELETED).

    Main is probed map-side with the (size-checked) delta keys; only the
    matched keys, at most one per delta record, take part in the anti join.
    """
    writes = delta.where(F.col("modification") != DELETED)
    wkeys = maybe_broadcast(writes.select(key).where(F.col(key).isNotNull()), max_broadcast_keys)
    matched = main.select(key).join(wkeys, key, "left_semi")
    return writes.join(matched, key, "left_anti")


def drop_deleted(main: DataFrame, delta: DataFrame, key: str = "registration",
                 max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS) -> DataFrame:
    """Main rows that survive the DELETE clause (main not shuffled when the
    DELETED keys fit the broadcast bound)."""
    gone = delta.where(F.col("modification") == DELETED).select(key).where(F.col(key).isNotNull())
    return main.join(maybe_broadcast(gone, max_broadcast_keys), key, "left_anti")
