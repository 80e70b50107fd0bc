"""Secret scan with an incremental blob ledger (DataFrame functions only).

Every version of a file is content-addressed by the SHA-256 of its text.  The
ledger holds one row per (blob, rule version) that has been scanned, with its
findings.  A run dedupes the blobs it is given, scans only the pairs that the
ledger lacks, adds them, and joins findings back to all paths of each blob.

Rules of version 1 (leftmost, non-overlapping, per kind):

* ``assign``  a password-like name, a separator and a value of 6 or more characters
* ``access``  ``AKIA`` followed by upper-case letters and digits, 20 or more in all
* ``hex``     24 or more lower-case hex digits

Spans count code points, end exclusive.  Greedy runs below the least length
can't hide a longer one for ``access`` and ``hex``, so their length is part of
the pattern; ``assign`` is matched whole and short values are dropped after.

Defined cases: null text equals empty text, which has no findings.  Rows that
repeat are kept, each with the findings of its blob.  An empty table gives an
empty result and leaves the ledger as it is.  A ledger that holds a blob twice gives
its findings once.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inspecta.llm.base import stored

RULE_VERSION = 1
KINDS = ("assign", "access", "hex")
# fixed patterns of rule version 1: kind -> (pattern, group that holds the value, least length of it)
PATTERNS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 3, 6),
    "access": (r"(AKIA[A-Z0-9]{16,})", 2, 20),
    "hex": (r"([0-9a-f]{24,})", 2, 24),
}
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEDGER = "blob string, rule_version int, spans array<struct<start:int,kind:int,end:int>>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def may_match(text: Column) -> dict[str, Column]:
    """Cheap tests that are true for every text with a match of the kind."""
    low = F.lower(text)
    named = F.lit(False)
    for n in NAMES:
        named = named | F.contains(low, F.lit(n))
    return {"assign": named, "access": F.contains(text, F.lit("AKIA")),
            "hex": text.rlike("[0-9a-f]{24}")}


def scan(blobs: DataFrame) -> DataFrame:
    """Findings of each row (blob, text): one row (blob, spans) per blob that has any.

    ``\\G`` makes each match begin where the last ended, so a match of the gap
    and the rule together tells both lengths; running sums give positions.
    """
    tests = may_match(F.col("text"))
    hits = None
    for k, kind in enumerate(KINDS):
        pattern, group, least = PATTERNS[kind]
        whole = F.lit(r"(?s)\G(.*?)" + pattern)
        found = (blobs.where(tests[kind])
                 .select("blob", F.posexplode(F.arrays_zip(
                     F.regexp_extract_all("text", whole, F.lit(0)).alias("seg"),
                     F.regexp_extract_all("text", whole, F.lit(1)).alias("gap"),
                     F.regexp_extract_all("text", whole, F.lit(group)).alias("val"))))
                 .select("blob", "pos", F.lit(k).alias("kind"), F.length("col.seg").alias("seg"),
                         F.length("col.gap").alias("gap"), F.length("col.val").alias("val"), F.lit(least).alias("least")))
        hits = found if hits is None else hits.unionByName(found)
    run = F.sum("seg").over(Window.partitionBy("blob", "kind").orderBy("pos")).cast("int")
    spans = (hits.withColumn("end", run)
             .where(F.col("val") >= F.col("least"))
             .select("blob", F.struct((F.col("end") - F.col("seg") + F.col("gap")).alias("start"),
                                      "kind", "end").alias("span")))
    return spans.groupBy("blob").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def update_ledger(spark: SparkSession, files: DataFrame, ledger_path: str,
                  rule_version: int = RULE_VERSION) -> DataFrame:
    """Scan the unseen blobs of ``files`` (blob, text), append them to the ledger
    at ``ledger_path`` and return the ledger's rows of this rule version, one per blob.

    Only texts that may match are moved; of the others the blob alone is."""
    tests = may_match(F.col("text"))
    may = tests["assign"] | tests["access"] | tests["hex"]
    blobs = files.select("blob", F.when(may, F.col("text")).alias("text")).dropDuplicates(["blob"])
    if _exists(spark, ledger_path):
        seen = spark.read.schema(LEDGER).parquet(ledger_path).where(F.col("rule_version") == rule_version)
        blobs = blobs.join(seen.select("blob"), "blob", "left_anti")
    # a clean blob has a row too: one shuffle by blob serves both branches
    found = scan(blobs)
    new = (blobs.select("blob").join(found, "blob", "left")
           .select("blob", F.lit(rule_version).alias("rule_version"),
                   F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("spans")))
    new.write.mode("append").parquet(ledger_path)
    return read_ledger(spark, ledger_path, rule_version)


def read_ledger(spark: SparkSession, ledger_path: str, rule_version: int = RULE_VERSION) -> DataFrame:
    """The ledger's rows of a rule version, one per blob.  Two writers, or a write that was
    done again after its commit was lost, leave a blob twice: then its rows, which are
    equal, are made one."""
    rows = spark.read.schema(LEDGER).parquet(ledger_path).where(F.col("rule_version") == rule_version)
    twice = rows.groupBy("blob").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.limit(1).count():
        return rows
    return stored(rows.groupBy("blob", "rule_version").agg(F.min("spans").alias("spans")), "ledger-once")


def find_secrets(spark: SparkSession, docs: DataFrame, ledger_path: str, id_col: str = "doc_id",
                 text_col: str = "text", rule_version: int = RULE_VERSION) -> DataFrame:
    """Findings of every path: doc_id, blob and spans, an array of
    (start, kind, end) where kind is a position in ``KINDS``."""
    blob = blob_of(docs[text_col])
    files = docs.select(blob.alias("blob"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    ledger = update_ledger(spark, files, ledger_path, rule_version)
    paths = docs.select(docs[id_col].alias("doc_id"), blob.alias("blob"))
    return paths.join(ledger.drop("rule_version"), "blob", "left")


def digest_rows(found: DataFrame) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and spans as text."""
    def count(k: int) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == k)).cast("long")
    kinds = F.array(*[F.lit(k) for k in KINDS])
    text = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(
        ":", F.element_at(kinds, s.kind + 1), s.start.cast("string"), s.end.cast("string"))))
    return found.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
                        F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
