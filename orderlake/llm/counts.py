"""Token-count rollups kept up by deltas (operator 7).

Changes arrive in batches: ``insert`` adds a document's count, ``delete`` takes it off,
``revise`` replaces an old count by a new one.  A batch becomes signed rows, which are summed
by source, language and tokenizer version before they are shuffled, and the sums are written
as the batch's delta.  Totals are the sum of the deltas of all committed batches.

A batch is committed when its folder has the writer's success mark.  Committing the same
batch id again does nothing; a folder without the mark is what a failed run left, is not read,
and is written anew.

Cases: null source, language or version is a group of its own; a null count is zero; an empty
batch commits and changes nothing; a group whose rows are all taken back stays with zeros;
an unknown kind of change is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
MEASURES = ["documents", "tokens"]


def signed(changes: DataFrame) -> DataFrame:
    """Signed rows of changes (source, lang, tokenizer, kind, n_tokens, old_tokens).

    insert: +1 document, +n_tokens; delete: -1 document, -n_tokens; revise: n_tokens -
    old_tokens and no document.
    """
    new = F.coalesce(F.col("n_tokens").cast("long"), F.lit(0))
    old = F.coalesce(F.col("old_tokens").cast("long"), F.lit(0))
    kind = F.col("kind")
    wrong = F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce(kind, F.lit("null"))))
    return changes.select(
        *KEYS,
        F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0)
        .otherwise(wrong).cast("long").alias("documents"),
        F.when(kind == "insert", new).when(kind == "delete", -new)
        .when(kind == "revise", new - old).otherwise(0).alias("tokens"))


class Rollup:
    """Totals in a folder that all executors share, one ``delta/batch=<id>`` per batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, batch: str) -> str:
        if not batch or any(c in batch for c in "/=\\ "):
            raise ValueError(f"batch id {batch!r} is no folder name")
        return f"{self.path}/delta/batch={batch}"

    def _files(self, folder: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(folder)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def committed(self, batch: str) -> bool:
        """Whether the batch's folder has the success mark."""
        fs, at = self._files(self._folder(batch) + "/_SUCCESS")
        return bool(fs.exists(at))

    def batches(self) -> list[str]:
        """Ids of the committed batches."""
        fs, at = self._files(f"{self.path}/delta")
        if not fs.exists(at):
            return []
        names = [s.getPath().getName().removeprefix("batch=") for s in fs.listStatus(at)]
        return sorted(n for n in names if self.committed(n))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False if it was committed before (and nothing is done)."""
        if self.committed(batch):
            return False
        delta = signed(changes).groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
        delta.write.mode("overwrite").parquet(self._folder(batch))
        return True

    def totals(self) -> DataFrame:
        """Sums over all committed batches: source, lang, tokenizer, documents, tokens."""
        folders = [self._folder(b) for b in self.batches()]
        schema = ", ".join([*(f"{k} string" for k in KEYS), *(f"{m} long" for m in MEASURES)])
        found = self.spark.read.schema(schema).parquet(*folders) if folders else \
            self.spark.createDataFrame([], schema)
        return found.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
