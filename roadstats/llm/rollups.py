"""Token counts as delta-maintained rollups.

Totals by (source, lang, tokenizer) are sums of signed deltas: an insert adds a document and its
tokens, a delete takes them away, and a revised count is a delete of the old and an insert of
the new row, possibly under another tokenizer version. Sums of signed rows can be added in any
order, so a batch is aggregated on its own and only its delta is stored.

A batch commits once: its delta is written to a folder of its own, then a marker named by the
batch id is written in one step if it is absent, and names that folder. Replaying a committed batch
changes nothing; a batch that died before its marker left a folder that nothing names, and one whose
marker is empty (its writer died in an older version) is not committed and can be. ``compact`` folds
the committed deltas into one snapshot; markers stay, so replays are still recognised.

Defined results: a null source, language or tokenizer is a group of its own; null token counts
are 0 tokens of one document. Repeated rows count each. Groups without documents and tokens left
are not shown. An empty batch commits an empty delta. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstats.session import list_dir, new_work_dir, read_small_text, write_small_text

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
#: Tokenizer versions: runs of other than ASCII white space; runs of letters and digits.
TOKENIZERS = {"space-1": r"[^\x20\x09-\x0D]+", "alnum-2": r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}


def inserts(rows: DataFrame) -> DataFrame:
    """Signed rows that add (source, lang, tokenizer, n_tokens)."""
    return rows.select(F.lit(1).alias("sign"), *KEYS, "n_tokens")


def deletes(rows: DataFrame) -> DataFrame:
    return rows.select(F.lit(-1).alias("sign"), *KEYS, "n_tokens")


def revisions(rows: DataFrame) -> DataFrame:
    """Signed rows of (source, lang, tokenizer, n_tokens, new_tokenizer, new_tokens)."""
    new = rows.select("source", "lang", F.col("new_tokenizer").alias("tokenizer"), F.col("new_tokens").alias("n_tokens"))
    return deletes(rows).unionByName(inserts(new))


class Rollup:
    """Totals kept under one folder of the shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _marker(self, batch_id: str) -> str:
        return hashlib.sha256(batch_id.encode()).hexdigest()[:32]

    def commit(self, batch_id: str, signed: DataFrame) -> bool:
        """Add a batch of signed rows; False if it was committed before."""
        marker = self._marker(batch_id)
        if read_small_text(self.spark, f"{self.root}/commits/{marker}") is not None:
            return False
        count = F.coalesce(F.col("n_tokens"), F.lit(0)).cast("bigint")
        delta = signed.groupBy(*KEYS).agg(F.sum(F.col("sign").cast("bigint")).alias("docs"), F.sum(F.col("sign") * count).alias("tokens"))
        folder = f"{marker}-{uuid.uuid4().hex[:8]}"
        delta.write.parquet(f"{self.root}/deltas/{folder}")
        return write_small_text(self.spark, f"{self.root}/commits/{marker}", folder)

    def _folders(self) -> dict[str, str]:
        names = {n.split(".")[0] for n in list_dir(self.spark, f"{self.root}/commits") if not n.startswith(".")}
        found = {n: read_small_text(self.spark, f"{self.root}/commits/{n}") for n in sorted(names)}
        return {n: folder.strip() for n, folder in found.items() if folder}

    def _snapshot(self) -> tuple[str | None, set[str]]:
        for name in sorted((n for n in list_dir(self.spark, f"{self.root}/snapshots") if n.isdigit()), reverse=True):
            text = read_small_text(self.spark, f"{self.root}/snapshots/{name}")
            if text:  # an empty one was never written: the one before holds
                folder, *folded = text.split()
                return folder, set(folded)
        return None, set()

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over all committed batches."""
        folder, folded = self._snapshot()
        folders = [f for n, f in sorted(self._folders().items()) if n not in folded] + ([folder] if folder else [])
        paths = [f"{self.root}/deltas/{f}" for f in folders]
        deltas = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        sums = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> None:
        """Fold the committed deltas into a snapshot, which later totals start from."""
        done = sorted(self._folders())
        number = max((int(n) for n in list_dir(self.spark, f"{self.root}/snapshots") if n.isdigit()), default=-1) + 1
        folder = f"snapshot-{number:08d}-{uuid.uuid4().hex[:8]}"
        self.totals().select(*KEYS, F.col("n_docs").alias("docs"), F.col("n_tokens").alias("tokens")).write.parquet(f"{self.root}/deltas/{folder}")
        write_small_text(self.spark, f"{self.root}/snapshots/{number:08d}", "\n".join([folder, *done]))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four commits over the whole tables: all documents inserted (space-1), those
    of quality 0 deleted, the toxic ones left recounted (alnum-2), and the delete batch replayed."""
    root = sf_dir.rstrip("/")
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text"))
    counted = docs.select(
        "doc_id", "source", "lang", *[F.regexp_count("text", F.lit(p)).cast("bigint").alias(n) for n, p in TOKENIZERS.items()]
    )
    work = new_work_dir(spark, "rollups")
    counted.write.parquet(f"{work}/counts")
    counted = spark.read.parquet(f"{work}/counts")
    labels = spark.read.parquet(f"{root}/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    space = counted.withColumn("tokenizer", F.lit("space-1")).withColumn("n_tokens", F.col("space-1"))
    known = space.join(labels, "doc_id")
    rejected = known.where("quality = 0")
    toxic = known.where("coalesce(quality, 1) <> 0 AND toxic = 1")
    toxic = toxic.withColumn("new_tokenizer", F.lit("alnum-2")).withColumn("new_tokens", F.col("alnum-2"))
    rollup = Rollup(spark, f"{work}/rollup")
    rollup.commit("insert", inserts(space))
    rollup.commit("delete", deletes(rejected))
    rollup.commit("revise", revisions(toxic))
    rollup.commit("delete", deletes(rejected))
    return rollup.totals()
