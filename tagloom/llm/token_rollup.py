"""Token counts kept up to date by deltas.

A batch is a table of signed changes: ``+1`` adds a document's count under a source, language and tokenizer version,
``-1`` takes it back, and a revised count is both. A batch is summed per group before it is written, and the totals are
the sums over committed batches, so no change ever reads the documents again.

A commit is the ``_SUCCESS`` marker that Spark's committer puts into the batch's folder. A batch that is committed is
skipped when it comes again; one whose job died leaves no marker, counts for nothing and is overwritten by the retry.
``compact`` replaces the batches it lists by their sum under a new snapshot; one table holds the sum and the list, so both
appear together, and a batch that is committed meanwhile is in neither. A batch that a snapshot holds is skipped too.
The name of a batch begins with a letter or digit, or Spark would not see it.

A text of any length is counted whole. Long runs of blanks, which the tokenizer's patterns can't take, are cut off where
the patterns would cut them. Repeated keys count as often as they stand there.

Null sources, languages and tokenizers are groups of their own; null counts and signs count as zero and no change.
An empty batch commits and changes nothing. Totals of groups without documents left stay at zero.
"""

from __future__ import annotations

import base64
import re
import uuid
from functools import lru_cache, reduce
from operator import or_

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.batches import append_columns
from tagloom.sources.paths import exists

GROUP = ("source", "lang", "tokenizer")
MEASURES = ("docs", "tokens", "chars")
#: How byte-level tokenizers of this family cut a text before they merge (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Blanks as ``\s`` means them there (a fixed value), and how many in a row are taken out of its hands.
_BLANK = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
LONG_RUN = 100_000
_LONG = re.compile(f"{_BLANK}{{{LONG_RUN},}}")
SCHEMA = "source string, lang string, tokenizer string, docs bigint, tokens bigint, chars bigint"


@lru_cache(maxsize=4)
def _encoding(content: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(encoding: tiktoken.Encoding, text: str) -> int:
    """Tokens of a text. A run of blanks ahead of something is a piece of its own but for its last blank."""
    total, start = 0, 0
    for run in _LONG.finditer(text) if len(text) >= LONG_RUN else ():
        stop = run.end() - (run.end() < len(text))
        total += len(encoding.encode_ordinary(text[start : run.start()]))
        total += len(encoding._encode_single_piece(text[run.start() : stop]))
        start = stop
    return total + len(encoding.encode_ordinary(text[start:]))


def with_token_counts(df: DataFrame, rank_file: str, name: str, text: str = "text", where: str = "true") -> DataFrame:
    """``df`` with the tokens of its texts under the version ``name``; null for rows for which ``where`` doesn't hold."""
    return with_versions(df, [(name, rank_file, where)], text)


def with_versions(df: DataFrame, versions: list[tuple[str, str, str]], text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with a count for each (name, file of ranks, condition), null for rows for which the condition doesn't hold.

    Python gets a text once, for all versions together, and doesn't send it back unless the result is to have it.
    """
    contents = []
    for _, rank_file, _ in versions:
        with open(rank_file, "rb") as f:
            contents.append(df.sparkSession.sparkContext.broadcast(f.read()))
    due = [f"_due_{i}" for i in range(len(versions))]
    holds = [F.coalesce(F.expr(where), F.lit(False)) for _, _, where in versions]
    counted = F.when(reduce(or_, holds), F.coalesce(df[f"`{text}`"], F.lit("")))
    rows = df.withColumns({"_counted": counted, **dict(zip(due, holds, strict=True))})
    rows = rows if keep_text else rows.drop(text)

    def compute(texts: pa.Array, batch: pa.RecordBatch) -> list:
        words, columns = texts.to_pylist(), []
        for content, flag in zip(contents, due, strict=True):
            encoding = _encoding(content.value)
            wanted = batch.column(batch.schema.names.index(flag)).to_pylist()
            columns.append([count_tokens(encoding, t) if d else None for t, d in zip(words, wanted, strict=True)])
        return columns

    fields = [T.StructField(name, T.LongType()) for name, _, _ in versions]
    return append_columns(rows, "_counted", fields, compute, keep_text=False).drop(*due)


def signed(df: DataFrame, sign: int, tokenizer: str, tokens: str) -> DataFrame:
    """Changes of one sign from documents with ``source``, ``lang``, a count and ``n_chars``."""
    return df.select(
        "source",
        "lang",
        F.lit(tokenizer).alias("tokenizer"),
        F.lit(sign).alias("sign"),
        F.col(tokens).cast("bigint").alias("tokens"),
        F.col("n_chars").cast("bigint").alias("chars"),
    )


class Rollup:
    """Totals in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, kind: str, name: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", name):
            raise ValueError(f"'{name}' is no name for a batch")
        return f"{self.folder}/{kind}/{name}"

    def _committed(self, kind: str) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{kind}")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(n for n in names if exists(self.spark, f"{self.folder}/{kind}/{n}/_SUCCESS"))

    def _snapshot(self) -> tuple[str | None, set[str]]:
        """The newest snapshot and the batches it holds."""
        snapshots = self._committed("snapshots")
        if not snapshots:
            return None, set()
        path = self._path("snapshots", snapshots[-1])
        held = self.spark.read.schema(f"{SCHEMA}, batch string").parquet(path).filter("batch IS NOT NULL").select("batch")
        return path, {r["batch"] for r in held.collect()}  # names of folders, as their listing has them

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of signed changes; False when it was there already."""
        path = self._path("batches", batch)
        if exists(self.spark, f"{path}/_SUCCESS") or batch in self._snapshot()[1]:
            return False
        sign = F.coalesce(F.col("sign"), F.lit(0)).cast("bigint")
        sums = changes.groupBy(*GROUP).agg(
            F.coalesce(F.sum(sign), F.lit(0)).alias("docs"),
            F.coalesce(F.sum(sign * F.col("tokens")), F.lit(0)).alias("tokens"),
            F.coalesce(F.sum(sign * F.col("chars")), F.lit(0)).alias("chars"),
        )
        sums.write.mode("overwrite").parquet(path)
        return True

    def _listed(self) -> tuple[str | None, set[str], list[str]]:
        """The newest snapshot, the batches it holds, and the committed batches it doesn't hold."""
        snapshot, held = self._snapshot()
        return snapshot, held, [b for b in self._committed("batches") if b not in held]

    def _sums(self, snapshot: str | None, batches: list[str]) -> DataFrame:
        """Totals of exactly these."""
        deltas = self.spark.createDataFrame([], SCHEMA)
        if batches:
            deltas = self.spark.read.schema(SCHEMA).parquet(*[self._path("batches", b) for b in batches])
        if snapshot:
            kept = self.spark.read.schema(f"{SCHEMA}, batch string").parquet(snapshot).filter("batch IS NULL").drop("batch")
            deltas = deltas.unionByName(kept)
        return deltas.groupBy(*GROUP).agg(*[F.sum(m).alias(m) for m in MEASURES])

    def totals(self) -> DataFrame:
        snapshot, _, batches = self._listed()
        return self._sums(snapshot, batches)

    def compact(self) -> None:
        """Sum everything committed into a snapshot, with the names of the batches in it."""
        snapshot, held, batches = self._listed()
        if not batches:
            return
        names = self.spark.createDataFrame([(b,) for b in sorted(held | set(batches))], "batch string")
        whole = self._sums(snapshot, batches).unionByName(names, allowMissingColumns=True)
        number = 1 + len(self._committed("snapshots"))
        whole.write.parquet(self._path("snapshots", f"{number:08d}-{uuid.uuid4().hex}"))
