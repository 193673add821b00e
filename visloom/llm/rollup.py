"""Delta-maintained token-count rollups.

A change is a signed row: an insert adds a document and its tokens, a delete takes them away, a revision
does both with the old and the new count and keys. Each batch of changes is aggregated to deltas by source,
language and tokenizer version and committed once, under its batch id: committing a batch again changes
nothing. A batch counts when Spark's writer has finished it, and what a broken attempt left does not. Totals
are the sum of all committed deltas; `compact` folds them into one batch that takes the place of those it sums.

`count_tokens` counts with the files of public tokenizers, whose names are the tokenizer versions.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encoder, in_chunks
from .wordscan import texts_of

KEYS = ["source", "lang", "tokenizer"]
DELTAS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def change(kind: str, source: Column, lang: Column, tokenizer: Column, n_tokens: Column) -> Column:
    """A signed change: kind is 'insert' or 'delete'; a null count is 0 tokens."""
    sign = {"insert": 1, "delete": -1}[kind]
    return F.struct(source.alias("source"), lang.alias("lang"), tokenizer.alias("tokenizer"), F.lit(sign).cast("long").alias("n_docs"), (sign * F.coalesce(n_tokens, F.lit(0))).cast("long").alias("n_tokens"))


def inserts(rows: DataFrame) -> DataFrame:
    """Changes that add rows (source, lang, tokenizer, n_tokens)."""
    return rows.select(change("insert", F.col("source"), F.col("lang"), F.col("tokenizer"), F.col("n_tokens")).alias("c")).select("c.*")


def deletes(rows: DataFrame) -> DataFrame:
    """Changes that take rows (source, lang, tokenizer, n_tokens) away."""
    return rows.select(change("delete", F.col("source"), F.col("lang"), F.col("tokenizer"), F.col("n_tokens")).alias("c")).select("c.*")


def revisions(rows: DataFrame) -> DataFrame:
    """Changes from old_* to new_* (tokenizer, n_tokens) of rows (source, lang)."""
    of = lambda kind, age: change(kind, F.col("source"), F.col("lang"), F.col(f"{age}_tokenizer"), F.col(f"{age}_n_tokens"))
    return rows.select(F.explode(F.array(of("delete", "old"), of("insert", "new"))).alias("c")).select("c.*")


_counters: dict[str, Callable[[list[bytes]], list[int]]] = {}


def counter(path: str) -> Callable[[list[bytes]], list[int]]:
    """Counts of ids of texts by a tokenizer's file: a .json with word ends, or a .tiktoken of byte ranks; one a worker process."""
    if path not in _counters:
        if path.endswith(".tiktoken"):
            import public_tokenizers

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            _counters[path] = lambda texts: [len(own.encode_ordinary(t.decode(errors="replace"))) for t in texts]
        else:
            _counters[path] = lambda texts: [len(ids) for ids in encoder(path).encode(texts)]
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, name: str = "n_tokens") -> DataFrame:
    """docs without their text, and each text's number of ids; null and empty texts have none. Repeated rows are kept."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            found: list[int] = []
            for _, some in in_chunks(texts_of(batch.column(len(others)))):
                found += count(some)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(others))), pa.array(found, pa.int64())], names=[*others, name])

    schema = docs.select(*others).schema.add(name, "long")
    return docs.select(*others, "text").mapInArrow(run, schema)


@dataclass
class Rollup:
    """Totals kept as committed deltas in a shared folder: a folder batch=ID each, and folded=ID for what batch ID took the place of."""

    spark: SparkSession
    folder: str

    def _in(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _done(self, name: str) -> bool:
        fs, path = self._in(f"{self.folder}/{name}/_SUCCESS")
        return fs.exists(path)

    def batches(self) -> list[str]:
        """Ids of the batches that count: committed, and not folded into another one."""
        fs, path = self._in(self.folder)
        if not fs.exists(path):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(path)]
        live = {n.removeprefix("batch=") for n in names if n.startswith("batch=") and self._done(n)}
        return sorted(live - set(self._folded(live)))

    def _folded(self, live: set[str]) -> list[str]:
        """Ids that committed batches took the place of."""
        lists = [f"{self.folder}/folded={i}" for i in sorted(live) if self._done(f"folded={i}")]
        return [r["id"] for r in self.spark.read.schema("id string").parquet(*lists).toLocalIterator()] if lists else []

    def committed(self, batch_id: str) -> bool:
        """Whether Spark's writer has finished the batch, or it has been folded since."""
        return self._done(f"batch={batch_id}") or batch_id in self._folded(set(self.batches()))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Commit the batch unless it is committed; returns whether it was new.

        Changes are summed before the shuffle, so a source that holds most of them is one row a task.
        """
        if not batch_id.isalnum():
            raise ValueError("a batch id is letters and digits")
        if self.committed(batch_id):
            return False
        self._write(batch_id, changes)
        return True

    def _write(self, batch_id: str, changes: DataFrame) -> None:
        deltas = changes.groupBy(*KEYS).agg(F.sum("n_docs").cast("long").alias("n_docs"), F.sum("n_tokens").cast("long").alias("n_tokens"))
        deltas.write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def deltas(self) -> DataFrame:
        """Deltas of the batches that count; an empty ledger has none."""
        paths = [f"{self.folder}/batch={i}" for i in self.batches()]
        return self.spark.read.schema(DELTAS).parquet(*paths) if paths else self.spark.createDataFrame([], DELTAS)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of keys that hold documents or tokens; null keys are keys of their own."""
        sums = self.deltas().groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> str | None:
        """Folds the batches that count into a new one and returns its id (None of an empty ledger).

        The list of what it folds is written first. The new batch counts, and the others stop to, when its own writer
        has finished; a compaction that breaks off before leaves all as it was. Folded ids stay committed for ever, and
        the folders of folded batches are removed; one that stays behind by a failure does not count.
        """
        old = self.batches()
        if not old:
            return None
        new = f"c{uuid.uuid4().hex}"
        known = sorted({*old, *self._folded(set(old))})
        self.spark.createDataFrame([(i,) for i in known], "id string").write.parquet(f"{self.folder}/folded={new}")
        self._write(new, self.deltas())
        for i in old:
            for name in (f"batch={i}", f"folded={i}"):
                fs, path = self._in(f"{self.folder}/{name}")
                fs.delete(path, True)
        return new
