"""Lines that many documents share, by levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, with A-Z in lower case. Keys of enough code points that
enough documents hold stay in one document only, that of the largest id. Documents come in batches of falling ids.
Each batch's keys are merged against the runs that earlier batches have left: those found there have a document of
a larger id, the others are new, and with the largest id that holds them they become the batch's own run, sorted by
hash. So no key is in two runs, and a run's rows say which document keeps a line. When `FANOUT` runs of a level are
there, they are merged into one of the next level, so that few runs are ever read.

Everything is said in DataFrame functions. Keys are two 64-bit hashes; a line that most documents hold is summed
within tasks before it is shuffled, and where rows of documents meet the runs, Spark splits it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import new_dir, store

#: White space at a line's ends.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Batches that a table is dealt into, and runs of one level that become one of the next.
BATCHES, FANOUT = 6, 3
KEY = ["h1", "h2"]
_ROW = ["doc_id", "t1", "t2"]


def line_key(line: Column) -> Column:
    """The line stripped of white space, A-Z in lower case and nothing else."""
    bare = F.trim(line, F.lit(BLANKS))
    # Lower-casing of ASCII alone touches nothing but A-Z, and takes a fraction of the time.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, SMALL))


def lines_of(text: Column) -> Column:
    """Parts between line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _hashes(of: Column) -> list[Column]:
    return [F.xxhash64(F.lit(1), of), F.xxhash64(F.lit(2), of)]


def hash_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, t1, t2 (of the text), lines (pos, h1, h2) of the lines whose keys have min_chars code points or more; documents without one are left out."""
    keyed = F.transform(lines_of(F.col("text")), lambda line, pos: F.struct(pos.alias("pos"), line_key(line).alias("key")))
    long = F.filter(keyed, lambda x: F.char_length(x["key"]) >= min_chars)
    h1, h2 = (lambda x: _hashes(x["key"])[0]), (lambda x: _hashes(x["key"])[1])
    lines = F.transform(long, lambda x: F.struct(x["pos"].alias("pos"), h1(x).alias("h1"), h2(x).alias("h2")))
    t1, t2 = _hashes(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", t1.alias("t1"), t2.alias("t2"), lines.alias("lines")).where(F.size("lines") > 0)


def keys_of(hashed: DataFrame) -> DataFrame:
    """batch, doc_id, h1, h2: each key of a row once."""
    own = F.array_distinct(F.transform("lines", lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"))))
    return hashed.select("batch", "doc_id", F.explode(own).alias("k")).select("batch", "doc_id", "k.h1", "k.h2")


@dataclass
class LineRuns:
    """Runs of (h1, h2, doc_id, batch) in a shared folder, one folder `run-FIRST-LAST` for the batches that it holds.

    A run counts when Spark's writer has finished it and no wider finished run holds its batches, so a batch or merge
    that breaks off leaves all as it was, and a batch that is given again is not added twice.
    """

    spark: SparkSession
    folder: str
    fanout: int = FANOUT

    def live(self) -> list[tuple[int, int]]:
        """(first, last) batch of each run that counts."""
        top = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(top):
            return []
        paths = [x.getPath() for x in fs.listStatus(top)]
        done = [p.getName() for p in paths if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        spans = sorted(tuple(map(int, name.split("-")[1:])) for name in done)
        return [(a, b) for a, b in spans if not any((c, d) != (a, b) and c <= a and b <= d for c, d in spans)]

    def _path(self, span: tuple[int, int]) -> str:
        return f"{self.folder}/run-{span[0]:06d}-{span[1]:06d}"

    def _write(self, rows: DataFrame, span: tuple[int, int]) -> None:
        rows.sortWithinPartitions(*KEY).write.mode("overwrite").option("compression", "zstd").parquet(self._path(span))

    def read(self, spans: list[tuple[int, int]]) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, doc_id long, batch int").parquet(*map(self._path, spans))

    def add(self, batch: int, keys: DataFrame) -> None:
        """Add the keys (h1, h2, doc_id; each once) of a batch that no run holds; batches are numbered 0, 1, ..."""
        live = self.live()
        if any(a <= batch <= b for a, b in live):
            return
        # Merged by hash on either side, the new keys lie sorted as the run wants them.
        new = keys.join(self.read(live).select(*KEY).hint("merge"), KEY, "left_anti") if live else keys
        self._write(new.select(*KEY, "doc_id", F.lit(batch).alias("batch")), (batch, batch))
        self.compact()

    def level(self, span: tuple[int, int]) -> int:
        held, n = span[1] - span[0] + 1, 0
        while held >= self.fanout:
            held, n = held // self.fanout, n + 1
        return n

    def compact(self) -> None:
        """Merge the newest `fanout` runs while they are of one level."""
        live = self.live()
        while len(last := live[-self.fanout :]) == self.fanout and len({self.level(x) for x in last}) == 1:
            self._write(self.read(last).repartition(*KEY), (last[0][0], last[-1][1]))
            live = self.live()

    def rows(self) -> DataFrame | None:
        """h1, h2, doc_id, batch of all keys; None before the first batch."""
        live = self.live()
        return self.read(live) if live else None


def _batch_of(docs: DataFrame, n: int) -> Column:
    """Batches 0, 1, ... of falling ids, of about equal sizes; a null id is in the last. Results don't depend on the cuts."""
    parts = [i / n for i in range(1, n)]
    cuts = docs.select(F.percentile_approx("doc_id", parts, 1000).alias("c")).first()["c"] or []
    at = F.lit(0)
    for cut in sorted(set(cuts)):
        at = at + F.when(F.col("doc_id").isNull() | (F.col("doc_id") <= cut), 1).otherwise(0)
    return at


def shared_keys(hashed: DataFrame, min_docs: int) -> DataFrame:
    """batch, h1, h2, doc_id (the largest in the batch) of keys that min_docs rows or more of all batches hold.

    A key is summed within tasks and batches first, so the sum over batches meets a few rows of it only.
    """
    own = keys_of(hashed).groupBy("batch", *KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("doc_id"))
    return own.withColumn("n", F.sum("n").over(W.partitionBy(*KEY))).where(F.col("n") >= min_docs).drop("n")


def shared_lines(docs: DataFrame, min_chars: int, min_docs: int, batches: int = BATCHES) -> DataFrame:
    """doc_id, t1, t2, dropped (places of lines to drop, from 0) of the documents that lose lines."""
    spark = docs.sparkSession
    folder = new_dir(spark, "lines")
    hashed = store(hash_lines(docs, min_chars).withColumn("batch", _batch_of(docs, batches)), folder, "hashed")
    own = store(shared_keys(hashed, min_docs), folder, "own")
    runs = LineRuns(spark, f"{folder}/runs")
    for batch in range(batches):
        runs.add(batch, own.where(F.col("batch") == batch).drop("batch"))
    keeper = runs.rows().select(*KEY, F.col("doc_id").alias("keeper"))
    places = hashed.select(*_ROW, F.explode("lines").alias("x")).select(*_ROW, "x.pos", "x.h1", "x.h2")
    met = places.join(keeper, KEY).where(~F.col("keeper").eqNullSafe(F.col("doc_id")))
    return met.groupBy(*_ROW).agg(F.collect_set("pos").alias("dropped"))


def drop_shared_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = BATCHES) -> DataFrame:
    """docs (doc_id, text, ...) with their text without the lines that other documents keep, n_lines (before), n_dropped.

    A line whose key has min_chars code points or more and is held by min_docs rows or more stays only in the rows of
    the largest doc_id that holds it, there in all its places. Null and empty texts are one empty line, and their text
    comes back empty. A null id is below all others; where only rows without an id hold a key, they keep it. Rows that
    repeat an id count each and are treated alike. An empty table gives none. Other columns stay, and a column
    n_lines or n_dropped is replaced.
    """
    lost = shared_lines(docs, min_chars, min_docs, batches).withColumnsRenamed({c: f"lost_{c}" for c in (*_ROW, "dropped")})
    t1, t2 = _hashes(F.coalesce("text", F.lit("")))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", t1.alias("t1"), t2.alias("t2"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("lost_doc_id")) & (F.col("t1") == F.col("lost_t1")) & (F.col("t2") == F.col("lost_t2"))
    met = rows.join(lost, same, "left").withColumn("lines", lines_of(F.col("text")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "lost_dropped")
    text = F.when(F.col("lost_dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    n = F.coalesce(F.size("lost_dropped"), F.lit(0))
    new = {"text": text, "n_lines": F.size("lines").cast("long"), "n_dropped": F.greatest(n, F.lit(0)).cast("long")}
    columns = [*docs.columns, *(c for c in new if c not in docs.columns)]
    return met.select(*(new[c].alias(c) if c in new else F.col(f"doc.`{c}`").alias(c) for c in columns))
