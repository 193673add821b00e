"""A store of flag versions: bitmaps of samples, and a log of what was saved and deleted.

Samples of a frame and band have places (baseline x channels + channel); 64 places make a word, and a version holds two
bitmaps of each word: which samples it knows, and which of them are flagged. Saving, restoring and merging are bit
operations on words. A version's words are written first, by Spark; it counts from the moment its entry is in the log,
which one rename puts there, so a save that breaks off leaves everything as it was.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHANNELS = 16
WORD = ["frame_id", "sub_band", "word"]
WORDS = "frame_id long, sub_band int, word int, known long, flagged long"
MERGES = ("replace", "and", "or")


def place(bl: Column, chan: Column) -> Column:
    return bl.cast("long") * CHANNELS + chan


def pack(flags: DataFrame) -> DataFrame:
    """frame_id, sub_band, word, known, flagged of samples (frame_id, sub_band, bl, chan, flag); of a sample that repeats any flag counts, and a null flag is none."""
    at = place(F.col("bl"), F.col("chan"))
    rows = flags.where(F.col("flag").isNotNull()).select("frame_id", "sub_band", F.floor(at / 64).cast("int").alias("word"), (at % 64).cast("int").alias("n"), "flag")
    rows = rows.withColumn("bit", F.expr("shiftleft(1L, n)"))
    return rows.groupBy(*WORD).agg(F.bit_or("bit").alias("known"), F.coalesce(F.bit_or(F.when(F.col("flag"), F.col("bit"))), F.lit(0).cast("long")).alias("flagged"))


def _put(now: tuple[Column, Column], then: tuple[Column, Column], how: str) -> tuple[Column, Column]:
    """known, flagged of words after a version's are put on them; null stands for no word."""
    known, flagged, k, f = (F.coalesce(c, F.lit(0).cast("long")) for c in (*now, *then))
    outside = k.bitwiseAND(F.bitwise_not(known)).bitwiseAND(f)
    new = {"replace": flagged.bitwiseAND(F.bitwise_not(k)).bitwiseOR(f), "and": flagged.bitwiseAND(f).bitwiseOR(outside), "or": flagged.bitwiseOR(f)}[how]
    return known.bitwiseOR(k), new


def _beside(now: DataFrame, then: DataFrame, kind: str, k: str = "k", f: str = "f") -> DataFrame:
    """Words of `now` with known and flagged of the same word of `then` beside them."""
    side = then.select(*(F.col(c).alias(f"t_{c}") for c in WORD), F.col("known").alias(k), F.col("flagged").alias(f))
    same = [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in WORD]
    return now.join(side, same, kind).select(*(F.coalesce(c, f"t_{c}").alias(c) for c in WORD), *(c for c in now.columns if c not in WORD), k, f)


def _check(how: str) -> None:
    if how not in MERGES:
        raise ValueError(f"a merge is one of {', '.join(MERGES)}")


def merged(now: DataFrame, then: DataFrame, how: str) -> DataFrame:
    """Words of `now` after a version's words are put on them: replace (where the version knows a sample), and, or.

    A sample that the version doesn't know isn't flagged by it, and one that `now` doesn't know is taken from it.
    """
    _check(how)
    known, flagged = _put((F.col("known"), F.col("flagged")), (F.col("k"), F.col("f")), how)
    return _beside(now.select(*WORD, "known", "flagged"), then, "full").select(*WORD, known.alias("known"), flagged.alias("flagged"))


@dataclass
class FlagVersions:
    """Named versions of flags in a shared folder: `words-*` of each, and `log/` of entries in their order."""

    spark: SparkSession
    folder: str

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _fs(self):
        return self._path("log").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _entries(self) -> list[str]:
        fs, log = self._fs(), self._path("log")
        return sorted(x.getPath().getName() for x in fs.listStatus(log) if x.getPath().getName().startswith("entry-")) if fs.exists(log) else []

    def _append(self, entry: dict) -> None:
        """Put an entry behind the others; of two writers at once the second takes the next place."""
        fs = self._fs()
        fs.mkdirs(self._path("log"))
        unsure = self._path(f"log/_{uuid.uuid4().hex}")
        out = fs.create(unsure, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        while True:
            names = self._entries()
            n = int(names[-1].split("-")[1].split(".")[0]) + 1 if names else 1
            to = self._path(f"log/entry-{n:09d}.json")
            if not fs.exists(to) and fs.rename(unsure, to):
                return

    def _live(self) -> dict[str, dict]:
        """Versions by name, in the order in which they were first saved."""
        names = self._entries()
        if not names:
            return {}
        rows = self.spark.read.schema("action string, name string, comment string, words string").json([f"{self.folder}/log/{n}" for n in names])
        held: dict[str, dict] = {}
        for r in sorted(rows.select("*", F.col("_metadata.file_name").alias("at")).collect(), key=lambda r: r["at"]):
            if r["action"] == "save":
                held[r["name"]] = r.asDict()
            else:
                held.pop(r["name"], None)
        return held

    def versions(self) -> list[tuple[str, str]]:
        """(name, comment) of the versions, oldest first."""
        return [(v["name"], v["comment"]) for v in self._live().values()]

    def words(self, name: str) -> DataFrame:
        held = self._live()
        if name not in held:
            raise KeyError(f"no flag version {name}")
        return self.spark.read.schema(WORDS).parquet(f"{self.folder}/{held[name]['words']}")

    def save(self, flags: DataFrame, name: str, comment: str = "", merge: str = "replace") -> None:
        """Save flags (frame_id, sub_band, bl, chan, flag) under a name; `and` and `or` merge them with the version of that name, if there is one."""
        words, held = pack(flags), self._live()
        if merge != "replace" and name in held:
            words = merged(words, self.words(name), merge)
        elif merge not in MERGES:
            raise ValueError(f"a merge is one of {', '.join(MERGES)}")
        to = f"words-{uuid.uuid4().hex}"
        kinds = dict(part.split() for part in WORDS.split(", "))
        typed = words.select(*(F.col(c).cast(t).alias(c) for c, t in kinds.items()))
        typed.sortWithinPartitions("sub_band", "word", "frame_id").write.option("compression", "zstd").parquet(f"{self.folder}/{to}")
        self._append({"action": "save", "name": name, "comment": comment, "words": to})
        if name in held:
            self._fs().delete(self._path(held[name]["words"]), True)

    def delete(self, *names: str) -> None:
        """Delete versions; a name that isn't there is an error, and then none is deleted."""
        held = self._live()
        if missing := [n for n in names if n not in held]:
            raise KeyError(f"no flag version {', '.join(missing)}")
        for n in names:
            self._append({"action": "delete", "name": n, "comment": "", "words": ""})
            self._fs().delete(self._path(held[n]["words"]), True)

    def restore(self, current: DataFrame, *names: str, merge: str = "replace") -> DataFrame:
        """current (frame_id, sub_band, bl, chan, flag, ...) with the flags of versions put on its own, one after the other.

        Rows stay as they are but for `flag`; a null flag is none. `and` keeps a flag that the version has too.
        """
        return self.restore_all(current, {"flag": (merge, names)})

    def restore_all(self, current: DataFrame, ways: dict[str, tuple[str, tuple[str, ...]]]) -> DataFrame:
        """current with a column for each way of restoring, by its name: (merge, names of versions) as for `restore`.

        Rows and each version are read and meet once, however many ways there are; so the words that rows don't have
        aren't asked for.
        """
        for how, names in ways.values():
            if names:
                _check(how)
        versions = {n: i for i, n in enumerate(dict.fromkeys(n for _, names in ways.values() for n in names))}
        words = pack(current).select(*WORD, "known", "flagged")
        for n, i in versions.items():
            words = _beside(words, self.words(n), "left", f"k{i}", f"f{i}")
        new = {}
        for c, (how, names) in ways.items():
            now = (F.col("known"), F.col("flagged"))
            for n in names:
                now = _put(now, (F.col(f"k{versions[n]}"), F.col(f"f{versions[n]}")), how)
            if names:
                new[c] = now[1]
        if not new:
            return current.select("*", *(F.col("flag").alias(c) for c in ways if c != "flag"))
        at = place(F.col("bl"), F.col("chan"))
        rows = current.withColumn("_word", F.floor(at / 64).cast("int")).withColumn("_bit", (at % 64).cast("int"))
        mine = words.select(*(F.col(c).alias(f"_{c}" if c != "word" else "_w") for c in WORD), *(x.alias(f"_flags{i}") for i, x in enumerate(new.values())))
        met = rows.join(mine, (F.col("frame_id") == F.col("_frame_id")) & F.col("sub_band").eqNullSafe(F.col("_sub_band")) & (F.col("_word") == F.col("_w")), "left")
        flags = {c: F.coalesce(F.expr(f"shiftrightunsigned(_flags{i}, _bit)").bitwiseAND(1) == 1, F.lit(False)) for i, c in enumerate(new)} | {c: F.col("flag") for c in ways if c not in new}
        return met.select(*(flags.get(c, F.col(c)).alias(c) for c in current.columns), *(x.alias(c) for c, x in flags.items() if c not in current.columns))

    def sweep(self) -> int:
        """Remove words that no version names, such as those of broken saves; returns how many. Not while a save runs."""
        fs, used = self._fs(), {v["words"] for v in self._live().values()}
        lost = [x.getPath() for x in fs.listStatus(self._path("")) if x.getPath().getName().startswith("words-") and x.getPath().getName() not in used]
        for path in lost:
            fs.delete(path, True)
        return len(lost)
