"""Tables whose versions are named by a ledger: numbered entries, of which none is ever replaced.

Data is written under a name of its own first. It counts from the moment when an entry that names it is there, and
an entry's number is taken by one writer only. So a crash at any point leaves the state before in force, and of two writers
that merged into the same state one has to merge again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

KEPT_ENTRIES = 5


class Ledger:
    """Entries 0, 1, 2 ... as small JSON files; the data folders that they name lie beside them."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm.org.apache.hadoop.fs
        self._jvm, self._conf = jvm, spark._jsc.hadoopConfiguration()
        self._folder = jvm.Path(f"{self.path}/ledger")
        self._store = self._folder.getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        if not self._store.exists(self._folder):
            return []
        names = [s.getPath().getName() for s in self._store.listStatus(self._folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        stream = self._store.open(self._jvm.Path(f"{self.path}/ledger/{number:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def newest(self) -> tuple[int, dict]:
        """(-1, {}) before the first entry."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (-1, {})

    def fresh(self, number: int) -> str:
        """A name for data that an entry of this number may count in."""
        return f"data/{number:012d}-{uuid.uuid4().hex}"

    def commit(self, number: int, entry: dict) -> bool:
        """Puts an entry where there is none; False if another writer has taken the number."""
        self._store.mkdirs(self._folder)
        draft, final = (self._jvm.Path(f"{self.path}/ledger/{n}") for n in (f".{uuid.uuid4().hex}", f"{number:012d}.json"))
        out = self._store.create(draft, False)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        options = self.spark.sparkContext._gateway.new_array(self._jvm.Options.Rename, 1)
        options[0] = self._jvm.Options.Rename.NONE  # a target that is there is an error
        try:
            self._jvm.FileContext.getFileContext(self._folder.toUri(), self._conf).rename(draft, final, options)
            return True
        except Exception:
            if not self._store.exists(final):
                raise
            self._store.delete(draft, False)
            return False

    def tidy(self, named: Callable[[dict], set[str]], keep: int = KEPT_ENTRIES) -> None:
        """Drops all but the newest entries, and data older than those that no kept entry names."""
        numbers = self.numbers()
        for n in numbers[:-keep]:
            self._store.delete(self._jvm.Path(f"{self.path}/ledger/{n:012d}.json"), False)
        kept = numbers[-keep:]
        used = {name for n in kept for name in named(self.read(n))}
        folder = self._jvm.Path(f"{self.path}/data")
        for entry in self._store.listStatus(folder) if kept and self._store.exists(folder) else []:
            name = entry.getPath().getName()
            if int(name.split("-")[0]) < kept[0] and f"data/{name}" not in used:
                self._store.delete(entry.getPath(), True)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that merge_table() keeps; None before the first version."""
    _, entry = Ledger(spark, path).newest()
    return spark.read.parquet(f"{path}/{entry['data']}") if entry else None


def merge_table(spark: SparkSession, path: str, merge: Callable[[DataFrame | None], DataFrame], batch: tuple[str, int] | None = None, attempts: int = 10) -> bool:
    """Replaces the table by merge(table); merges again into what another writer has put there meanwhile.

    batch names a stream and its batch: one that was merged before changes nothing, and False is returned.
    """
    ledger = Ledger(spark, path)
    for _ in range(attempts):
        number, entry = ledger.newest()
        done = entry.get("batches", {})
        if batch and done.get(batch[0], -1) >= batch[1]:
            return False
        data = ledger.fresh(number + 1)
        merge(spark.read.parquet(f"{path}/{entry['data']}") if entry else None).write.parquet(f"{path}/{data}")
        if ledger.commit(number + 1, {"data": data, "batches": done | ({batch[0]: batch[1]} if batch else {})}):
            ledger.tidy(lambda e: {e["data"]})
            return True
    raise RuntimeError(f"other writers were first {attempts} times")
