"""Delivery to a service that sends nothing twice, even if a task dies midway and is repeated.

Before rows are sent, a task writes their ids to a claim file of the shared folder; afterwards what became of them to a
result file. A repeated task, or a later run, reads both first: ids with a result are answered from it, ids that were
claimed without a result may or may not have arrived, so the service is asked for them, or they are told as unknown.
Rows are dealt out by a hash of their id to a fixed number of parts, so one part's files are read and written by one task.
"""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Outcomes: delivered now or earlier; surely not delivered, to be tried again by the next run; nobody knows.
SENT, FAILED, UNKNOWN = "sent", "failed", "unknown"


class NotSent(Exception):  # noqa: N818
    """Raised by a ``send`` that knows that the service didn't take the row."""


class _Part:
    """The files of one part."""

    def __init__(self, folder: str, part: int):
        self.fs, top = pafs.FileSystem.from_uri(folder)
        self.claims, self.results = (f"{top}/{kind}/part={part}" for kind in ("claims", "results"))
        for d in (self.claims, self.results):
            self.fs.create_dir(d, recursive=True)
        self.known: dict[str, str | None] = {}
        self.open: set[str] = set()
        self._replay()

    def _names(self, folder: str) -> list[str]:
        return sorted(i.base_name for i in self.fs.get_file_info(pafs.FileSelector(folder)) if i.base_name.endswith(".json"))

    def _read(self, path: str) -> list:
        with self.fs.open_input_stream(path) as f:
            return json.loads(f.read())

    def _write(self, path: str, value: list) -> None:
        """Whole or not at all: readers see only names that end in .json."""
        with self.fs.open_output_stream(f"{path}.tmp") as f:
            f.write(json.dumps(value).encode())
        self.fs.move(f"{path}.tmp", path)

    def _replay(self) -> None:
        """What earlier attempts left: claims in the order of their names, each with its results if it has any."""
        claims, results = self._names(self.claims), set(self._names(self.results))
        self.count = len(claims)
        for name in claims:
            self.open.update(self._read(f"{self.claims}/{name}"))
            if name in results:
                for key, outcome, signal in self._read(f"{self.results}/{name}"):
                    if outcome != UNKNOWN:
                        self.open.discard(key)
                    if outcome == SENT:
                        self.known[key] = signal
        self.open -= set(self.known)

    def claim(self, keys: list[str]) -> str:
        name = f"{self.count:09d}-{uuid.uuid4().hex}.json"
        self.count += 1
        self._write(f"{self.claims}/{name}", keys)
        return name

    def result(self, name: str, rows: list[tuple[str, str, str | None]]) -> None:
        self._write(f"{self.results}/{name}", rows)
        for key, outcome, signal in rows:
            if outcome == SENT:
                self.known[key] = signal
            (self.open.add if outcome == UNKNOWN else self.open.discard)(key)


def _delivered(part: _Part, rows: list[dict], keys: list[str], send, lookup, chunk: int) -> list[tuple[str, str | None]]:
    """(outcome, signal id) of each row. ``chunk`` rows are claimed at once."""
    out: dict[str, tuple[str, str | None]] = {}
    todo, asked = [], []
    for key, row in zip(keys, rows, strict=True):
        if key in part.known:
            out[key] = (SENT, part.known[key])
        elif key in out:
            continue
        elif key in part.open:
            out[key] = (UNKNOWN, None)
            asked.append((key, row))
        else:
            out[key] = (UNKNOWN, None)
            todo.append((key, row))
    if lookup:
        found = [(key, row, lookup(row)) for key, row in asked]
        if there := [(key, SENT, signal) for key, _, signal in found if signal is not None]:
            part.result(part.claim([k for k, _, _ in there]), there)
            out.update({key: (SENT, signal) for key, _, signal in there})
        todo += [(key, row) for key, row, signal in found if signal is None]
    for a in range(0, len(todo), chunk):
        batch, results = todo[a : a + chunk], []
        name = part.claim([key for key, _ in batch])
        for key, row in batch:
            try:
                results.append((key, SENT, send(row)))
            except NotSent:
                results.append((key, FAILED, None))
            except Exception:  # noqa: BLE001
                results.append((key, UNKNOWN, None))
        part.result(name, results)
        out.update({key: (outcome, signal) for key, outcome, signal in results})
    return [out[key] for key in keys]


def deliver_once(rows: DataFrame, send: Callable[[dict], str | None], folder: str, id_col: str = "id", lookup: Callable[[dict], str | None] | None = None, parts: int = 32, chunk: int = 1) -> DataFrame:
    """``(id, signal_id, outcome)``, one row for each input row; computing it again sends nothing again.

    ``send`` gets a row and returns the service's id; it raises :class:`NotSent` if the service surely didn't take the row,
    which is then tried again by the next run. After any other exception, or if a task dies, the row is open: ``lookup``
    gets it in the next run and returns the service's id, or None if the service doesn't have it, and then it is sent.
    Without ``lookup`` it stays unknown. Rows that repeat an id are one delivery; a null id is never sent (failed).

    ``folder`` is a URI that all executors share. ``parts`` must stay the same for a folder. Up to ``chunk`` rows are
    claimed by one file: with 1 at most one row of a dead task is open. Two attempts of one task at a time would send
    twice, so speculative execution is refused.
    """
    spark = rows.sparkSession
    if spark.sparkContext.getConf().get("spark.speculation", "false").lower() == "true":
        raise ValueError("deliver_once needs spark.speculation to be off")
    kind = rows.schema[id_col].dataType.simpleString()
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(parts)).cast("int")).withColumn("_key", F.col(id_col).cast("string"))
    columns = rows.columns

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[int, _Part] = {}
        for batch in batches:
            found = batch.to_pylist()
            told: list[tuple[str, str | None]] = []
            for number, group in itertools.groupby(found, key=lambda r: r["_part"]):
                own = list(group)
                if number not in files:
                    files = {number: _Part(folder, number)}  # rows come ordered by part
                named = [r for r in own if r["_key"] is not None]
                answers = iter(_delivered(files[number], [{c: r[c] for c in columns} for r in named], [r["_key"] for r in named], send, lookup, chunk))
                told += [(FAILED, None) if r["_key"] is None else next(answers) for r in own]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array([s for _, s in told], pa.string()), pa.array([o for o, _ in told], pa.string())], names=[id_col, "signal_id", "outcome"])

    return dealt.repartition(parts, "_part").sortWithinPartitions("_part", "_key").mapInArrow(each, f"`{id_col}` {kind}, signal_id string, outcome string")
