"""A run folder that remembers which steps are finished, for which inputs.

A step's folder is named after the fingerprint of its inputs, and a small record is written in it
last. A broken run leaves steps without a record, which are done again; a changed input has another
fingerprint, so nothing older is found.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.functions.expr import quoted
from promolens.sources.sinks import read_json_record, write_json_record

_PART = 0xFFFFFF  # 24 bits of a row's hash: their sums fit 64 bits up to 2**39 rows


def fingerprint(*parts: object) -> str:
    """A digest of JSON-like values."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def table_fingerprint(df: DataFrame) -> str:
    """A digest of the schema and the rows of a table, whatever their order and files.

    One aggregate of map-side sums over row hashes: no shuffle of rows. NULLs are hashed by their
    place, repeated rows count. Columns must be hashable, so no maps.
    """
    cells = [part for c in df.columns for part in (quoted(c), quoted(c).isNull())]
    row = df.select(F.xxhash64(*cells, F.lit(0)).alias("h"), F.hash(*cells, F.lit(1)).alias("g"))
    sums = [
        F.sum(F.shiftright("h", bits).bitwiseAND(F.lit(_PART))) for bits in (0, 24, 48)
    ]
    sums.append(F.sum(F.col("g").cast("long").bitwiseAND(F.lit(_PART))))
    total = row.agg(F.count(F.lit(1)), F.bit_xor("h"), *sums)
    return fingerprint(df.schema.jsonValue(), list(total.first()))


@dataclass
class Manifest:
    """Finished steps below ``folder``. ``built`` and ``reused`` list what this object did."""

    spark: SparkSession
    folder: str
    built: list[str] = field(default_factory=list)
    reused: list[str] = field(default_factory=list)

    def step(self, name: str, inputs: str, build: Callable[[str], None]) -> str:
        """The path of the step's output; ``build(path)`` writes it unless it is finished.

        ``build`` must be able to replace what a broken attempt left at the same path, or go on
        from it.
        """
        path = f"{self.folder}/{name}-{inputs[:32]}"
        if self._is_done(path, inputs):
            self.reused.append(name)
        else:
            build(f"{path}/data")
            write_json_record(self.spark, {"step": name, "inputs": inputs}, f"{path}/done")
            self.built.append(name)
        return f"{path}/data"

    def _is_done(self, path: str, inputs: str) -> bool:
        try:
            return read_json_record(self.spark, f"{path}/done").get("inputs") == inputs
        except (AnalysisException, TypeError, ValueError):  # absent, or empty as it broke off
            return False

    def publish(self, names: dict[str, str]) -> None:
        """Name the outputs in use, by role. One small record, written after all of them."""
        write_json_record(self.spark, names, f"{self.folder}/published")

    def published(self) -> dict[str, str]:
        try:
            return read_json_record(self.spark, f"{self.folder}/published")
        except (AnalysisException, TypeError, ValueError) as problem:
            raise FileNotFoundError(f"nothing published in {self.folder}") from problem
