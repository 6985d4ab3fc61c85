"""Hybridisation energies of duplexes; providers can be exchanged."""

from __future__ import annotations

import re
import subprocess
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stacking energies in kcal/mol of Watson-Crick and G-U neighbours, 5'-3' over 3'-5' (fixed values of the public Turner 2004 set).
STACK = {
    "AU/AU": -0.93, "AU/UA": -1.10, "UA/AU": -1.33, "CG/UA": -2.08, "CG/AU": -2.11, "GC/UA": -2.24, "GC/AU": -2.35, "CG/GC": -2.36, "GC/GC": -3.26, "GC/CG": -3.42,
}
#: Opening of a helix, and a mean for neighbours with G-U pairs.
INITIATION, WOBBLE = 4.09, -1.0
_RESULT = re.compile(r"([.()&]+)\s+\(?\s*(-?\d+(?:\.\d+)?)\s*\)?")


class EnergyProvider(Protocol):
    def __call__(self, splits: DataFrame) -> DataFrame:
        """Adds xe (energy, null if none) and xd (structure, null if none) to rows with seq1, seq2, xa1, xa2."""


def existing_energy(splits: DataFrame) -> DataFrame:
    """Keeps the columns xe and xd that are there already."""
    have = set(splits.columns)
    return splits.withColumns({c: F.lit(None).cast(k) for c, k in (("xe", "double"), ("xd", "string")) if c not in have})


def parse_fold(line: str) -> tuple[str, float] | None:
    """Structure and energy of a folding program's result line; None if it has neither."""
    m = _RESULT.search(line)
    return (m[1], float(m[2])) if m else None


def matched_results(asked: list[str | None], said: str) -> list[tuple[str, float] | None]:
    """A result for each pair asked for, in order; an error if the program gave more or fewer, as no result could then be told."""
    found = [r for r in map(parse_fold, said.splitlines()) if r]
    if len(found) != sum(x is not None for x in asked):
        raise ValueError(f"{len(found)} results of the folding program for {sum(x is not None for x in asked)} pairs")
    results = iter(found)
    return [next(results) if x else None for x in asked]


def stacking_energy(top: str, bottom: str) -> float | None:
    """Nearest-neighbour energy of an aligned duplex (an approximation: no loops, ends or dangles); None without a stack."""
    total, seen = INITIATION, False
    wc = {"AU", "UA", "GC", "CG"}
    for i in range(len(top) - 1):
        p, q = (top[k].replace("T", "U") + bottom[k].replace("T", "U") for k in (i, i + 1))
        if p in wc and q in wc:
            key, turned = f"{p}/{q}", f"{q[::-1]}/{p[::-1]}"
            total += STACK.get(key, STACK.get(turned, WOBBLE))
            seen = True
        elif {p, q} <= wc | {"GU", "UG"}:
            total += WOBBLE
            seen = True
    return round(total, 2) if seen else None


def stacking_udf():
    """Arrow function of both aligned parts -> energy."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([stacking_energy(x, y) if x and y else None for x, y in zip(a, b)], dtype="float64")

    return run


def nearest_neighbour(splits: DataFrame) -> DataFrame:
    """Approximate energies of the aligned parts by stacking alone."""
    return splits.withColumn("xe", stacking_udf()("xa1", "xa2")).withColumn("xd", F.lit(None).cast("string"))


def external_program(command: list[str], timeout: int = 3600) -> EnergyProvider:
    """Energies by a folding program that reads "seq1&seq2" lines; one process for each Arrow batch, not for each pair."""

    def run(splits: DataFrame) -> DataFrame:
        @F.pandas_udf("xe double, xd string")
        def fold(a: pd.Series, b: pd.Series) -> pd.DataFrame:
            asked = [f"{x}&{y}" if x and y else None for x, y in zip(a, b)]
            text = "".join(f"{x}\n" for x in asked if x)
            said = subprocess.run(command, input=text, capture_output=True, text=True, timeout=timeout, check=True).stdout if text else ""
            rows = matched_results(asked, said)
            return pd.DataFrame({"xe": [r[1] if r else None for r in rows], "xd": [r[0] if r else None for r in rows]})

        return splits.withColumn("_fold", fold("seq1", "seq2")).withColumns({"xe": F.col("_fold.xe"), "xd": F.col("_fold.xd")}).drop("_fold")

    return run
