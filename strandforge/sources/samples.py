"""The sample catalogue: groups, conditions and samples from directories."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Files of a sample in each subcall, in the order of their names.
ROLES = {
    "preproc": {"SE": ["forward"], "PE": ["forward", "reverse"]},
    "align": {"SE": ["forward"], "PE": ["forward", "R1only", "R1unmerged", "R2only", "R2unmerged"]},
    "detect": {"SE": ["matched"], "PE": ["matched"]},
    "clustering": {"SE": ["multsplits", "single", "splits"], "PE": ["multsplits", "single", "splits"]},
    "analysis": {"SE": ["multsplits", "single", "splits"], "PE": ["multsplits", "single", "splits"]},
}


#: How names of forward and reverse files end (fixed values); what a subcall writes has its own ending instead.
MATES = {"R1": ("_R1", "fwd"), "R2": ("_R2", "rev")}


@dataclass(frozen=True)
class Sample:
    group: str
    condition: str
    files: dict[str, str]

    @property
    def stem(self) -> str:
        base = os.path.basename(next(iter(self.files.values())))
        return base.partition(".")[0]


def add_suffix(path: str, suffix: str, old: tuple[str, ...] = ()) -> str:
    """The file name with suffix before its ending, in place of any of the old suffixes."""
    stem, dot, end = path.rpartition(".")
    for o in old:
        stem = stem.removesuffix(o)
    return f"{stem}{suffix}{dot}{end}"


def replace_directory(path: str, to: str) -> str:
    return os.path.join(to, os.path.basename(path))


def list_files(top: str, skip: tuple[str, ...] = ()) -> list[str]:
    """Files below a directory sorted without regard to case."""
    names = [f for f in os.listdir(top) if f != ".DS_Store" and not f.endswith(skip)] if skip else [f for f in os.listdir(top) if f != ".DS_Store"]
    return sorted((os.path.join(top, f) for f in names), key=str.lower)


def discover(subcall: str, readtype: str, trtms: str, ctrls: str = "") -> list[Sample]:
    """Samples of both groups; entries of a group that are no directories are passed over, a missing one is an error."""
    roles = ROLES[subcall][readtype]
    found = []
    for group, top in (("ctrls", ctrls), ("trtms", trtms)):
        if not top:
            continue
        if not os.path.isdir(top):
            raise FileNotFoundError(top)
        for cond in list_files(top):
            if not os.path.isdir(cond):
                continue
            files = list_files(cond, (".bed", ".txt") if subcall == "detect" else ())
            for i in range(0, len(files) - len(roles) + 1, len(roles)):
                found.append(Sample(group, os.path.basename(cond), dict(zip(roles, files[i : i + len(roles)]))))
    return found


def outputs(subcall: str, readtype: str, sample: Sample, outdir: str) -> dict[str, str]:
    """Names of what a subcall writes for a sample."""
    base = os.path.join(outdir, subcall, sample.group, sample.condition)
    first = replace_directory(next(iter(sample.files.values())), base)
    if subcall == "preproc":
        out = {"forward": add_suffix(first, "_preproc", MATES["R1"])}
        if readtype == "PE":
            names = {"R1": first, "R2": replace_directory(sample.files["reverse"], base)}
            for kind in ("only", "unmerged"):
                for mate, name in names.items():
                    out[mate + kind] = add_suffix(name, f"_{mate}{kind}", MATES[mate])
        return out
    if subcall == "align":
        bam = {role: replace_directory(path, base).rpartition(".")[0] + ".bam" for role, path in sample.files.items()}
        out = {"matched": add_suffix(bam["forward"], "_matched")}
        if readtype == "PE":
            out |= {f"matched_{r}": add_suffix(bam[r], "_matched") for r in ("R1only", "R2only")}
            out["matched_unmerged"] = add_suffix(bam["forward"], "_unmerged_matched", ("_preproc",))
        return out
    if subcall == "detect":
        return {k: add_suffix(first, f"_{k}", ("_matched",)) for k in ("single", "splits", "multsplits")}
    if subcall == "analysis":
        return {"interactions": os.path.join(base, f"{sample.stem.removesuffix('_multsplits')}_interactions.txt")}
    return {}


def catalogue_json(subcall: str, readtype: str, samples: list[Sample], outdir: str) -> str:
    """{subcall: {group: [{condition, samples: [{input, output}]}]}}, with escaped slashes."""
    tree: dict = {}
    for s in samples:
        conditions = tree.setdefault(s.group, [])
        entry = next((c for c in conditions if c["condition"] == s.condition), None)
        if entry is None:
            conditions.append(entry := {"condition": s.condition, "samples": []})
        entry["samples"].append({"input": s.files, "output": outputs(subcall, readtype, s, outdir)})
    return json.dumps({subcall: tree}, indent=4).replace("/", "\\/")


def assign_roles(files: DataFrame, roles: list[str]) -> DataFrame:
    """(group, condition, sample_no, role, path) of a table of files (group, condition, path), by name order."""
    no = F.row_number().over(Window.partitionBy("group", "condition").orderBy(F.lower("path"), "path")) - 1
    names = F.array(*(F.lit(r) for r in roles))
    return files.withColumn("no", no).select("group", "condition", F.expr(f"no div {len(roles)}").cast("long").alias("sample_no"), F.get(names, (F.col("no") % len(roles)).cast("int")).alias("role"), "path")
