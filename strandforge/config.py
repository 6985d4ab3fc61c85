"""Options of the engine, from a configuration file and the command line."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Options:
    readtype: str = "SE"
    trtms: str = ""
    ctrls: str = ""
    outdir: str = ""
    threads: int = 1
    quality: int = 20
    mapquality: int = 20
    minlen: int = 15
    splicing: bool = False
    features: str = ""
    overwrite: bool = False
    preproc: bool = False
    modetrm: int = 1
    adpt5: str = ""
    adpt3: str = ""
    wtrim: bool = False
    mmrate: float = 0.1
    wsize: int = 3
    minovlps: int = 5
    dbref: str = ""
    accuracy: int = 90
    minfragsco: int = 18
    minfraglen: int = 20
    minsplicecov: int = 80
    mapq: int = 10
    exclclipping: bool = False
    unprd: bool = False
    unmrg: bool = False
    cmplmin: float = 0.0
    sitelenratio: float = 0.1
    nrgmax: float = 0.0
    clust: bool = True
    clustdist: int = 0
    stats: bool = False
    outcnt: bool = False
    outjgf: bool = False
    #: forms that differ on purpose: see README
    best_by: str = "last"
    energy: str = "existing"
    #: also one file a sample and kind, named as in data.json, and graph.json: written by the driver, file by file
    named: bool = False
    #: other forms of some steps: clusters as "box" (merged until none overlap) or "pairwise" (chains of overlapping pairs),
    #: merged reads with what the mate has before the overlap, reads without their last base, reads one base wider on the left
    linkage: str = "box"
    compat_merge_prefix: bool = False
    compat_drop_last_base: bool = False
    compat_coords: bool = False

    def check(self, subcall: str) -> None:
        if self.linkage not in ("box", "pairwise"):
            raise ValueError(f"unknown linkage {self.linkage!r}")
        if subcall not in SUBCALLS:
            raise ValueError(f"unknown subcall {subcall!r}")
        if not self.trtms:
            raise ValueError("trtms is not set")
        if not self.outdir:
            raise ValueError("outdir is not set")
        if self.readtype not in ("SE", "PE"):
            raise ValueError("readtype is SE or PE")
        if subcall in ("analysis", "complete") and not self.features:
            raise ValueError("features is not set")


SUBCALLS = ("preproc", "align", "detect", "clustering", "analysis", "complete")


def _typed(name: str, text: str):
    kind = {f.name: f.type for f in fields(Options)}.get(name)
    if kind is None:
        raise ValueError(f"unknown option {name!r}")
    if kind == "bool":
        return text.strip().lower() in ("1", "true", "yes")
    return {"int": int, "float": float, "str": str}[kind](text)


def parse_config(text: str) -> dict:
    """`key = value # comment` lines; an empty value leaves the default."""
    found = {}
    for line in text.splitlines():
        line = line.partition("#")[0].strip()
        if not line:
            continue
        key, eq, value = line.partition("=")
        if not eq:
            raise ValueError(f"no '=' in {line!r}")
        if value.strip():
            found[key.strip()] = _typed(key.strip(), value.strip())
    return found


def parse_args(args: list[str]) -> tuple[str, Options]:
    """Subcall and options; the command line goes before the file named by --config."""
    subcall, given, file = "", {}, {}
    rest = list(args)
    while rest:
        a = rest.pop(0)
        if a.startswith("--"):
            key, eq, value = a[2:].partition("=")
            value = value if eq else rest.pop(0)
            if key == "config":
                with open(value, encoding="utf-8") as f:
                    file = parse_config(f.read())
            else:
                given[key] = _typed(key, value)
        else:
            subcall = a
    file.pop("subcall", None)
    return subcall, replace(Options(), **(file | given))
