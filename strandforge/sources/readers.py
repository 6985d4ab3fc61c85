"""File formats: Python data sources for FASTQ, FASTA, SAM and BAM; native readers for annotation and tables.

Register the formats with register_formats(spark). Files are partitions; with the option split_bytes, uncompressed
files of lines (FASTQ, SAM, numbered lines) are read in byte ranges of that size, and load_numbered() numbers their
records through. Paths are listed and opened through pyarrow's file systems, so local and remote stores both work.
"""

from __future__ import annotations

import gzip
import io
import itertools
import re
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..staging import staged

FASTQ = "sample_id string, read_no long, id string, seq string, qual string, path string, part long"
FASTA = "id string, seq string, record_no long, path string"
ALIGNMENT = "sample_id string, rec_no long, qname string, flag int, rname string, pos0 long, mapq int, cigar string, seq string, qual string, xx int, xy int, xj int, xh int, tags map<string,string>, path string, part long"
LINES = "file string, line_no long, line string, part long"
#: The column that numbers a file's records, and that of the file, in formats that can be read in ranges (from byte `part` on).
NUMBERED = {"fastq": ("read_no", "path"), "sam": ("rec_no", "path"), "numbered_lines": ("line_no", "file")}
FEATURE = "seqid string, source string, type string, start1 long, end1 long, score string, strand string, phase string, attributes string"
CLUSTERS = "clust_id string, chr1 string, strand1 string, start1 long, end1 long, chr2 string, strand2 string, start2 long, end2 long, no_splits long, len1 long, len2 long"
STATS = "condition string, replicate string, reads long, aligned long, splits long, multsplits long"


def _filesystem(path: str):
    import pyarrow.fs as fs

    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _files(path: str) -> list[str]:
    import pyarrow.fs as fs

    store, at = _filesystem(path)
    info = store.get_file_info(at)
    if info.type == fs.FileType.Directory:
        found = store.get_file_info(fs.FileSelector(at, recursive=True))
        return sorted((f.path for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))), key=str.lower)
    return [at]


def _open(root: str, path: str) -> io.BufferedIOBase:
    store, _ = _filesystem(root)
    raw = io.BufferedReader(store.open_input_file(path))
    return gzip.GzipFile(fileobj=raw) if raw.peek(2)[:2] == b"\x1f\x8b" else raw


def file_size(root: str, path: str) -> int:
    store, _ = _filesystem(root)
    return store.get_file_info(path).size or 0


def compressed(root: str, path: str) -> bool:
    store, _ = _filesystem(root)
    with store.open_input_file(path) as f:
        return f.read(2) == b"\x1f\x8b"


def sample_of(path: str) -> str:
    """The last three parts of a path without the file's ending: group/condition/sample."""
    parts = re.sub(r"\.(fastq|fq|sam|bam)(\.gz)?$", "", path).split("/")
    return "/".join(parts[-3:])


def lines_between(stream: io.BufferedIOBase, start: int, end: int | None) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that start at or behind start; the caller stops at end or reads on to complete a record."""
    at = start
    if start:
        stream.seek(start - 1)
        # the line that reaches over the start belongs to the range before
        at = start - 1 + len(stream.readline())
    for x in stream:
        yield at, x
        at += len(x)


def whole_lines(stream: io.BufferedIOBase, start: int, end: int | None) -> Iterator[bytes]:
    for at, x in lines_between(stream, start, end):
        if end is not None and at >= end:
            return
        yield x


def fastq_lines_between(stream: io.BufferedIOBase, start: int, end: int | None) -> Iterator[bytes]:
    """The lines of the records whose first line starts in the range."""
    it = lines_between(stream, start, end)
    ahead = [x for _, x in zip(range(7), it)] if start else []
    # a first line has its plus line two below; below a quality line that starts with @ stands a sequence
    first = next((i for i in range(min(4, len(ahead))) if ahead[i][1][:1] == b"@" and i + 2 < len(ahead) and ahead[i + 2][1][:1] == b"+"), None)
    if start and first is None:
        return
    n = 0
    for at, x in itertools.chain(ahead[first or 0 :], it):
        if n % 4 == 0:
            if end is not None and at >= end:
                return
            if not x.strip():
                continue
        yield x
        n += 1


def parse_fastq(lines: Iterator[bytes]) -> Iterator[tuple[str, str, str]]:
    """(id, seq, qual) of four-line records; the last line end may be missing."""
    it = (x.rstrip(b"\r\n") for x in lines)
    for head in it:
        if not head:
            continue
        seq, plus, qual = next(it, b""), next(it, b""), next(it, b"")
        if not head.startswith(b"@") or not plus.startswith(b"+") or len(seq) != len(qual):
            raise ValueError(f"not a FASTQ record: {head[:60]!r}")
        yield head[1:].decode(), re.sub("[^ACGT]", "N", seq.decode().upper().replace("U", "T")), qual.decode()


def parse_fasta(lines: Iterator[bytes]) -> Iterator[tuple[str, str]]:
    name, parts = None, []
    for x in lines:
        x = x.strip().decode()
        if x.startswith(">"):
            if name is not None:
                yield name, "".join(parts)
            name, parts = x[1:].split(" ")[0], []
        elif x:
            parts.append(x.upper())
    if name is not None:
        yield name, "".join(parts)


def parse_gff3(line: bytes) -> tuple | None:
    """The nine fields of an annotation line; None for comments and lines of fewer fields."""
    f = line.rstrip(b"\r\n").decode().split("\t")
    if line.startswith(b"#") or len(f) < 9:
        return None
    return *f[:3], *(int(x) if x.isdigit() else None for x in f[3:5]), *f[5:9]


def parse_sam(lines: Iterator[bytes]) -> Iterator[tuple]:
    """Fields of SAM lines, positions from 0, tags as strings."""
    for x in lines:
        if x.startswith(b"@") or not x.strip():
            continue
        f = x.rstrip(b"\r\n").decode().split("\t")
        tags = {t[:2]: t[5:] for t in f[11:]}
        yield f[0], int(f[1]), f[2], int(f[3]) - 1, int(f[4]), f[5], f[9], f[10], tags


_OPS, _BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
_NUMBERS = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}


def parse_bam(stream: io.BufferedIOBase) -> Iterator[tuple]:
    """The same fields of BAM records (stream: uncompressed; block gzip is read as ordinary gzip)."""
    if stream.read(4) != b"BAM\x01":
        raise ValueError("not a BAM file")
    stream.read(struct.unpack("<i", stream.read(4))[0])
    names = []
    for _ in range(struct.unpack("<i", stream.read(4))[0]):
        n = struct.unpack("<i", stream.read(4))[0]
        names.append(stream.read(n)[:-1].decode())
        stream.read(4)
    while head := stream.read(4):
        b = stream.read(struct.unpack("<i", head)[0])
        ref, pos, l_name, mapq, _, n_op, flag, l_seq = struct.unpack_from("<iiBBHHHi", b)
        at = 32
        qname = b[at : at + l_name - 1].decode()
        at += l_name
        cigar = "".join(f"{v >> 4}{_OPS[v & 15]}" for v in struct.unpack_from(f"<{n_op}I", b, at)) or "*"
        at += 4 * n_op
        packed = b[at : at + (l_seq + 1) // 2]
        seq = "".join(_BASES[v >> 4] + _BASES[v & 15] for v in packed)[:l_seq] or "*"
        at += (l_seq + 1) // 2
        qual = b[at : at + l_seq]
        quals = "*" if not l_seq or qual[0] == 255 else "".join(chr(q + 33) for q in qual)
        at += l_seq
        tags = {}
        while at < len(b):
            tag, kind = b[at : at + 2].decode(), chr(b[at + 2])
            at += 3
            if kind in _NUMBERS:
                tags[tag] = str(struct.unpack_from(_NUMBERS[kind], b, at)[0])
                at += struct.calcsize(_NUMBERS[kind])
            elif kind == "A":
                tags[tag] = chr(b[at])
                at += 1
            elif kind in "ZH":
                end = b.index(0, at)
                tags[tag] = b[at:end].decode()
                at = end + 1
            elif kind == "B":
                sub, n = chr(b[at]), struct.unpack_from("<i", b, at + 1)[0]
                step = struct.calcsize(_NUMBERS[sub])
                tags[tag] = sub + "".join("," + str(struct.unpack_from(_NUMBERS[sub], b, at + 5 + k * step)[0]) for k in range(n))
                at += 5 + n * step
            else:
                raise ValueError(f"unknown tag type {kind!r}")
        yield qname, flag, names[ref] if ref >= 0 else "*", pos, mapq, cigar, seq, quals, tags


def references(stream: io.BufferedIOBase, kind: str) -> Iterator[tuple[str, int]]:
    """(name, length) of the reference sequences that a SAM or BAM file's header names, in its order."""
    if kind == "sam":
        for x in stream:
            if not x.startswith(b"@"):
                return
            f = dict(t.split(":", 1) for t in x.decode().rstrip("\r\n").split("\t")[1:] if ":" in t)
            if x.startswith(b"@SQ") and "SN" in f:
                yield f["SN"], int(f.get("LN", 0))
        return
    if stream.read(4) != b"BAM\x01":
        raise ValueError("not a BAM file")
    stream.read(struct.unpack("<i", stream.read(4))[0])
    for _ in range(struct.unpack("<i", stream.read(4))[0]):
        name = stream.read(struct.unpack("<i", stream.read(4))[0])[:-1].decode()
        yield name, struct.unpack("<i", stream.read(4))[0]


class _File(InputPartition):
    def __init__(self, path: str, start: int = 0, end: int | None = None):
        self.path, self.start, self.end = path, start, end


class _Reader(DataSourceReader):
    def __init__(self, kind: str, root: str, split_bytes: int = 0):
        self.kind, self.root, self.split_bytes = kind, root, split_bytes

    def partitions(self):
        out = []
        for p in _files(self.root):
            size = file_size(self.root, p) if self.split_bytes and self.kind in NUMBERED and not compressed(self.root, p) else 0
            starts = range(0, size, self.split_bytes) if size > self.split_bytes else [0]
            out += [_File(p, s, s + self.split_bytes if len(starts) > 1 else None) for s in starts]
        return out

    def read(self, part):
        path, sample = part.path, sample_of(part.path)
        with _open(self.root, path) as f:
            if self.kind == "references":
                for n, (name, size) in enumerate(references(f, "bam" if path.endswith(".bam") else "sam")):
                    yield name, size, n, path
            elif self.kind == "gff3":
                for n, x in enumerate(f):
                    if (row := parse_gff3(x)) is not None:
                        yield *row, n, path
            elif self.kind == "numbered_lines":
                for n, x in enumerate(whole_lines(f, part.start, part.end)):
                    yield path, n, x.rstrip(b"\r\n").decode(), part.start
            elif self.kind == "fastq":
                for n, (i, s, q) in enumerate(parse_fastq(fastq_lines_between(f, part.start, part.end))):
                    yield sample, n, i, s, q, path, part.start
            elif self.kind == "fasta":
                for n, (i, s) in enumerate(parse_fasta(f)):
                    yield i, s, n, path
            else:
                for n, (*row, tags) in enumerate(parse_sam(whole_lines(f, part.start, part.end)) if self.kind == "sam" else parse_bam(f)):
                    number = [int(tags[t]) if t in tags else None for t in ("XX", "XY", "XJ", "XH")]
                    yield sample, n, *row, *number, tags, path, part.start


def _source(kind: str, ddl: str) -> type[DataSource]:
    class Source(DataSource):
        @classmethod
        def name(cls):
            return kind

        def schema(self):
            return ddl

        def reader(self, schema):
            return _Reader(kind, self.options["path"], int(self.options.get("split_bytes", 0)))

    Source.__name__ = f"{kind.title()}DataSource"
    return Source


FORMATS = {"fastq": FASTQ, "fasta": FASTA, "sam": ALIGNMENT, "bam": ALIGNMENT, "numbered_lines": LINES, "gff3": f"{FEATURE}, line_no long, path string", "references": "name string, length long, ref_no long, path string"}


def register_formats(spark: SparkSession) -> None:
    """Makes spark.read.format("fastq" | "fasta" | "sam" | "bam" | "gff3" | "references" | "numbered_lines") available."""
    from ..shipping import ship

    ship(spark)
    for kind, ddl in FORMATS.items():
        spark.dataSource.register(_source(kind, ddl))


def load_numbered(spark: SparkSession, kind: str, path: str, split_bytes: int) -> DataFrame:
    """The records of uncompressed files read in byte ranges, numbered through each file as if it were read at once.

    A first pass counts the records of each range; one number a range is joined back.
    """
    rows = spark.read.format(kind).option("split_bytes", split_bytes).load(path)
    if kind not in NUMBERED or not any(file_size(path, p) > split_bytes and not compressed(path, p) for p in _files(path)):
        return rows
    number, file = NUMBERED[kind]
    counts = rows.groupBy(file, "part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(file).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = staged(counts.select(file, "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    return rows.join(base, [file, "part"]).withColumn(number, F.col(number) + F.col("_base")).drop("_base").select(rows.columns)


def attribute(column: str, *keys: str):
    """First of the keys that GFF attributes hold (of repeated keys the first value), "" if none."""
    one = [F.expr(f"get(filter(transform(split({column}, ';'), x -> trim(x)), x -> startswith(x, '{k}=')), 0)") for k in keys]
    return F.coalesce(*(F.substring(v, F.lit(len(k) + 2), F.length(v)) for v, k in zip(one, keys)), F.lit(""))


def read_gff3(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(features, junctions) of an annotation file.

    Features are lines without a parent that are not regions; exons are junctions of the last such line above them,
    if they lie inside it. Line order counts, so lines are numbered within their file.
    """
    register_formats(spark)
    rows = spark.read.format("gff3").load(path).withColumnRenamed("path", "file").where("type <> 'region'")
    rows = rows.withColumns({"id": attribute("attributes", "ID"), "parent": attribute("attributes", "Parent"), "name": attribute("attributes", "gene_name", "Name"), "biotype": attribute("attributes", "gene_biotype", "gene_type"), "product": attribute("attributes", "product")})
    no = F.xxhash64("file", "line_no")
    w = Window.partitionBy("file", "seqid").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    top = F.when(F.col("parent") == "", F.struct(no.alias("feature_no"), "start1", "end1"))
    rows = rows.withColumn("owner", F.last(top, ignorenulls=True).over(w))
    features = rows.where("parent = ''").select(no.alias("feature_no"), F.col("seqid").alias("chrom"), F.col("start1").alias("f_start"), F.col("end1").alias("f_end"), F.col("strand").alias("f_strand"), "id", F.when(F.col("name") == "", F.col("id")).otherwise(F.col("name")).alias("name"), "biotype", "product")
    junctions = rows.where("type = 'exon' and parent <> '' and owner.start1 <= start1 and owner.end1 >= end1").select(F.col("owner.feature_no").alias("feature_no"), F.col("seqid").alias("chrom"), F.col("parent").alias("transcript"), "start1", "end1")
    return features, junctions


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=CLUSTERS, enforceSchema=True)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=STATS, enforceSchema=True)


def splits_from_sam(rows: DataFrame) -> DataFrame:
    """Split pairs of a SAM or BAM table in which records 2k and 2k+1 belong together."""
    half = rows.withColumn("pair", F.expr("rec_no div 2"))
    side = lambda k: half.where(f"rec_no % 2 = {k}").select("sample_id", "pair", F.struct("rname", "flag", "pos0", "seq", "cigar", "xx", "xy").alias(f"s{k + 1}"), *(["qname", F.col("tags")["XC"].cast("double").alias("xc"), F.col("tags")["XE"].cast("double").alias("xe"), F.col("tags")["XD"].alias("xd"), F.col("tags")["XA"].alias("xa1")] if k == 0 else [F.col("tags")["XA"].alias("xa2")]))
    return side(0).join(side(1), ["sample_id", "pair"])
