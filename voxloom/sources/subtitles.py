"""Subtitle files as dialogue rows (base, seq, start, end, actor, style, text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions import text as X

COLUMNS = ("base", "seq", "start", "end", "actor", "style", "text")
LINE_ENDS = r"\r\n|[\r\n\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
_CLOCK = r"\d+:\d{2}:\d{2}[,.]\d+"

#: Bases that cut the list of bases into ranges.
PIVOTS = 200


def _kept(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("text", X.clean_text_full(F.col("text"))).where((F.col("end") > F.col("start")) & (F.col("text") != ""))
    return rows.select(*COLUMNS)


def parse_ass(files: DataFrame) -> DataFrame:
    """From (base, text): lines `Dialogue:` of ten comma fields."""
    lines = files.select("base", F.posexplode(F.split("text", LINE_ENDS)).alias("seq", "line"))
    body = F.regexp_extract("line", r"^\s*Dialogue:(.*)$", 1)
    parts = lines.where(F.col("line").rlike(r"^\s*Dialogue:")).select("base", "seq", F.split(body, ",", 10).alias("p")).where("size(p) = 10")
    return _kept(parts.select("base", "seq", X.ass_seconds(X.strip(F.col("p")[1])).alias("start"), X.ass_seconds(X.strip(F.col("p")[2])).alias("end"), X.strip(F.col("p")[4]).alias("actor"), F.when(F.col("p")[3] == "", "Default").otherwise(X.strip(F.col("p")[3])).alias("style"), F.col("p")[9].alias("text")))


def parse_srt(files: DataFrame) -> DataFrame:
    """From (base, text): blocks by blank lines; the first line with an arrow must be a range of times, and what follows it is the text."""
    clean = F.regexp_replace("text", r"\r\n?", "\n")
    blocks = files.select("base", F.posexplode(F.split(clean, r"\n\s*\n")).alias("seq", "block"))
    row = F.regexp_extract("block", r"(?m)^(.*-->.*)$", 1)
    after = F.regexp_replace(F.regexp_extract("block", r"(?s)^.*?-->[^\n]*\n?(.*)$", 1), "\n", " ")
    timed = blocks.where(F.col("block").contains("-->")).withColumn("row", X.strip(row)).where(F.col("row").rlike(rf"^{_CLOCK}\s*-->\s*{_CLOCK}"))
    side = lambda i: X.srt_seconds(X.strip(F.split("row", "-->")[i]))
    return _kept(timed.select("base", "seq", side(0).alias("start"), side(1).alias("end"), F.lit("").alias("actor"), F.lit("Default").alias("style"), after.alias("text")))


def parse_smi(files: DataFrame) -> DataFrame:
    """From (base, text): cues at sync marks; each ends where the next one starts, the last goes."""
    mark = r"(?i)<sync\s[^>]*>"
    starts = F.transform(F.regexp_extract_all("text", F.lit(mark), 0), lambda tag: F.regexp_extract(tag, r"(?i)\bstart\s*=\s*(\d+)", 1))
    bodies = F.slice(F.split("text", mark), 2, F.greatest(F.size(starts), F.lit(1)))
    cues = files.select("base", F.posexplode(F.arrays_zip(starts.alias("start"), bodies.alias("text"))).alias("seq", "cue"))
    timed = cues.select("base", "seq", F.col("cue.start").try_cast("long").alias("ms"), F.col("cue.text").alias("text")).where("ms is not null")
    following = F.lead("ms").over(Window.partitionBy("base").orderBy("seq"))
    paragraph = F.regexp_extract("text", r"(?i)<p\s[^>]*class[^>]*>", 0)
    style = F.regexp_extract(paragraph, r"(?i)\bclass\s*=\s*[\"']?([^\s\"'>]*)", 1)
    ended = timed.withColumn("next", following).where("next is not null")
    return _kept(ended.select("base", "seq", (F.col("ms") / 1000.0).alias("start"), (F.col("next") / 1000.0).alias("end"), F.lit("").alias("actor"), F.when(style == "", "Default").otherwise(style).alias("style"), "text"))


def parse(files: DataFrame) -> DataFrame:
    """Dialogue rows of files (name, text), each by its sniffed format, with that format."""
    sniffed = files.select(X.stem(F.col("name")).alias("base"), "text", X.subtitle_format(F.col("text"), F.col("name")).alias("format"))
    out = None
    for kind, reader in (("ass", parse_ass), ("srt", parse_srt), ("smi", parse_smi)):
        rows = reader(sniffed.where(F.col("format") == kind)).withColumn("format", F.lit(kind))
        out = rows if out is None else out.unionByName(rows)
    return out


def shift(rows: DataFrame, ms: int) -> DataFrame:
    """Moves cues by ms; starts and ends stay at zero or above."""
    moved = lambda c: F.greatest(F.col(c) + ms / 1000.0, F.lit(0.0))
    return rows.withColumn("start", moved("start")).withColumn("end", moved("end"))


def _rows_before(counts: DataFrame) -> DataFrame:
    """(base, _before): rows of all bases that sort before each one.  The PIVOTS bases of the smallest hashes cut the list of bases into ranges; running sums stay inside a range, and one row a range is summed over all."""
    pivots = sorted(r[0] for r in counts.select("base").where("base is not null").orderBy(F.xxhash64("base")).limit(PIVOTS).collect())
    below = F.size(F.filter(F.lit(pivots).cast("array<string>"), lambda p: p <= F.col("base")))
    ranged = counts.withColumn("_range", F.when(F.col("base").isNull(), -1).otherwise(below))
    inside = Window.partitionBy("_range").orderBy("base").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum("_n").alias("_of"))
    before = totals.select("_range", F.coalesce(F.sum("_of").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_lower"))
    return ranged.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(F.broadcast(before), "_range").select("base", (F.col("_in") + F.col("_lower")).alias("_before"))


def slice_manifest(rows: DataFrame, scope: str = "global") -> DataFrame:
    """Manifest rows of dialogue rows in order of base and seq.

    scope `global` numbers over all bases: counts by base and sums over ranges of bases give each one's first number, so
    no task sorts all bases; `local` numbers each base by itself.  Numbers have six digits, or more where they need them.
    """
    local = F.row_number().over(Window.partitionBy("base").orderBy("seq")) - 1
    numbered = rows.withColumn("_i", local)
    if scope == "global":
        counts = rows.groupBy("base").agg(F.count(F.lit(1)).alias("_n"))
        before = _rows_before(counts).withColumnRenamed("base", "_base")
        numbered = numbered.join(before, F.col("base").eqNullSafe(F.col("_base"))).withColumn("_i", F.col("_i") + F.col("_before"))
    joiner = "__" if scope == "global" else "_"
    name = F.concat(F.col("base"), F.lit(joiner), F.format_string("%06d", F.col("_i")), F.lit(".wav"))
    line = X.transcript_line(X.actor(F.col("actor"), F.col("style")), F.col("text")) if scope == "global" else F.col("text")
    return numbered.select(name.alias("filename"), F.col("_i").cast("string").alias("index"), X.fixed6(F.col("start")).alias("timestamp_start"), X.fixed6(F.col("end")).alias("timestamp_end"), line.alias("transcript"))
