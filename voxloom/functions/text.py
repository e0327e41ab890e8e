"""Column functions for subtitle text, names and manifest fields."""

from __future__ import annotations

import html
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
MEDIA_EXTENSIONS = ("mp4", "mkv", "avi", "mov", "flv", "webm", "mp3", "aac", "flac", "ogg", "m4a", "wav")
NON_DIALOGUE_STYLES = ("op", "ed", "title", "sign", "kara", "lyric", "gasa", "ruby", "cell", "mail", "phone", "cm", "preview")
MUSIC_MARKS = "♪|♬"
SUBTITLE_RANK = {"ass": 0, "srt": 1, "smi": 2}
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
SNIFF_CHARS = 20_000
NO_SUFFIX = 1_000_000_000

SPACE = r"[\s\p{Z}]+"
#: All characters that count as white space at the ends of a field.
EDGES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(EDGES))


def blank(c: Column) -> Column:
    """Stripped text, the empty string for a null: how a manifest writes a missing value."""
    return F.coalesce(strip(c), F.lit(""))


def safe_int(c: Column, default: int = 0) -> Column:
    return F.coalesce(strip(c).try_cast("int"), F.lit(default))


def safe_float(c: Column, default: float = 0.0) -> Column:
    return F.coalesce(strip(c).try_cast("double"), F.lit(default))


def positive_int(c: Column) -> Column:
    value = strip(c).try_cast("int")
    return F.when(value >= 1, value)


def _clock(c: Column, pattern: str) -> list[Column]:
    return [F.regexp_extract(c, pattern, i) for i in range(1, pattern.count("(") + 1)]


def ass_seconds(c: Column) -> Column:
    """H:M:S.fraction at the start, 0.0 without one."""
    h, m, s = _clock(F.coalesce(c, F.lit("")), r"^(\d+):(\d+):(\d+\.\d+)")
    return F.when(h == "", F.lit(0.0)).otherwise(h.try_cast("double") * 3600 + m.try_cast("double") * 60 + s.try_cast("double"))


def srt_seconds(c: Column) -> Column:
    """H:M:S,fraction or H:M:S.fraction; the fraction counts by its own digits; 0.0 without one."""
    h, m, s, f = _clock(F.coalesce(c, F.lit("")), r"^(\d+):(\d+):(\d+)[,.](\d+)")
    return F.when(h == "", F.lit(0.0)).otherwise(
        h.try_cast("double") * 3600 + m.try_cast("double") * 60 + s.try_cast("double") + f.try_cast("double") / F.pow(F.lit(10.0), F.length(f))
    )


def clean_text(c: Column) -> Column:
    """Subtitle text as plain text; character references of the common kinds (see `clean_text_full`)."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), "\r\n?", "\n")
    c = F.regexp_replace(c, r"\\[Nn]", " ")
    c = F.regexp_replace(c, r"(?i)<br\s*/?>", " ")
    c = F.regexp_replace(c, r"\{[^}\n]*\}", "")
    c = F.regexp_replace(c, r"<[^>]+>", " ")
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    c = F.regexp_replace(c, SPACE, " ")
    return F.trim(c)


@F.pandas_udf(T.StringType())
def unescape(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """All character references of HTML 5."""
    for part in parts:
        yield part.map(lambda t: None if t is None else html.unescape(t))


def clean_text_full(c: Column) -> Column:
    """`clean_text` with every character reference decoded (an Arrow UDF between JVM-side steps)."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), "\r\n?", "\n")
    c = F.regexp_replace(F.regexp_replace(c, r"\\[Nn]", " "), r"(?i)<br\s*/?>", " ")
    c = F.regexp_replace(F.regexp_replace(c, r"\{[^}\n]*\}", ""), r"<[^>]+>", " ")
    return F.trim(F.regexp_replace(unescape(c), SPACE, " "))


def subtitle_format(text: Column, name: Column | None = None) -> Column:
    """smi, ass or srt by the first SNIFF_CHARS characters, else by the extension, else null."""
    head = F.lower(F.substring(text, 1, SNIFF_CHARS))
    by_name = F.when(extension(name).isin(*SUBTITLE_RANK), extension(name)) if name is not None else F.lit(None).cast("string")
    return (
        F.when(head.contains("<sync") | head.contains("<sami"), "smi")
        .when(head.contains("dialogue:") & head.contains("[events]"), "ass")
        .when(head.contains("-->") & head.rlike(r"\d+:\d{2}:\d{2}[,.]\d+"), "srt")
        .otherwise(by_name)
    )


def actor(actor_: Column, style: Column) -> Column:
    """The actor, else what follows the style's first dash, else the style unless it is the default, else Unknown."""
    style = blank(style)
    after = strip(F.regexp_extract(style, r"(?s)^[^-]*-(.*)$", 1))
    return F.coalesce(F.nullif(blank(actor_), F.lit("")), F.nullif(after, F.lit("")), F.when((style != "") & (F.lower(style) != "default"), style), F.lit("Unknown"))


def transcript_line(name: Column, text: Column) -> Column:
    return F.format_string("[%s] %s", name, text)


def fixed6(c: Column) -> Column:
    return F.format_string("%.6f", c.cast("double"))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r".\.([^.]*)$", 1))


def is_media(name: Column) -> Column:
    return F.lower(name).rlike(r"\.(" + "|".join(MEDIA_EXTENSIONS) + ")$")


def is_first_phase(style: Column) -> Column:
    return F.coalesce((style == "Default") | style.rlike(r"^\d+-"), F.lit(False))


def is_second_phase(style: Column, text: Column) -> Column:
    return ~F.coalesce(style, F.lit("")).rlike("(?i)(" + "|".join(NON_DIALOGUE_STYLES) + ")") & ~F.coalesce(text, F.lit("")).rlike(MUSIC_MARKS)


def is_unlabeled(cluster: Column) -> Column:
    return blank(cluster).rlike(r"(?i)^clustering_\d+$")


def is_noise(cluster: Column) -> Column:
    return F.lower(blank(cluster)) == "noise"


def cluster_number(cluster: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(blank(cluster)), r"^clustering_(\d+)$", 1).try_cast("int"), F.lit(NO_SUFFIX))


def label_check(name: Column) -> Column:
    """struct(ok, clean, reason): rules in order are empty, noise, reserved, separator."""
    clean = blank(name)
    reason = F.when(clean == "", "empty").when(is_noise(clean), "noise").when(is_unlabeled(clean), "reserved").when(clean.rlike(r"[/\\]"), "separator").otherwise("")
    return F.struct((reason == "").alias("ok"), clean.alias("clean"), reason.alias("reason"))
