"""Text and format columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
#: a word that is part of this string is attached without a space
PUNCTUATION = ".,!?;:'\")-"


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, _EDGE, "")


def language_code(language: Column) -> Column:
    """The lower-cased part before the first hyphen."""
    return F.lower(F.substring_index(language, "-", 1))


def join_words(words: Column) -> Column:
    """Join an array of words by spaces, attaching punctuation to the word before."""
    spaced = F.transform(words, lambda w, i: F.when((i == 0) | (F.instr(F.lit(PUNCTUATION), w) > 0), w).otherwise(F.concat(F.lit(" "), w)))
    return F.array_join(spaced, "")


def attached(word: Column) -> Column:
    """Whether a word attaches to the one before: it is part of the punctuation string."""
    return F.instr(F.lit(PUNCTUATION), word) > 0


def number(value: Column, digits: int = 1) -> Column:
    """A number with thousands separators; ``n/a`` for null."""
    return F.coalesce(F.format_number(value, digits), F.lit("n/a"))


def bytes_text(value: Column) -> Column:
    """A size in decimal units, halves rounded up; ``n/a`` for null."""
    n = value.cast("bigint")
    scaled = F.when(n >= 1_000_000_000, F.format_string("%.2f GB", n / 1e9)).when(n >= 1_000_000, F.format_string("%.1f MB", n / 1e6)).when(n >= 1000, F.format_string("%.1f KB", n / 1e3))
    return F.coalesce(scaled, F.when(n.isNotNull(), F.format_string("%d B", n)), F.lit("n/a"))


def duration_text(seconds: Column) -> Column:
    """Hours and minutes, minutes and seconds, or seconds; null stays null."""
    s = seconds.cast("double")
    hours, minutes = F.floor(s / 3600), F.floor(s / 60)
    return (
        F.when(s >= 3600, F.format_string("%dh %dm", hours, F.floor((s - hours * 3600) / 60)))
        .when(s >= 60, F.format_string("%dm %ds", minutes, F.floor(s - minutes * 60)))
        .when(s.isNotNull(), F.format_string("%.1fs", s))
    )


def percent(part: Column, whole: Column) -> Column:
    """A share with one decimal; ``n/a`` of nothing."""
    return F.when(whole > 0, F.format_string("%.1f%%", part / whole * 100)).otherwise("n/a")


def clip_name(call_id: Column, turn: Column) -> Column:
    """The file name of an exported turn."""
    return F.format_string("%s_turn_%03d.wav", call_id.cast("string"), turn)


def turn_name(turn: Column, speaker: Column) -> Column:
    """The file name of a turn within its call's folder."""
    return F.format_string("turn_%03d_%s.wav", turn, speaker)


def clip_parts(name: Column) -> Column:
    """Struct (call_id, turn) of an exported file name; null if it has another form."""
    pattern = r"^(.+)_turn_(\d{3})\.wav$"
    return F.when(name.rlike(pattern), F.struct(F.regexp_extract(name, pattern, 1).alias("call_id"), F.regexp_extract(name, pattern, 2).cast("int").alias("turn")))


def call_id_of(path: Column, whole_name: str = "full_normalized.wav") -> Column:
    """The parent folder of a whole call's file, else the file name without its suffix."""
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    return F.when(name == whole_name, F.try_element_at(parts, F.lit(-2))).otherwise(F.regexp_replace(name, r"\.[^.]*$", ""))


def unfenced(text: Column) -> Column:
    """Model output without white space at its ends and without a code fence around it."""
    bare = strip(text)
    inner = strip(F.regexp_replace(F.regexp_replace(bare, r"^```[a-zA-Z]*\s*", ""), r"\s*```\s*$", ""))
    return F.when(bare.startswith("```"), inner).otherwise(bare)


def json_text(text: Column, prefer: str = "object") -> Column:
    """The JSON in noisy model output, else null.

    The whole text if it parses; else what stands between the first and the last bracket of the preferred kind, which must parse; the other
    kind of bracket counts only if the preferred pair is absent.
    """
    bare = unfenced(text)
    pairs = [("{", "}"), ("[", "]")] if prefer == "object" else [("[", "]"), ("{", "}")]

    def between(opening: str, closing: str) -> tuple[Column, Column]:
        first, last = F.instr(bare, opening), F.length(bare) - F.instr(F.reverse(bare), closing) + 1
        last = F.when(F.instr(bare, closing) > 0, last).otherwise(0)
        return (first > 0) & (last > first), F.substring(bare, first, last - first + 1)

    (has1, part1), (has2, part2) = (between(*p) for p in pairs)
    chosen = F.when(has1, part1).when(has2, part2)
    return F.when(valid_json(bare), bare).when(valid_json(chosen), chosen)


def valid_json(text: Column) -> Column:
    """Whether a text is one JSON value."""
    return F.coalesce(F.try_parse_json(text).isNotNull(), F.lit(False))


def data_uri(content: Column, mime: str = "audio/wav") -> Column:
    """A data URI of binary content, without line breaks."""
    return F.concat(F.lit(f"data:{mime};base64,"), F.regexp_replace(F.base64(content), r"[\r\n]", ""))


def utc_iso(moment: Column | None = None) -> Column:
    """A time stamp as ISO-8601 text in UTC."""
    return F.date_format(F.current_timestamp() if moment is None else moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
