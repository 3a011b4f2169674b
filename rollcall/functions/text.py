"""Scalar rules on names, keys, dates and links, as Column -> Column functions without UDFs.

Rules on white space are Unicode-aware ((?U) in patterns), as Java's defaults are ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark a line of the game's interface, and the marks of computer players.
STOP_WORDS = ("enemies", "spectators", "units", "total", "fps", "units/", "units:", "total:", "spectators:")
AI_MARKS = ("(AI)", "(Al)")

#: <video>_<second>s.png; the video id may hold underscores.
FRAME_NAME = r"^(.*)_(\d+)s\.png$"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def is_frame(name: Column) -> Column:
    return name.rlike(FRAME_NAME)


def frame_video(name: Column) -> Column:
    return F.regexp_extract(name, FRAME_NAME, 1)


def frame_second(name: Column) -> Column:
    return F.regexp_extract(name, FRAME_NAME, 2).try_cast("int")


def strip_frame_suffix(name: Column) -> Column:
    return strip(F.regexp_replace(name, r"_\d+s\.png$", ""))


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def cleaned_name(text: Column) -> Column:
    """Only the characters that names have; white space is none of them."""
    return F.regexp_replace(text, r"[^A-Za-z0-9_\-\[\]()]", "")


#: Any of STOP_WORDS, those that hold another left out.
_STOP = "|".join(w for w in STOP_WORDS if not any(o != w and o in w for o in STOP_WORDS))


def is_gamertag(text: Column) -> Column:
    """Whether a line of recognised text can be a player's name: no interface word, 3 to 24 name characters, not a number or a number with one character after it."""
    # In a lambda, so that the cleaned name is made once for its two tests.
    sound = F.exists(F.array(cleaned_name(text)), lambda c: F.length(c).between(3, 24) & ~c.rlike(r"^[0-9]+.?$"))
    return F.coalesce(~F.lower(text).rlike(_STOP) & sound, F.lit(False))


def strip_leading_junk(text: Column) -> Column:
    """Without digits, white space and CJK ideographs in front."""
    return F.regexp_replace(text, "(?U)^[0-9\\s一-鿿]*", "")


def split_clan_tag(text: Column) -> Column:
    """struct<name, tag>: a bracketed tag in front, brackets of any kind; tag is [..], or null without one."""
    plain = strip(F.regexp_replace(text, r"\*", ""))
    pattern = r"(?U)^[\[({]([^\])}]+)[\])}]\s*(.+)$"
    has = plain.rlike(pattern)
    return F.struct(
        F.when(has, strip(F.regexp_extract(plain, pattern, 2))).otherwise(plain).alias("name"),
        F.when(has, F.concat(F.lit("["), F.regexp_extract(plain, pattern, 1), F.lit("]"))).alias("tag"),
    )


def has_ai_mark(names: Column) -> Column:
    return F.coalesce(F.exists(names, lambda x: F.coalesce(x.contains(AI_MARKS[0]) | x.contains(AI_MARKS[1]), F.lit(False))), F.lit(False))


def distinct_names(names: Column) -> Column:
    """Distinct names that are neither null nor empty; null gives an empty array."""
    return F.coalesce(F.array_distinct(F.filter(names, lambda x: x.isNotNull() & (x != ""))), F.array().cast("array<string>"))


def or_default(value: Column, default: str) -> Column:
    """default for null or empty."""
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit(default)).otherwise(value)


def field_or_default(document: Column, field: str, default: str) -> Column:
    """A field of a VARIANT as text: default where it is absent, null where it is null, text as it is, also empty."""
    path = f"$['{field}']"
    return F.when(F.try_variant_get(document, path, "variant").isNull(), F.lit(default)).otherwise(F.try_variant_get(document, path, "string"))


def upload_day(text: Column) -> Column:
    """yyyymmdd as a date, strictly; anything else is null."""
    return F.when(text.rlike(r"^[0-9]{8}$"), F.try_to_date(text, "yyyyMMdd"))


def upload_number(text: Column) -> Column:
    return text.try_cast("int")


def battle_day(timestamp: Column) -> Column:
    """The date of an ISO timestamp: cut at the first point, without Z; null if it doesn't parse."""
    return F.try_to_timestamp(F.replace(F.split_part(timestamp, F.lit("."), F.lit(1)), F.lit("Z"), F.lit(""))).cast("date")


def minutes_seconds(seconds: Column) -> Column:
    """M:SS, minutes unbounded."""
    return F.format_string("%d:%02d", (seconds / 60).cast("int"), seconds % 60)


def display_date(text: Column) -> Column:
    """yyyymmdd as 'Fri Jan 05 2024', in UTC; text that is no date passes as it is."""
    return F.coalesce(F.date_format(upload_day(text), "EEE MMM dd yyyy"), text)


def encode_component(text: Column) -> Column:
    """Percent-encoding as in URL components: space is %20, and ~ ! ' ( ) stay."""
    out = F.replace(F.url_encode(strip(text)), F.lit("+"), F.lit("%20"))
    for code, char in (("%7E", "~"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def watch_url(video_id: Column, seconds: Column | None = None) -> Column:
    url = F.concat(F.lit("https://www.youtube.com/watch?v="), video_id)
    return url if seconds is None else F.concat(url, F.lit("&t="), seconds.cast("string"), F.lit("s"))


def thumbnail_url(video_id: Column) -> Column:
    return F.concat(F.lit("https://i.ytimg.com/vi/"), video_id, F.lit("/mqdefault.jpg"))


def replay_url(battle_id: Column, base: str) -> Column:
    return F.concat(F.lit(base), battle_id)


def header_text(headers: Column) -> Column:
    """A map of HTTP headers as 'k: v' lines, each ended by CR LF."""
    return F.array_join(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit("\r\n"))), "")


def rounded_score(score: Column) -> Column:
    """Two decimals, half to even."""
    return F.bround(score, 2)
