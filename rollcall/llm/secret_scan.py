"""Secret scans, in Spark expressions only.

Base spans come from three patterns. The method adds spans by sliding-window Shannon entropy: candidate
strings are runs of key characters; over each, a window moves by one character and keeps the counts of its
characters and the sum of count * log2(count), from which a step takes what leaves and to which it adds
what enters. Hex, base32, other single-case and mixed candidates have thresholds of their own, as their
largest entropies differ. Candidates that an allow-list knows as harmless give no span.

Positions: a pattern is matched together with the gap before it, from where the last match ended (\\G), so
the lengths of gaps and matches add up to code point offsets. Nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (kind, pattern, group whose length counts, least length), in the order of the kinds.
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 3, 6),
    ("access", r"(AKIA[A-Z0-9]+)", 2, 20),
    # As long runs only: a run is matched whole, so its length can be asked for at once.
    ("hex", r"([0-9a-f]{24,})", 2, 24),
)
CANDIDATE = r"([A-Za-z0-9+/_=-]{20,})"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
WINDOW = 20
#: A count of a window's characters takes so many bits, and a word of the scan's state holds so many counts.
COUNT_BITS, COUNTS_A_WORD = 5, 12
#: Least bits a character of a window. Random keys of 20 characters lie around 3.4, 4.0, 3.8 and 3.85.
LEAST_BITS = {"entropy_hex": 3.0, "entropy_mixed": 3.8, "entropy_base32": 3.4, "entropy_base36": 3.5}
#: Candidates of a kind; the others are mixed. The single-case kinds leave out what holds a hex run of BASE: that is
#: found as such, and what stands beside it is judged as mixed.
ALPHABETS = {
    "entropy_hex": r"^([0-9a-f]+|[0-9A-F]+)$",
    "entropy_base32": r"^(?!.*[0-9a-f]{24})([A-Z2-7]+|[a-z2-7]+)$",
    "entropy_base36": r"^(?!.*[0-9a-f]{24})([A-Z0-9]+|[a-z0-9]+)$",
}
#: Candidates that are no secrets.
ALLOWED = (
    r"^[^0-9]*$",  # without a digit: words, headings, rulers
    r"^[^A-Za-z]*$",  # without a letter: numbers, dates, rulers
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    # Words with short numbers behind them, divided: slugs, paths, options. Said by what they don't hold, as a repeated
    # group would take stack for each word of a long one.
    r"^(?=[^/_=-]*[/_=-])(?!.*(?:\+|[0-9]{5}|[0-9][A-Za-z]))",
    r"(?i)^(?!.*(?:(?!example|x{4}|0{6}|123456|abcdef).){20})",  # placeholders: no WINDOW of characters in which none begins
)
KINDS = (*(k for k, *_ in BASE), *LEAST_BITS)

_SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string>"
_SPANS = f"array<{_SPAN}>"


def _matches(text: Column, pattern: str, group: int) -> Column:
    """array<struct<start, end, value>> of the leftmost, non-overlapping matches; value is the group's text."""
    whole = F.lit(rf"\G(?s:(.*?))({pattern})")
    part = lambda i: F.regexp_extract_all(text, whole, F.lit(i))
    steps = F.zip_with(part(1), F.zip_with(part(2), part(group), lambda w, v: F.struct(F.length(w).cast("long").alias("size"), v.alias("value"))), lambda g, m: F.struct(F.length(g).alias("gap"), m["size"].alias("size"), m["value"].alias("value")))

    def placed(own: Column) -> Column:
        ends = _running_sums(F.transform(own, lambda m: m["gap"] + m["size"]))
        return F.zip_with(ends, own, lambda end, m: F.struct((end - m["size"]).alias("start"), end.alias("end"), m["value"].alias("value")))

    return F.when(text.rlike(pattern), _once(steps, placed)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,value:string>>"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running_sums(values: Column) -> Column:
    """Each number plus all before it, in doubled steps: an array that grows by one element at a time is copied each time."""

    def step(sums: Column, by: Column) -> Column:
        shifted = F.concat(F.array_repeat(F.lit(0).cast("long"), by), F.slice(sums, F.lit(1), F.size(sums) - by))
        return F.zip_with(sums, shifted, lambda a, b: a + b)

    doubled = lambda n: F.transform(F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int") - 1), lambda i: F.pow(F.lit(2), i).cast("int"))
    return _once(values, lambda v: F.when(F.size(v) > 1, F.aggregate(doubled(F.size(v)), v, step)).otherwise(v))


def _long(matches: Column, least: int) -> Column:
    return F.filter(matches, lambda m: F.length(m["value"]) >= least)


def _spans(matches: Column, kind: str) -> Column:
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"))).cast(_SPANS)


def hot_range(value: Column, least: Column) -> Column:
    """struct<first, last>: start of the first window of at least `least` bits a character and end of the last; null if none.

    Windows have WINDOW characters. State of the scan: a count for each character of ALPHABET (COUNT_BITS bits each, as
    a step copies the state), the sum of count * log2(count), and what was found.
    """
    term = lambda c: c * math.log2(c) if c > 0 else 0.0
    #: What the sum gains when a count goes up or down by one.
    up, down = (F.array(*[F.lit(term(c + by) - term(c)) for c in range(WINDOW + 2)]) for by in (1, -1))
    # By code, 0 for no character: which word holds its count, at which bit, and one of it.
    places = [(-1, 0, 0), *((i // COUNTS_A_WORD, i % COUNTS_A_WORD * COUNT_BITS, 1 << i % COUNTS_A_WORD * COUNT_BITS) for i in range(len(ALPHABET)))]
    table = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(b).alias("bit"), F.lit(o).cast("long").alias("one")) for w, b, o in places])
    codes = F.transform(F.split(value, ""), lambda x: F.element_at(table, F.position(x, F.lit(ALPHABET)).cast("int") + 1))
    leaving = F.concat(F.array_repeat(F.element_at(table, 1), WINDOW), codes)
    steps = F.zip_with(codes, F.slice(leaving, F.lit(1), F.length(value)), lambda e, x: F.struct(e.alias("enter"), x.alias("leave")))
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), -(-len(ALPHABET) // COUNTS_A_WORD)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0).alias("at"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )
    count = lambda counts, x: F.call_function("shiftright", F.element_at(counts, x["word"] + 1), x["bit"]).bitwiseAND(F.lit((1 << COUNT_BITS) - 1))

    def step(acc: Column, s: Column) -> Column:
        enter, leave = s["enter"], s["leave"]
        same, full = (enter["word"] == leave["word"]) & (enter["bit"] == leave["bit"]), leave["word"] >= 0
        inn = count(acc["counts"], enter) - F.when(same, 1).otherwise(0)
        gain = F.element_at(up, (inn + 1).cast("int")) + F.when(full, F.element_at(down, (count(acc["counts"], leave) + 1).cast("int"))).otherwise(0.0)
        moved = F.transform(acc["counts"], lambda c, k: c + F.when(k == enter["word"], enter["one"]).otherwise(0) - F.when(k == leave["word"], leave["one"]).otherwise(0))
        first, last = seen(acc)
        return F.struct(F.when(same, acc["counts"]).otherwise(moved).alias("counts"), (acc["total"] + gain).alias("total"), (acc["at"] + 1).alias("at"), first, last)

    def seen(acc: Column) -> tuple[Column, Column]:
        """first and last with the window that the state stands at."""
        hot = (acc["at"] >= WINDOW) & (F.lit(math.log2(WINDOW)) - acc["total"] / WINDOW >= least)
        return F.when(acc["first"].isNull() & hot, acc["at"] - WINDOW).otherwise(acc["first"]).alias("first"), F.when(hot, acc["at"]).otherwise(acc["last"]).alias("last")

    return F.aggregate(steps, start, step, lambda acc: F.struct(*seen(acc)))


def _entropy_spans(text: Column) -> Column:
    def kind_of(value: Column) -> Column:
        kind = F.lit("entropy_mixed")
        for name, pattern in reversed(ALPHABETS.items()):
            kind = F.when(value.rlike(pattern), name).otherwise(kind)
        return kind

    def judged(m: Column) -> Column:
        value, kind = m["value"], m["kind"]
        return F.struct(m["start"].alias("start"), hot_range(value, by_kind(kind, LEAST_BITS)).alias("hot"), kind.alias("kind"))

    def by_kind(kind: Column, values: dict) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for k in LEAST_BITS for x in (k, values[k])]), kind)

    def harmless(m: Column) -> Column:
        out = F.lit(False)
        for pattern in ALLOWED:
            out = out | m["value"].rlike(pattern)
        return out

    candidates = F.filter(_matches(text, CANDIDATE, 2), lambda m: ~harmless(m))
    named = F.transform(candidates, lambda m: F.struct(m["start"].alias("start"), m["value"].alias("value"), kind_of(m["value"]).alias("kind")))
    hot = F.filter(F.transform(named, judged), lambda j: j["hot"]["first"].isNotNull())
    rank = lambda j: by_kind(j["kind"], {k: KINDS.index(k) for k in LEAST_BITS})
    return F.transform(hot, lambda j: F.struct((j["start"] + j["hot"]["first"]).alias("start"), rank(j).alias("rank"), (j["start"] + j["hot"]["last"]).alias("end"), j["kind"].alias("kind"))).cast(_SPANS)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, assign, access, hex, entropy of every row of docs(doc_id, text, ...): arrays of spans.

    A span is struct<start, rank, end, kind>, in code points, end exclusive. assign spans are whole
    assignments whose value has 6 characters or more; access ids have 20 or more, hex runs 24 or more. The
    entropy spans reach from the first to the last window above the threshold in a candidate. Null and empty
    texts have no spans; very long ones are scanned whole. Spans of several kinds at one place all stay, in order of
    start, then kind. Rows with equal or null ids are scanned each on its own; extra columns are ignored; an empty
    table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = [_spans(_long(_matches(text, pattern, group), least), kind).alias(kind) for kind, pattern, group, least in BASE]
    return docs.select("doc_id", *base, _entropy_spans(text).alias("entropy"))


def digest(docs: DataFrame) -> DataFrame:
    """op6's columns, from the spans that scan finds."""
    listed = lambda a: F.array_join(F.transform(F.array_sort(a), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.concat("assign", "access", "hex")
    return scan(docs).select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k, *_ in BASE],
        F.size("entropy").cast("long").alias("n_entropy"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.concat(base, F.col("entropy"))).alias("spans"),
    )
