"""Secret scans: sliding-window Shannon entropy over candidate strings (operator 4).

DataFrame functions only. Matches of a pattern and the gaps between them give the
positions. A window of a candidate is slid character by character: its counts, one for each
character of the class's alphabet, are carried along packed into whole numbers, and a step takes out the
character that leaves and puts in the one that enters, so that the work grows with the candidate's length alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kind, pattern, least characters, and the group they are counted in. The order settles ties.
#: A run of 32 hexadecimal digits or more is a whole run, so its pattern can ask for the length.
BASE_KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 1),
    ("access", "AKIA[A-Z0-9]+", 16, 0),
    ("hex", "[0-9a-f]{32,}", 32, 0),
)
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="


@dataclass(frozen=True)
class CharacterClass:
    """Candidates of a class, their alphabet, the window slid over them, and the least entropy in bits that some window must have."""

    kind: str
    pattern: str
    window: int
    bits: float
    needs: tuple[str, ...] = ()
    alphabet: str = BASE64


#: Candidate strings must mix letters and digits: long words of prose are none.
CLASSES = (
    CharacterClass("entropy_hex", "[0-9A-Fa-f]{24,}", 24, 3.0, ("[0-9]", "[A-Fa-f]"), "0123456789abcdefABCDEF"),
    CharacterClass("entropy_base64", "[A-Za-z0-9+/_-]{20,}={0,2}", 20, 3.7, ("[0-9]", "[a-z]", "[A-Z]")),
    CharacterClass("entropy_single_case", "[a-z0-9]{24,}|[A-Z0-9]{24,}", 24, 3.6, ("(?:[0-9].*){4}", "[A-Za-z]")),
)
#: Parts that are known to be harmless: words of examples, and what looks random but is an identifier, an alphabet or a run. They are taken out, and what is left of a candidate is scored.
HARMLESS = r"(?i:example|sample|dummy|placeholder|changeme|redacted)|(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|abcdefghij|0123456789|1234567890)|(.)\1{5,}"
#: Matches whose places are added up in one go.
BLOCK = 256
#: Bits of a packed count, and the counts in a whole number. A window has fewer than 2^5 characters.
COUNT_BITS, PACKED = 5, 12
#: Sums of c log2 c are whole numbers of this part, so that no step loses anything.
UNIT = 1 << 32


def _n(x: int) -> Column:
    return F.lit(x).cast("long")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(text: Column, pattern: str, struct: Callable[[Column, Column, Column], Column], empty: Column) -> Column:
    """`struct(gap, match, start of the gap)` for each gap between matches and the match behind it (null for the last).

    Starts are prefix sums in code points, over blocks of pairs and then inside a block, so that no long array is copied for each pair.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("body"))
    size = lambda p: F.char_length(p["gap"]) + F.coalesce(F.char_length(p["body"]), F.lit(0))

    def one(acc: Column, p: Column) -> Column:
        return F.struct((acc["at"] + size(p)).alias("at"), F.concat(acc["out"], F.array(struct(p["gap"], p["body"], acc["at"]))).alias("out"))

    def block(acc: Column, own: Column) -> Column:
        done = F.aggregate(own, F.struct(acc["at"].alias("at"), empty.alias("out")), one)
        return bound(done, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], F.array(x["out"])).alias("out")))

    def blocks(all_: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), lambda i: F.slice(all_, i * BLOCK + 1, BLOCK))
        return F.aggregate(parts, F.struct(_n(0).alias("at"), F.filter(F.array(empty), lambda _: F.lit(False)).alias("out")), block, lambda acc: F.flatten(acc["out"]))

    return bound(pairs, blocks)


def _none(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


SPAN = "struct<start:bigint,end:bigint,rank:int,kind:string,body:string>"


def located(text: Column, pattern: str, rank: int, kind: str) -> Column:
    """All matches of `pattern`, leftmost first, as spans in code points with their strings."""

    def span(gap: Column, body: Column, at: Column) -> Column:
        start = at + F.char_length(gap)
        return F.struct(start.alias("start"), (start + F.char_length(body)).alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), body.alias("body"))

    return F.when(text.rlike(pattern), F.filter(_pieces(text, pattern, span, _none(SPAN)), lambda s: s["body"].isNotNull())).otherwise(_none(SPAN))


def _base_spans(text: Column, rank: int, kind: str, pattern: str, least: int, group: int) -> Column:
    return F.filter(located(text, pattern, rank, kind), lambda s: F.char_length(F.regexp_extract(s["body"], pattern, group)) >= least)


def _masked(text: Column, pattern: str, least: int, group: int) -> Column:
    """The text with the pattern's matches of `least` characters or more as blanks of the same number."""

    def masked(t: Column) -> Column:
        blank = lambda m: F.when(F.char_length(F.regexp_extract(m, pattern, group)) >= least, F.repeat(F.lit(" "), F.char_length(m))).otherwise(m)
        found = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), blank)
        both = F.zip_with(F.split(t, pattern, -1), found, lambda gap, m: F.concat(gap, F.coalesce(m, F.lit(""))))
        return F.when(t.rlike(pattern), F.array_join(both, "")).otherwise(t)

    return bound(text, masked)


def peak_entropy(body: Column, window: int, alphabet: str = BASE64) -> Column:
    """The largest Shannon entropy, in bits a character, of any window of `body`; negative if it is shorter than a window.

    With counts c in a window of w characters the entropy is log2 w - sum(c log2 c) / w. The counts are carried along, `PACKED` of them
    to a whole number, and so is the sum: a step looks up and changes the count of the character that leaves
    and of the one that enters. Characters outside the alphabet count as one.
    """
    assert window < 1 << COUNT_BITS
    words = -(-(len(alphabet) + 1) // PACKED)
    weight = F.expr(f"array({', '.join(f'{round(c * math.log2(c) * UNIT) if c else 0}L' for c in range(window + 2))})")
    chars = F.filter(F.split(body, ""), lambda c: c != "")

    def cell(char: Column) -> Column:
        shift = F.pmod(F.instr(F.lit(alphabet), char), F.lit(PACKED)) * COUNT_BITS
        word = F.floor(F.instr(F.lit(alphabet), char) / PACKED).cast("int")
        return F.struct(word.alias("word"), shift.alias("shift"), F.call_function("shiftleft", _n(1), shift).alias("one"))

    cells = F.transform(chars, cell)

    def slid(cells: Column) -> Column:
        steps = F.transform(cells, lambda c, i: F.struct(c.alias("enters"), F.get(cells, i - window).alias("leaves"), i.alias("i")))

        def count(acc: Column, cell: Column) -> Column:
            return F.call_function("shiftright", F.get(acc["counts"], cell["word"]), cell["shift"]).bitwiseAND(_n((1 << COUNT_BITS) - 1))

        def step(acc: Column, s: Column) -> Column:
            x, y = s["enters"], s["leaves"]
            gone = F.coalesce(count(acc, y), _n(0))
            here = count(acc, x) - F.when(y.isNotNull() & (x["word"] == y["word"]) & (x["one"] == y["one"]), _n(1)).otherwise(_n(0))
            total = bound(here, lambda h: acc["sum"] + F.get(weight, h + 1) - F.get(weight, h))
            total = total + bound(gone, lambda g: F.when(g > 0, F.get(weight, g - 1) - F.get(weight, g)).otherwise(_n(0)))
            counts = F.transform(acc["counts"], lambda n, j: n + F.when(x["word"] == j, x["one"]).otherwise(_n(0)) - F.when(y["word"] == j, y["one"]).otherwise(_n(0)))
            return bound(total, lambda t: F.struct(counts.alias("counts"), t.alias("sum"), F.when(s["i"] >= window - 1, F.least(acc["least"], t)).otherwise(acc["least"]).alias("least")))

        start = F.struct(F.array(*(_n(0) for _ in range(words))).alias("counts"), _n(0).alias("sum"), _n(1 << 62).alias("least"))
        return F.aggregate(steps, start, step, lambda acc: F.lit(math.log2(window)) - acc["least"] / (window * UNIT))

    return bound(cells, slid)


def _entropy_spans(text: Column, c: CharacterClass, rank: int, harmless: str) -> Column:
    """The parts of the class's candidates, without what is known to be harmless, that have a window of high entropy."""
    whole = located(text, c.pattern, rank, c.kind)

    def part(s: Column) -> Callable[[Column, Column, Column], Column]:
        def span(gap: Column, _: Column, at: Column) -> Column:
            start = s["start"] + at
            return F.struct(start.alias("start"), (start + F.char_length(gap)).alias("end"), s["rank"].alias("rank"), s["kind"].alias("kind"), gap.alias("body"))

        return span

    parts = F.flatten(F.transform(whole, lambda s: F.when(s["body"].rlike(harmless), _pieces(s["body"], harmless, part(s), _none(SPAN))).otherwise(F.array(s))))

    def suspect(s: Column) -> Column:
        ok = F.char_length(s["body"]) >= c.window
        for need in c.needs:
            ok = ok & s["body"].rlike(need)
        return ok & F.when(ok, peak_entropy(s["body"], c.window, c.alphabet) >= c.bits).otherwise(F.lit(False))

    return F.filter(parts, suspect)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", classes: tuple[CharacterClass, ...] = CLASSES, harmless: str = HARMLESS) -> DataFrame:
    """Per row: key, base (spans of the base kinds), added (spans of high entropy that touch no base span).

    Candidates are sought where no base span stands. Spans are in code points, end exclusive, ordered by start, then kind;
    of added spans that touch each other the first class's stays. A null or empty text has none; repeated rows are each scanned; an empty
    table gives an empty result; a text or a candidate of any length costs time in proportion to it;
    columns other than `key` and `text` are not read.
    """
    rows = docs.select(F.col(key).alias("c0"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    base = [_base_spans(F.col("body"), rank, *kind) for rank, kind in enumerate(BASE_KINDS)]
    slim = lambda x: F.transform(x, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), s["kind"].alias("kind")))
    masked = F.col("body")
    for _, pattern, least, group in BASE_KINDS:
        masked = _masked(masked, pattern, least, group)
    maybe = F.col("body").rlike("|".join(f"(?:{c.pattern})" for c in classes))
    rows = rows.select("c0", F.array_sort(slim(F.concat(*base))).alias("base"), F.when(maybe, masked).otherwise(F.lit("")).alias("open"))
    added = [_entropy_spans(F.col("open"), c, len(BASE_KINDS) + i, harmless) for i, c in enumerate(classes)]
    rows = rows.select("c0", "base", slim(F.concat(*added)).alias("more"))
    touch = lambda x, y: (x["start"] < y["end"]) & (y["start"] < x["end"])
    rows = rows.select("c0", "base", F.filter("more", lambda m: ~F.exists("base", lambda b: touch(b, m))).alias("more"))
    own = F.filter("more", lambda m: ~F.exists("more", lambda o: (o["rank"] < m["rank"]) & touch(o, m)))
    return rows.select(F.col("c0").alias(key), "base", F.array_sort(own).alias("added"))


def secret_digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digest of the base spans, and all spans as one string."""
    found = secret_spans(docs, key, text)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        key, *(count(k[0]).alias(f"n_{k[0]}") for k in BASE_KINDS), F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_entropy"),
    )
