"""Personal data spans (native): patterns propose, checksums confirm, nearby words adjust the score.

Each kind has a pattern, a check of the match (Luhn for cards, mod-97 for IBANs, ranges for the rest),
a score, and words that raise the score when they stand shortly before or after the match, up to the next
match of the kind that passes its check. Such matches hand their context on to each other in a list (no
words between them but a conjunction) or column (a line break between). The base kinds are reported
whenever their check holds; the added kinds only from ``min_score`` on.

The patterns take whole runs possessively and start a run at its first character or where the last
match ended, which finds the same leftmost matches in linear time on texts without any white space.

Defined results: a null text is the empty text and has no span; spans count code points, the end is
exclusive; input columns stay, and added ones replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import let, whole_text

CONTEXT_CHARS = 40
CONTEXT_GAIN = 0.3
LISTED = r"^(?:(?:[^\p{L}]|\b(?:and|or|und|oder|et|ou|y|o|e)\b)*+|(?s:.*\n.*))$"
MIN_SCORE = 0.6
RUN = 256  # matches of a text folded at once
CUTS = (4096, 64)  # stretches of a text that are cut out together

SPAN_TYPE = "array<struct<start:int,end:int,score:double>>"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # a cheap pattern or character that every text with a match has
    score: float
    context: str
    base: bool = True


# Kinds in the order of the report, their patterns and context words.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        0.8,
        r"e-?mail|contact|write to|correo|courriel",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        ".",
        0.5,
        r"\bip\b|address|server|host|adresse",
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", 0.8, r"card|visa|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, r"phone|tel|call|mobile|fax|handy"),
    Kind(
        "iban",
        r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
        "",
        0.6,
        r"iban|account|konto|compte|cuenta",
        base=False,
    ),
    Kind(
        "ssn",
        r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
        "-",
        0.3,
        r"ssn|social security",
        base=False,
    ),
)
BASE_KINDS = tuple(kind.name for kind in KINDS if kind.base)
IP_PARTS = r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def mod97(match: Column) -> Column:
    """Whether the letters and digits of an IBAN leave 1 when divided by 97."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _valid(kind: Kind, match: Column) -> Column:
    if kind.name == "ip":
        return match.rlike(IP_PARTS)
    if kind.name == "card":
        return let(
            _digits(match),
            lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False)),
        )
    if kind.name == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind.name == "iban":
        return mod97(match)
    return F.lit(True)


def _left(text: Column) -> Column:
    return F.substring(text, 1, CONTEXT_CHARS)


def _right(text: Column) -> Column:
    return F.substring(text, -CONTEXT_CHARS, CONTEXT_CHARS)  # all of a shorter text


def _fold(
    items: Column,
    start: Column,
    step: Callable[[Column, Column], Column],
    emit: Callable[[Column, Column], Column],
    emitted: str,
) -> Column:
    """``carry`` after the last of the items (a lambda's variable) and ``out``, all that was emitted, in order.

    ``step`` gives the next carry of a carry and an item, ``emit`` an array (of type ``emitted``) for them.
    An array that grows by one is copied each time, so it grows in runs of ``RUN`` items only, and the
    runs are joined at the end.
    """

    def add(done: Column, at: Column) -> Column:
        item = F.get(items, at)
        out = F.concat(done["out"], emit(done["carry"], item))
        return F.struct(step(done["carry"], item).alias("carry"), out.alias("out"))

    def add_run(done: Column, at: Column) -> Column:
        empty = F.struct(done["carry"].alias("carry"), F.array().cast(emitted).alias("out"))
        run = F.aggregate(F.sequence(at, F.least(at + RUN, F.size(items)) - 1), empty, add)
        return let(
            run, lambda r: F.struct(r["carry"].alias("carry"), F.concat(done["runs"], F.array(r["out"])).alias("runs"))
        )

    none = F.struct(start.alias("carry"), F.array().cast(f"array<{emitted}>").alias("runs"))
    runs = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1, F.lit(RUN)))
    runs = F.coalesce(runs, F.array().cast("array<int>"))
    return F.aggregate(
        runs, none, add_run, lambda done: F.struct(done["carry"].alias("carry"), F.flatten(done["runs"]).alias("out"))
    )


def _found(pairs: Column) -> Column:
    """For the matches that pass their check: place, text before back to the last one, and if it is so near."""

    def before(done: Column, pair: Column) -> Column:
        return _right(F.concat(done["tail"], _right(pair["gap"])))

    def step(done: Column, pair: Column) -> Column:
        end = done["at"] + F.length(pair["gap"]) + F.length(pair["match"])
        tail = _right(F.concat(before(done, pair), _right(pair["match"])))
        return F.struct(
            end.alias("at"),
            F.when(pair["valid"], "").otherwise(tail).alias("tail"),
            F.when(pair["valid"], end).otherwise(done["last"]).alias("last"),
        )

    def emit(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        span = F.struct(
            start.alias("start"),
            (start + F.length(pair["match"])).alias("end"),
            before(done, pair).alias("before"),
            F.coalesce(start - done["last"] <= CONTEXT_CHARS, F.lit(False)).alias("close"),
        )
        return F.when(pair["valid"], F.array(span)).otherwise(F.array().cast(kind))

    kind = "array<struct<start:int,end:int,before:string,close:boolean>>"
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), F.lit(None).cast("int").alias("last"))
    return _fold(pairs, first, step, emit, kind)["out"]


def _after(pairs: Column) -> Column:
    """The text after each of those matches, up to the next one."""

    def after(done: Column, pair: Column) -> Column:
        return _left(F.concat(_left(pair["next"]), done["head"]))

    def step(done: Column, pair: Column) -> Column:
        head = _left(F.concat(_left(pair["match"]), after(done, pair)))
        return F.struct(F.when(pair["valid"], "").otherwise(head).alias("head"))

    def emit(done: Column, pair: Column) -> Column:
        return F.when(pair["valid"], F.array(after(done, pair))).otherwise(F.array().cast("array<string>"))

    none = F.struct(F.lit("").alias("head"))
    return let(F.reverse(pairs), lambda back: F.reverse(_fold(back, none, step, emit, "array<string>")["out"]))


def _spread(spans: Column, linked: Callable[[Column, Column], Column]) -> Column:
    """Context handed on from one span of the array to the next one, where they are linked."""

    def near(last: Column, span: Column) -> Column:
        return span["near"] | (last["near"] & linked(last, span))

    def step(last: Column, span: Column) -> Column:
        return F.struct(near(last, span).alias("near"), span["linked"].alias("linked"))

    def emit(last: Column, span: Column) -> Column:
        return F.array(span.withField("near", near(last, span)))

    kind = "array<struct<start:int,end:int,near:boolean,linked:boolean>>"
    none = F.struct(F.lit(False).alias("near"), F.lit(False).alias("linked"))
    return _fold(spans, none, step, emit, kind)["out"]


def spans_of(kind: Kind, text: Column, min_score: float) -> Column:
    """Spans of one kind. Gaps between matches and the matches themselves add up to positions."""
    none = F.array().cast(SPAN_TYPE)

    def scored(spans: Column) -> Column:
        def score(s: Column) -> Column:
            raised = F.lit(kind.score) + F.when(s["near"], CONTEXT_GAIN).otherwise(0.0)
            total = F.least(F.lit(1.0), raised)
            return F.struct(s["start"].alias("start"), s["end"].alias("end"), total.alias("score"))

        return F.filter(F.transform(spans, score), lambda s: F.lit(kind.base) | (s["score"] >= min_score))

    def placed(pairs: Column) -> Column:
        def near(found: Column, after: Column) -> Column:
            words = F.lower(found["before"]).rlike(kind.context) | F.lower(after).rlike(kind.context)
            return F.struct(
                found["start"].alias("start"),
                found["end"].alias("end"),
                words.alias("near"),
                (found["close"] & F.lower(found["before"]).rlike(LISTED)).alias("linked"),
            )

        own = F.zip_with(_found(pairs), _after(pairs), near)
        forth = let(own, lambda spans: _spread(spans, lambda last, s: s["linked"]))
        back = let(F.reverse(forth), lambda spans: _spread(spans, lambda last, s: last["linked"]))
        return let(F.reverse(back), scored)

    def paired(matches: Column) -> Column:
        def pairs(gaps: Column) -> Column:
            return F.transform(
                matches,
                lambda m, i: F.struct(
                    F.get(gaps, i).alias("gap"),
                    m.alias("match"),
                    F.get(gaps, i + 1).alias("next"),
                    _valid(kind, m).alias("valid"),
                ),
            )

        return F.when(F.size(matches) == 0, none).otherwise(
            let(
                let(F.split(text, kind.pattern, -1), pairs),
                lambda p: F.when(F.exists(p, lambda x: x["valid"]), placed(p)).otherwise(none),
            )
        )

    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    hinted = F.contains(text, F.lit(kind.hint)) if kind.hint else F.lit(True)
    return F.when(hinted, let(matches, paired)).otherwise(none)


def find(docs: DataFrame, text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with one array column ``<kind>_spans`` of start, end and score for each kind."""
    whole = whole_text(text)
    return docs.withColumns({f"{k.name}_spans": spans_of(k, whole, min_score) for k in KINDS})


def span_list(kinds) -> Column:
    """``kind:start:end`` of the kinds in their order, joined by commas."""

    def of_kind(name: str) -> Column:
        return F.transform(
            F.col(f"{name}_spans"),
            lambda s: F.concat_ws(
                ":", F.lit(name), s["start"].cast("string"), s["end"].cast("string")
            ),
        )

    return F.array_join(F.concat(*map(of_kind, kinds)), ",")


def _cut(text: Column, cuts: Column) -> Column:
    """The stretches of the text between neighbouring cuts (at least two, ascending).

    Cutting takes time by the length of what is cut from, so long texts are cut into parts with
    ``CUTS[0]`` stretches, these into parts with ``CUTS[1]``, and these into stretches.
    """

    def within(text: Column, base: Column, first: Column, stop: Column, sizes: tuple[int, ...]) -> Column:
        """Stretches ``first`` to ``stop`` (exclusive) of a text that starts at ``base``."""
        starts = F.sequence(first, stop - 1, F.lit(sizes[0] if sizes else 1))

        def part(i: Column) -> Column:
            end = F.least(i + (sizes[0] if sizes else 1), stop)
            at = F.get(cuts, i)
            piece = F.substring(text, at - base + 1, F.get(cuts, end) - at)
            return let(piece, lambda p: within(p, at, i, end, sizes[1:])) if sizes else piece

        return F.flatten(F.transform(starts, part)) if sizes else F.transform(starts, part)

    return within(text, F.lit(0), F.lit(0), F.size(cuts) - 1, CUTS)


def masked(text: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""

    def of_kind(kind: Kind) -> Column:
        name = F.lit(kind.name.upper())
        return F.transform(
            F.col(f"{kind.name}_spans"),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), name.alias("kind")),
        )

    def step(done: Column, s: Column) -> Column:
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"))

    def emit(done: Column, s: Column) -> Column:
        mark = F.struct(done["at"].alias("from"), s["start"].alias("to"), s["kind"].alias("kind"))
        return F.when(s["start"] >= done["at"], F.array(mark)).otherwise(F.array().cast(marks))

    def joined(done: Column) -> Column:
        ends = F.flatten(F.transform(done["out"], lambda m: F.array(m["from"], m["to"])))
        cuts = F.concat(ends, F.array(done["carry"]["at"], F.length(text)))
        marked = lambda kept: F.transform(
            done["out"], lambda m, i: F.concat(F.get(kept, 2 * i), F.lit("["), m["kind"], F.lit("]"))
        )
        return let(
            let(cuts, lambda c: _cut(text, c)),
            lambda kept: F.concat(F.array_join(marked(kept), ""), F.element_at(kept, -1)),
        )

    marks = "array<struct<from:int,to:int,kind:string>>"
    spans = F.array_sort(F.concat(*map(of_kind, KINDS)))
    fold = lambda all_: _fold(all_, F.struct(F.lit(0).alias("at")), step, emit, marks)
    return let(spans, lambda all_: F.when(F.size(all_) == 0, text).otherwise(let(fold(all_), joined)))
