"""Line-first quality rules (native): judge lines, remove the failing ones, then judge what is left.

Every line is tested by three rules: punctuation (drowned in symbols or repeated exclamation marks, or
in a paragraph without any sentence mark), navigation (short items between separators) and boilerplate
(set phrases). Failing lines are removed; a document that loses more than ``max_loss`` of its text is
rejected, and so is one that fails the counts over the whole text.

A paragraph is a line, or several that were wrapped at a width: a line goes on in the next one where
that one's first word had no room left. Short lines without a mark (headings, list items) stay between
lines that stay; in scripts that write no sentence marks no line needs one.

Defined results: a null or empty text has no words, fails the counts and is rejected; columns of the
input stay as they are, and the added ones replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import SPACES, let, whole_text, words

# Symbols counted, sentence marks, menu separators, phrases of page furniture.
SYMBOLS = "#*$%&|<>"
SENTENCE_MARK = r"""[.!?…:;。！？]"""
# Unicode's Sentence_Terminal, with the colons, semicolons and shads that end clauses, beyond those above.
OTHER_MARKS = (
    "[\u037E\u0589\u055C\u055E\u061B\u061D-\u061F\u06D4\u0700-\u0707\u07F9\u0837\u0839\u083D\u083E\u0964\u0965"
    "\u0E5A\u0E5B\u0F0D-\u0F12\u104A\u104B\u1362\u1364-\u1368\u166E\u1735\u1736\u17D4-\u17D6\u1803\u1804\u1809\u1944"
    "\u1945\u1AA8-\u1AAB\u1B5A\u1B5B\u1B5E\u1B5F\u1B7D\u1B7E\u1C3B\u1C3C\u1C7E\u1C7F\u203C\u203D\u2047-\u2049\u2E2E"
    "\u2E3C\u2E53\u2E54\uA4FF\uA60E\uA60F\uA6F3-\uA6F7\uA876\uA877\uA8CE\uA8CF\uA92F\uA9C8\uA9C9\uAA5D-\uAA5F"
    "\uAAF0\uAAF1\uABEB\uFE52\uFE54-\uFE57\uFF0E\uFF1A\uFF1B\uFF61\U00010A56\U00010A57\U00010F55-\U00010F59"
    "\U00011047\U00011048\U000110BE-\U000110C1\U00011141-\U00011143\U000111C5\U000111C6\U0001144B\U0001144C]"
)
MARKLESS_SCRIPTS = r"\p{IsThai}\p{IsLao}\p{IsTai_Viet}\p{IsNew_Tai_Lue}"
WIDEST_WRAP = 200  # longer lines are paragraphs
# A heading or list item: its marker, then at most 100 characters without menu separators.
SHORT_LINE = r"^\s*[*#>+•›»·-]*[^|•»›·]{1,100}$"
SEPARATORS = "|•»›·"
BOILERPLATE = (
    r"(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|"
    r"accept (all )?cookies|enable javascript|lorem ipsum|subscribe to our newsletter|"
    r"click here to|skip to (main )?content|powered by|add to cart)\b"
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOSS = 0.5


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def symbol_count(text: Column) -> Column:
    return F.length(text) - F.length(_without(text, SYMBOLS))


def repeat_words(tokens: Column) -> Column:
    """Words inside three-word windows that the text has twice or more.

    Windows are sorted by hash, so equal ones are neighbours; their positions, sorted again, cover
    three words each or as many as there are up to the next one.
    """

    def covered(windows: Column) -> Column:
        def position(i: Column) -> Column:
            key = windows[i]["h"]
            before, after = F.get(windows, i - 1)["h"], F.get(windows, i + 1)["h"]
            return F.when((key == before) | (key == after), windows[i]["p"])

        found = F.array_sort(
            F.array_compact(F.transform(F.sequence(F.lit(0), F.size(windows) - 1), position))
        )
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            found,
            start,
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    def sorted_windows(w: Column) -> Column:
        return F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(w) - 3),
                lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("p")),
            )
        )

    return let(
        tokens,
        lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(let(sorted_windows(w), covered)),
    ).cast("long")


def duplicate_lines(lines: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(
        F.filter(lines, lambda line: F.btrim(line, F.lit(SPACES)) != ""),
        lambda x: F.size(x) - F.size(F.array_distinct(x)),
    ).cast("long")


def line_fails(line: Column) -> Column:
    """Whether a line with words fails one of the rules that need no other line."""
    symbols = symbol_count(line)
    separators = F.length(line) - F.length(_without(line, SEPARATORS))
    blanks = F.length(line) - F.length(_without(line, " "))
    shouting = F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("!")))
    punctuation = ((symbols >= 3) & (symbols * 10 > F.length(line))) | (
        (shouting >= 3) & (shouting * 4 > blanks)
    )
    navigation = (separators >= 3) & (blanks < 6 * separators)
    return punctuation | navigation | line.rlike(BOILERPLATE)


def needs_no_mark(line: Column) -> Column:
    """Whether at least half of a line's characters are of scripts without sentence marks."""
    theirs = F.length(F.regexp_replace(line, f"[^{MARKLESS_SCRIPTS}]", ""))
    return line.rlike(f"[{MARKLESS_SCRIPTS}]") & (2 * theirs >= F.length(_without(line, SPACES)))


def line_code(line: Column) -> Column:
    """b: without a word, x: fails by itself, k: has a sentence mark or needs none, s: short, m: the rest."""
    return (
        F.when(F.btrim(line, F.lit(SPACES)) == "", "b")
        .when(line_fails(line), "x")
        .when(line.rlike(SENTENCE_MARK) | line.rlike(OTHER_MARKS) | needs_no_mark(line), "k")
        .when(line.rlike(SHORT_LINE), "s")
        .otherwise("m")
    )


def _joined(lines: Column, codes: Column) -> Column:
    """The codes in one text, with a slash where a paragraph ends.

    The width is that of the longest line up to WIDEST_WRAP; lines count as wrapped if two or more, and a
    third of those up to it, left no room for the next word.
    """
    sizes = F.transform(lines, lambda x: F.length(F.btrim(x, F.lit(SPACES))))
    firsts = F.transform(
        lines, lambda x: F.length(F.regexp_extract(x, r"^[\x20\x09-\x0D]*([^\x20\x09-\x0D]*)", 1))
    )

    def paragraphs(size: Column, first: Column) -> Column:
        narrow = F.filter(size, lambda n: n.between(1, WIDEST_WRAP))

        def full(width: Column) -> Column:
            return F.transform(
                size,
                lambda n, i: n.between(1, WIDEST_WRAP)
                & F.coalesce((F.get(first, i + 1) > 0) & (n + 1 + F.get(first, i + 1) > width), F.lit(False)),
            )

        def ends(goes_on: Column) -> Column:
            n = F.size(F.filter(goes_on, lambda x: x))
            wrapped = (n >= 2) & (3 * n >= F.size(narrow))
            return F.array_join(
                F.zip_with(
                    codes, goes_on, lambda c, on: F.when(wrapped & on, c).otherwise(F.concat(c, F.lit("/")))
                ),
                "",
            )

        return let(full(F.coalesce(F.array_max(narrow), F.lit(0))), ends)

    return let(sizes, lambda size: let(firsts, lambda first: paragraphs(size, first)))


def _settled(lines: Column, codes: Column) -> Column:
    """Codes where every line has b, x or k, by the paragraphs and by what short lines stand between."""

    def paragraph(p: Column) -> Column:
        return (
            F.when(F.contains(p, F.lit("k")), F.translate(p, "ms", "kk"))
            .when(p == "s", p)
            .otherwise(F.translate(p, "ms", "xx"))
        )

    def between(runs: Column) -> Column:
        def run(r: Column, i: Column) -> Column:
            before, after = F.get(runs, i - 1), F.get(runs, i + 1)
            heading = (i == 0) & (F.length(_without(r, "b")) == 1)  # one line above the text
            stays = F.coalesce(after.startswith("k"), F.lit(False)) & (
                heading | F.coalesce(before.endswith("k"), F.lit(False))
            )
            return F.when(~F.contains(r, F.lit("s")), r).when(stays, F.translate(r, "s", "k")).otherwise(
                F.translate(r, "s", "x")
            )

        return F.transform(runs, run)

    judged = F.array_join(F.transform(F.split(_joined(lines, codes), "/"), paragraph), "")
    runs = F.regexp_extract_all(judged, F.lit("[sb]+|[kx]+"), F.lit(0))
    return F.split(F.array_join(let(runs, between), ""), "")


def clean_lines(lines: Column) -> Column:
    """The lines that stay; those without a word stay too."""

    def staying(x: Column, codes: Column) -> Column:
        open_ones = F.arrays_overlap(codes, F.array(F.lit("m"), F.lit("s")))
        return let(
            F.when(open_ones, _settled(x, codes)).otherwise(codes),
            lambda c: F.filter(x, lambda line, i: F.get(c, i) != "x"),
        )

    return let(lines, lambda x: let(F.transform(x, line_code), lambda codes: staying(x, codes)))


def judge(
    docs: DataFrame,
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    max_loss: float = MAX_LOSS,
) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``cleaned_text``, ``lost`` and ``kept``.

    ``lost`` is the share of the non-blank characters that the line rules remove, 0 for no text.
    """
    whole = whole_text(text)
    lines = F.split(whole, "\n")
    counted = docs.withColumns(
        {
            "_tokens": words(whole),
            "word_chars": F.length(_without(whole, SPACES)).cast("long"),
            "n_symbols": symbol_count(whole).cast("long"),
            "n_dup_lines": duplicate_lines(lines),
            "cleaned_text": F.array_join(clean_lines(lines), "\n"),
        }
    )
    counted = counted.withColumns(
        {"n_words": F.size("_tokens").cast("long"), "n_repeat_words": repeat_words(F.col("_tokens"))}
    ).drop("_tokens")
    left = F.length(_without(F.col("cleaned_text"), SPACES))
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    return counted.withColumns(
        {
            "base_failed": failed,
            "lost": F.when(F.col("word_chars") > 0, 1.0 - left / F.col("word_chars")).otherwise(0.0),
        }
    ).withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= max_loss))
