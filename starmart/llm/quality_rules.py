"""Quality rules: a table of thresholds compiled into one projection.

Everything is a column expression. The words, lines and shingle hashes of a text are
arrays inside its row, so there is no shuffle and a text of any length is one row's work.

Defined results
    null or empty text      no words, all counts 0, rejected for its length
    very long text          counted whole
    repeated rows           judged one by one, alike
    empty table             empty result
    clashing extra columns  ``measure`` and ``verdicts`` replace columns of the same name

Three-word windows are compared by a 64-bit hash; two different windows of one text of a
million words collide with a chance below one in ten million.
"""

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters between words, and symbols that prose seldom has.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Frequent function words by language (en, de, fr, es, it, pt, nl).
STOP_WORDS = (
    "the be to of and that have with is are was for in on at by this from "
    "der die das und zu den von ist mit ein eine nicht auf des "
    "le la les et une est pour que dans du qui sur par "
    "el los las en del un para con por se "
    "il di che per non gli o em os uma com het een van voor"
).split()

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Reject when ``part / whole`` is below ``least`` or above ``most``; 0 / 0 passes."""

    name: str
    part: str
    whole: str
    least: float | None = None
    most: float | None = None

    def fails(self) -> Column:
        # compared as products, so no division rounds a ratio across its threshold
        part, whole = F.col(self.part).cast("double"), F.col(self.whole).cast("double")
        sides = []
        if self.least is not None:
            sides.append(part < whole * self.least)
        if self.most is not None:
            sides.append(part > whole * self.most)
        return reduce(or_, sides)


RULES = (
    Rule("word_length", "word_chars", "n_words", least=3.0, most=10.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("letters", "n_letter_words", "n_words", least=0.8),
    Rule("stop_words", "n_stop_words", "n_words", least=0.02),
    Rule("copied_lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=0.9),
    Rule("cut_lines", "n_cut_lines", "n_lines", most=0.3),
)

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_letter_words",
    "n_stop_words",
    "n_bullet_lines",
    "n_cut_lines",
)

_TEXT, _WORDS, _LINES, _SHINGLES, _SORTED, _PLACES = (
    "__text",
    "__words",
    "__lines",
    "__shingles",
    "__sorted",
    "__places",
)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of ``COUNTS`` for every text."""
    kept = [c for c in docs.columns if c not in COUNTS]
    words = F.filter(F.split(F.col(_TEXT), SPACE), lambda w: w != "")
    lines = F.filter(F.split(F.col(_TEXT), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    split = (
        docs.withColumn(_TEXT, F.coalesce(F.col(text), F.lit("")))
        .withColumns({_WORDS: words, _LINES: lines})
        .withColumn(_SHINGLES, _shingles(F.col(_WORDS)))
        .withColumn(_SORTED, _sorted_if_repeated(F.col(_SHINGLES)))
        .withColumn(_PLACES, _repeated_places(F.col(_SORTED)))
    )
    # one generated row per text: a filter on the counts cannot be moved below their evaluation,
    # where the optimizer would write the arrays out again inside every lambda
    counts = F.struct(*[_counts()[name].cast("long").alias(name) for name in COUNTS])
    return split.select(*kept, F.inline(F.array(counts)))


def _counts() -> dict[str, Column]:
    text, words, lines = F.col(_TEXT), F.col(_WORDS), F.col(_LINES)
    solid = F.translate(text, " \t\n\x0b\f\r", "")
    lowered = F.transform(words, lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")))
    return {
        "n_words": F.size(words),
        "word_chars": F.char_length(solid),
        "n_symbols": F.char_length(solid) - F.char_length(F.translate(solid, SYMBOLS, "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _covered(F.col(_PLACES)),
        "n_lines": F.size(lines),
        "n_letter_words": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))),
        "n_stop_words": F.size(F.filter(lowered, lambda w: w.isin(STOP_WORDS))),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[•*\-]"))),
        "n_cut_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))),
    }


def _shingles(words: Column) -> Column:
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) >= 3, windows).otherwise(F.array().cast("array<bigint>"))


def _sorted_if_repeated(shingles: Column) -> Column:
    """(hash, place) in order; empty if all hashes differ, so most texts skip the sort."""
    placed = F.transform(shingles, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    repeated = F.size(F.array_distinct(shingles)) < F.size(shingles)
    return F.when(repeated, F.sort_array(placed)).otherwise(nothing)


def _repeated_places(ordered: Column) -> Column:
    def has_twin(x, i):
        before, after = F.get(ordered, i - 1)["h"], F.get(ordered, i + 1)["h"]
        return (F.coalesce(before == x["h"], F.lit(False))) | F.coalesce(after == x["h"], F.lit(False))

    return F.sort_array(F.transform(F.filter(ordered, has_twin), lambda x: x["i"]))


def _covered(places: Column) -> Column:
    """Words in three-word windows that begin at the given places."""
    fresh = F.transform(
        places, lambda p, i: F.least(F.lit(3), p - F.coalesce(F.get(places, i - 1), F.lit(-3)))
    )
    return F.aggregate(fresh, F.lit(0), lambda total, x: total + x)


def verdicts(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One projection over the counts: ``base_failed``, ``failed_rules`` and ``kept``."""
    words = F.col("n_words")
    base = (words < MIN_WORDS) | (F.col("n_repeat_words") * 100 > words * MAX_REPEAT_PERCENT)
    failed = [F.when(rule.fails(), F.lit(rule.name)) for rule in rules]
    passes = reduce(and_, [~rule.fails() for rule in rules])
    added = {
        "base_failed": base,
        "failed_rules": F.array_compact(F.array(*failed)),
        "kept": ~base & passes,
    }
    others = [c for c in measured.columns if c not in added]
    return measured.select(*others, *[c.alias(name) for name, c in added.items()])


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass every rule, with their own columns.

    The whole row travels as one struct, so a column named like a count stays as it is.
    """
    boxed = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__judged"))
    judged = verdicts(measure(boxed, "__judged"))
    return judged.filter("kept").select("__row.*")
