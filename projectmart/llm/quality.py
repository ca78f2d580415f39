"""Quality rules: a threshold table compiled into one projection of built-in functions.

Every rule bounds one metric of a whole text. The metrics need no shuffle: words, lines and
five-word windows are arrays of the row itself. A window is known by the 64-bit hash of its words,
which is only compared inside one text.

Defined results: a null text has no words; an empty text likewise; both fail ``least words``. Rows
are judged one by one, so repeated rows get equal verdicts, and an empty table gives no rows. A
column of the input that has the name of a metric is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
WHITE_PATTERN = "[ \\t\\n\\x0B\\f\\r]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from had has have he in is it not of on or re she that the they"
    " this to was were which will with you"
    " aber als auch auf aus bei das dem den der des die ein eine einer er es für hat ich ihr im ist"
    " mit nicht sich sie sind und von war wie wir zu"
    " au aux avec ce dans de des du elle en est et il je la le les mais ne nous par pas pour que qui"
    " se son sur un une vous"
    " al como con del el ella es esta la las lo los más no nos o para pero por que se si sin su un"
    " una y"
).split()


@dataclass(frozen=True)
class Rule:
    """Texts with a metric outside [least, most] are rejected; a bound of None is no bound.

    The rule holds for texts of ``from_words`` words or more: ratios of short texts say little.
    """

    name: str
    metric: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


BASE_RULES = (
    Rule("least words", "n_words", least=10),
    Rule("repeated windows", "repeat_ratio", most=0.2),
)
METHOD_RULES = (
    Rule("word length", "mean_word_chars", least=1.5, most=20.0),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("stop words", "stop_word_ratio", least=0.02, from_words=20),
    Rule("repeated lines", "dup_line_ratio", most=0.5),
    Rule("shouted lines", "shout_ratio", most=0.3),
)


def _without(text: Column, characters: str) -> Column:
    return reduce(lambda c, x: F.replace(c, F.lit(x)), characters, text)


def text_metrics(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts and ratios that rules may bound."""
    stop = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})
    text = F.coalesce(F.col("text"), F.lit(""))
    arrays = docs.withColumns(
        {
            "_words": F.filter(F.split(text, WHITE_PATTERN), lambda w: w != ""),
            "_lines": F.filter(
                F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != ""
            ),
            "n_symbols": (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long"),
        }
    )
    counted = arrays.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "_n_lines": F.size("_lines"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_stop": F.size(F.filter("_words", lambda w: w.isin(stop))),
            "_shout": F.size(F.filter("_words", lambda w: w.endswith("!!"))),
            # The start of every window with the hash of its words.
            "_grams": F.when(F.size("_words") < WINDOW, F.array().cast("array<bigint>")).otherwise(
                F.transform(
                    F.sequence(F.lit(1), F.greatest(F.size("_words") - WINDOW + 1, F.lit(1))),
                    lambda i: F.xxhash64(F.slice(F.col("_words"), i, WINDOW)),
                )
            ),
        }
    ).drop("_words", "_lines")
    # Only texts with a repeated window sort their windows.
    ordered = counted.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_grams")) < F.size("_grams"),
            F.sort_array(
                F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
            ),
        ),
    ).drop("_grams")
    twice = ordered.withColumn(
        "_starts",
        F.sort_array(
            F.transform(
                F.filter(
                    F.transform(
                        "_sorted",
                        lambda x, k: F.struct(
                            x["i"].alias("i"),
                            (
                                F.coalesce(
                                    F.get(F.col("_sorted"), k - 1)["g"] == x["g"], F.lit(False)
                                )
                                | F.coalesce(
                                    F.get(F.col("_sorted"), k + 1)["g"] == x["g"], F.lit(False)
                                )
                            ).alias("again"),
                        ),
                    ),
                    lambda x: x["again"],
                ),
                lambda x: x["i"],
            )
        ),
    ).drop("_sorted")
    # Windows overlap: each start covers the words up to the next start, five at most.
    covered = twice.withColumn(
        "n_repeat_words",
        F.coalesce(
            F.aggregate(
                F.transform(
                    "_starts",
                    lambda s, k: F.least(
                        F.lit(WINDOW),
                        F.coalesce(F.get(F.col("_starts"), k + 1) - s, F.lit(WINDOW)),
                    ).cast("long"),
                ),
                F.lit(0).cast("long"),
                lambda total, n: total + n,
            ),
            F.lit(0).cast("long"),
        ),
    ).drop("_starts")

    def per_word(c: str) -> Column:
        return F.coalesce(F.try_divide(F.col(c), F.col("n_words")), F.lit(0.0))

    return covered.withColumns(
        {
            "mean_word_chars": per_word("word_chars"),
            "symbol_ratio": per_word("n_symbols"),
            "stop_word_ratio": per_word("_stop"),
            "shout_ratio": per_word("_shout"),
            "repeat_ratio": per_word("n_repeat_words"),
            "dup_line_ratio": F.coalesce(
                F.try_divide(F.col("n_dup_lines"), F.col("_n_lines")), F.lit(0.0)
            ),
        }
    ).drop("_n_lines", "_stop", "_shout")


def failed_rules(rules: tuple[Rule, ...]) -> Column:
    """The names of the rules that a row breaks, as an array."""

    def broken(rule: Rule) -> Column:
        value, out = F.col(rule.metric), F.lit(False)
        if rule.least is not None:
            out = out | (value < rule.least)
        if rule.most is not None:
            out = out | (value > rule.most)
        if rule.from_words:
            out = out & (F.col("n_words") >= rule.from_words)
        return F.when(out, F.lit(rule.name))

    return F.filter(F.array(*(broken(r) for r in rules)), lambda x: x.isNotNull())


def judge(docs: DataFrame, rules: tuple[Rule, ...] = METHOD_RULES) -> DataFrame:
    """``docs`` with metrics, ``base_failed``, ``failed`` (the broken rules) and ``kept``."""
    measured = text_metrics(docs)
    # The base decides in whole numbers, so that no rounding of a ratio matters.
    base = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    verdict = ~F.col("base_failed") & (F.size("failed") == 0)
    # An expression that is not a function of the row holds filters above the metrics. Pushed below
    # them, a filter would repeat the expressions of all metrics, and those they are made of.
    here = F.monotonically_increasing_id() >= 0
    return measured.withColumns({"base_failed": base, "failed": failed_rules(rules)}).withColumn(
        "kept", verdict & here
    )


def filter_documents(docs: DataFrame, rules: tuple[Rule, ...] = METHOD_RULES) -> DataFrame:
    """The documents that pass all rules, with the columns of ``docs``."""
    # The whole row travels as one struct: its own columns cannot clash with those of the metrics.
    names = docs.columns
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"), "text")
    kept = judge(packed, rules).filter("kept")
    return kept.select(*(f"_row.`{c}`" for c in names))
