"""Quality rules as a short-circuit cascade (DataFrame functions only).

Each rule is a condition that rejects a text.  The order in which a text meets the rules
does not change the verdict, only the work: ``order_rules`` estimates on a sample what a
rule costs and what share it rejects, and sorts by rejections per cost.  ``cascade`` then
evaluates one CASE in that order, so a text is spared every rule after the first that
rejects it.

Defined cases: a null text has no words and is rejected by ``few_words``; repeated rows are
judged alike; an empty table gives an empty result (and the rules keep their given order);
extra columns stay as they are, and the operator's columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import NOT_WHITE, count_chars, let, words

SYMBOLS = "[#*$%&|<>]"
CAPITALS = "[A-Z]"
NON_LETTERS = r"[!-@\[-`{-~]"  # ASCII digits and punctuation
SAMPLE_ROWS = 20_000  # rows on which costs and selectivities are estimated
SEED = 20260


def lines_with_words(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(parts, lambda x: F.regexp(x, F.lit(NOT_WHITE)))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(lines_with_words(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeated_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text, the first occurrence included.

    Windows are compared by a 64-bit hash.  Texts whose windows all differ stop after the distinct
    count; otherwise windows are sorted with their positions, equal neighbours give the repeated
    positions, and the words they cover are the gaps between those positions, at most 3 each.
    """
    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = F.filter(s, lambda x, k: (F.get(s, k - 1)["v"] == x["v"]) | (F.get(s, k + 1)["v"] == x["v"]))
            return F.sort_array(F.transform(same, lambda x: x["i"]))

        def total(p: Column) -> Column:
            gaps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

        # out-of-range neighbours are null, and null comparisons do not hold
        return let(ranked, lambda s: let(places(s), total))

    windows = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
                      1, F.greatest(F.size(w) - 2, F.lit(0)))
    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
               .otherwise(covered(h)))


def measures(w: Column) -> dict[str, Column]:
    """Expressions over ``text`` and its word array ``w``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": count_chars(text, SYMBOLS),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeated_words(w),
        "n_lines": F.size(lines_with_words(text)).cast("long"),
        "n_upper": count_chars(text, CAPITALS),
        "n_lower": F.length(F.regexp_replace(text, "[^a-z]+", "")).cast("long"),
        "n_non_letters": count_chars(text, NON_LETTERS),
    }


def _per_text(row: Callable[[Column], Column]) -> Column:
    """A generator of one row, the struct ``row(words)``.  The words are split once per text, and since
    what a generator gives are plain columns, filters on them do not drag the expressions along."""
    return F.inline(F.transform(F.array(words(F.col("text"))), row))


@dataclass(frozen=True)
class Rule:
    """``rejects``: condition over the measures; ``cost``: expression for the work of one text, in
    characters scanned (a word split costs about 3 of these, a word window about 40)."""

    name: str
    uses: tuple[str, ...]
    rejects: Callable[..., Column]
    cost: Callable[[Column], Column]


def _chars(times: float) -> Callable[[Column], Column]:
    return lambda w: F.length(F.coalesce(F.col("text"), F.lit(""))) * F.lit(float(times))


DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("few_words", ("n_words",), lambda n: n < 50, _chars(3)),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 50 * n,
         lambda w: F.size(w) * F.lit(40.0)),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 100 * s > 20 * n, _chars(1)),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"), lambda d, n: 100 * d > 50 * n, _chars(4)),
    Rule("capitals", ("n_upper", "n_lower"), lambda u, l: 100 * u > 60 * (u + l), _chars(2)),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 15 * n), _chars(1)),
    Rule("non_letters", ("n_non_letters", "word_chars"), lambda x, c: 100 * x > 40 * c, _chars(1)),
)


def _condition(rule: Rule, have: dict[str, Column]) -> Column:
    return F.coalesce(rule.rejects(*(have[u] for u in rule.uses)), F.lit(False))


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, sample_rows: int = SAMPLE_ROWS,
                seed: int = SEED) -> list[Rule]:
    """The rules by rejections per cost, highest first, estimated on about ``sample_rows`` rows; ties
    and an empty sample keep the given order."""
    n = docs.count()
    share = 1.0 if n <= sample_rows else sample_rows / n
    picked = docs.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000))

    def judged(w: Column) -> Column:
        have = measures(w)
        return F.struct(*(x for k, r in enumerate(rules) for x in (
            _condition(r, have).cast("double").alias(f"r{k}"), r.cost(w).alias(f"c{k}"))))

    names = [f"{x}{k}" for k in range(len(rules)) for x in "rc"]
    stats = picked.select(_per_text(judged)).agg(*(F.avg(n).alias(n) for n in names)).first()
    gain = [(stats[f"r{i}"] or 0.0) / max(stats[f"c{i}"] or 1.0, 1e-9) for i in range(len(rules))]
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-gain[i], i))]


def verdict(ordered: list[Rule], have: dict[str, Column]) -> Column:
    """Name of the first rule, in the given order, that rejects the text; null for a kept text."""
    case = None
    for r in ordered:
        case = (F if case is None else case).when(_condition(r, have), F.lit(r.name))
    return case if case is not None else F.lit(None).cast("string")


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, ordered: list[Rule] | None = None) -> DataFrame:
    """``docs`` plus ``rejected_by`` (null: kept) and ``kept``."""
    ordered = order_rules(docs, rules) if ordered is None else ordered
    kept = docs.drop("rejected_by", "kept")
    out = kept.select("*", _per_text(lambda w: F.struct(verdict(ordered, measures(w)).alias("rejected_by"))))
    return out.withColumn("kept", F.col("rejected_by").isNull())


def quality_report(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES) -> DataFrame:
    """Per document the base measures, ``base_failed`` and the cascade's verdict."""
    ordered = order_rules(docs, rules)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judged(w: Column) -> Column:
        have = measures(w)
        first = F.struct(*(have[b].alias(b) for b in base))  # computed once, for the columns and for the rules
        return let(first, lambda m: F.struct(*(m[b].alias(b) for b in base), verdict(
            ordered, have | {b: m[b] for b in base}).alias("rejected_by")))

    out = docs.select("doc_id", "text").select("doc_id", _per_text(judged))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & F.col("rejected_by").isNull())
