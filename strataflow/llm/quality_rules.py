"""Rule-based quality filter: a table of thresholds becomes one projection of built-in functions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.shared import SPACE, column


class Rule(NamedTuple):
    """``low`` to ``high`` per cent of ``bottom`` may be ``top``; None leaves a side open."""

    name: str
    top: str
    bottom: str
    low: int | None
    high: int | None


#: Characters that prose seldom holds.
SYMBOLS = "#*$%&|<>"
#: Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is was that it for with on as by at this are be from or an not "
    "der die das und ist in den von zu mit sich auf für ein eine im dem nicht des "
    "le la les de des et un une du en est que dans qui pour sur au pas par avec "
    "el los las del y una por con para se su no al lo como más"
).split()

RULES = (
    Rule("word length", "word_chars", "n_words", 200, 1500),
    Rule("symbols per word", "n_symbols", "n_words", None, 30),
    Rule("stop words", "n_stop_words", "n_words", 3, None),
    Rule("capital letters", "n_capitals", "word_chars", None, 40),
    Rule("repeated lines", "n_dup_lines", "n_lines", None, 50),
)


def verdict(rules: tuple[Rule, ...] = RULES) -> str:
    """The rules as one condition, in SQL that Spark and other engines share."""
    sides = [f"{r.low} * {r.bottom} <= 100 * {r.top}" for r in rules if r.low is not None]
    sides += [f"100 * {r.top} <= {r.high} * {r.bottom}" for r in rules if r.high is not None]
    return " and ".join(sides) or "true"


BASE = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, whole: bool = False) -> DataFrame:
    """One row per document with its counts, ``base_failed`` and ``kept``; ``whole`` adds the row itself as ``row``.

    NULL and empty texts have no words, fail the base and are not kept. Each row is judged alone,
    so repeated rows and NULL ids simply get their own rows; other columns are ignored. A text is
    one value of one task; nothing is shuffled. ``n_repeat_words`` counts the words covered by
    some window of three words that the text holds at least twice; windows of one text are compared
    by their 64-bit hash.
    """
    rows = docs.select(
        column(docs, key).alias("doc_id"), F.coalesce(column(docs, text), F.lit("")).alias("text"),
        *([F.struct("*").alias("row")] if whole else []),
    )
    own = ["doc_id", "row"] if whole else ["doc_id"]
    size = F.octet_length("text")

    def occurrences(characters: str):
        return sum((size - F.octet_length(F.replace(F.col("text"), F.lit(c), F.lit(""))) for c in characters), F.lit(0)).cast("long")

    step = rows.select(
        *own,
        F.array_remove(F.split("text", SPACE + "+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        occurrences(SYMBOLS).alias("n_symbols"),
        (F.char_length("text") - occurrences(" \t\n\x0b\f\r")).cast("long").alias("word_chars"),
    )
    carried = [*own, "n_capitals", "n_symbols", "word_chars"]
    n = F.size("words")
    step = step.select(
        *carried,
        n.cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.when(
            n >= 3,
            F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))),
        ).alias("windows"),
    )
    carried += ["n_words", "n_lines", "n_dup_lines", "n_stop_words"]
    # Most texts repeat no window; only the others sort theirs to find equal neighbours.
    step = step.select(
        *carried,
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("window"), i.alias("at")))),
        ).alias("ordered"),
    )
    step = step.select(
        *carried,
        F.sort_array(
            F.filter(
                F.transform(
                    "ordered",
                    lambda w, j: F.when(
                        (w["window"] == F.get("ordered", j - 1)["window"]) | (w["window"] == F.get("ordered", j + 1)["window"]),
                        w["at"],
                    ),
                ),
                lambda at: at.isNotNull(),
            )
        ).alias("repeats"),
    )
    step = step.select(
        *carried,
        F.coalesce(
            F.aggregate(
                F.transform("repeats", lambda at, j: F.least(F.lit(3), F.coalesce(F.get("repeats", j + 1) - at, F.lit(3)))),
                F.lit(0).cast("long"),
                lambda total, more: total + more,
            ),
            F.lit(0),
        ).cast("long").alias("n_repeat_words"),
    )
    return step.select(
        *own, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_capitals",
        F.expr(BASE).alias("base_failed"),
        F.expr(f"not ({BASE}) and {verdict(rules)}").alias("kept"),
    )


def _listed(words: list[str] | tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def oracle(source: str = "documents", rules: tuple[Rule, ...] = RULES) -> str:
    """The same result as DuckDB SQL over ``source``."""
    return f"""
    with d as (
        select row_number() over () as r, doc_id, coalesce(text, '') as text from {source}
    ), w as (
        select r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words,
            [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as lines from d
    ), windows as (
        select r, i, concat_ws(' ', words[i], words[i + 1], words[i + 2]) as g
        from (select r, words, unnest(range(1, len(words) - 1)) as i from w)
    ), repeated as (
        select r, i, count(*) over (partition by r, g) as n from windows
    ), covered as (
        select r, count(distinct pos) as n_repeat_words
        from (select r, unnest([i, i + 1, i + 2]) as pos from repeated where n > 1) group by r
    ), counted as (
        select w.doc_id, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars,
            cast(len(regexp_extract_all(text, '[{SYMBOLS}]')) as bigint) as n_symbols,
            cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
            cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
            cast(len(lines) as bigint) as n_lines,
            cast(len([x for x in words if lower(x) in ({_listed(STOP_WORDS)})]) as bigint) as n_stop_words,
            cast(len(regexp_extract_all(text, '\\p{{Lu}}')) as bigint) as n_capitals
        from w left join covered using (r)
    )
    select *, {BASE} as base_failed, not ({BASE}) and {verdict(rules)} as kept from counted
    """
