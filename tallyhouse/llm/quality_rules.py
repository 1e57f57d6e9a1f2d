"""Quality rules as a short-circuit cascade: rules that reject much for little cost come first.

Everything is built from DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.base import hash_sample, stage

#: White space of a text's words: space and the control characters 9 to 13.
_GAP = r"[ \x09-\x0D]+"
_NOT_GAP = r"[^ \x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


def words(text: Column) -> Column:
    """Words of a text; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAP), "")


def word_chars(ws: Column) -> Column:
    return F.length(F.array_join(ws, "")).cast("long")


def symbols(text: Column) -> Column:
    return F.coalesce(F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, "")), F.lit(0)).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(_NOT_GAP))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeated_words(hashes: Column, size: int = 5) -> Column:
    """Words in windows of ``size`` words that the text holds twice or more, the first time included.

    ``hashes`` is ``window_hashes``. Most texts have no equal windows, which one hash set tells. Else the windows are
    sorted by (hash, position): those with an equal neighbour are repeated, and in order of position each adds as many
    words as lie before the next, at most ``size``.
    """
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def cover(pairs: Column) -> Column:
        last = F.size(pairs) - 1
        same = F.filter(
            F.transform(
                pairs,
                lambda p, j: F.when(
                    ((j > 0) & (F.get(pairs, j - 1)["h"] == p["h"])) | ((j < last) & (F.get(pairs, j + 1)["h"] == p["h"])), p["i"]
                ),
            ),
            lambda i: i.isNotNull(),
        )
        return F.transform(F.array(F.array_sort(same)), lambda at: F.aggregate(
            F.transform(at, lambda i, j: F.least(F.lit(size), F.coalesce(F.get(at, j + 1) - i, F.lit(size)))),
            F.lit(0).cast("long"), lambda a, x: a + x,
        ))

    many = F.get(F.flatten(F.transform(F.array(ordered), cover)), F.lit(0))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(many)


def window_hashes(ws: Column, size: int = 5) -> Column:
    """64-bit hash of each window of ``size`` words; none for shorter texts.

    Words are hashed once, windows combine word hashes. Two different windows of one text agree with
    probability 2^-64.
    """
    def combined(hs: Column) -> Column:
        starts = F.slice(hs, F.lit(1), F.greatest(F.size(hs) - (size - 1), F.lit(0)))
        return F.transform(starts, lambda h, i: F.xxhash64(h, *[F.get(hs, i + k) for k in range(1, size)]))

    return F.flatten(F.transform(F.array(F.transform(ws, lambda w: F.xxhash64(w))), combined))


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for rows to drop; it is built from columns of the input or from what ``features`` adds."""

    name: str
    rejects: Column


def document_rules(text: Column) -> list[Rule]:
    """Rules on a raw text column. Limits are loose: clean prose in any language passes."""
    ws = words(text)
    n = F.size(ws)
    lines = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(_NOT_GAP)))
    return [
        Rule("short", n < 10),
        Rule("repetition", 100 * repeated_words(window_hashes(ws)) > 20 * n),
        Rule("symbols", 2 * symbols(text) > n),
        Rule("duplicate_lines", 10 * duplicate_lines(text) > 3 * F.greatest(lines, F.lit(1))),
        Rule("word_length", (word_chars(ws) < 2 * n) | (word_chars(ws) > 20 * n)),
    ]


def measured_rules() -> list[Rule]:
    """The same rules on columns already measured by ``features``."""
    n = F.col("n_words")
    return [
        Rule("short", n < 10),
        Rule("repetition", 100 * F.col("n_repeat_words") > 20 * n),
        Rule("symbols", 2 * F.col("n_symbols") > n),
        Rule("duplicate_lines", 10 * F.col("n_dup_lines") > 3 * F.greatest(F.col("n_lines"), F.lit(1))),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n)),
    ]


#: Rows on which costs and selectivities are measured, at most; chosen by a hash over the whole table.
SAMPLE_ROWS = 2000


def order_rules(rows: DataFrame, rules: Sequence[Rule], key: str, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per cost, highest first, estimated on a bounded hash sample of ``rows``.

    Cost is the time to evaluate the rule alone over the sample, less that of reading it; the order only decides
    what is skipped, never the verdict. An empty table keeps the given order.
    """
    sample = stage(hash_sample(rows, rows.columns, sample_rows, seed=11), "rule-sample").coalesce(1)
    shares = sample.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.coalesce(r.rejects, F.lit(False)).cast("int")).alias(r.name) for r in rules]).first()
    if not shares["n"]:
        return list(rules)

    def seconds(column: Column) -> float:
        took = []
        for _ in range(2):
            start = time.perf_counter()
            sample.agg(F.count_if(column)).first()
            took.append(time.perf_counter() - start)
        return min(took)

    idle = seconds(F.col(rows.columns[0]).isNull())
    worth = {r.name: shares[r.name] / max(seconds(r.rejects) - idle, 1e-3) for r in rules}
    return sorted(rules, key=lambda r: -worth[r.name])


def passes(rules: Sequence[Rule]) -> Column:
    """True where no rule rejects. The chain of WHENs stops at the first that does; NULL does not reject."""
    chain = F
    for rule in rules:
        chain = chain.when(rule.rejects, F.lit(False))
    return chain.otherwise(F.lit(True)) if rules else F.lit(True)


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Measured columns of every row: words, characters in them, symbols, duplicate lines, repeated words, lines.

    NULL and empty texts have none of anything. Rows keep their key (NULL too) and repeat as given; other columns are
    not read.
    """
    t = F.col("t")
    rows = docs.select(F.col(key), F.col(text).alias("t")).withColumn("w", words(t))
    lines = F.filter(F.split(F.coalesce(t, F.lit("")), "\n"), lambda x: x.rlike(_NOT_GAP))
    return rows.select(
        F.col(key),
        F.size("w").cast("long").alias("n_words"),
        word_chars(F.col("w")).alias("word_chars"),
        symbols(t).alias("n_symbols"),
        duplicate_lines(t).alias("n_dup_lines"),
        repeated_words(window_hashes(F.col("w"))).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
    )


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its measures, ``base_failed`` (too short or too repetitive) and ``kept``."""
    found = features(docs, key, text)
    rules = order_rules(docs.select(F.col(key), F.col(text).alias("t")), document_rules(F.col("t")), key)
    by_name = {r.name: r for r in measured_rules()}
    base = by_name["short"].rejects | by_name["repetition"].rejects
    return found.select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), passes([by_name[r.name] for r in rules]).alias("kept"),
    )


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, unchanged: rules are evaluated in the estimated order and stop at the first rejection."""
    rules = order_rules(docs.select(F.col(key), F.col(text).alias("t")), document_rules(F.col("t")), key)
    by_name = {r.name: r for r in document_rules(F.col(text))}
    return docs.where(passes([by_name[r.name] for r in rules]))
