"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each text gives a few whole numbers (symbols, repeated lines, repeated words,
word length). Their distribution is sketched per language and source as counts
of log-linear bins, 32 to an octave: sketches merge by adding counts, in any
order, with a relative error of at most 1/32, so the quartiles of a language
or of all rows come from the same table, and reruns agree. A document fails a
rule beyond the fence q75 + 3 (q75 - q25) + slack of its own language and
source. Their quartiles are means of the group's own, weighed by its documents,
and of its language's and all rows', weighed as ``PRIOR`` documents each: a
group's own figures prevail the more documents it has, at every size by one law.
Only DataFrame operations; words are compared inside the row, so that a text is
never spread over rows.

Defined results: a null text has no words; a null language or source is a
group of its own; repeated rows return repeated rows; an empty table returns no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import SPACES, bin_of, checkpointed, let, text_of, word_array

WINDOW = 8
#: rule: (slack added to the fence, on the rule's own scale)
RULES = {"symbol_permille": 50, "dup_line_permille": 150, "repeat_permille": 150, "word_length_x100": 300}
#: Documents that a language's quartiles, and those of all rows, count for in a group's.
PRIOR = 100
FENCE = 3


def repeated_words(words: Column) -> Column:
    """How many words lie in 8-word windows that the text holds twice or more."""

    def covered(s: Column) -> Column:
        # sorted by hash: a window is repeated if a neighbour has its hash
        twice = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]))
        at = F.array_sort(F.transform(twice, lambda x: x["i"]))
        return let(at, lambda p: F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x))

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        any_twice = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        # most texts repeat nothing and are done after the first look
        return F.when(F.size(w) <= WINDOW, 0).when(any_twice, let(F.array_sort(placed), covered)).otherwise(0)

    return counted(words)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source and the whole numbers of each text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{SPACES}]"))
    counted = rows.select(
        "doc_id", "lang", "source",
        let(word_array(F.col("t")), lambda w: F.struct(F.size(w).alias("n"), F.char_length(F.array_join(w, "")).alias("chars"), repeated_words(w).alias("repeated"))).alias("w"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).alias("symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("l"),
    )
    long = lambda c: F.col(c).cast("long")
    return counted.select("doc_id", "lang", "source", long("w.n").alias("n_words"), long("w.chars").alias("word_chars"), long("symbols").alias("n_symbols"), long("l.dup").alias("n_dup_lines"), long("w.repeated").alias("n_repeat_words"), long("l.n").alias("n_lines"))


def _permille(a: str, b: str, scale: int = 1000) -> Column:
    return F.floor(F.col(a) * scale / F.greatest(F.col(b), F.lit(1))).cast("long")


RULE_VALUES = {
    "symbol_permille": lambda: _permille("n_symbols", "word_chars"),
    "dup_line_permille": lambda: _permille("n_dup_lines", "n_lines"),
    "repeat_permille": lambda: _permille("n_repeat_words", "n_words"),
    "word_length_x100": lambda: _permille("word_chars", "n_words", 100),
}


def sketch(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rule, bin, n: the mergeable sketches."""
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), bin_of(f()).alias("bin")) for r, f in RULE_VALUES.items()])
    each = rows.select(*keys, F.explode(rules).alias("x")).select(*keys, "x.rule", "x.bin")
    return each.groupBy(*keys, "rule", "bin").agg(F.count("*").alias("n"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, documents, <rule>_25, <rule>_75 from sketches, which are merged first."""
    merged = sketches.groupBy(*keys, "rule", "bin").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys, "rule")
    merged = merged.withColumn("upto", F.sum("n").over(by.orderBy("bin"))).withColumn("all", F.sum("n").over(by))
    q = lambda r, p: F.min(F.when((F.col("rule") == r) & (F.col("upto") * 100 >= F.col("all") * p), F.col("bin"))).alias(f"{r}_{p}")
    return merged.groupBy(*keys).agg(F.first("all").alias("documents"), *[q(r, p) for r in RULES for p in (25, 75)])


def fences(own: DataFrame, of_lang: DataFrame, of_all: dict) -> DataFrame:
    """lang, source, max_<rule>: the fences of each group. of_all: one row."""
    g = of_lang.select(F.col("lang").alias("l2"), *[F.col(c).alias(f"{c}_lang") for c in of_lang.columns if c not in ("lang", "documents")])
    rows = own.join(g, own["lang"].eqNullSafe(F.col("l2"))).drop("l2")

    def blended(c: str) -> Column:
        return (F.col("documents") * F.col(c) + PRIOR * F.col(f"{c}_lang") + PRIOR * F.lit(of_all[c])) / (F.col("documents") + 2 * PRIOR)

    def fence(r: str) -> Column:
        return (1 + FENCE) * blended(f"{r}_75") - FENCE * blended(f"{r}_25") + RULES[r]

    return rows.select("lang", "source", *[fence(r).alias(f"max_{r}") for r in RULES])


def judged(docs: DataFrame, min_words: int = 20, max_repeat_percent: int = 30, **columns) -> DataFrame:
    """measures() + base_failed, failed_rules (array), kept."""
    rows = checkpointed(measures(docs, **columns))
    own = checkpointed(sketch(rows, ["lang", "source"]))
    of_all = quartiles(own.drop("lang", "source"), []).first()  # one row, whatever the input
    limits = fences(quartiles(own, ["lang", "source"]), quartiles(own, ["lang"]), of_all.asDict() if of_all else defaultdict(int))
    limits = limits.withColumnsRenamed({"lang": "l1", "source": "s1"})
    out = rows.join(limits, rows["lang"].eqNullSafe(F.col("l1")) & rows["source"].eqNullSafe(F.col("s1"))).drop("l1", "s1")
    failed = F.array_compact(F.array(*[F.when(f() > F.col(f"max_{r}"), F.lit(r)) for r, f in RULE_VALUES.items()]))
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    out = out.withColumn("base_failed", base).withColumn("failed_rules", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
