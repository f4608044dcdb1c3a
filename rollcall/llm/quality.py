"""Quality rules as a bitmask ledger, with DataFrame functions only.

Every rule is evaluated once per document: its measurements and one failure bit
per rule go into a ledger. A policy is a versioned set of rules; applying one,
or asking what each rule alone rejects, needs only the bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Rule -> whether a document fails it, from the measurements. The place in this
# list is the bit. New rules go to the end; policies name the rules they use.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "20 * n_symbols > n_words * 5 AND n_symbols > 4"),
    ("duplicate_lines", "n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines"),
    ("long_words", "word_chars > 40 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
]
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}

# Versions are never edited: a later policy gets a new name.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "duplicate_lines", "long_words", "short_words"),
}
DEFAULT_POLICY = "v1"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.transform(F.array(value), use)[0]


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash of each run of five words."""
    return _let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.when(
            F.size(h) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(h) - WINDOW),
                lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more.

    Equal windows stand side by side once (hash, place) pairs are sorted. Each
    repeated window covers its words up to the next repeated one.
    """

    def places(pairs: Column) -> Column:
        n = F.size(pairs)
        return F.sort_array(
            F.transform(
                F.filter(
                    F.transform(
                        F.sequence(F.lit(0), n - 1),
                        lambda i: F.struct(
                            F.get(pairs, i)["place"].alias("place"),
                            (
                                F.coalesce(F.get(pairs, i - 1)["hash"] == F.get(pairs, i)["hash"], F.lit(False))
                                | F.coalesce(F.get(pairs, i + 1)["hash"] == F.get(pairs, i)["hash"], F.lit(False))
                            ).alias("twin"),
                        ),
                    ),
                    lambda x: x["twin"],
                ),
                lambda x: x["place"],
            )
        )

    def covered(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("total")),
            lambda acc, p: F.struct(
                p.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("total")
            ),
        )["total"]

    return _let(
        hashes,
        lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")
        ).otherwise(
            _let(
                F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("hash"), i.alias("place")))),
                lambda p: _let(places(p), covered),
            )
        ),
    )


def _count(rows: Column) -> Column:
    return F.size(rows).cast("bigint")


def ledger(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with the measurements and ``failed_bits``, one bit per failed rule.

    A null text has no words: all its measurements are 0, and it fails the rule
    on few words. Columns of these names that ``docs`` has are replaced.
    """
    text = F.coalesce(F.col(column), F.lit(""))
    words = F.array_remove(F.split(text, WORD_GAP), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    length = F.char_length(text)
    measured = F.struct(
        _let(
            words,
            lambda w: F.struct(
                _count(w).alias("n_words"), _repeat_words(_window_hashes(w)).alias("n_repeat_words")
            ),
        ).alias("w"),
        _let(
            lines,
            lambda x: F.struct(_count(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines")),
        ).alias("x"),
        F.char_length(F.translate(text, " \t\n\u000b\u000c\r", "")).cast("bigint").alias("word_chars"),
        (length - F.char_length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )
    kept = [c for c in docs.columns if c not in (*MEASURES, "failed_bits")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], measured.alias("__m"))
    rows = rows.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("__m.w.n_words"),
        F.col("__m.word_chars"),
        F.col("__m.n_symbols"),
        F.col("__m.x.n_lines"),
        F.col("__m.x.n_dup_lines"),
        F.col("__m.w.n_repeat_words"),
    )
    bits = [F.when(F.expr(test), F.lit(BITS[name])).otherwise(F.lit(0)) for name, test in RULES]
    return rows.withColumn("failed_bits", reduce(lambda a, b: a.bitwiseOR(b), bits).cast("bigint"))


def policy_mask(policy: str) -> int:
    return sum(BITS[name] for name in POLICIES[policy])


def passes(policy: str = DEFAULT_POLICY) -> Column:
    """Whether a ledger row fails no rule of the policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(policy_mask(policy))) == 0


def filter_documents(docs: DataFrame, policy: str = DEFAULT_POLICY, column: str = "text") -> DataFrame:
    """The documents that the policy keeps, with the columns of ``docs``."""
    # The measurements live in a struct of their own, so no column can clash.
    name = "__ledger"
    while name in docs.columns:
        name += "_"
    bare = ledger(docs.select(F.struct("*").alias(name), F.col(column).alias("text")))
    return bare.where(passes(policy)).select(f"{name}.*")


def ablations(rows: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Per rule of the policy: documents it fails, and those that it alone rejects.

    One pass over the bits of a ledger; an empty ledger gives zeros.
    """
    mask = policy_mask(policy)
    failed = F.col("failed_bits").bitwiseAND(F.lit(mask))
    names = POLICIES[policy]
    counts = rows.agg(
        *[F.count(F.when(failed.bitwiseAND(F.lit(BITS[n])) != 0, 1)).alias(f"f_{n}") for n in names],
        *[F.count(F.when(failed == BITS[n], 1)).alias(f"o_{n}") for n in names],
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(policy).alias("policy"),
                        F.lit(n).alias("rule"),
                        F.col(f"f_{n}").alias("failed"),
                        F.col(f"o_{n}").alias("only_this"),
                    )
                    for n in names
                ]
            )
        )
    )


def report(docs: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """One row per document: measurements, the base verdict and the policy's."""
    return ledger(docs.select("doc_id", "text")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failed_bits").bitwiseAND(F.lit(policy_mask("base"))) != 0).alias("base_failed"),
        passes(policy).alias("kept"),
        "failed_bits",
    )


ORACLE = """
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text,
        list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
      FROM t),
g AS (SELECT r, unnest(range(1, greatest(len(words) - 3, 1))) AS i, words FROM w),
s AS (SELECT r, i, words[i:i+4] AS win FROM g),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM s) WHERE c > 1),
p AS (SELECT r, count(DISTINCT i + j) AS n FROM d, (SELECT unnest(range(0, 5)) AS j) GROUP BY r),
m AS (SELECT w.r, doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN p ON w.r = p.r),
b AS (SELECT *, CAST((CASE WHEN n_words < 10 THEN 1 ELSE 0 END)
        | (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
        | (CASE WHEN 20 * n_symbols > n_words * 5 AND n_symbols > 4 THEN 4 ELSE 0 END)
        | (CASE WHEN n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END)
        | (CASE WHEN word_chars > 40 * n_words THEN 16 ELSE 0 END)
        | (CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END) AS BIGINT) AS failed_bits
      FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits
FROM b
"""
