"""Quality rules as a bitmask ledger.

Each text is measured once and each rule evaluated once; the ledger keeps the measurements and one bit for each rule that
failed. A policy is a version and a mask: a document is kept if none of the mask's bits is set. Another policy, or the effect of
leaving one rule out, is a matter of bitwise arithmetic and sums over the ledger; texts are not read again.

Defined results: a null text has no words and fails as an empty one does; very long texts are measured whole; repeated rows are
measured alike; an empty table gives an empty ledger. Columns that the ledger adds get an underscore where the table has their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fields, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
NAMES = tuple(x.split()[0] for x in MEASURES.split(", "))


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL over the measurements


#: The place of a rule is its bit; rules are only ever appended.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("long_words", "word_chars > 20 * n_words"),
)
#: Versions of the policy: the names of the rules that it applies.
POLICIES = {1: ("few_words", "repeated_words"), 2: ("few_words", "repeated_words", "symbols", "repeated_lines", "long_words")}
CURRENT = 2


def measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    repeated = 0
    if len(counts := Counter(windows)) < len(windows):
        reach = 0  # words before this place are counted
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 5 - max(i, reach)
                reach = i + 5
    return len(words), sum(map(len, words)), len(SYMBOL.findall(text)), len(lines), len(lines) - len(set(lines)), repeated


@F.pandas_udf(fields(MEASURES))
def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame(list(map(measure, texts)), columns=NAMES)


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    return sum(1 << i for i, r in enumerate(rules) if r.name in names)


def ledger(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, prefix: str = "") -> DataFrame:
    """docs with the measurements and failed (long): bit i is set if rule i failed."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), measured(F.col(f"`{text}`")).alias("m"))
    whole = whole.select("doc", "m.*")
    bits = sum((F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(0).cast("long") for i, r in enumerate(rules)), F.lit(0).cast("long"))
    whole = whole.withColumn("failed", bits)
    free = lambda name: name if name not in docs.columns else free(f"{name}_")
    return whole.select("doc.*", *[F.col(x).alias(free(f"{prefix}{x}")) for x in (*NAMES, "failed")])


def fails(policy: int, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) != 0


def ablations(ledgers: DataFrame, policy: int = CURRENT, rules: tuple[Rule, ...] = RULES, failed: str = "failed") -> DataFrame:
    """For each rule of a policy: documents that fail it, that only it rejects, and that the policy would keep without it."""
    whole = mask(POLICIES[policy], rules)
    used = [(i, r.name) for i, r in enumerate(rules) if whole >> i & 1]
    held = F.col(failed).bitwiseAND(F.lit(whole).cast("long"))
    sums = [F.count(F.lit(1)).alias("n_docs"), F.count_if(held == 0).alias("kept")]
    sums += [F.count_if(held.bitwiseAND(F.lit(1 << i).cast("long")) != 0).alias(f"fail{i}") for i, _ in used]
    sums += [F.count_if(held == 1 << i).alias(f"only{i}") for i, _ in used]
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"fail{i}").alias("n_failed"), F.col(f"only{i}").alias("n_only"), (F.col("kept") + F.col(f"only{i}")).alias("kept_without")) for i, name in used])
    return ledgers.agg(*sums).select("n_docs", "kept", F.explode(rows).alias("r")).select("r.*", "kept", "n_docs")


def op6_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", fails(1).alias("base_failed"), (~fails(CURRENT)).alias("kept"), "n_lines", "failed")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    rows = ledger(docs)
    return rows.where(~fails(CURRENT, f"`{rows.columns[-1]}`")).select(*[f"`{c}`" for c in docs.columns])


MEASURED_SQL = r"""
SELECT d.*, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
       CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
       CAST(len(lines) AS BIGINT) AS n_lines,
       CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
       CAST(coalesce(len(list_distinct(flatten(list_transform(
         list_filter(range(1, greatest(len(words) - 3, 1)), lambda i: len(windows) > 0 AND counts[windows[i]] > 1),
         lambda i: [i, i + 1, i + 2, i + 3, i + 4])))), 0) AS BIGINT) AS n_repeat_words
FROM (
  SELECT *, CASE WHEN len(windows) > 0 THEN list_histogram(windows) END AS counts
  FROM (
    SELECT *, list_transform(range(1, greatest(len(words) - 3, 1)), lambda i: array_to_string(words[i:i + 4], ' ')) AS windows
    FROM (
      SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
      FROM (SELECT *, coalesce(text, '') AS body FROM docs)))) d
"""
BITS_SQL = " + ".join(f"CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END" for i, r in enumerate(RULES))
OP6_SQL = f"""
WITH docs AS (SELECT doc_id, text FROM documents), measured AS ({MEASURED_SQL}), ledger AS (SELECT *, CAST({BITS_SQL} AS BIGINT) AS failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & {mask(POLICIES[1])}) <> 0 AS base_failed,
       (failed & {mask(POLICIES[CURRENT])}) = 0 AS kept, n_lines, failed
FROM ledger
"""
