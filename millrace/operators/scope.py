"""What a text rules out: statements below headings of things that are not goals, in clauses that say so, and in rows of tables marked with a symbol that the text defines so.

Lines are numbered, and what a line needs to know of others comes from windows over its text's lines: the last heading before it (the section), and all symbols that legend lines define (the legend is read before any
line is judged). Texts in which no marker and no such heading occurs are left out before lines are made.

Defined results: a null or empty text says nothing; a table's row gives its first cell only, whatever its status says besides; nothing is inferred from other words.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import phrases

# fixed values: the markers, headings and words that results must agree on
MARKERS = ("out of scope", "out-of-scope", "not supported", "no plans to", "not planned", "non-goal", "not a goal", "won't support", "will not support", "won't implement", "will not implement", "not in scope")
HEADINGS = ("non-goals", "non goals", "out of scope", "out-of-scope", "not supported", "unsupported", "what it is not", "what this is not", "what it doesn't do", "what it does not do", "not planned")
FORWARD = ("no plans to", "not planned", "won't support", "will not support", "won't implement", "will not implement")
FILLER = ("is are was be being currently yet still also now explicitly intentionally deliberately considered and or support supporting add adding implement offer :").split()
SEPARATORS = ("=", ":", "-", "·", "|", "—", "–", "/", "*", "**")


#: Texts of a task, about.
TEXTS_AT_ONCE = 50_000


@dataclass(frozen=True)
class Scope:
    """lead: words that are read of an item, and one more of a list after a marker. subject: words of a subject before a marker; a longer one is not read."""

    markers: Sequence[str] = MARKERS
    headings: Sequence[str] = HEADINGS
    lead: int = 3
    subject: int = 3

    @property
    def marker(self) -> str:
        return "(?i)(?:" + "|".join(re.escape(m) for m in self.markers) + ")"

    @property
    def heading(self) -> str:
        return r"(?i)^\s{0,3}#{1,6}\s*(?:" + "|".join(re.escape(h) for h in self.headings) + ")"


def tokens(x: Column) -> Column:
    return F.filter(F.split(x, r"\s+"), lambda w: w != "")


def bare(x: Column) -> Column:
    """Without the bullet, number or quote mark that a line begins with."""
    return F.regexp_replace(x, r"^[\s\-*+>#\d.)]+", "")


def symbol(line: Column, scope: Scope) -> Column:
    """The symbol that a legend line defines: of the three words before its first marker the last without letters and digits."""
    before = tokens(F.regexp_extract(line, f"(?s)^(.*?){scope.marker}", 1))
    near = F.reverse(F.slice(before, F.greatest(F.size(before) - 2, F.lit(1)), 3))
    signs = F.filter(near, lambda w: ~w.rlike("(?i)[a-z0-9]") & ~w.isin(*SEPARATORS))
    return F.when(line.rlike(scope.marker) & ~F.ltrim(line).startswith("|"), F.get(signs, F.lit(0)))


def clauses(line: Column, scope: Scope) -> Column:
    """Statements of a line's clauses: for each marker a short subject before it, or what is listed after it."""

    def said(clause: Column) -> Column:
        rest, marks = F.split(clause, scope.marker, -1), F.regexp_extract_all(clause, F.lit(scope.marker), F.lit(0))
        pieces = F.zip_with(rest, marks, lambda a, b: F.struct(F.coalesce(a, F.lit("")).alias("a"), F.coalesce(b, F.lit("")).alias("b")))
        text = lambda some: F.aggregate(some, F.lit(""), lambda x, p: F.concat(x, p["a"], p["b"]))

        def one(k: Column) -> Column:
            before = F.concat(text(F.slice(pieces, F.lit(1), k - 1)), F.element_at(rest, k))
            after = text(F.slice(pieces, k + 1, F.size(pieces)))
            subject = F.filter(tokens(bare(before)), lambda w: ~F.btrim(w, F.lit("*_`")).isin(*FILLER))
            listed = F.filter(tokens(after), lambda w: ~F.btrim(w, F.lit(":*_`")).isin(*FILLER, "to"))
            none = F.array().cast("array<string>")
            short = F.when(F.size(subject).between(1, scope.subject), subject).otherwise(none)
            onward = (F.size(subject) == 0) | F.lower(F.element_at(marks, k)).isin(*FORWARD)
            return F.array_join(F.concat(short, F.when(onward, F.slice(listed, 1, scope.lead + 1)).otherwise(none)), " ")

        return F.transform(F.when(F.size(marks) > 0, F.sequence(F.lit(1), F.size(marks))).otherwise(F.array().cast("array<int>")), one)

    parts = F.split(line, r"(?i)(?<=[.;!?])\s+|\s+but\s+|,\s*(?:while|whereas)\s+")
    return F.filter(F.flatten(F.transform(parts, said)), lambda x: x != "")


def statements(texts: DataFrame, scope: Scope = Scope()) -> DataFrame:
    """id, line (from 1), form (section, clause, table), statement. texts: id, t."""
    # texts are much work and few bytes: they are dealt before it, so that a table in one file is not one task
    dealt = texts.select("id", "t").repartition(max(3 * texts.sparkSession.sparkContext.defaultParallelism, -(-texts.count() // TEXTS_AT_ONCE)), "id")
    some = dealt.where(F.col("t").rlike(scope.marker) | F.col("t").rlike("(?m)" + scope.heading))
    lines = some.select("id", F.posexplode(F.split("t", r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]")).alias("line", "x"))
    order = Window.partitionBy("id").orderBy("line")
    heading = F.col("x").rlike(r"^\s{0,3}#{1,6}\s")
    known = lines.withColumn("heading", heading).withColumn("sign", symbol(F.col("x"), scope))
    known = known.withColumn("section", F.coalesce(F.last(F.when(F.col("heading"), F.col("x").rlike(scope.heading)), True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(False)))
    known = known.withColumn("legend", F.collect_set("sign").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    s = F.trim(F.regexp_replace("x", r"^\s+|\s+$", ""))
    known = known.withColumn("s", s).where(~F.col("heading") & (F.col("s") != "") & ~F.col("s").rlike(r"^\|?\s*:?-{2,}"))
    cells = F.transform(F.split(F.btrim("s", F.lit("|")), r"\|"), lambda c: F.regexp_replace(c, r"^\s+|\s+$", ""))
    status = F.coalesce(F.get(cells, F.lit(1)), F.lit(""))
    marked = F.col("section") | status.rlike(scope.marker) | F.exists("legend", lambda sign: status.startswith(sign))
    table = F.col("s").startswith("|")
    form = F.when(table, F.when(marked, "table")).when(F.col("section"), "section").otherwise("clause")
    lead = F.array_join(F.slice(tokens(bare(F.col("s"))), 1, scope.lead), " ")
    found = F.when(table, F.array(F.get(cells, F.lit(0)))).when(F.col("section"), F.array(lead)).otherwise(clauses(F.col("s"), scope))
    return known.select("id", (F.col("line") + 1).alias("line"), form.alias("form"), F.explode(found).alias("statement")).where("form is not null")


def ruled_out(said: DataFrame, features: DataFrame) -> DataFrame:
    """id, feature: the features that a text's statements name as words of their own (a part of a dotted, slashed or hyphenated name is none). features: feature."""
    rows = said.select("id", F.lower("statement").alias("t")).distinct()
    found = phrases.hits(rows.select(F.col("t").alias("id"), "t").distinct(), features.select(F.lower("feature").alias("phrase")))
    alone = found.where((F.col("at") == 0) | ~F.substr("id", F.greatest(F.col("at"), F.lit(1)).cast("int"), F.lit(1)).rlike(r"[\w\-./]"))
    return rows.join(alone.select(F.col("id").alias("t"), F.col("phrase").alias("feature")), "t").select("id", "feature").distinct()
