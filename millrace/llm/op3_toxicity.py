"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses. A lexical transducer maps each word to a symbol: an insult (with a strength, by whole words and by
stems), a threat, a target, a negation, a verb or mark of reported speech, or another word. Three transducers over these symbols are
composed into one: negation marks the insults and threats of the few words after it, reported speech those up to the clause's
end, and a target binds those near it, before or after. The last is not deterministic: before it has seen the target it may take an insult as
aimed, but is then accepted only if a target follows in time. Arcs have weights; of a clause's accepted paths the best one
counts. An insult so leaves the composition as plain, aimed, negated or reported, a threat as aimed or loose. Clauses without an
insult or a threat emit nothing.

What is scored are matched clauses: a document's score is a logistic function of the logarithms of what its clauses have emitted by kind, of how many
more clauses than one match, and of their share of all clauses. A single plain word in a text of some length does not
reach one half; a second clause, a target, or a very short text does.

The insult lexicon and the weights of these features are learned from labelled rows; the other lexicons are fixed and given as
parameters. Learning uses a sample of labelled rows bounded by `Fit.max_rows`, drawn by a hash of the document id. Patterns
are counted inside Spark; those whose association with the label is beyond chance come to the driver and are broadcast: no more than the bounded sample
has. Scoring reads every text whole.

Defined results: a null text is an empty one; texts without any match have the score of the bias; a null document id is not held
out; rows with equal texts have equal scores; without labelled rows the fixed lexicons alone decide; repeated label rows for one
document count once (toxic if any says so); an empty table gives an empty result; a score column that the table already has gets the name
with an underscore. Very long texts are scored whole, clause by clause.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Hashable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import cut, fields, table, text_of

CLAUSE = re.compile(r"[.!?;:\n]+")
TOKEN = re.compile(r"[^\W_]+|[\"«»„“”]")
STEMS = (3, 4, 5, 6, 7, 8)
#: Words of the fixed lexicons, in English, German, French and Spanish.
THREATS = frozenset("kill hurt destroy murder attack shoot stab strangle töten umbringen schlagen erschiessen vernichten tuer frapper détruire assassiner matar golpear destruir asesinar".split())
TARGETS = frozenset("you your yours u he she they him her them du dich dir ihr euch sie ihn tu te toi vous ton ta il elle ils elles eux usted ustedes tú ti él ella ellos ellas".split())
NEGATIONS = frozenset("not never no isn aren wasn weren don doesn didn nobody nicht nie kein keine keinen niemals jamais aucun aucune nunca jamás tampoco".split())
REPORTS = frozenset("said says saying called calls claimed claims wrote quoted told reported sagte sagt nannte schrieb behauptete disait appelé écrit dijo dice llamó escribió".split()) | frozenset('"«„“')
EMISSIONS = ("plain", "aimed", "negated", "reported", "threat", "loose_threat")
#: Symbols of the lexical transducer; other words are OTHER.
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult", "threat", "target", "negation", "report", "other"
SYMBOLS = (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER)


@dataclass(frozen=True)
class Fit:
    """max_rows: labelled rows learned from. min_share: of the texts with a pattern, those that are toxic. margin: natural logarithm by which an association must beat chance over all candidates.
    prior: weights of the bias, the emissions, further clauses and the share of clauses before any row is seen, and how firmly."""

    max_rows: int = 20_000
    min_share: float = 0.9
    margin: float = 3.0
    prior: tuple[float, ...] = (-4.5, 3.0, 6.0, 1.0, 1.0, 5.0, 1.0, 4.0, 3.0)
    firmness: float = 1.0


@dataclass(frozen=True)
class Machine:
    """A weighted transducer: arcs from (state, symbol read) to (symbol written, weight, next state)."""

    start: Hashable
    finals: frozenset
    arcs: dict[tuple[Hashable, str], tuple[tuple[str, float, Hashable], ...]]

    def paths(self, symbols: list[str]) -> Iterator[tuple[float, list[str]]]:
        """Every accepted path, one by one."""

        def on(state: Hashable, at: int, weight: float, written: list[str]) -> Iterator[tuple[float, list[str]]]:
            if at == len(symbols):
                if state in self.finals:
                    yield weight, written
                return
            for out, w, then in self.arcs.get((state, symbols[at]), ()):
                yield from on(then, at + 1, weight + w, [*written, out])

        yield from on(self.start, 0, 0.0, [])

    def best(self, symbols: list[str]) -> list[str] | None:
        """What the accepted path of the largest weight writes; the first in the order of arcs if several have it."""
        reached: dict[Hashable, tuple[float, tuple | None]] = {self.start: (0.0, None)}
        for symbol in symbols:
            then: dict[Hashable, tuple[float, tuple | None]] = {}
            for state, (weight, written) in reached.items():
                for out, w, q in self.arcs.get((state, symbol), ()):
                    if q not in then or weight + w > then[q][0]:
                        then[q] = (weight + w, (written, out))
            reached = then
        ends = [x for q, x in reached.items() if q in self.finals]
        if not ends:
            return None
        written, out = max(ends, key=lambda x: x[0])[1], []
        while written is not None:
            written, symbol = written
            out.append(symbol)
        return out[::-1]


def composed(a: Machine, b: Machine) -> Machine:
    """The transducer that writes what b writes on reading what a writes; weights add up."""
    start, arcs = (a.start, b.start), {}
    todo, seen = [start], {start}
    leaving: dict[Hashable, list] = {}
    for (q, symbol), found in a.arcs.items():
        leaving.setdefault(q, []).append((symbol, found))
    while todo:
        p, q = todo.pop()
        for symbol, found in leaving.get(p, ()):
            both = [(out, wa + wb, (pa, qb)) for mid, wa, pa in found for out, wb, qb in b.arcs.get((q, mid), ())]
            if both:
                arcs[(p, q), symbol] = tuple(both)
            for _, _, state in both:
                if state not in seen:
                    seen.add(state)
                    todo.append(state)
    return Machine(start, frozenset((p, q) for p, q in seen if p in a.finals and q in b.finals), arcs)


def negation_machine(reach: int) -> Machine:
    """States: words for which a negation stays open. Writes `negated` for an insult or a threat under one."""
    arcs = {}
    for left in range(reach + 1):
        for x in SYMBOLS:
            then = reach if x == NEGATION else max(0, left - 1)
            arcs[left, x] = (("negated" if left and x in (INSULT, THREAT) else x, 0.0, then),)
    return Machine(0, frozenset(range(reach + 1)), arcs)


def report_machine() -> Machine:
    """Whether speech is reported, up to the end of the clause. Writes `reported` for an insult or a threat in it."""
    arcs = {(0, x): ((x, 0.0, int(x == REPORT)),) for x in (*SYMBOLS, "negated")}
    arcs |= {(1, x): (("reported" if x in (INSULT, THREAT, "negated") else x, 0.0, 1),) for x in (*SYMBOLS, "negated")}
    return Machine(0, frozenset((0, 1)), arcs)


def target_machine(reach: int) -> Machine:
    """States: (words for which a target before binds, 0), or (0, words within which a target must follow). Writes EMISSIONS, or OTHER; a path on which an insult or a threat is aimed weighs more."""
    kinds = {INSULT: ("plain", "aimed"), THREAT: ("loose_threat", "threat")}
    arcs = {}
    for near in range(reach + 1):
        on = (max(0, near - 1), 0)
        for x in (*SYMBOLS, "negated", "reported"):
            if x == TARGET:
                arcs[(near, 0), x] = ((OTHER, 0.0, (reach, 0)),)
            elif x not in kinds:
                arcs[(near, 0), x] = ((x if x in EMISSIONS else OTHER, 0.0, on),)
            elif near:
                arcs[(near, 0), x] = ((kinds[x][1], 1.0, on),)
            else:
                arcs[(near, 0), x] = ((kinds[x][0], 0.0, on), (kinds[x][1], 1.0, (0, reach)))
    for wait in range(1, reach + 1):
        for x in (*SYMBOLS, "negated", "reported"):
            if x == TARGET:
                arcs[(0, wait), x] = ((OTHER, 0.0, (reach, 0)),)
            elif wait > 1:
                arcs[(0, wait), x] = ((kinds[x][1], 1.0, (0, wait - 1)),) if x in kinds else ((x if x in EMISSIONS else OTHER, 0.0, (0, wait - 1)),)
    return Machine((0, 0), frozenset((near, 0) for near in range(reach + 1)), arcs)


@functools.lru_cache(8)
def clause_machine(negation_reach: int, target_reach: int) -> Machine:
    return composed(composed(negation_machine(negation_reach), report_machine()), target_machine(target_reach))


@dataclass(frozen=True)
class Grammar:
    insults: dict[str, float] = field(default_factory=dict)  # word, or stem and "*", to strength: the logarithm of its odds, divided by five
    weights: tuple[float, ...] = Fit.prior
    negation_reach: int = 3  # words
    target_reach: int = 4

    def starts(self) -> frozenset[str]:
        return frozenset(k.rstrip("*")[: STEMS[0]] for k in self.insults) | frozenset(w[: STEMS[0]] for w in THREATS)

    def symbol(self, word: str) -> tuple[str, float]:
        """The lexical transducer: what a word is, and how strongly; an insult by the best of the whole word and its stems."""
        if word in NEGATIONS:
            return NEGATION, 0.0
        if word in REPORTS:
            return REPORT, 0.0
        if word in TARGETS:
            return TARGET, 0.0
        if word in THREATS:
            return THREAT, 1.0
        get = self.insults.get
        strength = max(get(word, 0.0), *(get(word[:n] + "*", 0.0) for n in STEMS if len(word) >= n), 0.0)
        return (INSULT, strength) if strength else (OTHER, 0.0)

    def clause(self, words: list[str]) -> list[tuple[str, float]]:
        """What the best path through the composed machines emits for one clause: kinds and strengths."""
        read = [self.symbol(w) for w in words]
        if not any(x in (INSULT, THREAT) for x, _ in read):
            return []
        written = clause_machine(self.negation_reach, self.target_reach).best([x for x, _ in read])
        return [(kind, strength) for kind, (_, strength) in zip(written, read, strict=True) if kind in EMISSIONS]

    def matches(self, text: str) -> tuple[dict[str, float], int, int]:
        """Strengths by kind, the clauses that match other than by negated or reported words, and all clauses."""
        emitted, starts, matched, clauses = dict.fromkeys(EMISSIONS, 0.0), self._starts, 0, 0
        for clause in CLAUSE.split(text.lower()):
            words = TOKEN.findall(clause)
            clauses += bool(words)
            if any(w[: STEMS[0]] in starts for w in words):
                found = self.clause(words)
                for kind, strength in found:
                    emitted[kind] += strength
                matched += any(kind not in ("negated", "reported") for kind, _ in found)
        return emitted, matched, clauses

    def emissions(self, text: str) -> tuple[float, ...]:
        return tuple(round(x, 6) for x in self.matches(text)[0].values())

    def features(self, text: str) -> tuple[float, ...]:
        emitted, matched, clauses = self.matches(text)
        return (*(round(math.log1p(x), 6) for x in emitted.values()), round(math.log1p(max(0, matched - 1)), 6), round(matched / max(1, clauses), 6))

    def __post_init__(self) -> None:
        object.__setattr__(self, "_starts", self.starts())

    def score(self, features: tuple[float, ...]) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], features, strict=True))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


#: Files that the bounded sample, and what is counted of it, are written to.
FILES = 16


def candidates(text: Column) -> Column:
    """A text's different words of at least three letters, and their stems."""
    words = F.array_distinct(F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), lambda w: F.length(w) >= STEMS[0]))
    stems = [F.transform(F.filter(words, lambda w, n=n: F.length(w) >= n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*"))) for n in STEMS]
    return F.array_distinct(F.concat(words, *stems))


def sample(docs: DataFrame, labels: DataFrame, fit: Fit) -> DataFrame:
    """text, toxic of at most about max_rows labelled documents, none of them held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, fit.max_rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # the bound of the sample is what makes this small enough to broadcast
    rows = docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(known), "doc_id").select("text", (F.col("toxic") == 1).cast("int").alias("toxic"))
    return cut(rows.repartition(FILES))  # a bounded sample, not one small file for each part of the table


def lexicon(rows: DataFrame, fit: Fit) -> dict[str, float]:
    n, toxic = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not toxic or toxic == n:
        return {}
    base = toxic / n
    counts = cut(rows.select("toxic", F.explode(candidates(F.col("text"))).alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k")).where("k >= 2").coalesce(FILES))
    # by the Chernoff bound, n times the divergence of the pattern's toxic share from the base rate is the logarithm of how unlikely chance is
    share = F.col("k") / F.col("n")
    beyond = F.col("n") * (share * F.log(share / base) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0))
    found = counts.where(share >= fit.min_share).withColumn("beyond", beyond).where(F.col("beyond") > math.log(max(1, counts.count())) + fit.margin)
    odds = F.log((F.col("k") + 0.5) / (F.col("n") - F.col("k") + 0.5))
    # each takes several rows of the bounded sample, so there are no more than that has words
    return {r["pattern"]: round(float(r["odds"]) / 5, 6) for r in found.select("pattern", odds.alias("odds")).collect()}


def learn(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Grammar:
    """docs: doc_id, text; labels: doc_id, toxic."""
    rows = sample(docs, labels, fit)
    grammar = Grammar(lexicon(rows, fit), fit.prior)
    seen = rows.select("toxic", emitting(grammar)(F.col("text")).alias("e")).groupBy("toxic", "e").agg(F.count(F.lit(1)).alias("n")).collect()
    if not seen:
        return grammar
    x = np.array([[1.0, *r["e"]] for r in seen])
    y, n = np.array([r["toxic"] for r in seen], float), np.array([r["n"] for r in seen], float)
    prior = np.array(fit.prior)
    w = prior.copy()

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((n * (np.logaddexp(0, z) - y * z)).sum() + fit.firmness * ((v - prior) ** 2).sum() / 2)

    for _ in range(100):  # Newton's method with halved steps, for the logistic likelihood with a normal prior
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (n * (y - p)) - fit.firmness * (w - prior)
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + fit.firmness * np.eye(len(w)), slope)
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-9:
            step /= 2
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    w[1:] = np.maximum(w[1:], 0.0)
    return Grammar(grammar.insults, tuple(round(float(v), 6) for v in w))


def emitting(grammar: Grammar):
    """A function of a text column: its features, as an array."""

    @F.pandas_udf("array<double>")
    def emitted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([list(grammar.features(x)) for x in texts], dtype=object)

    return emitted


def scored(docs: DataFrame, grammar: Grammar, text: str = "text", score: str = "score", emitted: str | None = None) -> DataFrame:
    """docs with the score of each whole text, and what was emitted if it gets a name. A name that docs already has gets an underscore."""
    kind = fields("score double, emitted string")

    @F.pandas_udf(kind)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for x in texts:
                features = grammar.features(x)
                rows.append((grammar.score(features), ", ".join(f"{k} {math.expm1(v):g}" for k, v in zip(EMISSIONS, features, strict=False) if v)))
            yield pd.DataFrame(rows, columns=["score", "emitted"])

    free = lambda name: name if name not in docs.columns else free(f"{name}_")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), judge(text_of(F.col(f"`{text}`"))).alias("s"))
    return whole.select("doc.*", F.col("s.score").alias(free(score)), *([F.col("s.emitted").alias(free(emitted))] if emitted else []))


def op3_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    rows = scored(docs, learn(docs, labels), emitted="emitted")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "emitted")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the grammar is learned from the labels of the whole table."""
    grammar = learn(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    rows = scored(docs, grammar)
    return rows.where(F.col(f"`{rows.columns[-1]}`") < 0.5).select(*[f"`{c}`" for c in docs.columns])
