"""Toxicity by a weighted finite-state pattern grammar.

Small transducers rewrite the words of a clause one after another:

* the insult lexicon (learned stems and words with weights) and the threat words turn
  words into ``I`` and ``T``, and marks the targets, negators and speech verbs as
  ``P``, ``N`` and ``R``;
* the negation transducer rewrites ``I`` and ``T`` in the scope of ``N`` to ``i`` and ``t``;
* the reported-speech transducer rewrites what follows ``R`` in the clause to ``q``;
* the target transducer marks an ``I`` or ``T`` beside a ``P`` as ``J`` or ``U``.

A weighted acceptor then reads the rewritten clause.  Its state is the strongest symbol so
far, its weight the sum of the words with the force of that state (plain before negated
before reported: a stronger one starts the sum anew).  A clause that ends in such a state
is accepted as that pattern with that weight, once; a clause without any symbol is not
accepted and counts for nothing.  A document's features are, by pattern, the number of
accepted clauses, their weights together and the weight of the strongest one.  A logistic
regression over them, fitted on a bounded sample of labelled rows, learns what a clause of
each pattern counts for; an insult that nothing aims at is a pattern of its own, as are
negated and reported ones.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relload.llm.common import map_texts

MAX_LABELLED = 40_000  # labelled rows the model is fitted on, at most
MAX_LEXICON = 5_000  # insult words and stems kept, at most
MIN_TOXIC = 3  # toxic sampled texts an entry of the lexicon must occur in, at least
MIN_LOG_ODDS = 1.5
STEMS = (4, 5, 6)  # prefix lengths tried beside whole words
SCOPE = 3  # words a negator or a target reaches

# Function words of the grammar (English, German, French, Spanish).
THREATS = frozenset("kill hurt beat shoot stab destroy punish burn töten schlagen sterben tuer frapper mourir brûler matar golpear morir quemar".split())
TARGETS = frozenset("you your yours he him she her they them these those du dich dein ihr euch sie tu te toi ton vous il elle ils elles tú usted ustedes él ella ellos ellas".split())
NEGATORS = frozenset("not no never neither nor without nicht kein keine nie niemals ohne pas jamais ni sans nunca jamás sin".split())
REPORTS = frozenset("said says say told called wrote quoted claims claimed sagte sagt nannte schrieb dit disait appelé écrit dijo dice llamó escribió".split())

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:,\n\r]+")
SYMBOLS = "IJTUiqt"
STRENGTH = {s: n for n, s in enumerate("qitITJU")}  # states of the acceptor, weakest first
FORCE = {s: 0 if s == "q" else 1 if s in "it" else 2 for s in SYMBOLS}  # reported, negated, plain
FEATURES = [f"{s}{x}" for s in SYMBOLS for x in ("n", "w", "most")]


@dataclass
class Model:
    """Insult words and stems with weights, and the regression over the pattern features."""

    words: dict
    stems: dict
    weights: list
    bias: float

    def insult(self, word: str) -> float:
        found = [self.words.get(word, 0.0)] + [self.stems.get(word[:n], 0.0) for n in STEMS if len(word) > n]
        return max(found)


def units(text: str) -> set:
    """The entries a text could give the lexicon: its words (``=word``) and their stems."""
    out = set()
    for w in set(WORD.findall(text.lower())):
        out.add("=" + w)
        out.update(w[:n] for n in STEMS if len(w) > n)
    return out


def _lexical(words: list[str], insult: dict) -> list[str]:
    return [
        "I" if w in insult else "T" if w in THREATS else "N" if w in NEGATORS else "R" if w in REPORTS else "P" if w in TARGETS else "-"
        for w in words
    ]


def _negation(tape: list[str]) -> list[str]:
    """States count down the words left in a negator's scope."""
    left, out = 0, []
    for s in tape:
        out.append(s.lower() if left and s in "IT" else s)
        left = SCOPE if s == "N" else max(0, left - 1)
    return out


def _reported(tape: list[str]) -> list[str]:
    """From a speech verb to the end of the clause, insults and threats are someone else's."""
    said, out = False, []
    for s in tape:
        out.append("q" if said and s in "ITit" else s)
        said = said or s == "R"
    return out


def _target(tape: list[str]) -> list[str]:
    """An insult or threat with a target in reach on either side is aimed."""
    aimed = {"I": "J", "T": "U"}
    return [aimed[s] if s in aimed and "P" in tape[max(0, i - SCOPE) : i + SCOPE + 1] else s for i, s in enumerate(tape)]


def _accepted(tape: list[str], weights: list[float]) -> tuple[str, float] | None:
    """State and weight in which the acceptor ends on a rewritten clause; None if it never leaves its start."""
    state, total = None, 0.0
    for s, w in zip(tape, weights):
        if s not in FORCE or (state and FORCE[s] < FORCE[state]):
            continue
        total = w if not state or FORCE[s] > FORCE[state] else total + w
        state = s if not state or STRENGTH[s] > STRENGTH[state] else state
    return (state, total) if state else None


def _tapes(text: str, insult: dict):
    """(rewritten tape, weights of its words) of every clause that holds an insult or threat word."""
    hot = set(insult) | THREATS
    for clause in CLAUSE.split(text.lower()):
        words = WORD.findall(clause)
        if hot.isdisjoint(words):
            continue
        tape = _lexical(words, insult)
        for rewrite in (_negation, _reported, _target):
            tape = rewrite(tape)
        yield tape, [insult.get(w, 1.0) for w in words]


def clause_patterns(text: str, insult: dict) -> list[tuple[str, float]]:
    """(symbol, weight) of every insult and threat word of the clauses of ``text``, rewritten; ``insult`` maps its insult words to weights."""
    return [(s, w) for tape, weights in _tapes(text, insult) for s, w in zip(tape, weights) if s in FORCE]


def clause_scores(text: str, insult: dict) -> list[tuple[str, float]]:
    """(pattern, weight) of every accepted clause of ``text``, in order."""
    return [hit for tape, weights in _tapes(text, insult) if (hit := _accepted(tape, weights))]


def features(text: str, model: Model, memo: dict):
    """By pattern: log number of accepted clauses, log of their weights together, log weight of the strongest."""
    import numpy as np

    x = np.zeros(len(FEATURES))
    insult, threat = {}, False
    for w in set(WORD.findall(text.lower())):
        weight = memo.get(w)
        if weight is None:
            if len(memo) > 1_000_000:
                memo.clear()
            weight = memo[w] = model.insult(w)
        if weight:
            insult[w] = weight
        threat = threat or w in THREATS
    if insult or threat:
        for symbol, weight in clause_scores(text, insult):
            i = 3 * SYMBOLS.index(symbol)
            x[i] += 1
            x[i + 1] += weight
            x[i + 2] = max(x[i + 2], weight)
    return np.log1p(x)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from labelled rows (``learn`` is a column over the labels, true where a row may be used).

    The sample is the ``MAX_LABELLED`` labelled ids with the smallest hash; an id labelled
    twice counts as toxic if either label says so.  Entries of the lexicon are counted by
    Spark over the sample's texts.  With no labels, or labels of one class, the model
    scores every text 0.
    """
    import numpy as np
    import pyarrow as pa

    key = F.col(id_col)
    known = labels.where(learn).select(key.alias("id"), F.col(label_col).alias("y")).where("id is not null and y is not null")
    sample = known.groupBy("id").agg(F.max("y").cast("int").alias("y")).orderBy(F.xxhash64("id"), "id").limit(MAX_LABELLED)
    # at most MAX_LABELLED rows of two numbers: small enough for every task
    rows = docs.select(key.alias("id"), F.col(text_col).alias("text")).where("text is not null").join(F.broadcast(sample), "id")

    rows = rows.withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(2)).cast("int"))

    def count_units(batches):
        n = {}  # by fold and class, the texts that hold each unit; "" counts the texts
        for b in batches:
            for text, y, fold in zip(*(c.to_pylist() for c in b.columns)):
                seen = n.setdefault((fold, y > 0), Counter())
                seen.update(units(text))
                seen[""] += 1
        names = sorted(set().union(*n.values()))
        columns = [pa.array([n.get(k, {}).get(u, 0) for u in names], pa.int64()) for k in _CLASSES]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *columns], names=["unit", *_COUNTS])

    counted = map_texts(rows.select("text", "y", "fold"), count_units, "unit string, " + ", ".join(f"{c} long" for c in _COUNTS))
    counts = counted.groupBy("unit").agg(*[F.sum(c).alias(c) for c in _COUNTS]).persist()
    total = counts.where("unit = ''").first()
    empty = Model({}, {}, [0.0] * len(FEATURES), -20.0)
    if total is None or not total["t0"] + total["t1"] or not total["c0"] + total["c1"]:
        counts.unpersist()
        return empty
    # a half's patterns are matched with the other half's lexicon, so that the regression
    # sees what an entry is worth on texts it was not learned from
    other = [_lexicon(counts, total, [1]), _lexicon(counts, total, [0])]
    model = _lexicon(counts, total, [0, 1])
    counts.unpersist()

    def vectors(batches):
        memo: list = [{}, {}]
        for b in batches:
            x = [features(t, other[f], memo[f]).tolist() for t, f in zip(b.column(1).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(x, pa.list_(pa.float64()))], names=["id", "y", "x"])

    schema = T.StructType([rows.schema["id"]]).add("y", T.IntegerType()).add("x", T.ArrayType(T.DoubleType()))
    one = map_texts(rows.select("id", "text", "y", "fold"), vectors, schema).groupBy("id", "y").agg(F.max("x").alias("x"))
    fitted = one.orderBy("id").toPandas()  # at most one row a sampled id
    x, y = np.stack(fitted["x"]), (fitted["y"].to_numpy() > 0).astype(float)
    model.weights, model.bias = _regression(x, y)
    return model


_COUNTS = ["c0", "c1", "t0", "t1"]  # clean and toxic texts of either half
_CLASSES = [(0, False), (1, False), (0, True), (1, True)]


def _lexicon(counts: DataFrame, total, folds: list[int]) -> Model:
    """The ``MAX_LEXICON`` strongest entries of some halves; an entry weighs its log odds less their standard error."""
    toxic, clean = (sum((F.col(f"{c}{f}") for f in folds), F.lit(0)) for c in "tc")
    t, c = (sum(total[f"{x}{f}"] for f in folds) for x in "tc")
    odds = F.log((F.col("t") + 0.5) / F.lit(t + 1.0)) - F.log((F.col("c") + 0.5) / F.lit(c + 1.0))
    sure = odds - F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    rows = (
        counts.where("unit <> ''").select("unit", toxic.alias("t"), clean.alias("c")).where(F.col("t") >= MIN_TOXIC)
        .withColumn("sure", sure).where(F.col("sure") >= MIN_LOG_ODDS)
        .orderBy(F.desc(F.col("sure") * F.log(F.col("t") + 1.0)), "unit").limit(MAX_LEXICON).collect()
    )
    words = {r["unit"][1:]: r["sure"] for r in rows if r["unit"].startswith("=")}
    return Model(words, {r["unit"]: r["sure"] for r in rows if not r["unit"].startswith("=")}, [0.0] * len(FEATURES), -20.0)


def _regression(x, y):
    """Ridge logistic regression by Newton steps."""
    import numpy as np

    z = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    ridge = np.full(z.shape[1], 1e-2 * max(1.0, len(x) ** 0.5))
    ridge[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
        w += step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1].tolist(), float(w[-1])


def score(docs: DataFrame, model: Model, text_col: str, score_out: str, patterns_out: str) -> DataFrame:
    """``docs`` with a score from 0 to 1 and the number of accepted clauses by pattern.

    Null and empty texts have no patterns and get the score of a text without any;
    whole texts are read, however long.  Every row is kept, repeated rows each; all
    columns of ``docs`` are kept.  One pass without a shuffle.
    """
    import pyarrow as pa

    schema = T.StructType([*docs.schema.fields, T.StructField(score_out, T.DoubleType()), T.StructField(patterns_out, T.MapType(T.StringType(), T.IntegerType()))])
    place = docs.columns.index(text_col)

    def run(batches):
        import numpy as np

        w, memo = np.array(model.weights), {}
        for b in batches:
            x = [features(t or "", model, memo) for t in b.column(place).to_pylist()]
            p = [float(1 / (1 + np.exp(-np.clip(v @ w + model.bias, -30, 30)))) for v in x]
            n = [[(s, int(round(float(np.expm1(v[3 * i]))))) for i, s in enumerate(SYMBOLS) if v[3 * i]] for v in x]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64()), pa.array(n, pa.map_(pa.string(), pa.int32()))], names=schema.names)

    return map_texts(docs, run, schema)
