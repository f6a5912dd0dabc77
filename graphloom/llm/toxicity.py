"""Toxicity by a weighted finite-state grammar over clauses, with a lexicon and weights that are learned from labelled rows.

A word transducer, a trie over code points, maps words to classes: insult (learned stems with weights), threat, target, negation and
reported speech. Three transducers over the classes of one clause mark what the words before and after an insult or threat make of
it: negated, reported, aimed at a target. Each is a table of arcs (state, input, next state, output, weight), and compose() makes one
transducer of them. A clause's score is the sum over its matches of the word's weight times the weights of the arcs; a document's
features are sums over its clauses and the score of the worst one, and a logistic model, fitted on the labelled rows, turns them into a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import release, releasing, written

#: Plain insults by language that the lexicon starts from, for where few rows are labelled; labelled rows confirm, outweigh or drop them.
INSULTS = {
    "en": "idiot moron fool imbecile stupid dumb loser clown jerk creep scum trash filth vermin pathetic worthless useless disgusting despicable",
    "de": "idiot trottel depp dummkopf blödmann versager abschaum dreckskerl widerlich wertlos erbärmlich",
    "fr": "idiot idiote imbécile crétin abruti connard ordure minable pathétique dégoûtant",
    "es": "idiota imbécil estúpido estúpida tonto basura escoria payaso patético asqueroso inútil",
}
#: The weight of an insult that labelled rows say nothing about.
PRIOR = 4.0
#: Words of the closed classes by language.
TARGET = {
    "en": "you your yours yourself yourselves u ur he him his she her hers they them their theirs",
    "de": "du dich dir dein deine deiner deinem deinen ihr euch euer eure sie ihn ihm ihnen er",
    "fr": "tu toi te ton ta tes vous votre vos il elle ils elles lui leur leurs eux",
    "es": "tú tu tus te ti usted ustedes vosotros vosotras vuestro vuestra él ella ellos ellas",
}
NEGATION = {
    "en": "not never no none nor neither nobody nothing without isn't aren't wasn't weren't don't doesn't didn't won't can't cannot ain't",
    "de": "nicht kein keine keinen keiner nie niemals niemand nichts ohne weder",
    "fr": "ne n'est pas jamais aucun aucune rien personne sans ni",
    "es": "no nunca jamás ningún ninguna ninguno nadie nada sin ni tampoco",
}
REPORTED = {
    "en": "said says say saying called calls told tells wrote writes claimed claims quoted quotes reported reports alleged allegedly",
    "de": "sagte sagt sagten nannte nennt schrieb schreibt behauptete behauptet laut zitierte angeblich",
    "fr": "dit disait disent appelé appelle écrit écrivait affirme affirmait selon cité prétend",
    "es": "dijo dice dicen llamó llama escribió escribe afirmó afirma según citó supuestamente",
}
THREAT = {
    "en": "kill murder hurt destroy beat burn stab shoot strangle smash",
    "de": "töten umbringen schlagen verprügeln erstechen erschießen verbrennen vernichten",
    "fr": "tuer frapper brûler poignarder détruire étrangler abattre",
    "es": "matar golpear quemar apuñalar destruir estrangular disparar",
}
#: Prefix lengths in code points that may become stems; a stem may also be a whole word.
STEM_LENGTHS = (3, 4, 5, 6, 7, 8)
FEATURES = ("total", "worst", "affirmed", "negated", "reported", "aimed", "threats")
#: Words between a negation or a target and the insult that it reaches.
REACH = 3

_SPLIT = re.compile(r"[\s,:;.!?()\[\]{}\"“”«»|&%$#*_=+<>/\\~^]+")
_CLAUSE = re.compile(r"[.!?;:\n]+|,(?=\s)")


def tokens(text: str) -> list[str]:
    return _SPLIT.split(text)


def stems(word: str) -> list[str]:
    """What can stand for a word in the lexicon: the word itself, marked with a final "$", and its prefixes."""
    return [word + "$", *(word[:k] for k in STEM_LENGTHS if len(word) > k)]


def bucket(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; the remainder 2 is held out from learning. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4))


@dataclass(frozen=True)
class Transducer:
    """Weighted, with start state 0 and one arc at most for a state and an input: (state, input) to (next state, output, weight)."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]

    def run(self, symbols: Iterable[str]) -> list[tuple[str, float]]:
        """Output and weight of each step from the start on."""
        state, out = 0, []
        for s in symbols:
            state, y, w = self.arcs[state, s]
            out.append((y, w))
        return out


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The transducer that feeds what ``a`` writes to ``b``; weights are multiplied. States are those pairs that the start reaches."""
    number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
    inputs: dict[int, list] = {}
    for (p, x), arc in a.arcs.items():
        inputs.setdefault(p, []).append((x, *arc))
    while todo:
        p, q = todo.pop()
        for x, p2, y, w in inputs.get(p, ()):
            if (q, y) in b.arcs:
                q2, z, v = b.arcs[q, y]
                if (p2, q2) not in number:
                    number[p2, q2] = len(number)
                    todo.append((p2, q2))
                arcs[number[p, q], x] = (number[p2, q2], z, w * v)
    return Transducer(arcs)


#: Classes of words: insult, threat, target, negation, reported speech, any other.
CLASSES = ("insult", "threat", "target", "negation", "reported", "other")
#: The weight of a match that is negated or reported, or aimed at a target.
NEGATED, QUOTED, AIMED = 0.25, 0.5, 1.5


def negation() -> Transducer:
    """State: how many words a negation still reaches. A match within it gets the mark "-"."""
    arcs = {}
    for left in range(REACH + 1):
        for x in CLASSES:
            after = REACH if x == "negation" else max(0, left - 1)
            hit = left and x in ("insult", "threat")
            arcs[left, x] = (after, x + "-" if hit else x, NEGATED if hit else 1.0)
    return Transducer(arcs)


def reported() -> Transducer:
    """State: whether the clause reports speech so far. A match in it gets the mark "~" in place of "-"."""
    arcs = {}
    for seen in (0, 1):
        for x in CLASSES:
            arcs[seen, x] = (1 if x == "reported" else seen, x, 1.0)
        for x in ("insult", "threat"):
            for mark in ("", "-"):
                arcs[seen, x + mark] = (seen, x + ("~" if seen else mark), QUOTED if seen else 1.0)
    return Transducer(arcs)


def aim() -> Transducer:
    """State: how many words a target still reaches, and an insult that waits for one. A match that a target reaches gets the mark
    "@", and so does a target that a waiting match reaches."""
    arcs = {}
    for target in range(REACH + 1):
        for waits in range(REACH + 1):
            state, fewer, less = target * (REACH + 1) + waits, max(0, target - 1), max(0, waits - 1)
            for x in ("negation", "reported", "other"):
                arcs[state, x] = (fewer * (REACH + 1) + less, x, 1.0)
            arcs[state, "target"] = (REACH * (REACH + 1), "target@" if waits else "target", 1.0)
            for x in ("insult", "threat"):
                for mark in ("", "-", "~"):
                    arcs[state, x + mark] = (fewer * (REACH + 1) + (0 if target else REACH), x + mark + ("@" if target else ""), AIMED if target else 1.0)
    return Transducer(arcs)


GRAMMAR = compose(compose(negation(), reported()), aim())


def _table(grammar: Transducer) -> list[list[tuple[int, tuple[int, ...], float]]]:
    """By state and class: next state, the features that the output counts in, and the weight. Of a match, first the manner's."""
    manner = {"": 2, "-": 3, "~": 4}
    states = 1 + max(p for p, _ in grammar.arcs)
    out = [[(0, (), 0.0)] * len(CLASSES) for _ in range(states)]
    for (p, x), (q, y, w) in grammar.arcs.items():
        kind, mark = y.rstrip("-~@"), y[len(y.rstrip("-~@")) :]
        counted: tuple[int, ...] = ()
        if kind in ("insult", "threat"):
            counted = (manner[mark.rstrip("@")], *((5,) if "@" in mark else ()), *((6,) if kind == "threat" else ()))
        elif mark:
            counted = (5,)
        out[p][CLASSES.index(x)] = (q, counted, w)
    return out


_TABLE = _table(GRAMMAR)
_OTHER = (CLASSES.index("other"), 0.0)


class WordTransducer:
    """A trie over code points. A state may end a stem (any word that begins with it) or a whole word, each with a class and a weight;
    of an insult the greatest weight counts, and a word that is an insult is nothing else."""

    def __init__(self, lexicon: dict[str, float]):
        self.arcs: dict[tuple[int, str], int] = {}
        self.stems: dict[int, tuple[int, float]] = {}
        self.whole: dict[int, tuple[int, float]] = {}
        for name, words in (("reported", REPORTED), ("negation", NEGATION), ("target", TARGET), ("threat", THREAT)):
            for w in " ".join(words.values()).split():
                self._add(self.whole, w, (CLASSES.index(name), 1.0))
        for stem, weight in lexicon.items():
            if weight > 0:
                self._add(self.whole if stem.endswith("$") else self.stems, stem.rstrip("$"), (0, weight))

    def _add(self, ends: dict[int, tuple[int, float]], word: str, end: tuple[int, float]) -> None:
        state = 0
        for c in word:
            state = self.arcs.setdefault((state, c), len(self.arcs) + 1)
        ends[state] = end

    def read(self, word: str) -> tuple[int, float]:
        """Class and weight of a word."""
        state, best = 0, None
        for c in word:
            state = self.arcs.get((state, c))
            if state is None:
                break
            if state in self.stems and (best is None or self.stems[state][1] > best[1]):
                best = self.stems[state]
        else:
            end = self.whole.get(state)
            if end and (best is None or (end[0] == 0 and end[1] > best[1])):
                best = end
        return best or _OTHER


@dataclass
class ToxicityModel:
    """Insult stems with weights, and the logistic model: bias and one weight per feature."""

    lexicon: dict[str, float]
    bias: float = -3.0
    weights: list[float] = field(default_factory=lambda: [2.0] + [0.0] * (len(FEATURES) - 1))

    def __post_init__(self):
        self.words = WordTransducer(self.lexicon)
        self._seen: dict[str, tuple[int, float]] = {}

    def read(self, word: str) -> tuple[int, float]:
        got = self._seen.get(word)
        if got is None:
            if len(self._seen) > 50_000:
                self._seen.clear()
            got = self._seen[word] = self.words.read(word)
        return got

    def clause(self, words: list[str], total: list[float]) -> None:
        """Adds one clause's matches to the features."""
        state, score = 0, 0.0
        for w in words:
            kind, weight = self.read(w)
            state, counted, arc = _TABLE[state][kind]
            if counted:
                if kind < 2:
                    score += weight * arc
                    total[counted[0]] += weight
                    counted = counted[1:]
                for k in counted:
                    total[k] += 1.0
        total[0] += score
        total[1] = max(total[1], score)

    def features(self, text: str | None) -> list[float]:
        total = [0.0] * len(FEATURES)
        if text:
            text = text.lower()
            # clauses are looked at only where some word can start a match
            if any(self.read(w)[0] < 2 for w in set(tokens(text))):
                for part in _CLAUSE.split(text):
                    words = [w for w in tokens(part) if w]
                    if words:
                        self.clause(words, total)
        return total

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + np.log1p(features) @ np.array(self.weights), -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> tuple[float, list[float]]:
    """Logistic regression on log(1 + features) by Newton steps, with a ridge."""
    a = np.column_stack([np.ones(len(x)), np.log1p(x)])
    b = np.zeros(a.shape[1])
    penalty = ridge * np.eye(len(b))
    penalty[0, 0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty, a.T @ (y - p) - penalty @ b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(b[0]), b[1:].tolist()


def _stem_counts(wanted: frozenset[str] | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                own = {s for w in set(tokens((text or "").lower())) if w for s in stems(w)}
                seen.update(own if wanted is None else own & wanted)
                if len(seen) > 200_000:
                    yield batch_of(seen)
                    seen = Counter()
        if seen:
            yield batch_of(seen)

    def batch_of(seen: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], ["stem", "n"])

    return releasing(count)


def specific(lexicon: dict[str, float], toxic: dict[str, int], more: float = 1.1) -> dict[str, float]:
    """Without the prefixes that stand for one longer stem or word alone: a prefix stays if it is in ``more`` times as many toxic
    documents as each stem that it begins, so that other words of the lexicon's roots are found, but not words that only begin alike."""
    most: dict[str, int] = {}
    kept = {}
    for s in sorted(lexicon, key=lambda s: (-len(s.rstrip("$")), not s.endswith("$"), s)):
        word = s.rstrip("$")
        n = max(0 if s.endswith("$") else most.get(word, 0), most.get(word + " ", 0))
        if toxic[s] >= more * n:
            kept[s] = lexicon[s]
        if s.endswith("$"):
            most[word] = max(most.get(word, 0), toxic[s])
        for k in STEM_LENGTHS:
            if len(word) > k:
                most[word[:k] + " "] = max(most.get(word[:k] + " ", 0), toxic[s])
    return kept


def train(documents: DataFrame, labels: DataFrame, max_rows: int = 30_000, max_chars: int = 200_000_000, alpha: float = 0.05, purity: float = 0.5) -> ToxicityModel:
    """Learns from labelled rows outside the held-out remainder: at most about ``max_rows`` of them, and of their ``max_chars``
    characters (a documented bound of the fit, by a hash of the id; scoring covers everything).

    A stem enters the lexicon if toxic documents hold it more often than chance explains (binomial tail against the share of toxic
    documents, at level ``alpha`` over all candidate stems) and most that hold it (``purity``) are toxic. Its weight is the log odds. Null labels, ids and texts teach nothing;
    several labels of one id count as toxic if one is. Without toxic or without clean rows the lexicon is the fixed insults alone.
    """
    spark = documents.sparkSession
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (bucket(F.col("doc_id")) != 2)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n = known.count()
    part = min(1.0, max_rows / n) if n else 1.0
    known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < max(1, int(part * 1_000_000)))
    rows = written(documents.select("doc_id", "text").filter("text is not null").join(known, "doc_id"), "toxicity-sample")
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("c"), F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if size["c"] > max_chars:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("chars")), F.lit(1_000_000)) < max(1, int(1_000_000 * max_chars / size["c"])))
        size = rows.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    n_toxic, n_all = size["t"] or 0, size["n"]
    n_clean = n_all - n_toxic
    fixed = [w + "$" for words in INSULTS.values() for w in words.split()]
    if not n_toxic or not n_clean:
        return ToxicityModel(dict.fromkeys(fixed, PRIOR))
    counts = lambda toxic, wanted: rows.filter(F.col("toxic") == toxic).select("text").mapInArrow(_stem_counts(wanted), "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))
    least = max(3, n_toxic // 500)
    toxic = {r["stem"]: r["n"] for r in counts(1, None).filter(F.col("n") >= least).collect()}
    clean = {r["stem"]: r["n"] for r in counts(0, frozenset([*toxic, *fixed])).collect()}
    base = n_toxic / n_all
    lexicon: dict[str, float] = {}
    for s, t in toxic.items():
        c = clean.get(s, 0)
        q = t / (t + c)
        if q > max(purity, base):
            tail = t * np.log(q / base) + (c * np.log((1 - q) / (1 - base)) if c else 0.0)
            if tail > np.log(len(toxic) / alpha):
                lexicon[s] = float(np.log((t + 0.5) / (n_toxic + 1)) - np.log((c + 0.5) / (n_clean + 1)))
    # a fixed insult stays while the labelled rows that hold it are toxic no less often than others
    kept = {s: PRIOR for s in fixed if clean.get(s, 0) * base <= toxic.get(s, 0) * (1 - base) + 1}
    lexicon = kept | specific(lexicon, toxic)
    model = ToxicityModel(lexicon)
    shared = spark.sparkContext.broadcast(lexicon)
    found = rows.select("text", "toxic").mapInArrow(_features(shared), f"toxic int, {', '.join(f'{f} double' for f in FEATURES)}").toPandas()
    shared.destroy()
    model.bias, model.weights = _fit(found[list(FEATURES)].to_numpy(), found["toxic"].to_numpy(float))
    return model


def _features(lexicon):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ToxicityModel(lexicon.value)
        for batch in batches:
            x = np.array([model.features(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(c) for c in x.T)], ["toxic", *FEATURES])

    return emit


def score(documents: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """``documents`` with score (0 to 1) and predicted (1 from ``threshold`` on). Only the text is looked at, whole; null and empty
    texts get the score of a text without matches. Columns of the two names are replaced. No shuffle."""
    shared = documents.sparkSession.sparkContext.broadcast((model.lexicon, model.bias, model.weights))

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = ToxicityModel(*shared.value)
        for t in texts:
            x = np.array([own.features(v) for v in t.tolist()]).reshape(-1, len(FEATURES))
            yield pd.Series(own.scores(x))
        del own
        release()

    out = documents.drop("score", "predicted").withColumn("score", scored(F.col("text")))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
